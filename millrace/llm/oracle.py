"""DuckDB SQL of the queries that SQL can express."""

from hashlib import sha256

from millrace.llm.licence_texts import MORE_NOTICES, NOTICES, SPELLINGS, known_forms
from millrace.llm.licences import BETWEEN_WORDS, COPYRIGHT_LINE, LOWER, UPPER, canonical_of
from millrace.llm.mixing import MOST_TIMES, WEIGHTS
from millrace.llm.queries import SHARDS, SLOTS
from millrace.llm.warc import ALPHABET


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    out = f"replace(replace(translate({text}, '{UPPER}', '{LOWER}'), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    out = f"regexp_replace({out}, {_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    out = f"trim(regexp_replace({out}, {_text(BETWEEN_WORDS)}, ' ', 'g'))"
    for a, b in SPELLINGS:
        out = f"replace({out}, {_text(a)}, {_text(b)})"
    return out


def _digests(pairs: list[tuple[str, str]]) -> str:
    """Ids and digests of texts, worked out in plain Python."""
    return ", ".join(f"({_text(i)}, '{sha256(canonical_of(t).encode()).hexdigest()}')" for i, t in pairs)


_LINES = "string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"

LICENSES = f"""
WITH known AS (
  SELECT digest, min(i) AS license_id FROM (VALUES {_digests(known_forms())}) v(i, digest) GROUP BY 1
), notice AS (
  SELECT * FROM (VALUES {_digests([*NOTICES, *MORE_NOTICES])}) v(i, digest)
), docs AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), line AS (
  SELECT r, unnest({_LINES}) AS l FROM docs
), named AS (
  SELECT r, string_agg(DISTINCT i, ',' ORDER BY i) AS notices
  FROM line JOIN notice ON notice.digest = sha256({_canonical("l")}) GROUP BY 1
), digested AS (
  SELECT doc_id, r, sha256({_canonical("text")}) AS digest FROM docs
)
SELECT doc_id, digest, license_id, coalesce(notices, '') AS notices
FROM digested LEFT JOIN known USING (digest) LEFT JOIN named USING (r)
"""

_ESCAPES = r"""len(regexp_extract_all({0}, '\\|<\||</?s>|<</?SYS>>|\[/?INST\]'))"""

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len("<|turn|>") + len("<|body|>") + len("<|end|>") + 1} + length(role) + length(text)
    + {_ESCAPES.format("role")} + {_ESCAPES.format("text")})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_BASE32 = " || ".join(
    f"substr('{ALPHABET}', ((('0x' || substr(h, {i}, 5))::BIGINT >> {s}) & 31) + 1, 1)" for i in range(1, 41, 5) for s in (15, 10, 5, 0)
)

WARC = f"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digested AS (SELECT page_id, payload_bytes, {_BASE32} AS payload_digest FROM hashed),
named AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digested)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM named
"""

SHARDING = f"""
WITH RECURSIVE shard AS (
  SELECT i, name, ('0x' || md5(name)[1:8])::BIGINT % {SLOTS} AS start,
         ('0x' || md5(name)[9:16])::BIGINT % {SLOTS - 1} + 1 AS step
  FROM (VALUES {", ".join(f"({i}::BIGINT, '{s}')" for i, s in enumerate(SHARDS))}) v(i, name)
), fill(turn, owner, slot, i) AS (
  SELECT 0::BIGINT, list_transform(range({SLOTS}), lambda x: (-1)::BIGINT), (-1)::BIGINT, (-1)::BIGINT
  UNION ALL
  SELECT turn + 1, owner[:free] || [i] || owner[free + 2:], free, i FROM (
    SELECT turn, owner, shard.i, list_filter(
      list_transform(range({SLOTS}), lambda j: (start + j * step) % {SLOTS}), lambda s: owner[s + 1] = -1)[1] AS free
    FROM fill JOIN shard ON shard.i = turn % {len(SHARDS)} WHERE turn < {SLOTS})
)
SELECT doc_id, fill.slot::INT AS slot, shard.name AS shard
FROM documents
JOIN fill ON turn > 0 AND fill.slot = ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT % {SLOTS}
JOIN shard USING (i)
"""

MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sized AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::BIGINT AS weight FROM sized
), summed AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS total, (sum(weight) OVER ())::BIGINT AS weights,
         coalesce(sum({MOST_TIMES} * source_size) OVER earlier, 0)::BIGINT AS capped, coalesce(sum(weight) OVER earlier, 0)::BIGINT AS gone
  FROM weighed WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT gone, (total - capped)::DOUBLE / (weights - gone)::DOUBLE AS level FROM summed
  WHERE (total - capped)::DOUBLE / (weights - gone)::DOUBLE * weight <= ({MOST_TIMES} * source_size)::DOUBLE
), rates AS (
  SELECT source, source_size, least((SELECT level FROM levels ORDER BY gone LIMIT 1) * weight, ({MOST_TIMES} * source_size)::DOUBLE) AS target
  FROM summed
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM rates
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT
    + (('0x' || md5('42:' || coalesce(doc_id::VARCHAR, ''))[1:12])::BIGINT / 281474976710656.0::DOUBLE < rate - floor(rate))::BIGINT) AS taken
FROM docs JOIN rated ON docs.source IS NOT DISTINCT FROM rated.source
"""

TOPK = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, piece, row_number() OVER () AS p FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), listed AS (
  SELECT lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), words AS (
  SELECT lang, p, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM listed
), totals AS (
  SELECT lang, count(*) AS n FROM words GROUP BY lang
), runs AS (
  SELECT lang, w AS w1, lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3, lead(w, 3) OVER s AS w4 FROM words
  WINDOW s AS (PARTITION BY lang, p ORDER BY i)
), counts AS (
  SELECT lang, [w1] AS words, count(*) AS f FROM runs GROUP BY ALL HAVING f >= 30
  UNION ALL SELECT lang, [w1, w2], count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 30
  UNION ALL SELECT lang, [w1, w2, w3], count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 30
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) AS f FROM runs WHERE w4 IS NOT NULL GROUP BY ALL HAVING f >= 30
), cuts AS (
  SELECT c.lang, c.words, c.f AS a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f::HUGEINT + r.f::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM counts WHERE len(words) > 1) c
  JOIN counts l ON l.lang = c.lang AND l.words = c.words[1:k]
  JOIN counts r ON r.lang = c.lang AND r.words = c.words[k + 1:]
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, f, words[i:j] AS words FROM (
    SELECT *, unnest(range(i + 1, len(words) + 1)) AS j FROM (SELECT *, unnest(range(1, len(words))) AS i FROM counts WHERE len(words) > 2)
  ) WHERE j - i + 1 < len(words)
), longer AS (
  SELECT lang, words, max(f) AS f FROM inner_parts GROUP BY ALL
)
SELECT lang, (row_number() OVER best)::BIGINT AS rank, array_to_string(w.words, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM weakest w JOIN totals USING (lang) LEFT JOIN longer d USING (lang, words)
WHERE d.f IS NULL OR 100::HUGEINT * d.f < 80::HUGEINT * a
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w.words, ' ')) QUALIFY rank <= 2000
"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id AND len(c.v) = len(a.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

LLM_ORACLE = {
    "op1_licenses": LICENSES,
    "op2_chat": CHAT,
    "op5_sharding": SHARDING,
    "op7_warc": WARC,
    "op8_mixing": MIXING,
    "op10_topk": TOPK,
    "op11_collocations": COLLOCATIONS,
    "op12_hard_negatives": HARD_NEGATIVES,
}
