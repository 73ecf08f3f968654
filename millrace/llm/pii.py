"""Personal data, and the terms that give it away.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Hiding these
is not enough where the words beside one point to it all the same. How strongly a
term reveals an entity is estimated from the corpus: the entity has the information
IC = log2(D / n(c)), and a term next to it reveals PMI = log2(n(c,t) D / (n(c) n(t)))
of it, where n counts documents and n(c,t) those with the term near a mention of the
entity. A term that reveals a given share of IC is disclosed: it is generalised to its
class, or removed if the class reveals as much.
"""

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import staged
from millrace.llm.simhash import mark

KINDS = ("email", "ip", "card", "phone")
GENERALISE, REMOVE = "generalise", "remove"

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"\w+")

# Terms on either side of a mention that count as near it.
NEAR = 8
# Documents in which a term must be near an entity, and the share of the entity's
# information from which it is disclosed.
SUPPORT, SHARE = 2, 2 / 3
# Leading letters that name the class of a longer word.
STEM = 3
# Different terms that a task counts at once before it hands on what it has.
HELD_TERMS = 500_000

Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is looked at once: what may stand before it ends at the match or @ before."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(LOCAL))
        end = at + 1
        if start < at and (found := DOMAIN.match(text, at)):
            end = found.end()
            yield start, end
        at = text.find("@", end)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of numbers and dots, cut into fours from the left."""
    for run in DOTTED.finditer(text):
        at, parts = run.start(), run[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            # compared as text: a number of a million digits is no int
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in NUMBER.finditer(text):
        digits = digits_of(run[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for run in PHONE.finditer(text):
        if 8 <= len(digits_of(run[0])) <= 15:
            yield run.span()


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by kind and start."""
    finders = (emails, addresses, cards, phones)
    return [(kind, *span) for kind, find in enumerate(finders) for span in find(text)]


def number(kind: str, text: str) -> int:
    """64 bits that stand for an entity, a term or a class."""
    n = xxhash.xxh3_64_intdigest(f"{kind}:{text}".encode("utf-8", "surrogatepass"))
    return n - (1 << 64) if n >> 63 else n


def entity(kind: int, text: str) -> int:
    """Mentions that differ in case or in how digits are set apart are one entity."""
    if kind == 0:
        return number("email", text.lower())
    if kind == 1:
        return number("ip", ".".join(p.lstrip("0") for p in text.split(".")))
    return number(KINDS[kind], digits_of(text))


def wider(term: str) -> str:
    """The class of a term: numbers of as many digits, words that begin alike, short words."""
    if term.isdigit():
        return f"#{len(term)}"
    return f"{term[:STEM]}*" if len(term) > STEM else "*"


def covered(spans: list[Span]) -> list[list[int]]:
    """[start, end) of the parts of a text that spans cover, in order."""
    out: list[list[int]] = []
    for start, end in sorted(s[1:] for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def terms_outside(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """The terms of a text that no span touches."""
    hidden, out, i = covered(spans), [], 0
    for term in TERM.finditer(text):
        start, end = term.span()
        while i < len(hidden) and hidden[i][1] <= start:
            i += 1
        if i == len(hidden) or hidden[i][0] >= end:
            out.append((start, end))
    return out


def near(text: str, spans: list[Span], reach: int) -> list[dict]:
    """For each entity and term near one of its mentions: their numbers, and the term's places."""
    terms = terms_outside(text, spans)
    starts = [t[0] for t in terms]
    found: dict[tuple[int, int], set[int]] = {}
    for kind, start, end in spans:
        at = bisect_left(starts, start)
        who = entity(kind, text[start:end])
        for i in range(max(0, at - reach), min(len(terms), at + reach)):
            found.setdefault((who, i), set())
    out: dict[tuple[int, int], dict] = {}
    for who, i in sorted(found):
        term = text[slice(*terms[i])].lower()
        key = number("term", term)
        row = out.setdefault((who, key), {"entity": who, "term": key, "wide": number("class", wider(term)), "places": []})
        row["places"] += terms[i]
    return list(out.values())


PLACE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
NEAR_TERM = pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("wide", pa.int64()), ("places", pa.list_(pa.int32()))])


def mentions(docs: DataFrame, key: str, text: str, reach: int = NEAR) -> DataFrame:
    """(id, mark, base, entities, near), a row for each row of ``docs``, without the texts."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, who, beside = [], [], []
            for t in batch.column(2):
                t = t.as_py() or ""
                spans = base_spans(t)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                who.append(sorted({entity(s[0], t[s[1] : s[2]]) for s in spans}))
                beside.append(near(t, spans, reach) if spans else [])
            arrays = [pa.array(base, pa.list_(PLACE)), pa.array(who, pa.list_(pa.int64())), pa.array(beside, pa.list_(NEAR_TERM))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["id", "mark", "base", "entities", "near"])

    rows = docs.select(F.col(key).alias("id"), mark(text).alias("mark"), F.col(text).alias("text"))
    return rows.mapInArrow(
        each,
        f"id {kind}, mark long, base array<struct<kind:int,start:int,end:int>>, entities array<long>, "
        "near array<struct<entity:long,term:long,wide:long,places:array<int>>>",
    )


def frequencies(docs: DataFrame, text: str) -> DataFrame:
    """(of, n): the number of documents that have a term, or a term of a class."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, classes = Counter(), Counter()

        def counted() -> pa.RecordBatch:
            keys = [number("term", t) for t in terms] + [number("class", c) for c in classes]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([*terms.values(), *classes.values()], pa.int64())], ["of", "n"]
            )

        for batch in batches:
            for t in batch.column(0):
                own = {w.lower() for w in set(TERM.findall(t.as_py() or ""))}
                terms.update(own)
                classes.update(set(map(wider, own)))
                if len(terms) + len(classes) > HELD_TERMS:
                    yield counted()
                    terms.clear()
                    classes.clear()
        yield counted()

    return docs.select(text).mapInArrow(each, "of long, n long").groupBy("of").agg(F.sum("n").alias("n"))


def disclosing(found: DataFrame, often: DataFrame, documents: int, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """(entity, term, action) of the terms that reveal an entity.

    ``found`` is from mentions(), ``often`` from frequencies(). Counts join by entity,
    term and class; each is a row for one key, so that a frequent one is no heavy key.
    """
    beside = found.select(F.explode("near").alias("x")).select("x.entity", "x.term", "x.wide")
    classes = found.select(F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"], x["wide"])))).alias("x"))
    entities = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_c"))
    # An entity that all documents mention is no secret, and one below the support has no terms.
    secret = entities.where((F.col("n_c") >= support) & (F.col("n_c") < documents))

    def reveals(both: str, own: str):
        information = F.log2(F.lit(float(documents)) / F.col("n_c"))
        shown = F.log2(F.col(both) * F.lit(float(documents)) / (F.col("n_c") * F.col(own)))
        # equal but for rounding is enough
        return shown >= share * information - 1e-9

    def count_of(name: str) -> DataFrame:
        return often.select(F.col("of").alias(name), F.col("n").alias(f"n_{name}"))

    pairs = beside.groupBy("entity", "term").agg(F.count("*").alias("n_ct"), F.min("wide").alias("wide")).where(F.col("n_ct") >= support)
    told = pairs.join(secret, "entity").join(count_of("term"), "term").where(reveals("n_ct", "n_term"))
    wide_pairs = classes.groupBy("x.entity", "x.wide").agg(F.count("*").alias("n_cg"))
    both = told.join(wide_pairs, ["entity", "wide"]).join(count_of("wide"), "wide")
    action = F.when(reveals("n_cg", "n_wide"), REMOVE).otherwise(GENERALISE)
    return both.select("entity", "term", action.alias("action"))


def spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = NEAR, support: int = SUPPORT, share: float = SHARE
) -> DataFrame:
    """(id, mark, base, added), a row for each row of ``docs``.

    ``base`` lists (kind, start, end) of personal data by kind and start; ``added`` lists
    (action, start, end) of the terms near it that disclose it, by action and start.
    Places are code points, the end exclusive. Null texts count as empty and have no
    spans, as do texts without personal data, whatever terms they have. Each row counts
    as a document, copies and rows with a null key too; rows of one key and text have
    the same spans. ``mark`` is a hash of the text that tells rows of one key apart.
    """
    found = staged(mentions(docs, key, text, reach), "mentions")
    chosen = disclosing(found, frequencies(docs, text), found.count(), support, share)
    beside = found.select("id", "mark", F.explode("near").alias("x")).select("id", "mark", "x.entity", "x.term", "x.places")
    # places are pairs of start and end, one after another
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("places") - 2, F.lit(2)),
        lambda i: F.struct(F.get("places", i).alias("start"), F.get("places", i + 1).alias("end")),
    )
    told = beside.join(chosen, ["entity", "term"]).select("id", "mark", "action", F.inline(pairs))
    # a term near two entities is removed if one of them asks for that
    place = told.groupBy("id", "mark", "start", "end").agg(F.max("action").alias("action"))
    added = place.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.sort_array(F.collect_list(F.struct("action", "start", "end"))).alias("added")
    )
    own = (F.col("id").eqNullSafe(F.col("_id"))) & (F.col("mark") == F.col("_mark"))
    none = F.array().cast("array<struct<action:string,start:int,end:int>>")
    kind = F.array(*map(F.lit, KINDS))
    base = F.transform("base", lambda x: F.struct(F.element_at(kind, x["kind"] + 1).alias("kind"), x["start"], x["end"]))
    return found.join(added, own, "left").select("id", "mark", base.alias("base"), F.coalesce("added", none).alias("added"))


def written(places: Column, kind: str) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(places, lambda x: F.concat_ws(":", x[kind], x["start"], x["end"])), ",")


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """All rows and columns of ``docs`` with ``sanitised``, a text without what spans() finds.

    Personal data becomes its kind in brackets, a generalised term its class in brackets,
    and a removed term goes. A null text stays null. A column called sanitised is replaced.
    """
    found = spans(docs, key, text, **how)
    columns = [c for c in docs.columns if c.lower() != "sanitised"]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"), F.col(key).alias("key"), mark(text).alias("own"), F.col(text).alias("text"))
    one = found.dropDuplicates(["id", "mark"])
    met = rows.join(one, F.col("key").eqNullSafe(F.col("id")) & (F.col("own") == F.col("mark")))
    whole = F.concat(
        F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))),
        F.transform("added", lambda x: F.struct(x["action"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))),
    )
    schema = StructType().add("row", rows.schema["row"].dataType).add("sanitised", "string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else hidden(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "sanitised"])

    plain = met.select("row", "text", whole.alias("places"))
    return plain.mapInArrow(each, schema).select("row.*", "sanitised")


def hidden(text: str, places: list[dict]) -> str:
    """The text with its places replaced; of places that overlap the first counts for all."""
    out, end = [], 0
    for p in sorted(places, key=lambda p: (p["start"], -p["end"])):
        if p["start"] < end:
            end = max(end, p["end"])
            continue
        out.append(text[end : p["start"]])
        if p["kind"] == GENERALISE:
            out.append(f"[{wider(text[p['start'] : p['end']].lower())}]")
        elif p["kind"] != REMOVE:
            out.append(f"[{p['kind'].upper()}]")
        end = p["end"]
    return "".join([*out, text[end:]])
