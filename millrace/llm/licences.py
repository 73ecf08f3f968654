"""License scans: canonical digest lookup of whole texts and of single lines.

A text is brought to a canonical form (case, copyright lines, punctuation, white
space, equivalent spellings), digested, and looked up among the digests of known
licences. Both sides go through the same expressions, so two texts share a digest
exactly if their canonical forms are equal.
"""

import re
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name, replaced, without
from millrace.llm.licence_texts import MORE_NOTICES, NOTICES, SPELLINGS, known_forms

# Lines that name a holder, not a condition. Java's and RE2's syntax alike.
COPYRIGHT_LINE = (
    r"(?:^|\n)[ \t*#/;.-]*"
    r"(?:copyright[ \t:]*(?:\(c\)|\x{a9}|[0-9]{4}|[<\[{])|\(c\)[ \t]*[0-9]{4}|\x{a9}|all rights reserved)"
    r"[^\n]*"
)
# ASCII but letters and digits, and the punctuation and spaces of other blocks.
BETWEEN_WORDS = (
    r"[\x00-\x2f\x3a-\x60\x7b-\x7f\x{80}-\x{bf}\x{2000}-\x{206f}\x{3000}-\x{3003}\x{feff}]+"
)
# Lines of a lower-case text that name a holder in any usual order, not those of a
# licence's own sentences. '(c)' without a year may be a list item and stays.
HOLDER_LINE = (
    r"(?:^|\n)[ \t*#/;.-]*"
    r"(?:\(c\)[ \t,:]*(?:copyright\b|[^\n]*\b(?:19|20)[0-9]{2}\b)"
    r"|copyright\b(?![ \t]*(?:notices?|holders?|owners?|licen[cs]es?|laws?|and|or|on|in|of|to|for|is|are|as|that|which|"
    r"statements?|interests?|rights?|protection|treaty|treaties|ownership|disclaimers?|status|permission|information|infringement)\b)"
    r"(?=[^\n]*[a-z0-9]))"
    r"[^\n]*"
)
BETWEEN_WORDS_OF_LINE = BETWEEN_WORDS.replace(r"\x00-\x2f", r"\x00-\x09\x0b-\x2f")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """The canonical form; the empty text for null."""
    out = F.regexp_replace(lowered(text), COPYRIGHT_LINE, "\n")
    out = F.trim(F.regexp_replace(out, BETWEEN_WORDS, " "))
    return replaced(out, SPELLINGS)


def lowered(text: Column) -> Column:
    """With A-Z lowered and one kind of line end; the empty text for null."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return replaced(out, [("\r\n", "\n"), ("\r", "\n")])


def without_holders(text: Column) -> Column:
    """The lowered text without the lines that name a holder."""
    return F.regexp_replace(lowered(text), HOLDER_LINE, "\n")


def _python(pattern: str) -> str:
    return re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), pattern)


def lowered_of(text: str) -> str:
    return text.translate(str.maketrans(UPPER, LOWER)).replace("\r\n", "\n").replace("\r", "\n")


def canonical_of(text: str) -> str:
    """The canonical form of a constant, without Spark."""
    out = re.sub(_python(BETWEEN_WORDS), " ", re.sub(_python(COPYRIGHT_LINE), "\n", lowered_of(text))).strip(" ")
    for a, b in SPELLINGS:
        out = out.replace(a, b)
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def digested(known: DataFrame) -> DataFrame:
    """(license_id, whole, bare): digests of texts, and of texts without holder lines."""
    forms = [F.nullif(canonical(t), F.lit("")) for t in (F.col("text"), without_holders(F.col("text")))]
    return known.select("license_id", *[F.sha2(f.cast("binary"), 256).alias(n) for f, n in zip(forms, ("whole", "bare"), strict=True)])


def known_licences(spark: SparkSession) -> DataFrame:
    """The digests of all known licences, worked out here: the plan holds no texts."""
    rows = []
    for i, text in known_forms():
        forms = canonical_of(text), canonical_of(re.sub(HOLDER_LINE, "\n", lowered_of(text)))
        rows.append((i, *(sha256(f.encode()).hexdigest() for f in forms)))
    each = [F.struct(*[F.lit(x).alias(n) for x, n in zip(r, ("license_id", "whole", "bare"), strict=True)]) for r in dict.fromkeys(rows)]
    return spark.range(1).select(F.inline(F.array(*each)))


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with ``digest`` and ``license_id``.

    ``known``: license_id and text, or the digests of digested(); Spark broadcasts them if
    its size check allows, else both sides shuffle by digest. A text that isn't known by its digest is
    looked up without the lines that name a holder. ``license_id`` is null where nothing
    matches; of several licences with one canonical form the smallest id is given.
    A text that is null, empty or without words has the digest of the empty text
    and matches nothing. Repeated rows stay; columns called digest or license_id
    are replaced.
    """

    digests = digested(known) if "text" in known.columns else known

    def by(form: str, name: str, found: str) -> DataFrame:
        forms = digests.where(F.col(form).isNotNull()).select(F.col(form).alias(name), "license_id")
        return forms.groupBy(name).agg(F.min("license_id").alias(found))

    # only a text with one of these can have a line that names a holder
    own = lowered(F.col(text))
    bare = F.when(own.contains("copyright") | own.contains("(c)"), without_holders(F.col(text)))
    other = F.when(bare != own, digest(bare))
    other_digest, other_id = (free_name(x, docs.columns) for x in ("bare", "other"))
    rows = without(docs, ["digest", "license_id"])
    looked = rows.select(digest(F.col(text)).alias("digest"), "*", other.alias(other_digest))
    whole = by("whole", "digest", "license_id")
    stripped = by("bare", other_digest, other_id)
    met = looked.join(whole, "digest", "left").join(stripped, other_digest, "left")
    return met.withColumn("license_id", F.coalesce("license_id", other_id)).drop(other_digest, other_id)


def notices(text: Column, known: list[tuple[str, str]] = [*NOTICES, *MORE_NOTICES]) -> Column:
    """Ids of the licences that single lines name: sorted, joined by commas; else ''.

    A line is a notice if their canonical forms are equal. ``known`` is written into the
    plan, so it is a list of notices, not a table.
    """
    out = F.regexp_replace(lowered(text), COPYRIGHT_LINE, "\n")
    # The canonical form of each line: as of a text, but line ends stay.
    out = replaced(F.regexp_replace(out, BETWEEN_WORDS_OF_LINE, " "), [(" \n", "\n"), ("\n ", "\n")])
    lines = F.split(replaced(F.trim(out), SPELLINGS), "\n", -1)
    ids: dict[str, list[str]] = {}
    for i, t in known:
        if form := canonical_of(t):
            ids.setdefault(form, []).append(i)
    if not ids:
        return F.lit("")
    table = F.create_map(*[x for form, of in ids.items() for x in (F.lit(form), F.array(*map(F.lit, of)))])
    named = F.transform(F.array_intersect(lines, F.map_keys(table)), lambda x: F.element_at(table, x))
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(named))), ",")
