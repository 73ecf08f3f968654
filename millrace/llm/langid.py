"""Language ID with language-bitmask n-gram filters.

One Bloom filter for each language, bit-sliced: position p holds a word whose bit l
says whether p is set in the filter of language l. A lookup ANDs the words at an
n-gram's positions and so returns all languages that contain it. Counts of those
bits, corrected for each filter's rate of false positives, decide.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.llm.common import without

# Labelled documents that training takes of each language, about.
SAMPLE = 4_000
# Positions of the filter, a power of two, and positions of each n-gram.
POSITIONS, PROBES = 1 << 20, 3
# An n-gram belongs to a language if it is at least so frequent in it, which bounds
# the n-grams of a language, and not rare in it against another language.
LEAST_RATE, LEAST_SHARE = 2e-5, 0.25
ORDERS = (3, 4)
# Code points that are looked at together: long texts go piece by piece, whole.
PIECE = 1 << 18
UNKNOWN = "und"


def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def spelled(text: str, is_letter: np.ndarray) -> np.ndarray:
    """Lower-case letters as code points, with a space for each run of anything else."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(is_letter[codes], codes, np.uint32(32))
    space = codes == 32
    return codes[np.r_[True, ~(space[1:] & space[:-1])]]


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of all n-grams, in pieces."""
    most = max(ORDERS)
    mix = np.uint64(0x9E3779B97F4A7C15)
    for start in range(0, len(codes), PIECE):
        for n in ORDERS:
            piece = codes[max(0, start - n + 1) : start + PIECE].astype(np.uint64)
            if len(piece) < n:
                continue
            h = np.zeros(len(piece) - n + 1, np.uint64)
            for i in range(n):
                h = (h ^ piece[i : len(piece) - n + 1 + i]) * mix
                h ^= h >> np.uint64(29)
            yield h * np.uint64(2) + np.uint64(n == most)


def probes(h: np.ndarray) -> list[np.ndarray]:
    """Positions of n-grams in the filter: parts of a hash of the hash."""
    g = (h ^ (h >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    width = np.uint64(POSITIONS.bit_length() - 1)
    return [((g >> (width * np.uint64(i))) & np.uint64(POSITIONS - 1)).astype(np.int64) for i in range(PROBES)]


class Filters:
    """What a prediction needs: a few MB, whatever the corpus."""

    def __init__(self, langs: list[str], words: np.ndarray, is_letter: np.ndarray, usual: int):
        self.langs, self.words, self.is_letter, self.usual = langs, words, is_letter, usual
        bits = np.unpackbits(words.view(np.uint8).reshape(POSITIONS, -1), axis=1, bitorder="little")
        self.wrong = (bits[:, : len(langs)].mean(axis=0)) ** PROBES

    def hits(self, h: np.ndarray) -> np.ndarray:
        first, *rest = probes(h)
        found = self.words[first]
        for p in rest:
            found = found & self.words[p]
        used = (len(self.langs) + 7) // 8
        each = np.unpackbits(found.view(np.uint8).reshape(len(h), -1)[:, :used], axis=1, bitorder="little")
        return each.sum(axis=0, dtype=np.int64)[: len(self.langs)]

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = spelled(text or "", self.is_letter)
        if not self.langs or not (codes != 32).any():
            return UNKNOWN, 0.0
        hits, n = np.zeros(len(self.langs)), 0
        for h in grams(codes):
            hits, n = hits + self.hits(h), n + len(h)
        true = np.maximum((hits - n * self.wrong) / (1 - self.wrong), 0)
        if not true.any():
            return self.langs[self.usual], 0.0
        best = int(true.argmax())
        return self.langs[best], float(true[best] / true.sum())


def sample(labelled: DataFrame, key: str, lang: str, most: int) -> DataFrame:
    """About ``most`` rows of each language, chosen by a hash of the key."""
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}  # a row for each language
    if not sizes:
        return labelled.limit(0)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, most / n)))])
    part = F.crc32(F.concat(F.lit("sample:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")) / 2.0**32
    return labelled.where(part < F.element_at(share, F.col(lang)))


def counted(is_letter):
    """Counts of n-grams by language, a batch at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = is_letter.value
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, []).extend(grams(spelled(text, table)))
            for lang, parts in found.items():
                if parts:
                    h, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(h)), pa.array(h.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                    )

    return count


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = SAMPLE) -> Filters:
    """Filters from labelled rows; rows with null text or language teach nothing.

    Reads about ``most`` whole texts of each language; what comes to the driver is
    bounded by LEAST_RATE: at most 1 / LEAST_RATE n-grams of each language.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    is_letter = letters()
    taught = sample(rows, key, lang, most).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    each = taught.mapInArrow(counted(spark.sparkContext.broadcast(is_letter)), "lang string, gram long, n long")
    by_gram = each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r[0]: r[1] for r in by_gram.groupBy("lang").agg(F.sum("n")).collect()}
    langs = sorted(totals)
    words = np.zeros((POSITIONS, (len(langs) + 63) // 64 or 1), np.uint64)
    if langs:
        total = F.create_map(*[x for k, n in totals.items() for x in (F.lit(k), F.lit(float(n)))])
        rated = by_gram.withColumn("rate", F.col("n") / F.element_at(total, F.col("lang")))
        top = rated.where(F.col("rate") >= LEAST_RATE)
        best = top.groupBy("gram").agg(F.max("rate").alias("best"))
        kept = top.join(best, "gram").where(F.col("rate") >= LEAST_SHARE * F.col("best")).select("lang", "gram").toArrow()
        of = {k: i for i, k in enumerate(langs)}
        number = np.array([of[k] for k in kept["lang"].to_pylist()], np.int64)
        for p in probes(kept["gram"].to_numpy().view(np.uint64)):
            np.bitwise_or.at(words, (p, number // 64), np.uint64(1) << (number % 64).astype(np.uint64))
    usual = max(range(len(langs)), key=lambda i: totals[langs[i]], default=0)
    return Filters(langs, words, is_letter, usual)


def identify(docs: DataFrame, filters: Filters, text: str = "text", keep: Iterable[str] | None = None) -> DataFrame:
    """Each row's columns (``keep``, or all) with lang_pred and score.

    ``lang_pred`` is a learned language, or ``und`` if the text is null or has no
    letters or nothing was learned. ``score`` is the language's share of all
    languages' corrected counts; it is 0 for ``und`` and where no n-gram is known,
    which gives the language seen most. Equal counts go to the first language.
    Columns called lang_pred or score are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(filters)
    rows = without(docs, ["lang_pred", "score"])
    kept = rows.columns if keep is None else list(keep)
    schema = rows.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = held.value
        for batch in batches:
            got = [f.predict(x.as_py()) for x in batch.column(0)]
            found = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], [f"c{i}" for i in range(len(kept) + 2)])

    names = [f"c{i}" for i in range(len(kept))]
    source = rows.select(F.col(text).alias("t"), *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)])
    plain = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])
    return source.mapInArrow(each, plain).toDF(*schema.names)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def learned(docs: DataFrame) -> Filters:
    """Filters from the documents that aren't held out; a null doc_id isn't held out."""
    return train(docs.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
