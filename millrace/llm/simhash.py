"""SimHash near-duplicates, compared bit-sliced.

A fingerprint is the bitwise majority of the hashes of a text's shingles. Two that
differ in at most RADIUS bits agree in two of four blocks of 16 bits, so they meet
under one of six keys. Under a key, fingerprints stand as vertical bit planes: one
machine word holds one bit of 64 fingerprints, and a carry-save counter of two bits
adds up differences of many pairs at once. A block is left when all its pairs
exceed the radius.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.components import components

RADIUS = 2
SEED = 42
# Fingerprints of one key that a task compares at once; larger keys are cut into
# tiles, and every pair of tiles is compared.
TILE = 4096
# Small keys are compared together in packs of this size.
PACK = 256
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(text: bytes, words: int) -> list[bytes]:
    """The text's word shingles, repeats included.

    Only A-Z are lowered, and words end at ASCII white space; fewer words than a
    shingle has are one shingle, no words give none.
    """
    parts = text.lower().split()
    if not parts:
        return []
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(parts) - words + 1)
    return [line[i:j] for i, j in zip(starts[:n].tolist(), ends[len(parts) - n :].tolist(), strict=True)]


def fingerprint(text: bytes, words: int) -> bytes:
    """Of the text's word shingles, repeats included; eight bytes, the high one first.

    No words give zero.
    """
    spans = shingles(text, words)
    if not spans:
        return bytes(8)
    n = len(spans)
    hashes = b"".join([xxhash.xxh64_digest(s, SEED) for s in spans])
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 19):
        part = np.frombuffer(hashes[i : i + (1 << 19)], np.uint8)
        bits += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return np.packbits(bits * 2 > n).tobytes()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """(key, mark, fp), a row for each row; null texts count as empty.

    ``mark`` is a hash of the whole text, which tells rows of one key apart.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (x.as_py() or b"" for x in batch.column(1).cast(pa.binary()))
            got = np.frombuffer(b"".join([fingerprint(t, words) for t in texts]), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got)], [key, "mark", "fp"])

    rows = docs.select(key, text, mark(text).alias("mark"))
    return rows.mapInArrow(each, f"`{key}` {dict(docs.dtypes)[key]}, mark long, fp long")


def mark(text: str) -> Column:
    return F.xxhash64(F.lit("mark"), F.coalesce(F.col(text), F.lit("")))


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a word."""
    lanes = -len(fps) % 64
    bits = np.unpackbits(np.pad(fps, (0, lanes)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near(queries: np.ndarray, upright: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, lane) of the pairs that differ in at most RADIUS (2) bits."""
    asked = np.arange(len(queries))
    shape = (len(queries), upright.shape[1])
    ones, twos, over = (np.zeros(shape, np.uint64) for _ in range(3))
    if lanes % 64:
        over[:, -1] = ALL << np.uint64(lanes % 64)
    for b in range(64):
        bit = (queries[asked] >> np.uint64(b)) & np.uint64(1)
        diff = upright[b][None, :] ^ (np.uint64(0) - bit)[:, None]
        carry = ones & diff
        ones ^= diff
        over |= twos & (carry | ones)
        twos |= carry
        if b % 8 == 7:
            left = (over != ALL).any(axis=1)
            if not left.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if left.mean() < 0.5:
                asked, ones, twos, over = asked[left], ones[left], twos[left], over[left]
    hit = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")
    q, lane = hit.nonzero()
    return asked[q], lane


def forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, its root) that join all of ``fps`` within the radius of another.

    Fewer links than fingerprints, however many pairs are near.
    """
    label = np.arange(len(fps))
    unsigned, upright = fps.view(np.uint64), planes(fps)
    for i in range(0, len(fps), PACK):
        q, lane = near(unsigned[i : i + PACK], upright, len(fps))
        q = q + i
        q, lane = q[lane > q], lane[lane > q]
        while True:
            low = np.minimum(label[q], label[lane])
            new = label.copy()
            for at in (q, lane, label[q], label[lane]):
                np.minimum.at(new, at, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    while (label[label] != label).any():
        label = label[label]
    linked = (label != np.arange(len(fps))) & (fps[label] != fps)
    return fps[linked], fps[label[linked]]


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows (k, i, j, fp) in the order of (k, i, j)."""

    def out(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = forest(fps)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held = np.zeros((0, 4), np.int64)
    pack: list[np.ndarray] = []
    for batch in batches:
        rows = np.column_stack([c.to_numpy() for c in batch.columns]).astype(np.int64)
        held = np.concatenate([held, rows])
        cut = np.r_[0, (held[1:, :3] != held[:-1, :3]).any(axis=1).nonzero()[0] + 1]
        for start, end in zip(cut[:-1], cut[1:], strict=True):
            yield from grouped(held[start:end, 3], pack, out)
        held = held[cut[-1] :] if len(cut) else held
    yield from grouped(held[:, 3], pack, out)
    if pack:
        yield from out(np.concatenate(pack))


def grouped(fps: np.ndarray, pack: list[np.ndarray], out) -> Iterator[pa.RecordBatch]:
    """Compares a key's fingerprints, small keys together with others.

    Pairs of different keys in a pack are compared as well; a link found there is
    as true as any.
    """
    if len(fps) > PACK // 2:
        yield from out(fps.copy())
    elif len(fps) > 1:
        pack.append(fps.copy())
        if sum(map(len, pack)) > PACK // 2:
            yield from out(np.concatenate(pack))
            pack.clear()


def links(fps: DataFrame) -> DataFrame:
    """(a, b): enough links to join all of the different ``fp`` within the radius."""
    blocks = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keys = [
        F.lit(n << 32) + F.shiftleft(blocks[i], 16) + blocks[j] for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k"))
    sizes = keyed.groupBy("k").count().where("count > 1")
    tiles = F.ceil(F.col("count") / TILE).cast("long")
    dealt = keyed.join(sizes, "k").withColumn("n", tiles).withColumn("t", F.pmod(F.xxhash64("fp"), "n"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
        lambda o: F.struct(F.least("t", o).alias("i"), F.greatest("t", o).alias("j")),
    )
    tiled = dealt.select("k", "fp", F.inline(pairs))
    placed = tiled.select("k", "i", "j", "fp").repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")
    return placed.mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(id, mark, fp, root, component_id), a row for each row of ``docs``."""
    own = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    of = staged(fingerprints(own, "id", "text", words), "fingerprints")
    least = of.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(of.select("fp").distinct())).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return of.join(rooted.select("fp", "root").join(smallest, "root"), "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """(key, fingerprint, component_id), a row for each row of ``docs``.

    Fingerprints link at RADIUS or fewer differing bits; ``component_id`` is the
    smallest key that links reach, itself included, and null where all those keys
    are null. Texts that are null or without words have the fingerprint zero and
    link like others. Repeated rows stay. Copies share one fingerprint and are
    compared once.
    """
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return classes(docs, key, text, words).select(F.col("id").alias(key), hexed.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one row stays.

    It is the one with the smallest key, null last; of several rows with that key the
    one whose text has the smallest hash. Only keys and hashes are grouped; the texts
    shuffle once, to meet the keys that stay. Other columns can have any names.
    """
    first = classes(docs, key, text, words).groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("first"))
    kept = first.select(written(F.col("first.id")).alias("key"), F.col("first.mark").alias("mark"))
    rows = docs.select(F.struct("*").alias("row"), written(F.col(key)).alias("key"), mark(text).alias("mark"))
    return rows.join(kept, ["key", "mark"], "left_semi").dropDuplicates(["key", "mark"]).select("row.*")


def written(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null:"))
