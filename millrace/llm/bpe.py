"""BPE encoding and decoding through a table of distinct words.

Documents are cut into blocks, and each block into words. A block's documents become
codes of the block's own words. The words alone are shuffled, so that each distinct
word is encoded once; their ids return to the block and are put back by position.
Decoding joins a block's distinct ids to the id-to-piece table, and puts the pieces
back by position in the same way.
"""

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import tokenizers
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer

from millrace.llm.common import staged

# Characters of a block: a task holds one, its words and its ids.
BLOCK_CHARS = 8_000_000
# Words whose ids are put back together.
SLICE_WORDS = 200_000
# A vocabulary up to this size is broadcast as id-to-piece table.
MOST_PIECES = 1_000_000
# The split of the vocabularies for which there is a quick path.
QUICK_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
QUICK_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Marks a word that is a special token. Words that begin with it get a second one.
SPECIAL = "\0"


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte.

    Printable bytes are written as themselves, the others by letters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def tokenizer_of(spec: str) -> Tokenizer:
    """The tokenizer, loaded once in a worker's life: each load leaves some MB behind.

    This module's functions come to a worker anew with each task, and what they hold
    goes with it; so the tokenizers are kept beside the library that they belong to.
    """
    held = vars(tokenizers).setdefault("_loaded_by_millrace", {})
    if spec not in held:
        held[spec] = Tokenizer.from_str(spec)
    return held[spec]


class Splitter:
    """Cuts a text into the words that the tokenizer merges within.

    Texts of Latin letters take a pattern, all others the library's normalizer and
    pre-tokenizer, which are loaded when the first such text comes. Special tokens are
    cut out first, as the library does.
    """

    def __init__(self, spec: str):
        loaded = json.loads(spec)
        self.special_tokens = [t["content"] for t in loaded.get("added_tokens") or []]
        kinds = [n["type"] for n in (loaded.get("normalizer") or {}).get("normalizers", [])]
        self.is_quick = kinds == QUICK_NORMALIZERS and QUICK_SPLIT in spec.replace("\\\\", "\\")

    def ready(self, spec: Broadcast) -> "Splitter":
        """In a task: compiles the patterns. ``spec`` is read only if a text needs it."""
        self.spec, self.library = spec, None
        tokens = sorted(self.special_tokens, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, tokens))) if tokens else None
        letter, number = (
            "".join(re.escape(chr(c)) for c in range(0x300) if unicodedata.category(chr(c))[0] == k) for k in "LN"
        )
        # letters first: no other alternative begins with one
        self.quick = re.compile(f"[{letter}]+|'(?:s|t|re|ve|m|ll|d)|[{number}]|[^ \t\n\r{letter}{number}]+")
        # Composed letters without a decomposition beyond the range, one case each.
        self.plain = re.compile("[\t\n\r -~¡-¬®-įı-ž]*") if self.is_quick else None
        return self

    def words(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self._words(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [*self._words(text[at : found.start()]), SPECIAL + found[0]]
            at = found.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[str]:
        if self.plain is not None and self.plain.fullmatch(text):
            return self.quick.findall(text.lower())
        self.library = self.library or tokenizer_of(self.spec.value)
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        words = [normal[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return [SPECIAL + w if w[0] == SPECIAL else w for w in words]


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Codes(dict):
    """Words to numbers in the order of their first appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


def gathered(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Runs of values, one after another: run i has count[i] of them from first[i] on."""
    ends = np.cumsum(count)
    return values[np.repeat(first - (ends - count), count) + np.arange(count.sum())]


def _blocks(batches: Iterator[pa.RecordBatch], splitter: Splitter, coded: bool):
    """(block, keys, codes of each document, words): a block is so many characters of
    one partition. Without ``coded`` only the words are gathered, in the same order."""
    part, number = TaskContext.get().partitionId(), 0
    keys, codes, words, chars = [], [], Codes(), 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py() or ""
            own = splitter.words(text)
            keys.append(key)
            if coded:
                codes.append(np.array(list(map(words.__getitem__, own)), np.int32))
            else:
                words.update(dict.fromkeys(own))
            chars += len(text)
            if chars >= BLOCK_CHARS:
                yield part << 24 | number, keys, codes, list(words)
                number, keys, codes, words, chars = number + 1, [], [], Codes(), 0
    if keys:
        yield part << 24 | number, keys, codes, list(words)


def _bucketed(words: list[str], buckets: int) -> tuple[list[list[str]], int]:
    """The words of each bucket in order, and a checksum of them all."""
    dealt: list[list[str]] = [[] for _ in range(buckets)]
    for w in words:
        dealt[crc32(w.encode("utf-8", "surrogatepass")) % buckets].append(w)
    return dealt, crc32("\n".join(words).encode("utf-8", "surrogatepass"))


class Encoder:
    """Splits, encodes and decodes frames by one tokenizer, given as its JSON text."""

    def __init__(self, spark: SparkSession, spec: str):
        self.spark = spark
        self.spec, self.splitter = spark.sparkContext.broadcast(spec), Splitter(spec)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def word_table(self, docs: DataFrame) -> DataFrame:
        """(bucket, block, stamp, words): each block's distinct words, once."""
        spec, splitter, buckets = self.spec, self.splitter, self.buckets

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, _, _, words in _blocks(batches, splitter.ready(spec), coded=False):
                dealt, stamp = _bucketed(words, buckets)
                full = [i for i in range(buckets) if dealt[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int32()),
                        pa.array([block] * len(full), pa.int64()),
                        pa.array([stamp] * len(full), pa.int64()),
                        pa.array([json.dumps(dealt[i], ensure_ascii=False) for i in full], pa.string()),
                    ],
                    ["bucket", "block", "stamp", "words"],
                )

        return docs.mapInArrow(each, "bucket int, block long, stamp long, words string")

    def encoded_words(self, words: DataFrame) -> DataFrame:
        """(block, bucket, stamp, ids, counts, seen): each distinct word is encoded once."""
        spec = self.spec

        def each(table: pa.Table) -> pa.Table:
            tokenizer, letters = tokenizer_of(spec.value), byte_letters()
            table = table.sort_by("block")
            lists = [json.loads(w) for w in table["words"].to_pylist()]
            place, encoded = Codes(), []
            for w in dict.fromkeys(w for of in lists for w in of):
                place[w] = len(encoded)
                word = w.removeprefix(SPECIAL)
                if word != w and word[0] != SPECIAL:
                    encoded.append([tokenizer.token_to_id(word)])
                else:
                    written = "".join([letters[b] for b in word.encode("utf-8", "surrogatepass")])
                    encoded.append([t.id for t in tokenizer.model.tokenize(written)])
            count = np.array([len(e) for e in encoded], np.int32)
            first = np.cumsum(count) - count
            ids = np.array([i for e in encoded for i in e], np.int32)
            at = [np.array(list(map(place.__getitem__, of)), np.int32) for of in lists]
            counts = [count[a] for a in at]
            flat = [gathered(ids, first[a], n) for a, n in zip(at, counts, strict=True)]
            return pa.table(
                {
                    "block": table["block"],
                    "bucket": table["bucket"],
                    "stamp": table["stamp"],
                    "ids": pa.array([packed(f) for f in flat], pa.binary()),
                    "counts": pa.array([packed(c) for c in counts], pa.binary()),
                    "seen": pa.array([np.unique(f).astype(np.int32) for f in flat], pa.list_(pa.int32())),
                }
            )

        return words.groupBy("bucket").applyInArrow(
            each, "block long, bucket int, stamp long, ids binary, counts binary, seen array<int>"
        )

    def coded_documents(self, docs: DataFrame, key: str, kind: str) -> DataFrame:
        """(block, stamp, keys, lengths, codes): a row for each block.

        A code is the place of a word among the block's, in the order of word_table.
        """
        spec, splitter, buckets = self.spec, self.splitter, self.buckets

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, keys, each_codes, words in _blocks(batches, splitter.ready(spec), coded=True):
                lengths, codes = [len(c) for c in each_codes], np.concatenate(each_codes)
                dealt, stamp = _bucketed(words, buckets)
                place = {w: i for i, w in enumerate(w for b in dealt for w in b)}
                # Sent as ranks by frequency: most are small numbers and compress well.
                order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
                rank = np.empty(len(words), np.int64)
                rank[order] = np.arange(len(words))
                at = np.array([place[words[i]] for i in order], np.int64)
                keys = pa.array([k.as_py() for k in keys], keys[0].type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([stamp], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                        pa.array([packed(np.array(lengths, np.int64))], pa.binary()),
                        pa.array([packed(rank[codes])], pa.binary()),
                        pa.array([packed(at)], pa.binary()),
                    ],
                    ["block", "stamp", "keys", "lengths", "codes", "places"],
                )

        return docs.mapInArrow(
            each, f"block long, stamp long, keys array<{kind}>, lengths binary, codes binary, places binary"
        )

    def pieces(self) -> DataFrame:
        """(id, piece): the vocabulary."""
        tokenizer = Tokenizer.from_str(self.spec.value)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        schema = StructType([StructField("id", IntegerType()), StructField("piece", StringType())])
        return self.spark.createDataFrame([(i, p) for p, i in vocabulary.items()], schema)

    def block_pieces(self, coded: DataFrame) -> DataFrame:
        """(block, ids, pieces): each block's distinct ids joined to their pieces."""
        pieces = self.pieces()
        if Tokenizer.from_str(self.spec.value).get_vocab_size() <= MOST_PIECES:
            pieces = F.broadcast(pieces)
        # a block's ids at most, whatever the number of buckets
        seen = coded.groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"))
        used = seen.select("block", F.explode("seen").alias("id"))
        named = used.join(pieces, "id").groupBy("block").agg(F.collect_list(F.struct("id", "piece")).alias("named"))
        return named.select("block", F.col("named.id").alias("seen"), F.col("named.piece").alias("pieces"))


def decoded_words(ids: np.ndarray, first: np.ndarray, count: np.ndarray, words: pa.Table) -> list[str]:
    """The decoded text of each word of a block, by the block's ids and their pieces."""
    piece = {
        i: p
        for seen, pieces in zip(words["seen"].to_pylist(), words["pieces"].to_pylist(), strict=True)
        for i, p in zip(seen or (), pieces or (), strict=True)
    }
    each = [piece[i] for i in ids.tolist()]
    return [" ".join(each[i : i + k]) for i, k in zip(first.tolist(), count.tolist(), strict=True)]


def encode(docs: DataFrame, spec: str, key: str = "doc_id", text: str = "text", decode: bool = True) -> DataFrame:
    """(key, ids array<int>[, decoded]), a row for each row of ``docs``.

    ``ids`` is what the tokenizer gives for the whole text without added tokens, whole
    and unpadded; ``decoded`` what it gives for those ids, special tokens kept. Null
    texts count as empty: no ids, an empty decoded text. Repeated rows and keys stay,
    null keys too. ``docs`` is read twice and must give the same rows in each
    partition, as files do; a block that differs is an error, not a wrong result.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    encoder = Encoder(spark, spec)
    coded = staged(encoder.encoded_words(encoder.word_table(own)), "words")
    back = coded.select("block", "bucket", "stamp", "ids", "counts", F.lit(None).cast("array<int>").alias("seen"), F.lit(None).cast("array<string>").alias("pieces"))
    if decode:
        named = encoder.block_pieces(coded).selectExpr(
            "block", "-1 AS bucket", "NULL AS stamp", "NULL AS ids", "NULL AS counts", "seen", "pieces"
        )
        back = back.unionByName(named)
    kept = encoder.coded_documents(own, "key", kind)

    def put_back(block: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("bucket")
        stamps = {s for s in words["stamp"].to_pylist() if s is not None} | set(block["stamp"].to_pylist())
        if block.num_rows != 1 or len(stamps) > 1:
            raise ValueError("the documents were not the same when they were read again")
        flat = [unpacked(x) for x in words["ids"].to_pylist() if x is not None]
        counts = [unpacked(x) for x in words["counts"].to_pylist() if x is not None]
        ids, count = (np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32) for x in (flat, counts))
        first = (np.cumsum(count) - count).astype(np.int32)
        bounds = np.r_[0, np.cumsum(unpacked(block["lengths"][0].as_py()))]
        code = unpacked(block["places"][0].as_py()).astype(np.int32)[unpacked(block["codes"][0].as_py())]
        keys = block["keys"].combine_chunks().flatten()
        written = decoded_words(ids, first, count, words) if decode else []

        def documents(i: int, j: int) -> pa.Table:
            """Rows of the documents from i to j: a block's ids are many times its words."""
            own = code[bounds[i] : bounds[j]]
            n = count[own]
            out = gathered(ids, first[own], n)
            at = bounds[i : j + 1] - bounds[i]
            offsets = pa.array(np.r_[0, np.cumsum(n)][at].astype(np.int32))
            columns = {"key": keys[i:j], "ids": pa.ListArray.from_arrays(offsets, pa.array(out, pa.int32()))}
            if decode:
                each = [written[c] for c in own.tolist()]
                ranges = zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
                columns["decoded"] = pa.array([" ".join(each[k:m]) for k, m in ranges], pa.string())
            return pa.table(columns)

        starts = np.unique(np.searchsorted(bounds[:-1], np.arange(0, bounds[-1] + 1, SLICE_WORDS)))
        edges = [*starts[starts < len(keys)].tolist(), len(keys)]
        return pa.concat_tables([documents(i, j) for i, j in zip(edges[:-1], edges[1:], strict=True)])

    schema = f"key {kind}, ids array<int>" + ", decoded string" * decode
    result = kept.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(put_back, schema)
    return result.withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, spec: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, decoded) of any frame with an array of ids and a key that names its rows.

    Each id is joined to its piece, and a row's pieces are put in order by position. An
    id that the vocabulary lacks gives nothing, as in the library; null is empty.
    """
    pieces = F.broadcast(Encoder(encoded.sparkSession, spec).pieces())
    each = encoded.select(key, F.posexplode_outer(ids).alias("at", "id"))
    joined = each.join(pieces, "id", "left").groupBy(key)
    found = F.filter(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"].isNotNull())
    return joined.agg(F.array_join(F.transform(found, lambda x: x["piece"]), " ").alias("decoded"))
