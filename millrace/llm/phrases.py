"""Phrase collocations, counted in HAT-tries.

A task keeps a shallow trie over numbers of words: under each first word hangs a hash
container of the words that follow, which bursts into a container for each second word
when it grows. When a task holds too much, it spills its largest subtrees, whole and
each in the order of its phrases. Such sorted runs are dealt by their prefix, and each
prefix partition merges its own.

Words are counted first, then pairs of frequent words, then all longer phrases whose
neighbouring words are frequent pairs: others can't be frequent. Bloom filters tell which
words and pairs are. Their size is bounded; what they let through in error is counted
like the rest, and its count tells.
"""

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged

LEAST_COUNT, MOST_WORDS = 30, 4
TOP, CONTAINED_PERCENT, SCALE = 2_000, 80, 2_000_000
NO_LANGUAGE = "und"

# What ends a piece, what ends a word.
PIECE_ENDS, WORD_ENDS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
# No word is a full stop: it ends pieces.
STOP = b"."
PLAIN = bytes.maketrans(PIECE_ENDS + WORD_ENDS, STOP * len(PIECE_ENDS) + b" " * len(WORD_ENDS))

# Characters of texts that are cut into words together, and words counted together.
BLOCK_CHARS, SLICE_WORDS = 1 << 23, 1 << 19
# Phrases that a task holds, of which a spill leaves half, and words with a number.
HELD, NUMBERED = 1_000_000, 1 << 20
# Entries of a container before it bursts; so few are added one by one.
BURST, FEW = 4_096, 8
# Bits for a word's number: three words fit in a whole number of 64 bits.
BITS = 21
# The most bits of a filter (32 MB); 16 for each phrase are enough.
FILTER_BITS, PROBES = 1 << 28, 3
MIX = 0x9E3779B97F4A7C15
ALL = (1 << 64) - 1


# --- the filter ---


def seed_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def word_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed)


def mixed(h, word):
    """The hash of a phrase from that of its beginning and of its next word; whole numbers or arrays."""
    if isinstance(h, int):
        h = ((h ^ word) * MIX) & ALL
        return h ^ (h >> 29)
    h = (h ^ word) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def phrase_hash(lang: str, phrase: str) -> int:
    """As a signed long."""
    h, seed = 0, seed_of(lang)
    for word in phrase.encode().split(b" "):
        h = mixed(h, word_hash(word, seed))
    return h - (1 << 64) if h >> 63 else h


class Filter:
    """Which phrases may be frequent. Those that are, are in it."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, len(words) * 64 - 1

    def has(self, h: np.ndarray) -> np.ndarray:
        first, step = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        found = np.ones(len(h), bool)
        for i in range(PROBES):
            at = (first + np.uint64(i) * step) & np.uint64(self.mask)
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_of(frequent: DataFrame) -> Filter:
    """Of the hashes ``h``. Spark ORs the bits; a row for each 64 of them comes to the driver."""
    bits = 1 << 16
    while bits < min(FILTER_BITS, 16 * frequent.count()):
        bits *= 2
    first, step = F.shiftrightunsigned("h", 32), F.col("h").bitwiseAND(0xFFFFFFFF).bitwiseOR(F.lit(1).cast("long"))
    places = F.array(*[(first + F.lit(i) * step).bitwiseAND(bits - 1) for i in range(PROBES)])
    at = frequent.select(F.explode(places).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    ored = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[ored["word"].to_numpy()] = ored["bits"].to_numpy().view(np.uint64)
    return Filter(words)


# --- counting ---


class Numbers(dict):
    """A language's words and their numbers; -1 for those that no frequent phrase has."""

    def __init__(self, lang: str, frequent: Filter):
        super().__init__({STOP: -1})
        self.seed, self.frequent = seed_of(lang), frequent
        self.words: list[bytes] = []
        self.hashes = np.zeros(0, np.uint64)

    def learn(self, words: list[bytes]) -> int:
        """Numbers the words that are new; returns how many those are."""
        new = [w for w in words if w not in self]
        h = np.fromiter((word_hash(w, self.seed) for w in new), np.uint64, len(new))
        kept = self.frequent.has(mixed(np.zeros(len(h), np.uint64), h))
        numbers = np.where(kept, len(self.words) + np.cumsum(kept) - 1, -1)
        self.update(zip(new, numbers.tolist(), strict=True))
        self.words += [w for w, k in zip(new, kept.tolist(), strict=True) if k]
        self.hashes = np.concatenate([self.hashes, h[kept]])
        return len(new)


class Trie:
    """Counts of phrases of ``size`` words in one language.

    ``first`` has a hash container for each first word: a Counter of the other words,
    packed into one number; or, once burst, a dict of one for each second word.
    """

    def __init__(self, size: int, numbers: Numbers):
        self.size, self.numbers = size, numbers
        self.first: dict[int, Counter | dict[int, Counter]] = {}
        self.held: dict[int, int] = {}
        # places of the second word in what a container packs, and of the rest
        self.shift = BITS * (size - 2)
        self.rest = (1 << self.shift) - 1

    def add(self, first: np.ndarray, others: np.ndarray) -> int:
        """Counts phrases in the order of their first word; returns how many are new."""
        cuts = [*(first[1:] != first[:-1]).nonzero()[0] + 1, len(first)]
        of, packed = first[[0, *cuts[:-1]]].tolist(), others.tolist()
        new = i = 0
        for word, j in zip(of, cuts, strict=True):
            container = self.first.get(word)
            if container is None:
                container = self.first[word] = Counter()
            before = self.held.get(word, 0)
            if type(container) is dict:
                added = self._below(container, packed[i:j])
            else:
                if j - i < FEW:
                    for p in packed[i:j]:
                        container[p] += 1
                else:
                    container.update(packed[i:j])
                added = len(container) - before
                if len(container) > BURST and self.size > 2:
                    self.first[word] = self._burst(container)
            self.held[word] = before + added
            new += added
            i = j
        return new

    def _below(self, seconds: dict[int, Counter], packed: list[int]) -> int:
        new = 0
        for p in packed:
            container = seconds.get(p >> self.shift)
            if container is None:
                container = seconds[p >> self.shift] = Counter()
            p &= self.rest
            new += p not in container
            container[p] += 1
        return new

    def _burst(self, container: Counter) -> dict[int, Counter]:
        seconds: dict[int, Counter] = {}
        for p, n in container.items():
            seconds.setdefault(p >> self.shift, Counter())[p & self.rest] = n
        return seconds

    def take(self, subtrees: list[int]) -> tuple[pa.Array, pa.Array]:
        """Removes the subtrees of some first words: their phrases, in order, and counts."""
        firsts, seconds, containers = [], [], []
        for word in subtrees:
            container = self.first.pop(word)
            del self.held[word]
            below = container if type(container) is dict else {0: container}
            firsts += [word] * len(below)
            seconds += below.keys()
            containers += below.values()
        sizes = list(map(len, containers))
        first, second = np.repeat(firsts, sizes), np.repeat(seconds, sizes)
        packed = np.fromiter(chain.from_iterable(containers), np.int64, len(first)) | second << self.shift
        counts = np.fromiter(chain.from_iterable(c.values() for c in containers), np.int64, len(first))
        texts = pa.array(self.numbers.words, pa.binary()).cast(pa.string())
        rank = np.empty(len(texts), np.int64)
        rank[pc.sort_indices(texts).to_numpy()] = np.arange(len(texts))
        mask = (1 << BITS) - 1
        columns = [first, *(packed >> s & mask for s in range(self.shift, -1, -BITS))]
        order = np.lexsort([rank[c] for c in reversed(columns)])
        phrases = pc.binary_join_element_wise(*(texts.take(pa.array(c[order])) for c in columns), " ")
        return phrases, pa.array(counts[order])


def tokens_of(texts: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """The words of texts, and stops between pieces: places in a list of different ones."""
    plain = STOP.join([t.encode() for t in texts]).lower().translate(PLAIN).replace(STOP, b" . ")
    data = np.frombuffer(plain, np.uint8)
    letter = data != 32
    edge = np.diff(letter, prepend=False, append=False).nonzero()[0]
    offsets = np.r_[0, np.cumsum(edge[1::2] - edge[::2])]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[letter])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.to_pylist()


class Counted:
    """What a task counts: words in one container for each language, or phrases in a
    trie for each language and length; and runs when they hold too much."""

    def __init__(self, sizes: list[int], words: Filter | None, pairs: Filter | None):
        self.sizes, self.words, self.pairs = sizes, words, pairs
        self.single: dict[str, Counter] = {}
        self.numbers: dict[str, Numbers] = {}
        self.tries: dict[tuple[str, int], Trie] = {}
        self.held = self.numbered = 0

    def add(self, lang: str, texts: list[str]) -> Iterator[pa.RecordBatch]:
        places, words = tokens_of(texts)
        if self.sizes == [1]:
            yield from self._words(lang, places, words)
            return
        longest = max(self.sizes)
        for start in range(0, len(places), SLICE_WORDS):
            if self.numbered > NUMBERED:
                yield from self.spilled(0)
                self.tries.clear()
                self.numbers.clear()
                self.numbered = 0
            if lang not in self.numbers:
                self.numbers[lang] = Numbers(lang, self.words)
                self.tries.update({(lang, size): Trie(size, self.numbers[lang]) for size in self.sizes})
            numbers = self.numbers[lang]
            part = places[start : start + SLICE_WORDS + longest - 1]
            used = np.bincount(part, minlength=len(words)).nonzero()[0]
            own = [words[i] for i in used.tolist()]
            self.numbered += numbers.learn(own)
            code = np.full(len(words), -1)
            code[used] = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
            codes = code[part]
            for size, at in self.places(codes, numbers, min(SLICE_WORDS, len(places) - start)):
                if len(at):
                    # in the order of first words; what follows them is packed
                    at = at[np.argsort(codes[at], kind="stable")]
                    others = np.zeros(len(at), np.int64)
                    for i in range(1, size):
                        others = others << BITS | codes[at + i]
                    self.held += self.tries[lang, size].add(codes[at], others)
            if self.held > HELD:
                yield from self.spilled(HELD // 2)

    def _words(self, lang: str, places: np.ndarray, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        counts = self.single.setdefault(lang, Counter())
        self.held -= len(counts)
        counts.update(dict(zip(words, np.bincount(places, minlength=len(words)).tolist(), strict=True)))
        # the empty phrase stands for all words
        counts[b""] += len(places) - counts.pop(STOP, 0)
        self.held += len(counts)
        if self.held > HELD:
            yield from self.spilled(0)

    def places(self, codes: np.ndarray, numbers: Numbers, begins: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each size where phrases begin, before ``begins``, that have no stop and may
        be frequent: all their pairs of neighbours may be."""
        near = (codes[:-1] >= 0) & (codes[1:] >= 0)
        if self.pairs is not None:
            at = near.nonzero()[0]
            h = mixed(mixed(np.zeros(len(at), np.uint64), numbers.hashes[codes[at]]), numbers.hashes[codes[at + 1]])
            near[at] = self.pairs.has(h)
        for size in self.sizes:
            n = max(0, len(codes) - size + 1)
            whole = np.ones(n, bool)
            for i in range(size - 1):
                whole &= near[i : i + n]
            yield size, whole[:begins].nonzero()[0]

    def spilled(self, leave: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs: all words, or the largest subtrees until so many phrases are left."""
        for lang, counts in self.single.items():
            words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            order = pc.sort_indices(words)
            yield run(lang, words.take(order), pa.array(counts.values(), pa.int64()).take(order))
        if self.single:
            self.single.clear()
            self.held = 0
        sizes = sorted(((n, trie, word) for trie, t in self.tries.items() for word, n in t.held.items()), reverse=True)
        taken: dict[tuple[str, int], list[int]] = {}
        for n, trie, word in sizes:
            if self.held <= leave:
                break
            self.held -= n
            taken.setdefault(trie, []).append(word)
        for trie, subtrees in taken.items():
            yield run(trie[0], *self.tries[trie].take(subtrees))


def run(lang: str, phrases: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, counts], ["lang", "phrase", "n"])


def runs(docs: DataFrame, sizes: list[int], words: Filter | None = None, pairs: Filter | None = None) -> DataFrame:
    """(lang, phrase, n) of all tasks; the empty phrase counts words, in the pass for words."""
    spark = docs.sparkSession
    # plain arrays: a worker may not have this package on its path
    given = spark.sparkContext.broadcast([f and f.words for f in (words, pairs)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counted(sizes, *(None if w is None else Filter(w) for w in given.value))
        texts: dict[str, list[str]] = {}
        chars = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if text:
                    texts.setdefault(lang.as_py(), []).append(text)
                    chars += len(text)
                if chars >= BLOCK_CHARS:
                    for lang_, of in texts.items():
                        yield from counter.add(lang_, of)
                    texts, chars = {}, 0
        for lang_, of in texts.items():
            yield from counter.add(lang_, of)
        yield from counter.spilled(0)

    return docs.mapInArrow(each, "lang string, phrase string, n long")


def merged(parts: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n, h) of the phrases that come ``least`` times, and of the empty one.

    A prefix of up to three words names the partition in which runs are added up: at
    most all words can follow one, so that no prefix is too large for a task.
    """
    prefix = F.substring_index("phrase", " ", 3)
    placed = parts.repartition(F.col("lang"), prefix)
    # grouped where it lies: the partitioning is by part of these columns
    summed = placed.groupBy("lang", prefix.alias("prefix"), "phrase").agg(F.sum("n").alias("n"))
    summed = summed.where((F.col("n") >= least) | (F.col("phrase") == ""))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [phrase_hash(lang, phrase) for lang, phrase in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h, pa.int64())], ["lang", "phrase", "n", "h"])

    return summed.select("lang", "phrase", "n").mapInArrow(each, "lang string, phrase string, n long, h long")


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, longest: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all frequent phrases, and (lang, n) of all words.

    Three passes over the texts, each with a table: words, pairs of frequent words, and
    all that is longer and of frequent pairs.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    counted = staged(merged(runs(rows, [1]), least), "words")
    words = counted.where("phrase <> ''")
    tables = [words]
    of_words = filter_of(words)
    if longest > 1:
        tables.append(staged(merged(runs(rows, [2], of_words), least), "pairs"))
    if longest > 2:
        longer = runs(rows, list(range(3, longest + 1)), of_words, filter_of(tables[1]))
        tables.append(staged(merged(longer, least), "longer"))
    size = F.size(F.split("phrase", " "))
    all_of = reduce(DataFrame.unionByName, (t.select("lang", "phrase", size.alias("size"), "n") for t in tables))
    return all_of, counted.where("phrase = ''").select("lang", "n")


# --- scores ---


def part_of(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def wide(count: str) -> Column:
    """A count in arithmetic that no product passes."""
    return F.col(count).cast("decimal(38,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of two words or more, at their weakest cut.

    Parts of a frequent phrase are frequent, so each finds its count in the same table.
    """
    long = counts.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    halves = cuts.select(
        "lang", "phrase", "a", "k", part_of(F.col("words"), 1, F.col("k")).alias("first"),
        part_of(F.col("words"), F.col("k") + 1, F.size("words") - F.col("k")).alias("last"),
    )
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    last = counts.select("lang", F.col("phrase").alias("last"), F.col("n").alias("r"))
    # both parts come as often as the whole or more, so a score is at most SCALE / 2
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(38,0)") * wide("a"), wide("l") + wide("r")).cast("long")
    each = halves.join(first, ["lang", "first"]).join(last, ["lang", "last"]).withColumn("score", whole)
    weakest = each.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def within_longer(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the count of the most frequent longer phrase that has the phrase in it."""
    long = counts.where("size > 2").select("lang", "n", "size", F.split("phrase", " ").alias("words"))
    of = long.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    parts = F.transform(
        F.sequence(F.lit(1), F.col("size") - F.col("length") + 1), lambda i: part_of(F.col("words"), i, F.col("length"))
    )
    return of.select("lang", "n", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, longest: int = MOST_WORDS, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A-Z are lowered; texts are cut into pieces at ``.,;:!?`` and line ends, pieces into
    words at spaces and tabs. Phrases of 2 to ``longest`` words that come ``least`` times
    within pieces are candidates. A cut into two parts that come l and r times gives
    floor(2,000,000 a / (l + r)); the lowest cut counts, ties to the shortest first part.
    A candidate goes if a longer one that has it comes at least 80 % as often. Order is
    by score, then ``a``, then the phrase's bytes.

    Null and empty texts have no words; a null language is ``und``, together with that
    name. Repeated rows count each. A language without candidates has no rows. Texts are
    never cut off: long ones are counted a slice at a time.
    """
    found, totals = frequent(docs, text, lang, least, longest)
    counts = staged(found, "phrases")
    longer = within_longer(counts)
    kept = scored(counts).join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.lit(100) * wide("longer") < F.lit(CONTAINED_PERCENT) * wide("a"), F.lit(True))
    )
    # Spark limits each task's rows to ``top`` of a language before it shuffles them.
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
