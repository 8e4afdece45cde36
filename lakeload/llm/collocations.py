"""Phrase collocations: Misra-Gries summaries find what is frequent, a second pass counts it.

1. Every n-gram of 1 to 4 words is a 64-bit hash. Tasks count the hashes of some texts and cut
   the counts into ranges of hashes. All parts of a range meet in one summary whose
   capacity exceeds the range's mass divided by the threshold, so each n-gram that
   reaches the threshold survives in it.
2. The survivors mark bits of a filter. The texts are read again; n-grams whose bit is set
   are counted by their words, exactly, and those that reach the threshold are kept.

Scores, the removal of parts and ranks are joins and windows of the kept phrases.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_groups, saved

LONGEST = 4  # words of a phrase
THRESHOLD = 30
TOP = 2000
SHARE = 80  # percent of a phrase that a longer one must hold to remove it
SCALE = 2_000_000

SLACK = 4  # the capacity of a summary is so many times its mass by the threshold
RANGE_BYTES = 8 << 20  # of text for each range of hashes
SLICE_BYTES = 4 << 20  # of text that a task splits at a time
FLUSH_GRAMS = 3_000_000  # that a task gathers before it counts them
FILTER_BITS = 16  # for each survivor
LEAST_FILTER, MOST_FILTER = 1 << 16, 1 << 29  # bits; 64 MB at most
FILTER_BLOCK = 1 << 16  # bits that one task sets

# Where pieces end, and the blanks between words.
PIECE_ENDS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_IS_END = np.isin(np.arange(256), np.frombuffer(PIECE_ENDS, np.uint8))
_IS_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8))


# --- words and n-grams of some texts --------------------------------------------------


def _slices(batch: pa.RecordBatch):
    """Some texts at a time, of a bounded number of bytes unless one text has more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(batch):
        before = ends[start] - sizes[start]
        stop = max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of texts in order, as numbers of distinct words.

    ``piece`` numbers the pieces over all texts, so words of one phrase share it; ``lang`` is
    the number of the text's language.
    """

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = pc.fill_null(texts, "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        # A line end behind each text ends its last piece.
        data = np.frombuffer("\n".join([*texts.to_pylist(), ""]).encode(), np.uint8)
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        ends = _IS_END[data]
        inside = ~(ends | _IS_BLANK[data])
        first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
        offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
        letters = pa.py_buffer(data[inside].tobytes())
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), letters])
        coded = words.dictionary_encode()
        self.distinct = coded.dictionary
        self.numbers = coded.indices.to_numpy(zero_copy_only=False)
        self.piece = np.cumsum(ends, dtype=np.int32)[first]
        text = np.searchsorted(np.cumsum(sizes + 1), first, "right")
        known = pc.fill_null(langs, "und").dictionary_encode()
        self.langs = known.dictionary.to_pylist()
        self.lang = known.indices.to_numpy(zero_copy_only=False)[text]

    def hashes(self) -> list[np.ndarray]:
        """For n = 1, 2, ... the hash of the n-gram that starts at each word."""
        hashed = lambda values: np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))
        word = hashed(self.distinct.to_pylist())[self.numbers]
        total = (hashed(self.langs) * _MIX[1])[self.lang]  # a language is not the word of its name
        out = []
        for n in range(LONGEST):
            own = word[n:]
            mixed = (total[: len(own)] ^ own) * _MIX[0]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1]
            total = mixed ^ (mixed >> np.uint64(32))
            out.append(total * _MIX[2])
        return out

    def starts(self, n: int) -> np.ndarray:
        """Whether the n words from each one on lie in one piece."""
        count = len(self.piece) - n + 1
        return self.piece[:max(count, 0)] == self.piece[n - 1 :]

    def grams(self) -> list[np.ndarray]:
        """The hashes of all n-grams."""
        return [h[self.starts(n)] for n, h in enumerate(self.hashes(), 1)]


def _words(batches):
    """The words of some texts at a time, from batches of (text, lang)."""
    for whole in batches:
        for batch in _slices(whole):
            yield Words(batch.column(0), batch.column(1))
            pa.default_memory_pool().release_unused()


# --- first pass: summaries ------------------------------------------------------------


def _deltas(sorted_keys: np.ndarray) -> bytes:
    steps = np.diff(sorted_keys, prepend=np.uint64(0))
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _bounds(ranges: int) -> np.ndarray:
    """The first hash of every range but the first."""
    return np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)


def _count_hashes(ranges: int):
    """Rows (range, mass, keys, counts): the counted hashes of some texts, in parts."""
    bounds = _bounds(ranges)

    def pack(parts: list[np.ndarray]):
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        cuts = np.searchsorted(keys, bounds)
        for number, (k, n) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts), strict=True)):
            if len(k):
                yield number, int(n.sum()), _deltas(k), zlib.compress(n.astype(np.uint32).tobytes(), 1)

    def batch(parts: list[np.ndarray]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*pack(parts), strict=True)) or [[]] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["range", "mass", "keys", "counts"])

    def run(batches):
        parts, held = [], 0
        for words in _words(batches):
            parts += words.grams()
            held += sum(map(len, parts[-LONGEST:]))
            if held >= FLUSH_GRAMS:
                yield batch(parts)
                parts, held = [], 0
        if held:
            yield batch(parts)

    return run


class Summary:
    """A Misra-Gries summary: counters of at most ``capacity`` keys.

    A counter lacks at most ``lost`` of its key's count. Each time ``lost`` grows by one,
    more than ``capacity`` counts leave the summary, so ``lost`` is at most mass / capacity.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._held += len(keys)
        if self._held > self.capacity:
            self.merge()

    def merge(self) -> None:
        """Take in what waits, then subtract the largest count that has no place from all."""
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._held = [], 0
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys)
        keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            over = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.lost += over
            left = counts > over
            keys, counts = keys[left], counts[left] - over
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """All keys whose counts may reach the threshold."""
        self.merge()
        return self.keys[self.counts + self.lost >= threshold]


def _survivors(threshold: int):
    """Rows (range, mass, keys, counts, total), sorted by range, to the hashes that survive."""

    def run(batches):
        current, summary = None, None

        def rest():
            found = summary.at_least(threshold).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["hash"])

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("range", "keys", "counts", "total")]
            for number, keys, counts, total in zip(*columns, strict=True):
                if number != current:
                    if current is not None:
                        yield rest()
                    current, summary = number, Summary(SLACK * total // threshold + 1)
                summary.add(_keys(keys), np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.int64))
        if current is not None:
            yield rest()

    return run


def survivors(texts: DataFrame, threshold: int) -> DataFrame:
    """The hashes of all n-grams that reach the threshold, with some that don't."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
    ranges = max(size // RANGE_BYTES, 16)
    parts = texts.mapInArrow(_count_hashes(ranges), "range int, mass long, keys binary, counts binary")
    # One exchange serves the sum of a range's mass and its summary.
    total = F.sum("mass").over(Window.partitionBy("range"))
    whole = parts.withColumn("total", total).select("range", "keys", "counts", "total")
    return saved(whole.mapInArrow(_survivors(threshold), "hash long"), "frequent-hashes")


# --- second pass: exact counts --------------------------------------------------------


def _filter_bit(hashed: Column, bits: int) -> Column:
    return hashed.bitwiseAND(F.lit(bits - 1))


def filter_of(found: DataFrame) -> tuple[int, np.ndarray]:
    """A filter of the survivors, one bit each, as bytes; never more than ``MOST_FILTER`` bits."""
    wanted = max(found.row_count * FILTER_BITS, LEAST_FILTER)
    bits = min(1 << (wanted - 1).bit_length(), MOST_FILTER)

    def blocks(batches):
        # Rows come sorted by bit.
        current, held = None, None

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["block", "bytes"]
            )

        for batch in batches:
            places = batch.column(0).to_numpy(zero_copy_only=False)
            for number in np.unique(places // FILTER_BLOCK):
                if number != current:
                    if current is not None:
                        yield block()
                    current, held = int(number), np.zeros(FILTER_BLOCK, bool)
                held[places[places // FILTER_BLOCK == number] % FILTER_BLOCK] = True
        if current is not None:
            yield block()

    placed = found.select(_filter_bit(F.col("hash"), bits).alias("bit")).distinct()
    numbered = placed.withColumn("block", F.floor(F.col("bit") / FILTER_BLOCK))
    dealt = numbered.repartition("block").sortWithinPartitions("bit").select("bit")
    packed = np.zeros(bits // 8, np.uint8)
    for row in dealt.mapInArrow(blocks, "block long, bytes binary").toLocalIterator():
        at = row.block * FILTER_BLOCK // 8
        packed[at : at + FILTER_BLOCK // 8] = np.frombuffer(row.bytes, np.uint8)
    return bits, packed


def _by_words(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place and the count of each distinct row of ``ids``; equal rows hash alike."""
    group = pa.array(hashes).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    counts = np.bincount(group)
    first = np.empty(len(counts), np.int64)
    first[group[::-1]] = np.arange(len(group))[::-1]
    if (ids == ids[first[group]]).all():
        return first, counts
    _, first, counts = np.unique(ids, axis=0, return_index=True, return_counts=True)
    return first, counts


def _count_words(bits: int, shared):
    """Rows (lang, phrase, words, count) of n-grams the filter lets through.

    With them, a row of no words for each language: its number of words.
    """

    def batch(langs: list[str], lang: np.ndarray, phrases: pa.Array, n: int, counts: np.ndarray) -> pa.RecordBatch:
        of = pa.array(langs, pa.string()).take(pa.array(lang))
        sizes = pa.array(np.full(len(lang), n, np.int32))
        return pa.RecordBatch.from_arrays(
            [of, phrases.cast(pa.string()), sizes, pa.array(counts, pa.int64())], ["lang", "phrase", "words", "count"]
        )

    def run(batches):
        packed = shared.value
        mask = np.uint64(bits - 1)
        for words in _words(batches):
            seen = np.bincount(words.lang, minlength=len(words.langs))
            nothing = pa.array([""] * len(seen), pa.string())
            yield batch(words.langs, np.arange(len(seen)), nothing, 0, seen)
            for n, hashes in enumerate(words.hashes(), 1):
                at = np.flatnonzero(words.starts(n))
                bit = hashes[at] & mask
                at = at[(packed[bit >> np.uint64(3)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 == 1]
                if not len(at):
                    continue
                ids = np.stack([words.lang[at], *[words.numbers[at + k] for k in range(n)]], axis=1)
                first, counts = _by_words(ids, hashes[at])
                each = [words.distinct.take(pa.array(ids[first, k + 1])) for k in range(n)]
                phrases = pc.binary_join_element_wise(*each, pa.scalar(b" ", pa.large_binary()))
                yield batch(words.langs, ids[first, 0], phrases, n, counts)

    return run


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all n-grams that reach the threshold, and (lang, n)."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    texts = docs.select("text", lang)
    bits, packed = filter_of(survivors(texts, threshold))
    shared = spark.sparkContext.broadcast(packed)
    counted = texts.mapInArrow(_count_words(bits, shared), "lang string, phrase string, words int, count long")
    totals = counted.groupBy("lang", "phrase", "words").agg(F.sum("count").alias("f"))
    stored = saved(totals.where((F.col("f") >= threshold) | (F.col("words") == 0)), "phrases")
    sizes = saved(stored.where("words = 0").select("lang", F.col("f").alias("n")), "languages")
    return stored.where("words > 0"), sizes


# --- scores, parts, ranks ---------------------------------------------------------------


def _part(phrase: str, first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def _with_counts(cuts: DataFrame, phrases: DataFrame, part: str, name: str, total: int) -> DataFrame:
    """Add the count of a part; a part that very many phrases share is one of few."""
    uses = cuts.groupBy("lang", part).agg(F.count(F.lit(1)).alias("uses"))
    counts = phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    groups = saved(counts.join(uses, ["lang", part]), "part-counts")
    return join_groups(cuts, groups, ["lang", part], "uses", total).drop("uses")


def scored(phrases: DataFrame, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every phrase of two words or more."""
    candidates = phrases.where("words > 1").withColumnRenamed("f", "a")
    each = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = saved(
        each.withColumn("first", _part("phrase", 1, F.col("cut"))).withColumn(
            "rest", _part("phrase", F.col("cut") + 1, F.col("words") - F.col("cut"))
        ),
        "cuts",
    )
    total = cuts.row_count
    both = _with_counts(_with_counts(cuts, phrases, "first", "l", total), phrases, "rest", "r", total)
    score = F.expr(f"(cast({scale} as decimal(18,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest).select(
        "lang", "phrase", "words", "a", "low.l", "low.r", "low.score"
    )


def without_parts(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """The candidates that no longer candidate holds nearly always."""
    long = candidates.where("words > 2")
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), i -> struct(i AS at, s AS size))))"
    )
    parts = long.select("lang", "phrase", "a", F.explode(inner).alias("of")).select(
        "lang", _part("phrase", F.col("of.at"), F.col("of.size")).alias("phrase"), F.col("a").alias("within")
    )
    most = parts.groupBy("lang", "phrase").agg(F.max("within").alias("within"))
    held = F.coalesce(F.expr(f"100 * cast(within as decimal(20,0)) >= {share} * cast(a as decimal(20,0))"), F.lit(False))
    return candidates.join(most, ["lang", "phrase"], "left").where(~held).drop("within")


def top_phrases(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first phrases of each language, numbered; parts of a language are cut down first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = candidates.withColumn("part", part)
    some = some.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = some.where(F.col("place") <= top).drop("part", "place")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top)


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the first ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and split into pieces and those into words; phrases lie within
    a piece. A phrase of 2 to 4 words that occurs ``threshold`` times is a candidate. Of its
    cuts in two the one with the lowest score counts; see the module for the rest. A null
    language is ``und``; null and empty texts have no words. Repeated rows count as often as
    they occur. Texts of any length are counted whole; a task holds the words of one text at
    least. Ties are ordered down to the phrase itself. Other columns are ignored. An empty
    table gives an empty result. Counts are exact: hashes only choose what is counted.
    """
    phrases, sizes = frequent_phrases(docs, threshold)
    candidates = saved(scored(phrases), "candidates")
    ranked = top_phrases(without_parts(candidates, share), top)
    # A row for each language that occurs.
    n = sizes.select(F.col("lang").alias("of"), "n")
    return ranked.join(n, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
