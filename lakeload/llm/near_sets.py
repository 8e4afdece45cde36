"""Near-duplicate texts: an exact join of shingle sets by Jaccard similarity.

A set's prefix is its first shingles in one global order, rare ones first; two sets that
reach the similarity share a shingle of their prefixes. Documents with the same prefix and
size are one group, and only groups are listed under the shingles of their prefixes. All
members of a group meet others alike, so candidates are found between groups:

1. In some rounds every group is paired with one other group of its lists, of the largest
   component there. The pair is expanded: its members are compared to one member of the
   other group, and linked if their sets reach the similarity. Large families of near copies
   become components by that, without listing their pairs.
2. Then pairs of groups in different components are listed, all of them. Those whose sizes
   and shared prefix shingles leave room for the similarity are expanded to pairs of members,
   which are verified by their whole sets.

Members of one group may be of several components; a group then counts once in each.

The order needs to know which shingles are frequent. Counts of 32-bit keys of all shingles
are added up over all documents; a bounded number of the most frequent keys orders the
prefixes.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, components, join_groups, maybe_broadcast, saved, split_words, text_slices, unused

LEAST_COUNT = 8  # keys seen less often are ordered by their hash alone
MOST_KEYS = 1 << 20  # frequent keys that tasks get, 8 bytes each
KEY_RANGES = 1024  # ranges of keys, each counted by itself
FLUSH_SHINGLES = 2_000_000  # that a task gathers before it counts them
LIST_ROWS = 50_000  # of one shingle that a task looks through
ROUNDS = 6  # at most, of linking members to one other
PIECE = 1 << 14  # words that are hashed at once

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, text after text, and each text's bounds.

    Unsigned 64-bit, repeats included. A text of fewer words makes one run of all of them.
    """
    words, numbers, bounds = split_words(texts)
    texts = words.to_numpy(zero_copy_only=False)  # a list from Arrow takes much longer
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(words))
    lengths = np.diff(bounds)
    counts = np.where(lengths > 0, np.maximum(lengths - width + 1, 1), 0)
    ends = np.cumsum(counts)
    first = np.arange(ends[-1] if len(ends) else 0) + np.repeat(bounds[:-1] - (ends - counts), counts)
    total = _runs(known[numbers], width)[first]
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    for length in np.unique(lengths[short]):
        at = short[lengths[short] == length]
        words_of = numbers[bounds[at][:, None] + np.arange(length)]
        total[ends[at] - 1] = _runs(known[words_of.ravel()], int(length))[::length]
    return total, np.concatenate([[0], ends]).astype(np.int64)


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` words from each word on, in pieces that fit a processor's cache."""
    out = np.full(len(hashes), width, np.uint64)
    hashes = np.concatenate([hashes, np.zeros(width, np.uint64)])
    high = np.empty(min(PIECE, len(out)), np.uint64)
    for start in range(0, len(out), PIECE):
        mixed = out[start : start + PIECE]
        shifted = high[: len(mixed)]
        for k in range(width):
            mixed ^= hashes[start + k : start + k + len(mixed)]
            mixed *= _MIX[0]
            mixed ^= np.right_shift(mixed, np.uint64(29), out=shifted)
            mixed *= _MIX[1]
            mixed ^= np.right_shift(mixed, np.uint64(32), out=shifted)
        mixed *= _MIX[2]
    return out


def sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    total, bounds = shingles(texts, width)
    return [_distinct(total[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, without repeats; ``numbers`` is sorted in place."""
    numbers.sort()
    if len(numbers) < 2:
        return numbers
    new = numbers[1:] != numbers[:-1]
    return numbers if new.all() else numbers[np.concatenate([[True], new])]


def _count_keys(width: int):
    """Sorted keys with their counts, packed, for each range of keys."""

    def pack(parts: list[np.ndarray]):
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        ends = np.searchsorted(keys, np.arange(1, KEY_RANGES, dtype=np.uint64) * np.uint64(2**32 // KEY_RANGES))
        for number, (k, n) in enumerate(zip(np.split(keys, ends), np.split(counts, ends), strict=True)):
            if len(k):
                steps = np.diff(k, prepend=k[:1]).astype(np.uint32)
                steps[0] = k[0]
                planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
                yield number, zlib.compress(planes, 1), zlib.compress(n.astype(np.uint32).tobytes(), 1)

    def run(batches):
        parts, held = [], 0
        for batch in text_slices(batches, 0):
            total, _ = shingles(batch.column(0), width)
            parts.append((total >> np.uint64(32)).astype(np.uint32))
            held += len(total)
            if held >= FLUSH_SHINGLES:
                yield _batch(pack(parts))
                parts, held = [], 0
        if held:
            yield _batch(pack(parts))

    def _batch(rows):
        numbers, keys, counts = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict(
            {"range": pa.array(numbers, pa.int32()), "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())}
        )

    return run


def _add_keys(least: int):
    """Add the counts of each range in a table of its own, and keep the frequent keys."""

    def run(batches):
        size = 2**32 // KEY_RANGES
        current, totals = None, None

        def frequent():
            at = np.flatnonzero(totals >= least)
            return pa.RecordBatch.from_pydict(
                {"key": pa.array(at.astype(np.int64) + current * size), "df": pa.array(totals[at].astype(np.int64))}
            )

        for batch in batches:
            for number, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if number != current:
                    if current is not None:
                        yield frequent()
                    current, totals = number, np.zeros(size, np.int64)
                planes = np.frombuffer(zlib.decompress(keys), np.uint8).reshape(4, -1)
                steps = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
                at = np.cumsum(steps, dtype=np.int64) - current * size
                totals[at] += np.frombuffer(zlib.decompress(counts), np.uint32)
        if current is not None:
            yield frequent()

    return run


def frequent_keys(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent keys, at most ``MOST_KEYS``, sorted, with their counts."""
    packed = docs.select("text").mapInArrow(_count_keys(width), "range int, keys binary, counts binary")
    dealt = packed.repartition("range").sortWithinPartitions("range")
    counted = saved(dealt.mapInArrow(_add_keys(LEAST_COUNT), "key long, df long"), "shingle-keys")
    spread = counted.groupBy("df").count().orderBy(F.col("df").desc())
    held, least = 0, LEAST_COUNT
    for row in spread.toLocalIterator():
        held += row["count"]
        if held > MOST_KEYS:
            least = row.df + 1
            break
    table = counted.where(F.col("df") >= least).toArrow()
    keys, df = np.asarray(table.column("key")), np.asarray(table.column("df"))
    order = np.argsort(keys)
    return keys[order].astype(np.uint32), df[order].astype(np.int64)


def _describe(width: int, percent: int, keys: np.ndarray, df: np.ndarray):
    """For each row: size of its set, digest, and prefix with the lists' numbers of parts."""

    def order(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles in the global order, with the counts of the frequent ones."""
        if not len(keys):
            return np.arange(len(found)), np.zeros(len(found), np.int64)
        short = (found >> np.uint64(32)).astype(np.uint32)
        place = np.minimum(np.searchsorted(keys, short), len(keys) - 1)
        seen = np.where(keys[place] == short, df[place], 0)
        often = np.flatnonzero(seen)
        often = often[np.argsort(seen[often], kind="stable")]
        return np.concatenate([np.flatnonzero(seen == 0), often]), seen

    def run(batches):
        for batch in text_slices(batches, 1):
            ids = batch.column(0)
            sizes, digests, groups, prefixes, parts = [], [], [], [], []
            for found in sets(batch.column(1), width):
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                length = len(found) - -(-percent * len(found) // 100) + 1 if len(found) else 0
                first, seen = order(found)
                prefix = found[first[:length]].view(np.int64)
                groups.append(xxhash.xxh3_128_digest(prefix.tobytes() + len(found).to_bytes(8, "little")))
                prefixes.append(prefix)
                parts.append((seen[first[:length]] // LIST_ROWS + 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(groups, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(parts, pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "digest", "group", "prefix", "parts"],
            )

    return run


def _sets(width: int):
    def run(batches):
        for batch in text_slices(batches, 1):
            found = [s.view(np.int64) for s in sets(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"]
            )

    return run


def _stored_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles, n) of the units that share a list with another."""
    needed = saved(members.select(F.col("unit").alias("doc_id")).distinct(), "set-ids")
    texts = docs.select("doc_id", "text").join(maybe_broadcast(needed), "doc_id")
    found = texts.mapInArrow(_sets(width), "doc_id long, shingles array<long>")
    return saved(found.select("doc_id", "shingles", F.size("shingles").alias("n")), "sets")


def _verified(pairs: DataFrame, stored: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of units, those whose whole sets reach the similarity."""
    pairs = saved(pairs.select("a", "b").distinct(), "set-pairs")
    if not pairs.row_count:
        return pairs
    needed = saved(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "set-ids")
    # An id may occur with several texts; it links by each of them.
    sets = stored.join(maybe_broadcast(needed), "doc_id")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"), F.col("n").alias("n_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"), F.col("n").alias("n_b"))
    common = F.size(F.array_intersect("left", "right"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    reached = 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))
    return joined.where(reached).select("a", "b").distinct()


def _size_class(step: float, percent: int):
    """Sets that can reach the similarity are of one class, or of neighbouring ones."""
    return F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + step).cast("int")


def _enough(shared: str, percent: int):
    """Whether prefixes that share so many shingles leave room for the similarity."""
    rest = lambda n: F.floor(F.col(n) * percent / 100) + 1  # noqa: E731  outside the prefix, rounded up
    most = F.col(shared) + F.greatest(rest("n_a"), rest("n_b"))
    return most * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))


def near_classes(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id for every row.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word shingles. With fewer words, all words are the one shingle. Documents
    without words, and null texts, have an empty set and link with nothing. Rows with equal
    sets are compared once. Rows without an id link with nothing and get no component. If an
    id occurs with several texts, it links by each of them. Other columns are ignored.
    Sets are held as 64-bit hashes.
    """
    keys, df = frequent_keys(docs, width)
    described = docs.select("doc_id", "text").mapInArrow(
        _describe(width, percent, keys, df),
        "doc_id long, n long, digest binary, group binary, prefix array<long>, parts array<int>",
    )
    rows = saved(described, "prefixes")
    linkable = rows.where("n > 0 AND doc_id IS NOT NULL")

    # Units are distinct sets, by their least id; groups are units with one prefix and size.
    units = linkable.groupBy("digest").agg(
        F.min("doc_id").alias("unit"),
        F.count(F.lit(1)).alias("copies"),
        F.any_value("n").alias("n"),
        F.any_value("group").alias("group"),
    )
    units = saved(units, "units")
    members = units.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    groups = linkable.select("group", "n", "prefix", "parts").dropDuplicates(["group"]).join(members, "group")
    listed = groups.select(
        "group", "n", "members", F.posexplode(F.arrays_zip("prefix", "parts")).alias("at", "entry")
    ).select(
        F.col("entry.prefix").alias("shingle"),
        F.pmod(F.xxhash64("group"), F.col("entry.parts")).cast("int").alias("part"),
        (F.col("entry.parts") > 1).alias("split"),
        "at", "group", "n", "members",
    )
    # A list split into parts is long; the others are kept if they hold two members.
    in_list = Window.partitionBy("shingle", "part")
    shared = listed.withColumn("in_list", F.sum("members").over(in_list)).where("split OR in_list > 1")
    shared = saved(shared.select("shingle", "part", "at", "group", "in_list"), "lists")
    # A group that shares most is the likeliest to hold what others are copies of.
    degrees = shared.groupBy("group").agg(F.sum("in_list").alias("degree"))
    lists = shared.drop("in_list")
    members = saved(units.join(degrees, "group").select("group", "unit", "n", "degree"), "members")

    # Ids with several texts are vertices of several units.
    several = linkable.select("doc_id", "digest").distinct().join(units.select("digest", "unit"), "digest")
    several = several.groupBy("doc_id").agg(F.min("unit").alias("a"), F.max("unit").alias("b"))
    edges = saved(several.where("a <> b").select("a", "b"), "edges")

    stored = _stored_sets(docs, members, width)
    parts = components(edges)
    for number in range(ROUNDS):
        held, cells = _cells(members, parts, number)
        best = _partners(lists.join(cells, "group"), number, percent)
        new = saved(_verified(_expanded(best, held, cells), stored, percent), "edges")
        edges = edges.unionByName(new)
        if new.row_count:
            parts = components(edges)
        elif number > 2:
            break

    held, cells = _cells(members, parts)
    labelled = saved(lists.join(cells, "group"), "labelled")
    met = saved(_pairs_across(labelled, percent), "group-pairs")
    edges = edges.unionByName(_verified(_expanded(met, held), stored, percent))
    parts = components(saved(edges, "edges"))

    found = units.join(parts, F.col("unit") == F.col("id"), "left").select(
        "digest", "copies", F.coalesce("component", "unit").alias("component_id")
    )
    total = rows.row_count
    known = join_groups(linkable.select("doc_id", "n", "digest"), saved(found, "classes"), "digest", "copies", total)
    alone = rows.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    result = known.select("doc_id", "n", "component_id").unionByName(alone)
    return result.withColumnRenamed("n", "n_shingles")


def _partners(labelled: DataFrame, number: int, percent: int) -> DataFrame:
    """For each cell (a) another one (b) to compare it to, of the largest component in its lists.

    The first rounds take the group that shares most, later ones others of that component;
    rounds alternate between two divisions of sizes into classes.
    """
    own = labelled.withColumn("class", _size_class(number % 2 / 2, percent))
    place = ["shingle", "part", "class"]
    draw = -F.col("degree") if number < 2 else F.xxhash64("cell", F.lit(number))
    any_one = F.struct(draw.alias("draw"), "cell", "n")
    heads = own.groupBy(*place, "component").agg(F.sum("units").alias("units"), F.min(any_one).alias("one"))
    heads = heads.groupBy(*place).agg(
        F.max(F.struct("units", (-F.col("one.draw")).alias("by"), "component", "one")).alias("top"),
        F.count(F.lit(1)).alias("components"),
    )
    partners = own.join(heads.where("components > 1"), place).where("component <> top.component")
    met = partners.groupBy(
        F.col("cell").alias("a"), F.col("n").alias("n_a"),
        F.col("top.one.cell").alias("b"), F.col("top.one.n").alias("n_b"),
    ).agg(F.count(F.lit(1)).alias("met"))
    return met.where(_enough("met", percent)).groupBy("a").agg(
        F.max_by("b", F.struct("met", -F.col("b"))).alias("b")
    )


def _cells(members: DataFrame, parts: DataFrame, number: int = 0) -> tuple[DataFrame, DataFrame]:
    """Members with their cell, and the cells: the members of a group in one component.

    A cell goes by its least unit. ``one`` is a member that others are compared to, another
    one in each of the later rounds.
    """
    known = parts.select(F.col("id").alias("unit"), "component")
    own = members.join(maybe_broadcast(known), "unit", "left").withColumn("component", F.coalesce("component", "unit"))
    draw = F.col("unit") if number < 2 else F.xxhash64("unit", F.lit(number))
    cells = own.groupBy("group", "component").agg(
        F.min("unit").alias("cell"), F.min_by("unit", draw).alias("one"),
        F.any_value("n").alias("n"), F.any_value("degree").alias("degree"), F.count(F.lit(1)).alias("units"),
    )
    cells = saved(cells, "cells")
    named = cells.select("group", "component", "cell")
    return saved(own.join(named, ["group", "component"]).select("cell", "unit"), "cell-members"), cells


def _expanded(pairs: DataFrame, held: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Pairs of members from pairs (a, b) of cells; with ``cells``, b gives only its ``one``."""
    left = held.select(F.col("cell").alias("a"), F.col("unit").alias("left"))
    right = held.select(F.col("cell").alias("b"), F.col("unit").alias("right"))
    if cells is not None:
        right = cells.select(F.col("cell").alias("b"), F.col("one").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select(F.col("left").alias("a"), F.col("right").alias("b"))


def _least_overlap(n_a, n_b, percent: int):
    """The shared shingles that two sets of these sizes need."""
    return F.ceil((n_a + n_b) * percent / (100 + percent))


def _needed(n_a, n_b, percent: int):
    """How many shingles must be shared among the first n - overlap + needed of either set.

    One would do; some more rule out most pairs early. Prefixes hold that many.
    """
    overlap = _least_overlap(n_a, n_b, percent)
    held = lambda n: n - F.ceil(n * percent / 100) + 1 - n + overlap
    return F.least(F.greatest(F.floor(overlap / 50), F.lit(1)), held(n_a), held(n_b))


def _pairs_across(labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of cells of one list, of different components, whose members may be similar.

    Lists are first paired by component, so groups in one component never meet. A pair
    meets only in lists of the first shingles of both, as many as its sizes ask for. As all
    members of a group have its size and its prefix, what is left out here has no links.

    A test takes sizes and places only, so cells of one component that have both alike in a
    list are one form of it there. Forms are tested, and only those that pass become cells.
    """
    forms = labelled.select("shingle", "component", "n", "at").distinct()
    in_list = Window.partitionBy("shingle")
    forms = forms.withColumn("several", F.min("component").over(in_list) < F.max("component").over(in_list))
    forms = saved(forms.where("several").drop("several"), "forms")
    heads = forms.groupBy("shingle", "component").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("at").alias("at")
    )
    heads = saved(heads, "heads")
    c = heads.select("shingle", *[F.col(x).alias(y) for x, y in (("component", "c"), ("least", "l"), ("most", "m"), ("at", "i"))])
    d = heads.select("shingle", *[F.col(x).alias(y) for x, y in (("component", "d"), ("least", "k"), ("most", "o"), ("at", "j"))])
    spare = F.floor(_least_overlap(F.col("m"), F.col("o"), percent) / 50) + 1
    overlap = _least_overlap(F.col("l"), F.col("k"), percent)
    fits = (F.col("m") * 100 >= F.col("k") * percent) & (F.col("o") * 100 >= F.col("l") * percent)
    early = (F.col("i") < F.col("m") - overlap + spare) & (F.col("j") < F.col("o") - overlap + spare)
    on = (c["shingle"] == d["shingle"]) & (F.col("c") < F.col("d")) & fits & early
    meet = c.join(d, on).select(c["shingle"], "c", "d", "k", "o")
    side = lambda rows, x, n, i, *more: rows.select(
        "shingle", F.col("component").alias(x), F.col("n").alias(n), F.col("at").alias(i), *more
    )
    n_a, n_b = F.col("n_a"), F.col("n_b")
    # A form of c goes on only where some size from k to o would take it; the least one asks for least.
    fewest = _least_overlap(n_a, F.greatest(F.col("k").cast("double"), n_a * percent / 100), percent)
    some = (n_a * 100 >= F.col("k") * percent) & (F.col("o") * 100 >= n_a * percent)
    some = some & (F.col("i") < n_a - fewest + F.floor(fewest / 50) + 1)
    met = meet.join(side(forms, "c", "n_a", "i"), ["shingle", "c"]).where(some).select("shingle", "c", "d", "n_a", "i")
    met = met.join(side(forms, "d", "n_b", "j"), ["shingle", "d"])
    reach = _needed(n_a, n_b, percent) - _least_overlap(n_a, n_b, percent)
    met = met.where(
        (n_a * 100 >= n_b * percent) & (n_b * 100 >= n_a * percent)
        & (F.col("i") < n_a + reach) & (F.col("j") < n_b + reach)
    )
    # No pair of cells shares more shingles than the forms of its components and sizes meet in.
    lists = F.size(F.collect_set("shingle").over(Window.partitionBy("c", "d", "n_a", "n_b")))
    met = met.withColumn("lists", lists).where(F.col("lists") >= _needed(n_a, n_b, percent))
    met = maybe_broadcast(saved(met.select("shingle", "c", "n_a", "i", "d", "n_b", "j"), "forms-met"))
    cells = met.join(side(labelled, "c", "n_a", "i", F.col("cell").alias("a")), ["shingle", "c", "n_a", "i"])
    cells = cells.join(side(labelled, "d", "n_b", "j", F.col("cell").alias("b")), ["shingle", "d", "n_b", "j"])
    counted = cells.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("shared"))
    return counted.where(F.col("shared") >= _needed(n_a, n_b, percent)).select("a", "b")


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, that stay: the least id of each component.

    Of rows that share that id the least by text stays. Rows without an id or without
    words stay.
    """
    classes = saved(near_classes(docs, width, percent), "near-classes")
    linked = classes.where("doc_id IS NOT NULL AND n_shingles > 0")
    gone = linked.groupBy("doc_id").agg(
        F.min(F.col("component_id") == F.col("doc_id")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    own, first = unused("_id", docs.columns), unused("_first", docs.columns)
    gone = gone.where("NOT first OR rows > 1").select(F.col("doc_id").alias(own), F.col("first").alias(first))
    marked = docs.join(maybe_broadcast(saved(gone, "dropped")), F.col("doc_id") == F.col(own), "left")
    has_words = F.coalesce(F.regexp_count("text", F.lit(WORD)) > 0, F.lit(False))
    kept = marked.where(F.col(own).isNull() | ~has_words).drop(own, first)
    twice = marked.where(F.col(first)).where(has_words).drop(own, first)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    least = twice.groupBy("doc_id").agg(F.min(F.struct("text", *others)).alias("row"))
    one = least.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"row.`{c}`") for c in docs.columns])
    return kept.unionByName(one)
