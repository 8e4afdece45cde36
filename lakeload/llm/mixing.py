"""Mixing sources to target weights, by thresholds on a hash of each row.

All work is DataFrame expressions. A source's target is met with whole copies of the
source and, for what is left, the rows whose hash lies below a threshold. Thresholds come
from histograms of tokens by source and hash bucket; only the bucket in which a budget ends
is looked at more finely, so rows are never sorted. Where it ends among rows that share one
hash, as rows equal in key and text do, as many of them go in as come nearest to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import maybe_broadcast, ranked, saved, word_count

HASH_BITS = 60
LEVEL_BITS = 10
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
BLOCK_ROWS = 10_000  # rows of one hash that are numbered together


def row_hash(key: str = "doc_id", text: str = "text", seed: int = 17) -> Column:
    """60 bits from the key and the text; only rows equal in both share one."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, text), 64 - HASH_BITS)


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, hash) of every row, stored once for all later steps."""
    return saved(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(text).alias("size"),
            row_hash(key, text).alias("hash"),
        ),
        "mixing",
    )


def targets(counted: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target): shares of all tokens by weight, capped per source.

    Sources in code point order, null last, take the weights in turn. Where a share
    is above ``repeats`` times the source's size, the excess is reshared by weight among
    the others until none is above. That ends at one level of tokens per unit of weight:
    with sources in the order of cap by weight, the first whose cap holds the level that
    the remaining budget gives.
    """
    per_source = counted.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per_source.withColumn("weight", cycle[place])
    cap = F.col("source_size") * float(repeats)
    weighed = weighed.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    leveled = weighed.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)
    share = F.coalesce(first["level"] * F.col("weight"), F.col("cap"))
    return leveled.select("source", "source_size", F.least("cap", share).alias("target"))


def thresholds(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, threshold, edge, extra): how often rows go in.

    Rows go in ``copies`` times, and once more below ``threshold``. Of a last single row it
    is decided by what comes nearer to the target. If several rows share the last hash,
    that is ``edge``, and ``extra`` of them go in once more; else ``edge`` is null.
    """
    copies = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    left = F.col("target") - F.col("copies") * F.col("source_size")
    state = wanted.withColumn("copies", copies).select(
        "source", "source_size", "target", "copies",
        left.alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("inside"),
        F.lit(0).cast("long").alias("rows"),
        F.lit(False).alias("settled"),
    )
    state = saved(state, "mixing-state")
    shift = HASH_BITS
    while shift > 0:
        shift -= LEVEL_BITS
        state = saved(_refine(counted, state, shift), "mixing-state")
        if state.where("NOT settled").isEmpty():
            break
    left = F.col("budget") - F.col("below")
    some = F.when(F.col("rows") > 0, F.round(left * F.col("rows") / F.col("inside"))).otherwise(0)
    state = state.withColumn("extra", F.greatest(F.least(some.cast("long"), "rows"), F.lit(0)))
    parted = (F.col("rows") > 1) & (F.col("extra") > 0) & (F.col("extra") < F.col("rows"))
    whole = (F.col("extra") > 0) & (F.col("extra") == F.col("rows"))
    return state.select(
        "source", "source_size", "target", "copies",
        F.shiftleft(F.col("prefix") + F.when(whole, 1).otherwise(0), shift).alias("threshold"),
        F.when(parted, F.col("prefix")).alias("edge"),
        "extra",
    )


def _refine(counted: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """Move every prefix one level down, into the bucket in which the budget ends."""
    wide = shift + LEVEL_BITS
    known = state.select(F.col("source").alias("of"), F.col("prefix").alias("at"))
    edge = counted.join(
        maybe_broadcast(known),
        F.col("source").eqNullSafe(F.col("of"))
        & (F.shiftright("hash", wide) == F.col("at")),
    )
    bucket = F.shiftright("hash", shift)
    hist = edge.groupBy("of", bucket.alias("bucket")).agg(
        F.sum("size").alias("tokens"), F.count_if(F.col("size") > 0).alias("worded")
    )
    up_to = Window.partitionBy("of").orderBy("bucket")
    hist = hist.withColumn("upto", F.sum("tokens").over(up_to))
    joined = state.join(
        hist,
        F.col("source").eqNullSafe(F.col("of")) & (F.col("below") + F.col("upto") > F.col("budget")),
        "left",
    )
    found = joined.groupBy("source", "source_size", "target", "copies", "budget", "prefix", "below").agg(
        F.min(F.struct("bucket", "upto", "tokens", "worded")).alias("hit")
    )
    # Without a hit the budget ends at the end of the bucket (no rows, or rounding).
    child = F.coalesce(F.col("hit.bucket"), F.shiftleft("prefix", LEVEL_BITS))
    below = F.col("below") + F.coalesce(F.col("hit.upto") - F.col("hit.tokens"), F.lit(0))
    return found.select(
        "source", "source_size", "target", "copies", "budget",
        child.alias("prefix"),
        below.alias("below"),
        F.coalesce("hit.tokens", F.lit(0)).alias("inside"),
        F.coalesce("hit.worded", F.lit(0)).alias("rows"),
        (F.coalesce("hit.worded", F.lit(0)) <= 1).alias("settled"),
    )


def repeated(rows: DataFrame, plan: DataFrame, source: str, hashed: Column) -> DataFrame:
    """(row, source_size, target, repeats): each row as a struct, and how often the mix takes it.

    Rows of a source's ``edge`` are stored once more and numbered by their place there, in
    blocks of a bounded size, so that a row may be read again and keeps its number.
    """
    held = rows.select(F.struct("*").alias("row"), F.col(f"`{source}`").alias("of"), hashed.alias("hash"))
    marked = held.join(maybe_broadcast(plan), F.col("of").eqNullSafe(F.col("source")))
    times = F.col("copies") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)
    columns = ["row", "source_size", "target", "repeats"]
    if plan.where("edge IS NOT NULL").isEmpty():
        return marked.withColumn("repeats", times.cast("int")).select(*columns)
    at_edge = F.col("hash").eqNullSafe(F.col("edge"))
    others = marked.where(~at_edge).withColumn("repeats", times.cast("int"))
    tied = marked.where(at_edge).select(
        "row", "source_size", "target", "copies", "extra",
        F.coalesce("of", F.lit("")).alias("name"), F.col("of").isNull().alias("nameless"),
    )
    placed = saved(tied, "mixing-ties").select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    placed = placed.withColumn("block", F.floor(F.col("place") / BLOCK_ROWS))
    numbered = ranked(placed, ["name", "nameless"], ["file", "block"], ["place"], "number")
    times = F.col("copies") + F.when(F.col("number") < F.col("extra"), 1).otherwise(0)
    return others.select(*columns).unionByName(
        numbered.withColumn("repeats", times.cast("int")).select(*columns)
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row for each of ``docs``: doc_id, size, source_size, target, taken.

    Null texts and empty texts have size 0 and are taken 0 words; a text of any length
    counts whole. Rows without a source are a source of their own, the last. Rows equal in
    id and text share a hash; if a source's target ends among them, some of them are taken,
    and as they are interchangeable the result is the same on each run. An empty table gives
    an empty result; other columns are ignored, whatever their names.
    """
    counted = sizes(docs)
    plan = saved(thresholds(counted, targets(counted, weights, repeats)), "mixing-plan")
    mixed = repeated(counted, plan, "source", F.col("hash"))
    return mixed.select(
        "row.doc_id", "row.size", "source_size", "target",
        (F.col("row.size") * F.col("repeats")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs`` as the mix holds them: left out, once, or repeated.

    Rows, columns and cases as in ``mix``. A row without words costs no tokens; it is taken
    as often as its hash asks for, so in a repeated source several times.
    """
    counted = sizes(docs)
    plan = saved(thresholds(counted, targets(counted, weights, repeats)), "mixing-plan")
    kept = repeated(docs, plan, "source", row_hash()).where("repeats > 0")
    each = kept.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy"))
    return each.select(*[F.col(f"row.`{c}`") for c in docs.columns])
