"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard by its hash. In each
round, every group that lies in several shards asks for one: that with most of its documents.
What leaves a shard in a round counts as room there, so full shards still exchange groups.
Rounds go on until the gain levels off. Groups that are large next to a shard are placed
first, by size. Documents without links and the few groups left fill the rest, so that the
counts of shards differ by one at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_groups, ranked, saved

# Rows to number in one task at a time.
BUCKET_ROWS = 20_000
# Groups above this share of a shard are placed by the driver; there are few.
LARGE = 1 / 16
# A round that moves a smaller share of the linked rows has levelled off.
LEVEL = 0.001


def _unit(*values: Column) -> Column:
    """A hash as a number from 0 to 1."""
    return F.shiftrightunsigned(F.xxhash64(*values), 11).cast("double") / float(1 << 53)


def _by_shard(shard: Column, values: list) -> Column:
    """The value for each shard; there are only as many as shards."""
    return F.get(F.array(*[F.lit(v) for v in values]), shard)


def base_rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.octet_length(text)).alias("group"),
        F.xxhash64("doc_id", text, F.lit(5)).alias("hash"),
    )
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "sharding")


def packed(groups: list[tuple[int, int]], room: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """Places of large groups (group, size), and the room that they leave.

    A place is (group, shard, first, end): the group's rows from first to end. Larger
    groups come first; each takes the tightest shard that holds it whole. One that fits
    nowhere fills the emptiest shards.
    """
    room, out = list(room), []
    for group, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        at = 0
        while at < size:
            fit = [s for s in range(len(room)) if room[s] >= size - at]
            s = min(fit, key=lambda s: (room[s], s)) if fit else max(range(len(room)), key=lambda s: (room[s], -s))
            n = min(room[s], size - at)
            out.append((group, s, at, at + n))
            room[s] -= n
            at += n
    return out, room


def admitted(wanted: np.ndarray, loads: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each shard, the largest share of the rows that ask for it that leaves none overfull.

    ``wanted`` has the rows that would move from a shard (row) to another (column). What
    leaves a shard is room there. A shard already overfull admits none unless more leave.
    """
    share, asked = np.ones(len(room)), np.maximum(wanted.sum(0), 1e-9)
    for _ in range(10_000):
        now = np.minimum(share, np.clip((room - loads + wanted @ share) / asked, 0, 1))
        if (share - now).max() < 1e-6:
            return now
        share = now
    return share


def _flows(groups: DataFrame, shards: int) -> np.ndarray:
    """Rows by the shard that holds them and the group's target."""
    out = np.zeros((shards, shards))
    held = groups.select(F.explode("held").alias("_at"), "target").where("_at.shard <> target")
    for r in held.groupBy("_at.shard", "target").agg(F.sum("_at.n").alias("n")).collect():
        out[r.shard, r.target] = r.n
    return out


def propagate(linked: DataFrame, room: list[int], rounds: int | None) -> DataFrame:
    """(group, group_size, shard) of the groups that come to lie in one shard."""
    shards, limit = len(room), np.array(room, float)
    held = linked.groupBy("group", "group_size", "shard").agg(F.count(F.lit(1)).alias("n"))
    held = held.groupBy("group", "group_size").agg(F.collect_list(F.struct("shard", "n")).alias("held"))
    held = saved(held, "sharding-held")
    loads = np.zeros(shards)
    cells = held.select(F.explode("held").alias("_at")).groupBy("_at.shard").agg(F.sum("_at.n").alias("n"))
    for r in cells.collect():
        loads[r.shard] = r.n
    done = held.where(F.size("held") == 1).select("group", "group_size", F.col("held")[0]["shard"].alias("shard"))
    left = held.where(F.size("held") > 1)
    closed, level, number = {s for s in range(shards) if room[s] <= 0}, 0, 0
    while level < 2 and (rounds is None or number < rounds):
        open_ = [s for s in range(shards) if s not in closed]
        if not open_:
            break
        # Equal numbers are told apart by a hash, so that no shard is preferred.
        turn = F.lit(number)
        here = F.filter("held", lambda h: h["shard"].isin(open_))
        here = F.transform(
            here, lambda h: F.struct(h["n"], F.xxhash64("group", h["shard"], turn), h["shard"].alias("shard"))
        )
        other = _by_shard(F.pmod(F.xxhash64("group", turn), F.lit(len(open_))).cast("int"), open_)
        tried = left.withColumn("target", F.coalesce(F.array_max(here)["shard"], other))
        wanted = _flows(tried, shards)
        if not wanted.any():
            break
        share = admitted(wanted, loads, limit)
        goes = _unit("group", turn, F.lit("goes")) < _by_shard(F.col("target"), share.tolist())
        after = saved(tried.withColumn("goes", goes), "sharding-round")
        moved = _flows(after.where("goes"), shards)
        loads += moved.sum(0) - moved.sum(1)
        done = done.unionByName(after.where("goes").select("group", "group_size", F.col("target").alias("shard")))
        left = after.where("NOT goes").drop("goes", "target")
        # Shards that admit next to none are not asked again until they have room.
        closed = {s for s in closed if loads[s] >= limit[s]}
        closed |= {s for s in range(shards) if wanted[:, s].any() and share[s] < 0.02}
        level = level + 1 if moved.sum() < LEVEL * loads.sum() else 0
        number += 1
    return done


def shard(docs: DataFrame, shards: int = 8, rounds: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    The law is ``rows``: counts of shards are at most one apart, however texts repeat; a
    group too large for a shard is spread over as few as the quotas allow. ``slot`` counts
    a shard's rows from 0 without gaps. ``rounds`` bounds the propagation, which otherwise
    ends when the gain levels off. Null texts count as empty and as equal to empty ones.
    Null and repeated ids are fine, and so are repeated rows: each is placed. Other columns
    are ignored. An empty table gives no rows.
    """
    base = base_rows(docs)
    total = base.row_count
    sizes = base.groupBy("group").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    sizes = saved(sizes, "sharding-groups")
    placed = join_groups(base, sizes, "group", "group_size", total, "left")
    placed = saved(placed, "sharding-linked")
    room = [total // shards + (s < total % shards) for s in range(shards)]

    is_large = F.col("group_size") > total / shards * LARGE
    places, rest = packed([(r.group, r.group_size) for r in sizes.where(is_large).collect()], room)
    places = docs.sparkSession.createDataFrame(places, "group long, shard int, _first long, _end long")
    piece = F.pmod("hash", F.greatest(F.floor(F.col("group_size") / BUCKET_ROWS), F.lit(1)))
    large = ranked(placed.where(is_large).withColumn("_piece", piece), ["group"], ["_piece"], ["hash", "row"], "_place")
    large = large.join(F.broadcast(places), "group").where("_place >= _first AND _place < _end")

    # The others start in proportion to the room that is left.
    ends = np.cumsum(rest) / max(sum(rest), 1)
    start = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        start = F.when(_unit("hash", F.lit("start")) < float(ends[s]), F.lit(s)).otherwise(start)
    small = placed.where("group_size IS NOT NULL").where(~is_large)
    chosen = propagate(small.withColumn("shard", start), rest, rounds)
    chosen = chosen.withColumnRenamed("group_size", "_size")
    small = join_groups(small, chosen, "group", "_size", total, "left")

    columns = ["doc_id", "size", "text_crc32", "group", "hash", "row", "group_size", "shard"]
    linked = large.select(*columns).unionByName(small.select(*columns))
    # Groups that found no shard are parted with, too.
    linked = linked.withColumn("shard", F.coalesce("shard", F.lit(shards)))
    # By group, so that an overfull shard parts with whole groups where it can, large ones last.
    buckets = max(1, total // BUCKET_ROWS)
    bucket = F.shiftrightunsigned("group", 40) % buckets
    in_order = linked.withColumn("_bucket", F.when(is_large, bucket - buckets).otherwise(bucket))
    in_order = in_order.withColumn("_piece", piece)
    in_order = saved(ranked(in_order, ["shard"], ["_bucket", "_piece"], ["group", "row"], "slot"), "sharding-slots")
    stays = F.col("slot") < _by_shard(F.col("shard"), [*room, 0])
    kept = in_order.where(stays)
    counts = {r.shard: r.n for r in in_order.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = [min(counts.get(s, 0), room[s]) for s in range(shards)]

    columns = ["doc_id", "size", "text_crc32", "hash", "row"]
    free = placed.where("group_size IS NULL").select(*columns)
    # Rows of a group stay next to each other, so that most go to one shard.
    together = F.when(F.col("group_size") <= BUCKET_ROWS, F.col("group")).otherwise(F.col("hash"))
    parted = in_order.where(~stays).withColumn("hash", together).select(*columns)
    free = free.unionByName(parted)
    free = free.withColumn("_bucket", F.shiftrightunsigned("hash", 34) % max(1, total // BUCKET_ROWS))
    free = ranked(free, [], ["_bucket"], ["hash", "row"], "place")
    # Places in the order of shards: each takes as many as it still has room for.
    chosen, slot, start = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        here = (F.col("place") >= start) & (F.col("place") < start + room[s] - held[s])
        chosen = F.when(here, F.lit(s)).otherwise(chosen)
        slot = F.when(here, F.col("place") - start + held[s]).otherwise(slot)
        start += room[s] - held[s]
    filled = free.withColumn("shard", chosen).withColumn("slot", slot)
    out = ["doc_id", "size", "text_crc32", "shard", "slot"]
    return (
        kept.select(*out)
        .unionByName(filled.select(*out))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"),
            F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
        )
    )
