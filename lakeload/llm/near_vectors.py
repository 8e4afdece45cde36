"""Near-duplicate vectors: sign hashing in several tables, exact cosines, components.

The signs of projections on random hyperplanes give each vector a bucket in every table.
Vectors in one bucket are compared as blocks of a matrix product, in double precision. A
pair that meets in several tables counts only in the first one, so links are counted
without listing pairs. Tasks return one row for each vector: its number of links and the
head of its connected part, from which components are joined.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, join_groups, maybe_broadcast, saved

LEAST_COSINE = 0.93
MISSED = 0.001  # the share of pairs just at the threshold that may meet in no table
BUCKET_ROWS = 2048  # aimed at; a bucket with more is compared block by block
SEED = 29
# Cosines this near the threshold are computed once more, from the vectors as they are.
CLOSE = 1e-9


def tables_for(rows: int, cosine: float, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a bucket and number of tables, for so many rows of one label.

    Bits grow with the logarithm of the rows, so buckets do not; the number of tables
    then follows from the share of pairs that may be missed.
    """
    bits = min(16, max(4, math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - meet))


def _buckets(bits: int, tables: int):
    powers = 1 << np.arange(bits)
    planes: dict[int, np.ndarray] = {}

    @F.pandas_udf("array<int>")
    def hashed(vectors: pd.Series) -> pd.Series:
        out = []
        for vector in vectors:
            size = len(vector)
            if size not in planes:
                planes[size] = np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))
            v = np.asarray(vector, float)
            signs = (v / np.abs(v).max()) @ planes[size] >= 0
            out.append(signs.reshape(tables, bits) @ powers)
        return pd.Series(out)

    return hashed


def _compare(cosine: float):
    """Links and heads inside a block, or between two blocks of one bucket."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        table, first, second = key[2], key[4], key[5]
        raw = np.stack(rows["embedding"].to_numpy()).astype(float)
        raw /= np.abs(raw).max(1, keepdims=True)
        unit = raw / np.sqrt((raw * raw).sum(1, keepdims=True))
        ids, weights = rows["unit"].to_numpy(), rows["weight"].to_numpy()
        buckets = np.stack(rows["buckets"].to_numpy())
        block = rows["block"].to_numpy()
        left = np.flatnonzero(block == first)
        right = np.flatnonzero(block == second)
        product = unit[left] @ unit[right].T
        a, b = np.nonzero(product >= cosine - CLOSE)
        values = product[a, b]
        a, b = left[a], right[b]
        if first == second:
            once = a < b
            a, b, values = a[once], b[once], values[once]
        near = np.abs(values - cosine) <= CLOSE
        for k in np.flatnonzero(near):
            x, y = raw[a[k]], raw[b[k]]
            values[k] = math.fsum(x * y) / (math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y)))
        linked = values >= cosine
        a, b = a[linked], b[linked]
        new = ~(buckets[a, :table] == buckets[b, :table]).any(1) if table else np.ones(len(a), bool)
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, a[new], weights[b[new]])
        np.add.at(links, b[new], weights[a[new]])
        head = ids.copy()
        while True:
            before = head.copy()
            low = np.minimum(head[a], head[b])
            np.minimum.at(head, a, low)
            np.minimum.at(head, b, low)
            if (before == head).all():
                break
        some = (links > 0) | (head != ids)
        return pd.DataFrame({"unit": ids[some], "links": links[some], "head": head[some]})

    return run


def link(embeddings: DataFrame, cosine: float = LEAST_COSINE, missed: float = MISSED) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Only vectors of one label and one length are compared. Vectors that are null or zero,
    or hold null or non-finite components, and rows without a label or an id link with
    nothing. Rows with equal vectors are compared once and counted as often as they occur,
    so copies need no pairs. Rows that share an id but not the vector are linked each by
    itself. Links found are exact; of pairs just at the threshold about ``missed`` are
    not found, of closer pairs far fewer. Other columns are ignored.
    """
    sound = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    marked = embeddings.select("vec_id", "label", "embedding", F.coalesce(sound, F.lit(False)).alias("sound"))
    hashes = [F.xxhash64(F.lit(i), "label", "embedding").alias(f"key{i}") for i in (1, 2)]
    keyed = marked.where("sound").select("vec_id", "label", "embedding", *hashes)
    rows = saved(keyed.select("vec_id", "key1", "key2"), "vectors")
    units = (
        keyed.groupBy("key1", "key2")
        .agg(
            F.min("vec_id").alias("least_id"),
            F.count(F.lit(1)).alias("weight"),
            F.any_value("label").alias("label"),
            F.any_value("embedding").alias("embedding"),
        )
        .withColumn("unit", F.monotonically_increasing_id())
    )
    units = saved(units, "vector-units")
    per_label = units.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(per_label, cosine, missed)

    hashed = units.select("unit", "weight", "label", "embedding").withColumn(
        "buckets", _buckets(bits, tables)("embedding")
    )
    where = ["label", "length", "table", "bucket"]
    dealt = hashed.select("*", F.size("embedding").alias("length"), F.posexplode("buckets").alias("table", "bucket"))
    large = dealt.groupBy(*where).count().where(F.col("count") > BUCKET_ROWS)
    large = saved(large.select(*where, F.ceil(F.col("count") / BUCKET_ROWS).alias("blocks")), "vector-buckets")
    dealt = dealt.join(maybe_broadcast(large), where, "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    # Each row goes to the pairs of its own block with every block of the bucket.
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("unit"), "blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("*", other).select(
        *where, "unit", "weight", "embedding", "buckets", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
    )
    found = dealt.groupBy(*where, "first", "second").applyInPandas(
        _compare(cosine), "unit long, links long, head long"
    )
    found = saved(found, "vector-links")

    links = found.groupBy("unit").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("unit").alias("a"), F.col("head").alias("b")), "vector-parts")
    least = units.select("unit", "least_id").join(parts, F.col("unit") == F.col("id"))
    heads = least.groupBy("component").agg(F.min("least_id").alias("component_id"))
    grouped = least.join(heads, "component").select("unit", "component_id")
    facts = (
        units.select("key1", "key2", "unit", "weight", "least_id")
        .join(links, "unit", "left")
        .join(grouped, "unit", "left")
        .select(
            "key1", "key2", "weight",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least_id").alias("component_id"),
        )
    )
    facts = saved(facts, "vector-facts")
    linked = join_groups(rows, facts, ["key1", "key2"], "weight", rows.row_count)
    alone = marked.where("NOT sound").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
