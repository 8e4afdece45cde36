"""Exact search for the largest inner products, of integer vectors.

Candidates are dealt into blocks by descending length. Vectors are rotated onto the
singular directions of all candidates, so the first coordinates hold most of a product;
the rest is bounded by the lengths of what remains (Cauchy-Schwarz). The longest block
gives every query a first bound on its k-th score. Later blocks whose lengths cannot reach
it are left out before the shuffle, and inside a block only candidates whose partial sum
plus bound reaches it are computed in full.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import maybe_broadcast, saved

SCALE = 1024
EXACT = float(1 << 53)  # integers of doubles are exact below
PLAIN = float(1 << 51)  # components below are carried as integers by scale, larger ones as they are
LAST = 2**63 - 1
BLOCK_ROWS = 8192  # candidates of a block
QUERY_ROWS = 2048  # queries of a block
STRIP_ROWS = 1024  # candidates between two updates of the bounds
LEADING = 1 / 4  # of the coordinates make the partial sum


def quantized(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, length, ints, norm) of the rows that take part.

    Vectors that are null or empty, or hold null or non-finite components, and rows
    without an id take no part. ``ints`` are the integers floor(scale * x) over the scale;
    large components stay as they are, so that every finite one is carried exactly.
    """
    sound = (
        F.col("vec_id").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    times = lambda x: x.cast("double") * float(scale)
    whole = F.transform(
        "embedding",
        lambda x: F.when(F.abs(times(x)) <= PLAIN, F.floor(times(x)).cast("double") / float(scale)).otherwise(x.cast("double")),
    )
    ints = embeddings.where(sound).select("vec_id", whole.alias("ints"))
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda s, x: s + times(x) * times(x)))
    return ints.select("vec_id", F.size("ints").alias("length"), "ints", norm.alias("norm"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float).reshape(len(column), -1)


def _products_of(batches):
    """Sums of products of coordinates, by length of vector; one set for each task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        lengths = np.asarray(batch.column("length"))
        for length in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == length))
            x = _matrix(rows.column("ints"))
            with np.errstate(over="ignore", invalid="ignore"):
                sums[int(length)] = sums.get(int(length), 0) + x.T @ x
    for length, total in sums.items():
        yield pa.RecordBatch.from_pydict({"length": pa.array([length], pa.int32()), "products": [total.ravel().tolist()]})


def rotations(candidates: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector, the singular directions, largest first."""
    partial = candidates.select("length", "ints").mapInArrow(_products_of, "length int, products array<double>")
    summed = (
        partial.select("length", F.posexplode("products").alias("place", "value"))
        .groupBy("length", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    out = {}
    for length in {r.length for r in summed}:
        gram = np.zeros(length * length)
        for r in summed:
            if r.length == length:
                gram[r.place] = r.value
        gram = np.nan_to_num(gram.reshape(length, length))
        gram /= max(np.abs(gram).max(), 1e-300)
        _, directions = np.linalg.eigh((gram + gram.T) / 2)
        out[length] = directions[:, ::-1]
    return out


def _whole(row: np.ndarray, scale: int) -> list[int]:
    """The integers of a vector, exact whatever their size."""
    out = []
    for x in row.tolist():
        n, d = x.as_integer_ratio()
        out.append(round(x * scale) if abs(x * scale) <= PLAIN else n * scale // d)
    return out


def _exact(q: np.ndarray, x: np.ndarray, a: np.ndarray, t: np.ndarray, scale: int) -> np.ndarray:
    """Inner products of rows ``a`` of q and ``t`` of x, as Python integers."""
    left = {i: _whole(q[i], scale) for i in np.unique(a).tolist()}
    right = {i: _whole(x[i], scale) for i in np.unique(t).tolist()}
    out = np.empty(len(a), object)
    for n, (i, j) in enumerate(zip(a.tolist(), t.tolist(), strict=True)):
        out[n] = sum(map(operator.mul, left[i], right[j]))
    return out


def _order_key(score: int) -> bytes | None:
    """Orders scores that a long cannot tell apart; null for others."""
    if -LAST - 1 < score < LAST:
        return None
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return key if score > 0 else bytes(255 - b for b in key)


def _rounded(score: int) -> float:
    try:
        return float(score)
    except OverflowError:
        return np.inf if score > 0 else -np.inf


def _search(directions: dict[int, np.ndarray], k: int, scale: int):
    """The k best candidates of one block for each query of one block."""
    empty = {n: pa.array([], pa.int64()) for n in ("query", "vec_id", "score")} | {"exact": pa.array([], pa.binary())}

    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(queries) or not len(candidates):
            return pa.table(empty)
        length = key[0].as_py()
        turn = directions[length]
        lead = max(1, int(length * LEADING))
        q_own, qid = _matrix(queries.column("ints")), np.asarray(queries.column("query_id"))
        q_at = np.asarray(queries.column("query"))
        # A bound may have been rounded up.
        bound = np.nextafter(np.asarray(queries.column("bound")).astype(float), -np.inf)
        x_own, xid = _matrix(candidates.column("ints")), np.asarray(candidates.column("vec_id"))
        norm = np.asarray(candidates.column("norm"))
        order = np.argsort(-norm, kind="stable")
        x_own, xid, norm = x_own[order], xid[order], norm[order]
        q, x = np.rint(q_own * scale), np.rint(x_own * scale)
        q_norm = np.sqrt((q * q).sum(1))
        q_turned, x_turned = q @ turn, x @ turn
        q_rest = np.sqrt((q_turned[:, lead:] ** 2).sum(1))
        x_rest = np.sqrt((x_turned[:, lead:] ** 2).sum(1))
        safe = q_norm.max() * norm[0] < EXACT
        have: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        kept = [np.empty((0, 2), np.int64 if safe else object) for _ in range(len(q))]
        for start in range(0, len(x), STRIP_ROWS):
            strip = slice(start, start + STRIP_ROWS)
            # Candidates come by length: once the longest left cannot reach a bound, none can.
            slack = 1e-9 * q_norm * norm[start] + 1e-6
            live = np.flatnonzero(~(q_norm * norm[start] + slack < bound))
            if not len(live):
                if (bound > -np.inf).all():
                    break
                continue
            partial = q_turned[live, :lead] @ x_turned[strip, :lead].T
            reach = partial + np.outer(q_rest[live], x_rest[strip]) + slack[live, None]
            reach[~np.isfinite(reach)] = np.inf  # beyond doubles nothing is left out
            at, to = np.nonzero((reach >= bound[live, None]) & (qid[live, None] != xid[strip][None, :]))
            at, to = live[at], to + start
            for part in range(0, len(at), 200_000):
                a, t = at[part : part + 200_000], to[part : part + 200_000]
                score = (q[a] * x[t]).sum(1).astype(np.int64) if safe else _exact(q_own, x_own, a, t, scale)
                good = (score >= bound[a]).astype(bool)
                have.append((a[good], xid[t[good]], score[good]))
            have, bound = _shorten(have, bound, kept, k)
        rows = [(i, r) for i, r in enumerate(kept) if len(r)]
        if not rows:
            return pa.table(empty)
        scores = np.concatenate([r[:, 0] for _, r in rows]).tolist()
        return pa.table(
            {
                "query": np.concatenate([np.full(len(r), q_at[i]) for i, r in rows]),
                "vec_id": np.concatenate([r[:, 1] for _, r in rows]).astype(np.int64),
                "score": pa.array([max(min(s, LAST), -LAST - 1) for s in scores], pa.int64()),
                "exact": pa.array([_order_key(s) for s in scores], pa.binary()),
            }
        )

    def quiet(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        with np.errstate(over="ignore", invalid="ignore"):
            return run(key, queries, candidates)

    return quiet


def _shorten(have, bound, kept, k):
    """Keep the k best of each query, and raise its bound to the last of them."""
    if have:
        at = np.concatenate([h[0] for h in have])
        ids = np.concatenate([h[1] for h in have])
        scores = np.concatenate([h[2] for h in have])
        order = np.argsort(at, kind="stable")
        at, ids, scores = at[order], ids[order], scores[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
        for i, start in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else len(at)
            mine = np.concatenate([kept[at[start]], np.column_stack([scores[start:end], ids[start:end]])])
            if mine.dtype == object:
                mine = mine[sorted(range(len(mine)), key=lambda r: (-mine[r, 0], mine[r, 1]))][:k]
            else:
                mine = mine[np.lexsort((mine[:, 1], -mine[:, 0]))][:k]
            kept[at[start]] = mine
            if len(mine) == k:
                bound[at[start]] = max(bound[at[start]], np.nextafter(_rounded(mine[-1, 0]), -np.inf))
    return [], bound


def search(embeddings: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``embeddings`` for each query.

    Scores are integer inner products, ranked by their exact values; those beyond 64 bits
    are given as the last integer. Ties go to the smaller vec_id. Rows with the
    query's own id are no candidates for it. Only vectors of the query's length are.
    A query with fewer than k candidates gets all of them; equal rows of ``queries`` count
    once, equal candidates each. Other columns are ignored.
    """
    ready = quantized(embeddings, scale)
    total = ready.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    dealt = ready.repartitionByRange(blocks, F.col("norm").desc(), F.xxhash64("vec_id"))
    candidates = saved(dealt.withColumn("block", F.spark_partition_id()), "top-candidates")
    asked = quantized(queries, scale).select(F.col("vec_id").alias("query_id"), "length", "ints", "norm").distinct()
    asked = saved(asked.withColumn("query", F.monotonically_increasing_id()), "top-queries")
    query_blocks = max(1, -(-asked.row_count // QUERY_ROWS))
    asked = asked.withColumn("query_block", F.pmod(F.xxhash64("query"), F.lit(query_blocks)))
    run = _search(rotations(candidates), k, scale)

    on = ["length", "block", "query_block"]
    spread = candidates.withColumn(
        "query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))
    )
    longest = candidates.groupBy("length", "block").agg(F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n"))
    longest = saved(longest, "top-blocks")
    first = longest.groupBy("length").agg(F.max_by("block", F.struct("longest", -F.col("block"))).alias("first"))

    def searched(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        return (
            pairs.groupBy(*on)
            .cogroup(rows.groupBy(*on))
            .applyInArrow(run, "query long, vec_id long, score long, exact binary")
        )

    columns = ["query", "query_id", "ints", "bound", *on]
    opening = asked.join(maybe_broadcast(first), "length").withColumnRenamed("first", "block")
    opening = opening.withColumn("bound", F.lit(float("-inf"))).select(*columns)
    in_first = spread.join(maybe_broadcast(first), "length").where("block = first").drop("first")
    opened = saved(searched(opening, in_first), "top-first")
    bounds = opened.groupBy("query").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("reached")
    )
    bounded = asked.join(bounds, "query", "left").withColumn("bound", F.coalesce("reached", F.lit(float("-inf"))))
    # A block is searched only for queries that its longest vector might serve.
    rest = bounded.join(maybe_broadcast(longest.join(first, "length").where("block <> first")), "length")
    rest = rest.where(F.col("norm") * F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("bound")).select(*columns)
    others = spread.join(maybe_broadcast(first), "length").where("block <> first").drop("first")
    found = opened.unionByName(searched(rest, others))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("exact").desc(), F.col("vec_id"))
    ordered = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ordered.join(asked.select("query", "query_id"), "query").select("query_id", "rank", "vec_id", "score")
