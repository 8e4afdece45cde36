"""Records of delimited text whose quoted values hold line breaks, read in splits.

A split may start inside a quoted value, so what a line break means there depends on all text
before it. Each line is a function: from "outside" or "inside" a quoted value at its start to the
same at its end. Functions compose, so

1. each split reports the function of all its lines, from two patterns a line;
2. a running composition over a file's splits gives the state each one starts in;
3. splits then cut their lines into records where they are outside. What a record has in other
   splits (only if a quoted value reaches over their border) is joined afterwards.

The text is read once for each of 1 and 3, and once more only if a value reaches over a border.
Nothing but those pieces is shuffled.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUOTE, ESCAPE = '"', "\\"

# Tasks get the functions below as they are, as this package may not be on their machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _patterns(separator: str, quote: str, escape: str) -> tuple[str, str]:
    """Patterns of lines that end outside, having started outside and inside.

    A quote opens a value only where the value starts. Inside, the escape character hides what
    follows it; after the closing quote, all up to the separator belongs to the value. All
    quantifiers are possessive, so a line is looked at once.
    """
    sep, q, esc = re.escape(separator), re.escape(quote), re.escape(escape)
    rest = rf"(?:(?!{sep}).)*+"
    hidden = rf"(?:[^{q}{esc}]|{esc}(?:.|\z))*+"
    field = rf"(?:{q}{hidden}{q}{rest}|(?!{q}){rest})"
    more = rf"(?:{sep}{field})*+\z"
    return rf"(?s)\A{field}{more}", rf"(?s)\A{hidden}{q}{rest}{more}"


def _lines(spark: SparkSession, path: str, separator: str, quote: str, escape: str, decode) -> DataFrame:
    """Lines in order, where each lies, and its function as two flags: does it end inside?"""
    outside, inside = _patterns(separator, quote, escape)
    # With this separator a line keeps a carriage return, which may be inside a value.
    text = spark.read.option("lineSep", "\n").text(path)
    placed = text.select(
        # A file goes by a 64-bit hash of its path, which is short beside each line.
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        decode(F.col("value")).alias("line"),
    )
    quoted = F.col("line").contains(quote)
    return placed.select(
        "file", "start", "line",
        (quoted & ~F.col("line").rlike(outside)).alias("from_outside"),
        (~quoted | ~F.col("line").rlike(inside)).alias("from_inside"),
    )


def _runs(batch: pa.RecordBatch):
    """(file, start, from, to) of the stretches of a batch that lie in one split."""
    files, starts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "start"))
    change = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
    cuts = [0, *change.tolist(), len(starts)] if len(starts) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(files[a]), int(starts[a]), a, b


def _states(first: int, from_outside: np.ndarray, from_inside: np.ndarray) -> np.ndarray:
    """The state before each line and after the last, 1 for inside, given the first.

    A line whose two ends agree forgets what was before it; others keep or turn the state.
    So a state is that of the last line that forgot, turned as often as lines since turn it.
    """
    count = len(from_outside)
    forgets = from_outside == from_inside
    turns = np.concatenate([[0], np.cumsum(from_outside & ~from_inside)])
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(forgets, np.arange(count), -1))])
    known = np.where(last >= 0, from_outside[last] if count else 0, first)
    return (known.astype(np.int64) + turns - np.where(last >= 0, turns[last + 1], 0)) % 2


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, state, after) of every split: is it inside a quoted value at its ends?"""

    def summed(batches):
        at, ends = None, [0, 1]

        def row():
            values = [[at[0]], [at[1]], [bool(ends[0])], [bool(ends[1])]]
            return pa.RecordBatch.from_pydict(dict(zip(("file", "start", "out", "in"), values, strict=True)))

        for batch in batches:
            functions = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("from_outside", "from_inside")]
            for file, start, a, b in _runs(batch):
                if at != (file, start):
                    if at:
                        yield row()
                    at, ends = (file, start), [0, 1]
                ends = [int(_states(s, *[f[a:b] for f in functions])[-1]) for s in ends]
        if at:
            yield row()

    each = lines.select("file", "start", "from_outside", "from_inside").mapInArrow(
        summed, "file long, start long, out boolean, `in` boolean"
    )
    # One row for each split. The same running composition, as windows over them.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    through = before.rowsBetween(Window.unboundedPreceding, 0)
    turned = each.withColumn("turns", F.sum((F.col("out") & ~F.col("in")).cast("int")).over(through))
    forgot = F.when(F.col("out") == F.col("in"), F.struct(F.col("out").cast("int").alias("state"), "turns"))
    known = turned.withColumn("last", F.last(forgot, True).over(before)).withColumn(
        "so_far", F.coalesce(F.last("turns").over(before), F.lit(0))
    )
    state = F.coalesce("last.state", F.lit(0)) + F.col("so_far") - F.coalesce("last.turns", F.lit(0))
    placed = known.withColumn("state", F.pmod(state, F.lit(2)))
    return placed.select("file", "start", "state", F.when(F.col("state") == 1, F.col("in")).otherwise(F.col("out")).alias("after"))


def _cut(lines: DataFrame, inside: frozenset, pieces: bool) -> DataFrame:
    """Records that lie in one split or, if ``pieces``, what others have in each split."""

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["file", "start", "opens", "record"])

    def run(batches):
        at, state, opens, held = None, 0, True, []

        def left():
            # What is still held when a split ends goes on in the next one.
            return [(*at, opens, "\n".join(held))] if held and pieces else []

        for batch in batches:
            functions = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("from_outside", "from_inside")]
            text = batch.column("line")
            out = []
            for file, start, a, b in _runs(batch):
                if at != (file, start):
                    out += left()
                    at, held = (file, start), []
                    state = int((file, start) in inside)
                    opens = not state
                found = _states(state, *[f[a:b] for f in functions])
                state = int(found[-1])
                ends = np.flatnonzero(found[1:] == 0) + 1
                if not len(ends):
                    held += text[a:b].to_pylist()
                    continue
                first = "\n".join([*held, *text[a : a + int(ends[0])].to_pylist()])
                if not opens and pieces:
                    out.append((file, start, False, first))
                offsets = pa.array(ends, pa.int32())
                middle = text.slice(a, b - a)
                if not pieces:
                    whole = pa.ListArray.from_arrays(offsets, middle)
                    records = pc.binary_join(whole, "\n").to_pylist()
                    out += [(file, start, True, r) for r in ([first] if opens else []) + records]
                opens = True
                held = middle[int(ends[-1]) :].to_pylist()
            yield table(out)
        yield table(left())

    return lines.mapInArrow(run, "file long, start long, opens boolean, record string")


def records(
    spark: SparkSession,
    path: str,
    separator: str = "|",
    quote: str = QUOTE,
    escape: str = ESCAPE,
    decode=lambda line: line,
) -> DataFrame:
    """The records below a path as one column ``record``, line breaks inside quotes kept.

    A record whose last value is never closed reaches to the end of its file's last line. A carriage return
    before the line feed that ends a record is dropped. An empty file has no records. The
    driver gets the splits that start or end inside a value; it lists all splits anyway.
    """
    lines = _lines(spark, path, separator, quote, escape, decode)
    open_ends = split_states(lines).where("state = 1 OR after").select("file", "start", "state").collect()
    inside = frozenset((r.file, r.start) for r in open_ends if r.state)
    whole = _cut(lines, inside, pieces=False).select("record")
    trimmed = F.regexp_replace("record", r"\r\z", "").alias("record")
    if not open_ends:
        return whole.select(trimmed)
    pieces = _cut(lines, inside, pieces=True)
    in_order = Window.partitionBy("file").orderBy("start", "opens")
    numbered = pieces.withColumn("number", F.sum(F.col("opens").cast("int")).over(in_order))
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts")
    )
    across = joined.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(across).select(trimmed)
