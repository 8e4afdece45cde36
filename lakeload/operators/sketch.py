"""Which rows differ between two tables, from a small summary of each.

The summary is an invertible Bloom lookup table: a row's 128-bit hash is added to three cells of
a fixed number, and a cell holds how many were added and the sums of their pieces. What two
tables share cancels when one summary is taken from the other. A cell left with copies of one
row only gives that row's hash; taking it out of its other cells frees more. Up to about
three quarters as many differing rows as there are cells come out, each with its surplus of
copies, however large the tables are.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.columns import hash_parts, row_hash

CELLS = 3 * 8192
NESTED = (T.ArrayType, T.MapType, T.StructType)
PARTS = [f"part{i}" for i in range(6)]
COLUMNS = ", ".join(["cell int", "row_count bigint", *[f"{p} bigint" for p in PARTS]])


class Unsuitable(ValueError):
    """The tables' columns can't be summed up, or two summaries don't belong together."""


@dataclass(frozen=True)
class Differences:
    """Row hashes with their surplus in the first table; negative where the second has more."""

    surplus: dict[tuple[int, int], int]

    @property
    def missing(self) -> int:
        return sum(n for n in self.surplus.values() if n > 0)

    @property
    def extra(self) -> int:
        return -sum(n for n in self.surplus.values() if n < 0)


def _places(a, b, width: int) -> list:
    """The cell of a row in each third, from its two hashes."""
    mixed = F.shiftrightunsigned(a, 20).bitwiseXOR(F.shiftrightunsigned(b, 31))
    return [(F.pmod(x, F.lit(width)) + i * width).cast("int") for i, x in enumerate((a, b, mixed))]


def _cells_of(a: int, b: int, width: int) -> list[int]:
    """The same for one pair of signed 64-bit hashes."""
    mixed = ((a & 2**64 - 1) >> 20) ^ ((b & 2**64 - 1) >> 31)
    return [x % width + i * width for i, x in enumerate((a, b, mixed))]


def sketch(rows: DataFrame, cells: int = CELLS) -> DataFrame:
    """The cells of a table that rows fell into: (cell, row_count, part0, ..., part5).

    One pass. Tasks add up their rows by cell, so at most ``cells`` rows of each are shuffled.
    Columns of arrays, maps and structs are refused, as hashes skip nulls inside them.
    """
    if any(isinstance(f.dataType, NESTED) for f in rows.schema):
        raise Unsuitable("nested columns can't be told apart by row hashes")
    if cells < 3:
        raise Unsuitable("a sketch has 3 cells at least")
    hashed = rows.select(row_hash(rows.columns, 1).alias("a"), row_hash(rows.columns, 2).alias("b"))
    parts = [p.alias(name) for name, p in zip(PARTS, hash_parts(F.col("a")) + hash_parts(F.col("b")), strict=True)]
    placed = hashed.select(F.explode(F.array(*_places(F.col("a"), F.col("b"), cells // 3))).alias("cell"), *parts)
    return placed.groupBy("cell").agg(F.count(F.lit(1)).alias("row_count"), *[F.sum(p).alias(p) for p in PARTS])


def _numbers(found: Iterable[Row]) -> dict[int, list[int]]:
    return {r.cell: [r.row_count, *[r[p] for p in PARTS]] for r in found}


def row_total(cells: Iterable[Row], count: int = CELLS) -> int:
    """How many rows a sketch sums up: each is in one cell of the first third."""
    return sum(r.row_count for r in cells if r.cell < count // 3)


def _hash(parts: list[int], copies: int) -> int | None:
    """The signed hash whose pieces were added ``copies`` times, if one was."""
    pieces = []
    for part, bits in zip(parts, (22, 21, 21), strict=True):
        piece, rest = divmod(part, copies)
        if rest or not 0 <= piece < 1 << bits:
            return None
        pieces.append(piece)
    value = pieces[0] << 42 | pieces[1] << 21 | pieces[2]
    return value - (1 << 64) if value >= 1 << 63 else value


def decode(first: Iterable[Row], second: Iterable[Row], count: int = CELLS) -> Differences | None:
    """What the first sketch has more or less of than the second, or None if that is too much."""
    width = count // 3
    left = _numbers(first)
    for cell, numbers in _numbers(second).items():
        left[cell] = [x - y for x, y in zip(left.get(cell, [0] * 7), numbers, strict=True)]
    surplus: dict[tuple[int, int], int] = {}
    waiting = list(left)
    steps = 20 * (len(left) + 3)
    while waiting:
        # A mixed cell may look like one row's; taking that out leads nowhere.
        steps -= 1
        if not steps:
            return None
        cell = waiting.pop()
        copies, *parts = left[cell]
        if not copies:
            continue
        a, b = _hash(parts[:3], copies), _hash(parts[3:], copies)
        if a is None or b is None or cell not in (own := _cells_of(a, b, width)):
            continue
        surplus[a, b] = surplus.get((a, b), 0) + copies
        taken = [copies, *parts]
        for each in own:
            left[each] = [x - y for x, y in zip(left.get(each, [0] * 7), taken, strict=True)]
        waiting += own
    if any(any(numbers) for numbers in left.values()):
        return None
    return Differences({key: n for key, n in surplus.items() if n})


def rows_of(rows: DataFrame, found: Differences) -> DataFrame:
    """The rows of a table whose hashes differ, with their ``surplus``; they are as few as decoded."""
    keys = rows.sparkSession.createDataFrame(
        [(a, b, n) for (a, b), n in found.surplus.items()], "_a bigint, _b bigint, surplus bigint"
    )
    hashes = [row_hash(rows.columns, 1) == F.col("_a"), row_hash(rows.columns, 2) == F.col("_b")]
    return rows.join(F.broadcast(keys), hashes).drop("_a", "_b")
