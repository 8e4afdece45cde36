"""Column expressions. All are built-in, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_path(path: Column | str) -> Column:
    """Drop one trailing ``/``, as when turning a listed prefix into a name."""
    return F.regexp_replace(path, "/$", "")


def row_hash(columns: list[str], salt: int = 0) -> Column:
    """64-bit hash of a row; different salts give independent hashes.

    ``xxhash64`` skips nulls, so ``(null, 'a')`` and ``('a', null)`` hash alike. One bit
    for each null column is hashed too, which tells such rows apart.
    """
    masks = []
    for start in range(0, len(columns), 62):
        bits = enumerate(columns[start : start + 62])
        masks.append(F.expr(" | ".join(f"if(isnull(`{c}`), {1 << i}L, 0L)" for i, c in bits)))
    return F.xxhash64(F.lit(salt), *masks, *[F.col(f"`{c}`") for c in columns])


def hash_parts(hashed: Column) -> list[Column]:
    """The hash as three unsigned pieces of 22, 21 and 21 bits.

    A sum of the pieces fits a bigint for up to 2 * 10^12 rows, so a bucket that
    holds most of a very large table still sums without overflow.
    """
    piece = F.lit((1 << 21) - 1)
    return [
        F.shiftrightunsigned(hashed, 42),
        F.shiftrightunsigned(hashed, 21).bitwiseAND(piece),
        hashed.bitwiseAND(piece),
    ]


def digest_sums(columns: list[str], where: Column | None = None) -> list[Column]:
    """Aggregates that, with the row count, tell two sets of rows apart.

    Sums over two independent hashes: they do not depend on the order of rows, merge
    across tasks, and count repeated rows as often as they occur.
    """
    parts = [part for salt in (1, 2) for part in hash_parts(row_hash(columns, salt))]
    return [F.sum(part if where is None else F.when(where, part)) for part in parts]
