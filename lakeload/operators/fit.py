"""Which types the values of text columns fit, found over all values in one aggregate.

A value that does not fit its declared type loads as null. The fold keeps, for each column,
what its values need of every type at once: ranges of integers, digits before and after the
decimal point, and counts of dates. Partial folds merge, so only one row a task shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER = "^[+-]?[0-9]+$"
NUMBER = "^[+-]?[0-9]+([.][0-9]+)?$"
DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DIGITS = 38  # of the widest decimal

# Integer types by rising width, with their bits.
WIDTHS = (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64))


def _fold(value: Column) -> Column:
    """What the values of a column need, as one struct of aggregates."""
    filled = F.nullif(value, F.lit(""))
    number = F.when(filled.rlike(NUMBER), filled)
    whole = F.regexp_extract(number, "^[+-]?0*([0-9]*)", 1)
    part = F.regexp_extract(number, "[.]([0-9]+)$", 1)
    integer = F.when(filled.rlike(INTEGER), filled).try_cast(f"decimal({DIGITS},0)")
    date = filled.rlike(DATE) & filled.try_cast("date").isNotNull()
    return F.struct(
        F.count(filled).alias("filled"),
        F.count_if(filled.rlike(INTEGER)).alias("integers"),
        F.count(number).alias("numbers"),
        F.count_if(date).alias("dates"),
        F.min(integer).alias("least"),
        F.max(integer).alias("most"),
        F.max(F.length(whole)).alias("whole_digits"),
        F.max(F.length(part)).alias("scale"),
        F.max(F.length(filled)).alias("longest"),
    )


def _within(bits: int) -> Column:
    low, high = (F.lit(str(n)).cast(f"decimal({DIGITS},0)") for n in (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1))
    return (F.col("least") >= low) & (F.col("most") <= high)


def _fitted() -> Column:
    """The narrowest type that holds every value; null for a column without values."""
    digits = F.greatest(F.col("whole_digits") + F.col("scale"), F.lit(1))
    found = F.when(F.col("filled") == 0, F.lit(None).cast("string"))
    short = (F.col("integers") == F.col("filled")) & (F.col("whole_digits") <= DIGITS)
    for name, bits in WIDTHS:
        found = found.when(short & _within(bits), name)
    numeric = (F.col("numbers") == F.col("filled")) & (digits <= DIGITS)
    found = found.when(numeric, F.format_string("decimal(%d,%d)", digits, F.col("scale")))
    return found.when(F.col("dates") == F.col("filled"), "date").otherwise("string")


def _holds(declared: T.DataType) -> Column:
    """Whether a declared type holds every value of the column."""
    integers, numbers, dates = (F.col(c) == F.col("filled") for c in ("integers", "numbers", "dates"))
    bits = dict(WIDTHS).get({"byte": "tinyint", "short": "smallint", "long": "bigint"}.get(
        declared.typeName(), "int" if isinstance(declared, T.IntegerType) else ""))
    if bits:
        held = integers & (F.col("whole_digits") <= DIGITS) & _within(bits)
    elif isinstance(declared, T.DecimalType):
        whole = F.col("whole_digits") <= declared.precision - declared.scale
        held = numbers & whole & (F.col("scale") <= declared.scale)
    elif isinstance(declared, (T.FloatType, T.DoubleType)):
        held = numbers
    elif isinstance(declared, T.DateType):
        held = dates
    elif isinstance(declared, (T.CharType, T.VarcharType)):
        held = F.col("longest") <= declared.length
    elif isinstance(declared, T.StringType):
        held = F.lit(True)
    else:  # timestamps and others, whose texts have no single form
        return F.lit(None).cast("boolean")
    return F.coalesce(held, F.col("filled") == 0)


def type_fit(rows: DataFrame, declared: T.StructType | None = None) -> DataFrame:
    """One row for each column of text: what its values need, the narrowest type, a verdict.

    ``fitted`` is the narrowest of tinyint, smallint, int, bigint, decimal, date and string
    that holds all values as written, or null if there are none. Nulls and empty texts count as no
    value. ``holds`` says whether the type declared under the same name does; it is null
    without a declaration, and for types such as timestamps. Numbers with exponents are strings.
    """
    if not rows.columns:
        raise ValueError("there are no columns to fit")
    folded = rows.agg(*[_fold(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(rows.columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("need")) for i, c in enumerate(rows.columns)])
    needs = folded.select(F.inline(each)).select("column_name", "need.*")
    types = {f.name: f.dataType for f in declared} if declared else {}
    name, holds = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for column, of in types.items():
        here = F.col("column_name") == column
        name = F.when(here, of.simpleString()).otherwise(name)
        holds = F.when(here, _holds(of)).otherwise(holds)
    return needs.select(
        "column_name", "filled", "integers", "numbers", "dates", "whole_digits", "scale", "longest",
        _fitted().alias("fitted"), name.alias("declared"), holds.alias("holds"),
    )
