"""Delimited text with a declared schema.

Two readers. ``scan`` is the plain typed read: a field that does not parse becomes
null, and nothing says so. ``parse`` keeps the raw line beside the fields and
marks the lines that do not fit the schema, so they can be set aside.

Generated files end each line with the separator, which reads as one value more
than the schema has. Both readers declare that value as a padding column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.sources import quoted

PAD = "_pad"
BAD = "_bad"
LINE = "_line"
MALFORMED = "_malformed"

# What the layout itself sets, and what would give one reader other rows than the other.
REFUSED_OPTIONS = (
    "sep", "delimiter", "encoding", "charset", "mode", "columnnameofcorruptrecord",
    "multiline", "inferschema", "enforceschema",
)
LINE_OPTIONS = ("header", "linesep", "comment")
# Not in any text, so a line read with it is one field.
NO_SEPARATOR = "\u0001\u0002\u0001\u0002"


@dataclass(frozen=True)
class Layout:
    """How the text is written.

    ``quoted_breaks``: values in quotes may hold line breaks. Records are then cut with regard
    to quotes, which reads the text once more; files still split over tasks.
    """

    separator: str = "|"
    trailing_separator: bool = True
    encoding: str = "UTF-8"
    quoted_breaks: bool = False
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        refused = {name for name in self.options if name.lower() in REFUSED_OPTIONS}
        if refused:
            raise ValueError(f"options {sorted(refused)} are set by the layout or not supported")
        if self.encoding.upper().startswith(("UTF-16", "UTF-32")):
            raise ValueError("lines are split on single bytes; convert the files to UTF-8 first")
        if self.quoted_breaks and self.line_options():
            raise ValueError(f"with quoted_breaks, {sorted(self.line_options())} are not supported")

    def option(self, name: str, default: str) -> str:
        return next((v for k, v in self.options.items() if k.lower() == name), default)

    def reader_options(self) -> dict[str, str]:
        return {"sep": self.separator, **self.options}

    def line_options(self) -> dict[str, str]:
        """Options that say what the lines of a file are, not what is in them."""
        return {k: v for k, v in self.options.items() if k.lower() in LINE_OPTIONS}


def _declared(schema: T.StructType, layout: Layout, *extra: str) -> T.StructType:
    if taken := {PAD, BAD, LINE, MALFORMED} & set(schema.names):
        raise ValueError(f"column names {sorted(taken)} are reserved")
    added = ([PAD] if layout.trailing_separator else []) + list(extra)
    return T.StructType(schema.fields + [T.StructField(name, T.StringType()) for name in added])


def scan(
    spark: SparkSession, path: str, schema: T.StructType, layout: Layout | None = None
) -> DataFrame:
    """Typed scan; a field that does not parse is null.

    The files are read line by line, so one large file splits over many tasks.
    """
    layout = layout or Layout()
    if layout.quoted_breaks:
        return parse(spark, path, schema, layout).select(*[f"`{c}`" for c in schema.names])
    return (
        spark.read.schema(_declared(schema, layout))
        .options(**layout.reader_options(), encoding=layout.encoding)
        .csv(path)
        # Folders named key=value below the path add no columns.
        .select(*[f"`{c}`" for c in schema.names])
    )


def parse(
    spark: SparkSession, path: str, schema: T.StructType, layout: Layout | None = None
) -> DataFrame:
    """Typed fields, the raw line in ``_line`` and whether it is malformed in ``_malformed``.

    A line is malformed if a field does not parse or overflows its type, or if it has
    too few or too many fields. ``from_csv`` parses the whole line however few columns
    a query selects, where the CSV reader would skip the unselected ones and miss their
    errors. It sits in a generator because the optimizer would otherwise copy it into
    every filter on its result and parse each line twice.
    """
    layout = layout or Layout()
    declared = _declared(schema, layout, BAD)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in declared)
    by_line = layout.line_options()
    options = {k: v for k, v in layout.reader_options().items() if k not in by_line}
    options["columnNameOfCorruptRecord"] = BAD

    line = F.col("value")
    if layout.quoted_breaks:
        files = _quoted_records(spark, path, layout)
    elif by_line:
        # The CSV reader itself leaves out headers and comments; each line is one field.
        raw = {**by_line, "sep": NO_SEPARATOR, "quote": "", "encoding": layout.encoding}
        files = spark.read.schema("value string").options(**raw).csv(path)
    else:
        files = spark.read.text(path)
        if layout.encoding.upper() != "UTF-8":
            # The text source hands over the bytes as they are.
            line = F.decode(line.cast("binary"), layout.encoding)
    lines = (
        files
        # Like the CSV reader, skip lines of blanks and control characters only.
        .where(F.col("value").rlike(r"[^\x00-\x20]"))
        .select(line.alias(LINE))
    )
    parsed = lines.select(LINE, F.inline(F.array(F.from_csv(LINE, ddl, options))))
    malformed = F.col(BAD).isNotNull()
    if layout.trailing_separator:
        malformed = malformed | F.col(PAD).isNotNull()
    return parsed.select(*[f"`{c}`" for c in schema.names], LINE, malformed.alias(MALFORMED))


def _quoted_records(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    utf8 = layout.encoding.upper() == "UTF-8"
    found = quoted.records(
        spark,
        path,
        layout.separator,
        layout.option("quote", quoted.QUOTE),
        layout.option("escape", quoted.ESCAPE),
        (lambda line: line) if utf8 else (lambda line: F.decode(line.cast("binary"), layout.encoding)),
    )
    return found.withColumnRenamed("record", "value")


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col(MALFORMED)).drop(LINE, MALFORMED)


def rejects(parsed: DataFrame) -> DataFrame:
    """The raw lines that do not fit the schema."""
    return parsed.where(MALFORMED).select(LINE)


def write_delimited(
    df: DataFrame,
    path: str,
    layout: Layout | None = None,
    compression: str = "none",
    file_rows: int = 0,
) -> None:
    """Write rows in the layout ``scan`` reads, for staging and tests.

    Strings keep their blanks. A string with a line break would become two lines, so it
    fails the write unless the layout allows breaks in quotes. Compressed files are read
    whole by one task each; ``file_rows``, the most rows of a file, keeps them small.
    """
    layout = layout or Layout()
    broken = F.raise_error(F.lit("a value holds a line break and can't be written as a line"))
    for f in df.schema:
        if isinstance(f.dataType, T.StringType) and not layout.quoted_breaks:
            value = F.col(f"`{f.name}`")
            df = df.withColumn(f.name, F.when(value.rlike("[\\r\\n]"), broken).otherwise(value))
    if layout.trailing_separator:
        df = df.withColumn(PAD, F.lit(None).cast("string"))
    (
        df.write.options(
            **layout.reader_options(),
            encoding=layout.encoding,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            compression=compression,
            maxRecordsPerFile=file_rows,
            **({"zlib.compress.level": "BEST_SPEED"} if compression == "gzip" else {}),
        ).csv(path)
    )
