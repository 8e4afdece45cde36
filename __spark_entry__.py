"""Queries for the driver, one for each operator, and SQL with the same results.

Where an operator reads delimited text, the given tables are first written as text to
the scratch folder, once for each session, and read from there.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload import scratch
from lakeload.functions.columns import clean_path
from lakeload.operators import catalog, checks, fit, sinks
from lakeload.plans.load import (
    LoadFailed,
    LoadResult,
    audit_frame,
    keep_sketch,
    load_all,
    load_table,
    reconcile_all,
    side_by_side,
    source_bytes,
)
from lakeload.plans.load import reconcile_sketch as reconcile_by_sketch
from lakeload.plans.schemas import Registry, data_type, declared_not_null, tpcds
from lakeload.plans.spec import LoadSpec
from lakeload.sources import delimited, files

# The operators for training data are a part of their own, which may be left out.
_part = importlib.util.find_spec("lakeload.llm")
llm = None
if _part and _part.origin and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline
    from lakeload.llm import queries as llm

STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
FLAT = (*STAR, "events", "labels")  # tables without arrays or line breaks in their text


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- staging ------------------------------------------------------------------------

_staged: dict[tuple, str] = {}
# Text is several times as large as the given tables, and stays beside what is loaded from it.
STAGED_AS = {"compression": "gzip", "file_rows": 500_000}


def staged(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]) -> str:
    """The data root holding ``{name}.dat``; rows are written on first use in a session."""
    session = (spark.sparkContext.applicationId, sf_dir)
    root = _staged.setdefault(session, scratch.new_dir(spark, "stage"))
    if (*session, name) not in _staged:
        path = f"{root}/{name}.dat"
        delimited.write_delimited(rows(), path, **STAGED_AS)
        _staged[(*session, name)] = path
    return root


def staged_spec(
    spark: SparkSession, sf_dir: str, tables: Iterable[str], **settings
) -> LoadSpec:
    """A spec that loads the given tables, from text, into a namespace of its own."""
    tables = list(tables)
    for t in tables:
        root = staged(spark, sf_dir, t, lambda t=t: given(spark, sf_dir, t))
    schemas = {t: given(spark, sf_dir, t).schema for t in tables}
    return new_spec(spark, root, Registry(schemas), **settings)


def new_spec(spark: SparkSession, root: str, registry: Registry, **settings) -> LoadSpec:
    home = scratch.new_dir(spark, "load")
    settings = {"options": {"compression": "zstd"}} | settings
    return LoadSpec(
        data_root=root,
        namespace=home.rsplit("/", 1)[1].replace("-", "_"),
        namespace_location=home,
        registry=registry,
        **settings,
    )


def new_namespace(spark: SparkSession) -> str:
    home = scratch.new_dir(spark, "tables")
    name = home.rsplit("/", 1)[1].replace("-", "_")
    catalog.create_namespace(spark, name, home)
    return name


# --- scans, projection, views -------------------------------------------------------


def scan_delimited(spark, sf_dir):
    rows = given(spark, sf_dir, "orders")
    root = staged(spark, sf_dir, "orders", lambda: rows)
    return delimited.scan(spark, f"{root}/orders.dat", rows.schema)


TYPED = {
    "l_orderkey": "bigint",
    "l_linenumber": "int",
    "l_extendedprice": "decimal(15,2)",
    "l_shipdate": "date",
    "l_returnflag": "string",
}
# Types declared for the same columns, some too narrow for their values.
NARROW = {
    "l_orderkey": "int",
    "l_linenumber": "tinyint",
    "l_extendedprice": "decimal(15,1)",
    "l_shipdate": "date",
    "l_returnflag": "string",
}


def _typed_root(spark, sf_dir):
    def as_text():
        rows = given(spark, sf_dir, "lineitem")
        return rows.select(*[F.col(c).cast(t).alias(c) for c, t in TYPED.items()])

    return staged(spark, sf_dir, "typed_lineitem", as_text)


def type_fit(spark, sf_dir):
    """Every value as text, against types of which some are too narrow."""
    root = _typed_root(spark, sf_dir)
    text = T.StructType([T.StructField(c, T.StringType()) for c in TYPED])
    declared = T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in NARROW.items()))
    return fit.type_fit(delimited.scan(spark, f"{root}/typed_lineitem.dat", text), declared)


def _type_fit_sql() -> str:
    holds = {
        "tinyint": "integers = filled AND most <= 127 AND least >= -128",
        "int": "integers = filled AND most <= 2147483647 AND least >= -2147483648",
        "decimal(15,1)": "numbers = filled AND whole_digits <= 14 AND scale <= 1",
        "date": "dates = filled",
        "string": "true",
    }
    folds = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{NARROW[c]}' AS declared, nullif(CAST(CAST({c} AS"
        f" {'varchar' if t == 'string' else t}) AS varchar), '') AS v FROM lineitem"
        for c, t in TYPED.items()
    )
    verdict = " ".join(f"WHEN declared = '{t}' THEN {sql}" for t, sql in holds.items())
    return f"""
        WITH t AS ({folds}), marked AS (
            SELECT *, regexp_matches(v, '{fit.INTEGER}') AS is_integer, regexp_matches(v, '{fit.NUMBER}') AS is_number,
                regexp_matches(v, '{fit.DATE}') AND TRY_CAST(v AS date) IS NOT NULL AS is_date
            FROM t
        ), needs AS (
            SELECT column_name, declared, count(v) AS filled, count(*) FILTER (is_integer) AS integers,
                count(*) FILTER (is_number) AS numbers, count(*) FILTER (is_date) AS dates,
                min(TRY_CAST(CASE WHEN is_integer THEN v END AS hugeint)) AS least,
                max(TRY_CAST(CASE WHEN is_integer THEN v END AS hugeint)) AS most,
                CAST(max(length(regexp_extract(v, '^[+-]?0*([0-9]*)', 1))) FILTER (is_number) AS int) AS whole_digits,
                CAST(max(length(regexp_extract(v, '[.]([0-9]+)$', 1))) FILTER (is_number) AS int) AS scale,
                CAST(max(length(v)) AS int) AS longest
            FROM marked GROUP BY column_name, declared
        )
        SELECT column_name, filled, integers, numbers, dates, whole_digits, scale, longest,
            CASE WHEN filled = 0 THEN NULL
                WHEN integers = filled AND least >= -128 AND most <= 127 THEN 'tinyint'
                WHEN integers = filled AND least >= -32768 AND most <= 32767 THEN 'smallint'
                WHEN integers = filled AND least >= -2147483648 AND most <= 2147483647 THEN 'int'
                WHEN integers = filled AND whole_digits <= 18 THEN 'bigint'
                WHEN numbers = filled THEN 'decimal(' || (whole_digits + scale) || ',' || scale || ')'
                WHEN dates = filled THEN 'date' ELSE 'string' END AS fitted,
            declared, CASE {verdict} END AS holds
        FROM needs
    """


def scan_typed(spark, sf_dir):
    root = _typed_root(spark, sf_dir)
    schema = T.StructType([T.StructField(c, data_type(t)) for c, t in TYPED.items()])
    return delimited.scan(spark, f"{root}/typed_lineitem.dat", schema)


def scan_table(spark, sf_dir):
    name = f"{new_namespace(spark)}.customer"
    sinks.create_as_select(given(spark, sf_dir, "customer"), name)
    return catalog.read_table(spark, name)


def show_rows(spark, sf_dir):
    name = f"{new_namespace(spark)}.orders"
    sinks.create_as_select(given(spark, sf_dir, "orders"), name)
    return catalog.show_rows(spark, name, 20, order_by="o_orderkey")


def project_star(spark, sf_dir):
    with catalog.temp_view(given(spark, sf_dir, "supplier")) as view:
        return spark.sql(f"SELECT * FROM {view}")


def temp_view(spark, sf_dir):
    for table in ("customer", "part"):
        given(spark, sf_dir, table).createOrReplaceTempView("temp_view")
    return spark.table("temp_view")


# --- sinks --------------------------------------------------------------------------


def ctas(table: str, fmt: str, options: dict[str, str] | None = None):
    def query(spark, sf_dir):
        name = f"{new_namespace(spark)}.{table}"
        sinks.create_as_select(given(spark, sf_dir, table), name, fmt, options)
        return catalog.read_table(spark, name)

    return query


def ctas_location(spark, sf_dir):
    name = f"{new_namespace(spark)}.supplier"
    path = scratch.new_dir(spark, "location")
    sinks.create_as_select(given(spark, sf_dir, "supplier"), name, location=path)
    return catalog.read_table(spark, name)


def write_overwrite(spark, sf_dir):
    path = scratch.new_dir(spark, "path")
    for _ in range(2):
        sinks.write_path(given(spark, sf_dir, "part"), path)
    return spark.read.parquet(path)


def external_table(spark, sf_dir):
    path = scratch.new_dir(spark, "path")
    name = f"{new_namespace(spark)}.orders"
    sinks.write_path(given(spark, sf_dir, "orders"), path, "orc")
    sinks.register_external(spark, name, path, "orc")
    return catalog.read_table(spark, name)


def create_if_missing(spark, sf_dir):
    name = f"{new_namespace(spark)}.test_table"
    for _ in range(2):
        sinks.create_if_missing(spark, name, "id INT, name STRING")
    rows = given(spark, sf_dir, "supplier")
    sinks.insert_rows(rows.select(F.expr("try_cast(s_suppkey AS int)"), "s_name"), name)
    return catalog.read_table(spark, name)


# --- loads --------------------------------------------------------------------------


def loaded(table: str, **settings):
    def query(spark, sf_dir):
        spec = staged_spec(spark, sf_dir, [table], **settings)
        load_table(spark, table, spec)
        return catalog.read_table(spark, spec.table_name(table))

    return query


def load_external(spark, sf_dir):
    root = scratch.new_dir(spark, "external")
    return loaded("part", mode="external", table_root=root)(spark, sf_dir)


def load_external_two(spark, sf_dir):
    """Two namespaces with one table root: neither load touches the other's files."""
    root = scratch.new_dir(spark, "external")
    rows = given(spark, sf_dir, "orders")
    back = []
    for kind, kept in (("all", rows), ("urgent", rows.where("o_orderpriority = '1-URGENT'"))):
        at = staged(spark, sf_dir, f"{kind}_two/orders", lambda kept=kept: kept)
        registry = Registry({"orders": rows.schema})
        spec = new_spec(spark, f"{at}/{kind}_two", registry, mode="external", table_root=root)
        load_table(spark, "orders", spec)
        back.append((kind, spec.table_name("orders")))
    return _union([catalog.read_table(spark, name).withColumn("loaded", F.lit(kind)) for kind, name in back])


def load_layout(spark, sf_dir):
    """Lines that end with ``;`` below a header, read strictly."""
    rows = given(spark, sf_dir, "orders")
    layout = delimited.Layout(options={"lineSep": ";", "header": "true"})
    root = f"{scratch.new_dir(spark, 'layout')}"
    delimited.write_delimited(rows, f"{root}/orders.dat", layout)
    spec = new_spec(spark, root, Registry({"orders": rows.schema}), layout=layout, malformed="reject")
    load_table(spark, "orders", spec)
    return catalog.read_table(spark, spec.table_name("orders"))


def scan_quoted(spark, sf_dir):
    """Documents, whose texts hold line breaks, from text that is read in splits."""
    rows = given(spark, sf_dir, "documents")
    layout = delimited.Layout(quoted_breaks=True, options={"maxCharsPerColumn": "-1"})
    path = f"{scratch.new_dir(spark, 'quoted')}/documents.dat"
    delimited.write_delimited(rows, path, layout)
    return delimited.scan(spark, path, rows.schema, layout)


def load_quoted(spark, sf_dir):
    """Customers whose names break in the middle, loaded strictly, nothing rejected."""
    rows = given(spark, sf_dir, "customer").withColumn("c_name", F.regexp_replace("c_name", "#", '"\n|#'))
    layout = delimited.Layout(quoted_breaks=True)
    root = scratch.new_dir(spark, "quoted")
    delimited.write_delimited(rows, f"{root}/customer.dat", layout)
    spec = new_spec(
        spark, root, Registry({"customer": rows.schema}), layout=layout, malformed="fail", split_bytes=1 << 16
    )
    load_table(spark, "customer", spec)
    return catalog.read_table(spark, spec.table_name("customer"))


def reconcile_exact(spark, sf_dir):
    """One table against itself, all rows compared, and against one with rows changed."""
    rows = given(spark, sf_dir, "customer")
    changed = rows.withColumn(
        "c_mktsegment",
        F.when(F.col("c_mktsegment") == "BUILDING", "HOUSES").otherwise(F.col("c_mktsegment")),
    )
    return _union(
        [
            checks.reconcile(rows, rows, "same", exact=True),
            checks.reconcile(rows, changed, "changed", exact=True),
        ]
    )


def load_replace(spark, sf_dir):
    """Load, load again in place of the first, then leave it alone."""
    spec = staged_spec(spark, sf_dir, ["orders"])
    for if_exists in ("fail", "replace", "skip"):
        load_table(spark, "orders", _with(spec, if_exists=if_exists))
    return catalog.read_table(spark, spec.table_name("orders"))


def _with(spec: LoadSpec, **settings) -> LoadSpec:
    return LoadSpec(**{**vars(spec), **settings})


def load_all_tables(spark, sf_dir):
    spec = staged_spec(spark, sf_dir, FLAT)
    load_all(spark, spec)
    counts = [
        catalog.read_table(spark, spec.table_name(t)).agg(
            F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for t in FLAT
    ]
    return _union(counts)


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionAll(frame)
    return result


def list_tables(spark, sf_dir):
    tables = ("customer", "orders", "part")
    spec = staged_spec(spark, sf_dir, tables)
    load_all(spark, spec)
    return catalog.list_tables(spark, spec.namespace)


def load_audit(spark, sf_dir):
    audit_in = f"{new_namespace(spark)}.load_audit"
    load_all(spark, staged_spec(spark, sf_dir, FLAT, audit_table=audit_in))
    return catalog.read_table(spark, audit_in).select("table_name", "row_count", "status")


def load_one_bad(spark, sf_dir):
    """A table whose text is missing fails alone; the audit keeps its error, and all times."""
    audit_in = f"{new_namespace(spark)}.load_audit"
    spec = staged_spec(spark, sf_dir, ["customer", "orders"], audit_table=audit_in)
    absent = T.StructType([T.StructField("id", T.LongType())])
    registry = Registry({**{t: spec.registry[t] for t in spec.registry}, "absent": absent})
    try:
        load_all(spark, _with(spec, registry=registry))
    except LoadFailed:
        pass
    return catalog.read_table(spark, audit_in).select(
        "table_name",
        "row_count",
        "status",
        F.coalesce(F.col("error").contains("PATH_NOT_FOUND"), F.lit(False)).alias("names_error"),
        (F.col("seconds") > 0).alias("timed"),
    )


def load_variant(spark, sf_dir):
    """One benchmark variant: its data set's folder, its label, its format."""
    rows = given(spark, sf_dir, "supplier")
    parent = scratch.new_dir(spark, "variant")
    delimited.write_delimited(rows, f"{parent}/tpcds-dataset-3TB/supplier.dat")
    home = scratch.new_dir(spark, "load")
    spec = LoadSpec.for_variant(
        "Sys1", 3000, "files", "orc",
        data_parent=parent,
        suffix=f"_{home[-12:]}",
        namespace_location=home,
        registry=Registry({"supplier": rows.schema}),
    )
    load_table(spark, "supplier", spec)
    label = spec.namespace.removesuffix(f"_{home[-12:]}")
    return catalog.read_table(spark, spec.table_name("supplier")).withColumn("variant", F.lit(label))


# --- the 25 registered schemas, over rows derived from the given tables --------------

# For each given table, the values that can fill a registered column of each kind, as
# expressions that mean the same in both SQL dialects. Amounts that do not fit a narrower
# column load as null, as keys do.
KINDS = {
    "lineitem": {
        "int": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "decimal": [
            "CAST(l_quantity AS decimal(15,2))",
            "CAST(l_extendedprice AS decimal(15,2))",
            "CAST(l_discount AS decimal(15,2))",
            "CAST(l_tax AS decimal(15,2))",
        ],
        "date": ["CAST(l_shipdate AS date)"],
        "string": ["l_returnflag", "l_linestatus"],
    },
    "orders": {
        "int": ["o_orderkey", "o_custkey"],
        "decimal": ["CAST(o_totalprice AS decimal(15,2))"],
        "date": ["CAST(o_orderdate AS date)"],
        "string": ["o_orderstatus", "o_orderpriority"],
    },
    "customer": {
        "int": ["c_custkey", "c_nationkey"],
        "decimal": ["CAST(c_acctbal AS decimal(15,2))"],
        "string": ["c_name", "c_mktsegment"],
    },
    "part": {
        "int": ["p_partkey", "p_size"],
        "decimal": ["CAST(p_retailprice AS decimal(15,2))"],
        "string": ["p_name", "p_brand", "p_type"],
    },
    "supplier": {
        "int": ["s_suppkey", "s_nationkey"],
        "decimal": ["CAST(s_acctbal AS decimal(15,2))"],
        "string": ["s_name"],
    },
}

# The given table each registered table's rows come from; orders where not listed.
FILLED_FROM = {
    "store_sales": "lineitem",
    "catalog_sales": "lineitem",
    "web_sales": "lineitem",
    "customer": "customer",
    "customer_address": "customer",
    "customer_demographics": "customer",
    "household_demographics": "customer",
    "income_band": "customer",
    "promotion": "part",
    "catalog_page": "part",
    "inventory": "part",
    "warehouse": "supplier",
    "ship_mode": "supplier",
    "reason": "supplier",
}


def filled_from(table: str) -> str:
    return FILLED_FROM.get(table, "orders")


def _filling(table: str, schema: T.StructType) -> list[tuple[T.StructField, str]]:
    """Each registered column with the expression that fills it."""
    kinds = KINDS[filled_from(table)]
    filling = []
    for position, field in enumerate(schema):
        values = kinds[field.dataType.simpleString().partition("(")[0]]
        filling.append((field, values[position % len(values)]))
    return filling


# Pages of the second version hold numbers of many values as packed differences.
PACKED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
# Tables that share a turn take this much of the given bytes, or one table its own.
TURN_BYTES = 512 * 1024 * 1024


def _tpcds_rows(spark, sf_dir, table: str, schema: T.StructType) -> DataFrame:
    """Keys are as wide as they are given; whether they fit is for the load to find."""
    filled = [f"{value} AS {field.name}" for field, value in _filling(table, schema)]
    return given(spark, sf_dir, filled_from(table)).selectExpr(*filled)


def tpcds_spec(spark, sf_dir, **settings) -> LoadSpec:
    """A spec that loads all 25 from text that stays, for loads that are repeated."""
    registry = tpcds()

    def stage(table: str) -> str:
        def as_text():
            return _tpcds_rows(spark, sf_dir, table, registry[table])

        return staged(spark, sf_dir, f"tpcds/{table}", as_text)

    root = side_by_side(spark, stage, registry, 4)[0]
    return new_spec(spark, f"{root}/tpcds", registry, **{"options": PACKED, **settings})


def tpcds_turns(spark, sf_dir) -> list[list[str]]:
    """The 25 tables in groups to load one after another, the largest tables first.

    No group holds more than the largest table does, judged by the bytes given for its columns,
    or more than ``TURN_BYTES`` where all tables are small.
    """
    registry = tpcds()
    column = {
        t: source_bytes(spark, f"{sf_dir}/{t}.parquet") / len(given(spark, sf_dir, t).columns)
        for t in sorted({filled_from(table) for table in registry})
    }
    sizes = {table: column[filled_from(table)] * len(registry[table]) for table in registry}
    most = max(TURN_BYTES, *sizes.values())
    turns: list[list[str]] = []
    for table in sorted(sizes, key=lambda table: -sizes[table]):
        fits = (turn for turn in turns if sum(sizes[t] for t in (*turn, table)) <= most)
        if (turn := next(fits, None)) is None:
            turns.append([table])
        else:
            turn.append(table)
    return turns


def load_in_turns(
    spark, sf_dir, after: Callable[[LoadSpec, list[str]], None] | None = None
) -> list[LoadResult]:
    """Load the 25 tables from text that is there only while its table loads.

    All of the text is about as large as all tables together. ``after`` is called with the
    tables that each turn has loaded. Every table is tried before a failure is raised.
    """
    registry = tpcds()
    spec = new_spec(spark, scratch.new_dir(spark, "stage"), registry, options=PACKED)

    @contextmanager
    def landed(table: str) -> Iterator[None]:
        path = spec.source_path(table)
        try:
            rows = _tpcds_rows(spark, sf_dir, table, registry[table])
            delimited.write_delimited(rows, path, **STAGED_AS)
            yield
        finally:
            sinks.remove_path(spark, path)

    results = {}
    for turn in tpcds_turns(spark, sf_dir):
        try:
            loaded = load_all(spark, spec, turn, landed)
        except LoadFailed as failed:
            loaded = failed.results
        results |= {r.table_name: r for r in loaded}
        if after:
            after(spec, [r.table_name for r in loaded if r.status == "ok"])
    ordered = [results[table] for table in registry]
    if any(r.status == "failed" for r in ordered):
        raise LoadFailed(ordered)
    return ordered


def load_tpcds(spark, sf_dir):
    results = load_in_turns(spark, sf_dir)
    return audit_frame(spark, results).select("table_name", "row_count", "rejected", "status")


def schema_registry(spark, sf_dir):
    """Every registered column as loaded: its type, rows, nulls and range.

    No other query can name these tables, so each is dropped once its profile is there.
    """
    found = {}

    def profile(spec: LoadSpec, table: str) -> None:
        name = spec.table_name(table)
        frame = checks.column_profile(catalog.read_table(spark, name), table)
        # One row for each declared column, whatever the size of the tables.
        found[table] = frame.collect(), frame.schema
        spark.sql(f"DROP TABLE {catalog.quoted(name)}")

    def profiles(spec: LoadSpec, tables: list[str]) -> None:
        side_by_side(spark, lambda table: profile(spec, table), tables, 8)

    load_in_turns(spark, sf_dir, profiles)
    profiled = [found[table] for table in tpcds()]
    return spark.createDataFrame([r for rows, _ in profiled for r in rows], profiled[0][1])


# --- checks -------------------------------------------------------------------------


def partition_profile(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem")
    root = staged(spark, sf_dir, "lineitem", lambda: rows)
    scan = delimited.scan(spark, f"{root}/lineitem.dat", rows.schema)
    return checks.partition_profile(scan).agg(F.sum("row_count").alias("row_count"))


def _inventory_root(spark, sf_dir) -> str:
    root = scratch.new_dir(spark, "inventory")
    tables = ("customer", "orders", "lineitem")
    spec = staged_spec(spark, sf_dir, tables, mode="external", table_root=root)
    load_all(spark, spec)
    return spec.external_root()


def file_inventory(spark, sf_dir):
    """Bytes of text files by folder: each file's line is as long as SQL says, plus its end."""
    return files.prefix_sizes(spark, _text_root(spark, sf_dir)).select("prefix", "total_bytes")


def _text_root(spark, sf_dir) -> str:
    """Parts as text, a folder for each brand, in it folders for ten sizes each."""
    root = scratch.new_dir(spark, "text")
    rows = given(spark, sf_dir, "part").select(
        F.translate("p_brand", "#", "-").alias("brand"),
        F.expr("p_size div 10").alias("size"),
        F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name").alias("value"),
    )
    rows.repartition("brand", "size").write.partitionBy("brand", "size").text(root)
    return root


def list_keys(spark, sf_dir):
    """The folders of one brand's files, by their keys."""
    keys = files.list_keys(spark, _text_root(spark, sf_dir), "brand=Brand-11")
    folder = F.regexp_extract("key", "^(.*)/[^/]*$", 1).alias("folder")
    return keys.groupBy(folder).agg(F.sum("length").alias("total_bytes"))


def list_prefixes(spark, sf_dir):
    return files.list_prefixes(spark, _inventory_root(spark, sf_dir))


def path_clean(spark, sf_dir):
    return given(spark, sf_dir, "pages").select("page_id", clean_path("url").alias("url"))


GAPPED = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_linenumber", T.IntegerType(), False),
        T.StructField("l_shipdate", T.DateType(), False),
        T.StructField("l_quantity", T.DecimalType(15, 2)),
    ]
)


def not_null_check(spark, sf_dir):
    """Line items whose line number or ship date is blank for some flags and states."""

    def as_text():
        return given(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("l_linenumber"),
            F.when(F.col("l_linestatus") != "O", F.col("l_shipdate").cast("date")).alias(
                "l_shipdate"
            ),
            F.col("l_quantity").cast("decimal(15,2)").alias("l_quantity"),
        )

    root = staged(spark, sf_dir, "gapped", as_text)
    spec = new_spec(spark, root, Registry({"gapped": GAPPED}))
    load_table(spark, "gapped", spec)
    table = catalog.read_table(spark, spec.table_name("gapped"))
    return checks.null_counts(table, declared_not_null(GAPPED))


PRICED = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DecimalType(15, 2)),
        T.StructField("o_orderdate", T.DateType()),
    ]
)


def _spoiled_root(spark, sf_dir) -> str:
    """Orders as text, with a price that is no number on urgent ones."""

    def as_text():
        price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
        return given(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderpriority") == "1-URGENT", "bad").otherwise(price),
            F.col("o_orderdate").cast("date"),
        )

    return staged(spark, sf_dir, "spoiled", as_text)


def quarantine_good(spark, sf_dir):
    path = f"{_spoiled_root(spark, sf_dir)}/spoiled.dat"
    return delimited.well_formed(delimited.parse(spark, path, PRICED))


def quarantine_bad(spark, sf_dir):
    path = f"{_spoiled_root(spark, sf_dir)}/spoiled.dat"
    rejected = delimited.rejects(delimited.parse(spark, path, PRICED))
    return rejected.withColumnRenamed(delimited.LINE, "line")


def load_rejects(spark, sf_dir):
    """One load that keeps the good rows and sets the bad lines aside."""
    root = _spoiled_root(spark, sf_dir)
    spec = new_spec(spark, root, Registry({"spoiled": PRICED}), malformed="reject")
    result = load_table(spark, "spoiled", spec)
    kept = catalog.read_table(spark, spec.table_name("spoiled"))
    lines = catalog.read_table(spark, spec.rejects_name("spoiled"))
    audit = audit_frame(spark, [result])
    rows = F.count(F.lit(1)).alias("line_count")
    return _union(
        [
            audit.select(F.lit("audit").alias("seen_in"), F.lit("good").alias("kind"), "row_count"),
            audit.select(F.lit("audit"), F.lit("rejected"), "rejected"),
            kept.agg(rows).select(F.lit("tables"), F.lit("good"), "line_count"),
            lines.agg(rows).select(F.lit("tables"), F.lit("rejected"), "line_count"),
        ]
    )


def reconcile(spark, sf_dir):
    spec = staged_spec(spark, sf_dir, FLAT)
    load_all(spark, spec)
    return reconcile_all(spark, spec)


def reconcile_digest(spark, sf_dir):
    """The same answer from the tables and what their loads observed, without the text."""
    spec = staged_spec(spark, sf_dir, FLAT, digest=True, malformed="reject")
    return reconcile_all(spark, spec, results=load_all(spark, spec))


def reconcile_differences(spark, sf_dir):
    """A copy of the customers that lacks one segment and has another twice."""
    source = given(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    copy = source.where(segment != "BUILDING").withColumn(
        "copies", F.when(segment == "MACHINERY", 2).otherwise(1)
    )
    copy = copy.select(*source.columns, F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return checks.reconcile(source, copy.drop("copy"), "customer")


def reconcile_sketch(spark, sf_dir):
    """The same copy loaded over the customers, compared with a sketch of what was loaded before.

    The text is not read for it.
    """
    spec = staged_spec(spark, sf_dir, ["customer"], digest=True)
    keep_sketch(spark, "customer", spec, load_table(spark, "customer", spec))
    segment = F.col("c_mktsegment")
    copy = given(spark, sf_dir, "customer").where(segment != "BUILDING")
    copy = copy.unionAll(copy.where(segment == "MACHINERY"))
    path = scratch.new_dir(spark, "path")
    sinks.write_path(copy, path)
    sinks.point_table_at(spark, spec.table_name("customer"), path, "parquet")
    return reconcile_by_sketch(spark, "customer", spec)


# --- the driver's three functions ---------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Stage orders as delimited text, load them as a table, read the table."""
    return loaded("orders")(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return loader_queries()
    return {**loader_queries(), **llm.queries(), "pipeline": corpus_pipeline.run}


def loader_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_delimited": scan_delimited,
        "scan_typed": scan_typed,
        "type_fit": type_fit,
        "schema_registry": schema_registry,
        "scan_table": scan_table,
        "show_rows": show_rows,
        "project_star": project_star,
        "temp_view": temp_view,
        "ctas_parquet": ctas("lineitem", "parquet"),
        "ctas_orc": ctas("orders", "orc"),
        "ctas_documents": ctas("documents", "orc"),
        "ctas_options": ctas("customer", "parquet", {"compression": "zstd"}),
        "ctas_location": ctas_location,
        "write_overwrite": write_overwrite,
        "external_table": external_table,
        "create_if_missing": create_if_missing,
        "list_tables": list_tables,
        "load_ctas": loaded("customer"),
        "load_ctas_lineitem": loaded("lineitem", format="orc"),
        "load_strict": loaded("events", malformed="fail"),
        "load_external": load_external,
        "load_external_two": load_external_two,
        "load_layout": load_layout,
        "scan_quoted": scan_quoted,
        "load_quoted": load_quoted,
        "reconcile_exact": reconcile_exact,
        "load_replace": load_replace,
        "load_all": load_all_tables,
        "load_tpcds": load_tpcds,
        "load_audit": load_audit,
        "load_one_bad": load_one_bad,
        "load_variant": load_variant,
        "load_rejects": load_rejects,
        "partition_profile": partition_profile,
        "file_inventory": file_inventory,
        "list_keys": list_keys,
        "list_prefixes": list_prefixes,
        "not_null_check": not_null_check,
        "quarantine_good": quarantine_good,
        "quarantine_bad": quarantine_bad,
        "reconcile": reconcile,
        "reconcile_digest": reconcile_digest,
        "reconcile_differences": reconcile_differences,
        "reconcile_sketch": reconcile_sketch,
        "path_clean": path_clean,
    }


def _each(tables: Iterable[str], columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {columns} FROM {t}" for t in tables
    )


def _tpcds_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS rejected,"
        f" 'ok' AS status FROM {filled_from(t)}"
        for t in tpcds()
    )


def _tpcds_profile() -> str:
    selects = []
    for table, schema in tpcds().items():
        given_table = filled_from(table)
        for position, (field, filled) in enumerate(_filling(table, schema), 1):
            type_text = field.dataType.simpleString()
            sql_type = "VARCHAR" if type_text == "string" else type_text.upper()
            value = f"TRY_CAST({filled} AS {sql_type})"
            selects.append(
                f"SELECT '{table}' AS table_name, {position} AS position,"
                f" '{field.name}' AS column_name, '{type_text}' AS data_type,"
                f" count(*) AS row_count, count(*) - count({value}) AS null_count,"
                f" CAST(min({value}) AS VARCHAR) AS min_value,"
                f" CAST(max({value}) AS VARCHAR) AS max_value FROM {given_table}"
            )
    return " UNION ALL ".join(selects)


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return loader_sql()
    pipeline = corpus_pipeline.ORACLE_SQL
    return {**loader_sql(), **llm.oracle_sql(), **({"pipeline": pipeline} if pipeline else {})}


def loader_sql() -> dict[str, str]:
    urgent = "o_orderpriority = '1-URGENT'"
    same = (
        "count(*) AS source_rows, count(*) AS table_rows, CAST(0 AS BIGINT) AS missing,"
        " CAST(0 AS BIGINT) AS extra"
    )
    building = "count(*) FILTER (WHERE c_mktsegment = 'BUILDING')"
    machinery = "count(*) FILTER (WHERE c_mktsegment = 'MACHINERY')"
    text_bytes = (
        "CAST(sum(octet_length(encode(p_partkey || '|' || p_name)) + 1) AS BIGINT) AS total_bytes"
    )
    differences = (
        f"SELECT 'customer' AS table_name, count(*) AS source_rows,"
        f" count(*) - {building} + {machinery} AS table_rows,"
        f" {building} AS missing, {machinery} AS extra FROM customer"
    )
    return {
        "scan_delimited": "SELECT * FROM orders",
        "scan_typed": (
            "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2))"
            " AS l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag"
            " FROM lineitem"
        ),
        "type_fit": _type_fit_sql(),
        "schema_registry": _tpcds_profile(),
        "scan_table": "SELECT * FROM customer",
        "show_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
        "project_star": "SELECT * FROM supplier",
        "temp_view": "SELECT * FROM part",
        "ctas_parquet": "SELECT * FROM lineitem",
        "ctas_orc": "SELECT * FROM orders",
        "ctas_documents": "SELECT * FROM documents",
        "ctas_options": "SELECT * FROM customer",
        "ctas_location": "SELECT * FROM supplier",
        "write_overwrite": "SELECT * FROM part",
        "external_table": "SELECT * FROM orders",
        "create_if_missing": (
            "SELECT TRY_CAST(s_suppkey AS INT) AS id, s_name AS name FROM supplier"
        ),
        "list_tables": (
            "SELECT DISTINCT t AS \"tableName\" FROM (SELECT 'customer' AS t FROM customer"
            " UNION ALL SELECT 'orders' FROM orders UNION ALL SELECT 'part' FROM part) AS names"
        ),
        "load_ctas": "SELECT * FROM customer",
        "load_ctas_lineitem": "SELECT * FROM lineitem",
        "load_strict": "SELECT * FROM events",
        "load_external": "SELECT * FROM part",
        "load_external_two": (
            "SELECT *, 'all' AS loaded FROM orders UNION ALL"
            f" SELECT *, 'urgent' FROM orders WHERE {urgent}"
        ),
        "load_layout": "SELECT * FROM orders",
        "scan_quoted": "SELECT * FROM documents",
        "load_quoted": "SELECT * REPLACE (replace(c_name, '#', '\"' || chr(10) || '|#') AS c_name) FROM customer",
        "reconcile_exact": (
            f"SELECT 'same' AS table_name, {same} FROM customer UNION ALL SELECT 'changed',"
            f" count(*), count(*), {building}, {building} FROM customer"
        ),
        "load_replace": "SELECT * FROM orders",
        "load_all": _each(FLAT, "count(*) AS row_count"),
        "load_tpcds": _tpcds_counts(),
        "load_audit": _each(FLAT, "count(*) AS row_count, 'ok' AS status"),
        "load_one_bad": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {n} AS row_count, '{status}' AS status,"
            f" {error} AS names_error, true AS timed"
            for t, n, status, error in (
                ("customer", "(SELECT count(*) FROM customer)", "ok", "false"),
                ("orders", "(SELECT count(*) FROM orders)", "ok", "false"),
                ("absent", "CAST(NULL AS BIGINT)", "failed", "true"),
            )
        ),
        "load_variant": "SELECT *, 'sys1_files_s3k_orc' AS variant FROM supplier",
        "load_rejects": " UNION ALL ".join(
            f"SELECT '{where}' AS seen_in, '{kind}' AS kind,"
            f" count(*) FILTER (WHERE {rows}) AS row_count FROM orders"
            for where in ("audit", "tables")
            for kind, rows in (("good", f"NOT {urgent}"), ("rejected", urgent))
        ),
        "partition_profile": "SELECT count(*) AS row_count FROM lineitem",
        "file_inventory": (
            f"SELECT 'brand=' || replace(p_brand, '#', '-') AS prefix, {text_bytes} FROM part GROUP BY p_brand"
        ),
        "list_keys": (
            f"SELECT 'brand=' || replace(p_brand, '#', '-') || '/size=' || (p_size // 10) AS folder, {text_bytes}"
            " FROM part WHERE replace(p_brand, '#', '-') = 'Brand-11' GROUP BY p_brand, p_size // 10"
        ),
        "list_prefixes": (
            "SELECT DISTINCT t AS prefix FROM (SELECT 'customer' AS t FROM customer"
            " UNION ALL SELECT 'orders' FROM orders"
            " UNION ALL SELECT 'lineitem' FROM lineitem) AS names"
        ),
        "not_null_check": " UNION ALL ".join(
            f"SELECT '{column}' AS column_name, count(*) FILTER (WHERE {gap}) AS null_count"
            " FROM lineitem"
            for column, gap in (
                ("l_orderkey", "l_orderkey IS NULL"),
                ("l_linenumber", "l_returnflag = 'R'"),
                ("l_shipdate", "l_linestatus = 'O'"),
            )
        ),
        "quarantine_good": (
            "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,"
            f" CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE NOT {urgent}"
        ),
        "quarantine_bad": (
            "SELECT o_orderkey || '|bad|' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|'"
            f" AS line FROM orders WHERE {urgent}"
        ),
        "reconcile": _each(FLAT, same),
        "reconcile_digest": _each(FLAT, same),
        "reconcile_differences": differences,
        "reconcile_sketch": differences,
        "path_clean": "SELECT page_id, regexp_replace(url, '/$', '') AS url FROM pages",
    }
