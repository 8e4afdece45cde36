"""``python -m lakeload``: load the benchmark tables for one variant."""

from __future__ import annotations

import argparse
import time
from dataclasses import replace

from lakeload.plans.load import LoadFailed, load_all
from lakeload.plans.schemas import tpcds
from lakeload.plans.spec import LoadSpec
from lakeload.session import build_session
from lakeload.sources.delimited import Layout


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeload", description="Load TPC-DS text into tables")
    p.add_argument("--system", required=True, help="label of the storage under test")
    p.add_argument("--scale", type=int, required=True, help="GB, in whole TB: 3000, 10000")
    p.add_argument("--nodes", type=int, help="number of workers, for the application name")
    p.add_argument("--table-format", required=True, choices=["iceberg", "delta", "files"])
    p.add_argument("--file-format", choices=["parquet", "orc", "avro"])
    p.add_argument("--data-parent", default="/spark", help="folder of the data sets")
    p.add_argument("--table-root", help="where external tables go; needed for delta")
    p.add_argument("--suffix", default="", help="end of the namespace name")
    p.add_argument("--if-exists", default="fail", choices=["fail", "skip", "replace"])
    p.add_argument("--malformed", default="null", choices=["null", "reject", "fail"])
    p.add_argument("--nulls", default="report", choices=["report", "fail"])
    p.add_argument("--digest", action="store_true", help="observe a digest of the rows")
    p.add_argument("--encoding", default="UTF-8", help="of the text, such as ISO-8859-1")
    p.add_argument("--no-trailing-separator", action="store_true")
    p.add_argument(
        "--type",
        action="append",
        default=[],
        metavar="TABLE.COLUMN=TYPE",
        help="load a column as another type; repeatable",
    )
    p.add_argument("--split-mb", type=int, default=512)
    p.add_argument("--parallel-tables", type=int, default=4)
    p.add_argument("--audit-table", help="default: load_audit in the namespace")
    p.add_argument("--table", action="append", help="load only this table; repeatable")
    p.add_argument("--metastore-uri")
    p.add_argument("--warehouse")
    return p


def type_overrides(words: list[str]) -> dict[str, dict[str, str]]:
    """``['t.c=bigint']`` as ``{'t': {'c': 'bigint'}}``."""
    overrides: dict[str, dict[str, str]] = {}
    for word in words:
        name, _, type_text = word.partition("=")
        table, _, column = name.partition(".")
        if not (table and column and type_text):
            raise ValueError(f"expected TABLE.COLUMN=TYPE, not {word!r}")
        overrides.setdefault(table, {})[column] = type_text
    return overrides


def spec_from(args: argparse.Namespace) -> LoadSpec:
    external = {"mode": "external", "table_root": args.table_root} if args.table_root else {}
    spec = LoadSpec.for_variant(
        args.system,
        args.scale,
        args.table_format,
        args.file_format,
        data_parent=args.data_parent,
        suffix=args.suffix,
        if_exists=args.if_exists,
        malformed=args.malformed,
        nulls=args.nulls,
        digest=args.digest,
        layout=Layout(
            trailing_separator=not args.no_trailing_separator, encoding=args.encoding
        ),
        registry=tpcds().override(type_overrides(args.type)),
        split_bytes=args.split_mb * 1024 * 1024,
        parallel_tables=args.parallel_tables,
        **external,
    )
    return replace(spec, audit_table=args.audit_table or f"{spec.namespace}.load_audit")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spec = spec_from(args)  # a bad variant ends here, before a session starts
    profile = "hive" if args.table_format == "files" else args.table_format
    name = f"load-{spec.namespace}" + (f"-{args.nodes}nodes" if args.nodes else "")
    spark = build_session(
        profile, name, metastore_uri=args.metastore_uri, warehouse=args.warehouse
    )
    start = time.monotonic()
    try:
        results = load_all(spark, spec, args.table)
    except LoadFailed as failure:
        results = failure.results
    for r in results:
        print(f"{r.table_name}\t{r.status}\t{r.row_count}\t{r.seconds}s\t{r.error or ''}")
    print(f"total\t{time.monotonic() - start:.2f}s")
    return int(any(r.status == "failed" for r in results))
