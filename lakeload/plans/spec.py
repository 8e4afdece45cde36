"""What a load reads, where it writes, and what it does on a clash or a bad line."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from lakeload.operators.sinks import FILE_FORMATS, TABLE_FORMATS
from lakeload.plans.schemas import Registry, tpcds
from lakeload.sources.delimited import Layout

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


def _one_of(what: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")


@dataclass(frozen=True)
class LoadSpec:
    """A load of the registry's tables from ``{data_root}/{table}.dat``.

    mode
        ``managed``: the catalog chooses the path (create table as select).
        ``external``: files go under ``table_root``, in a folder for the namespace, and the
        catalog points at them.
    if_exists
        ``fail``, ``skip`` or ``replace`` a table whose name is taken. Decided before
        any data is written.
    malformed
        ``null``: fields that do not parse load as null. ``reject``: lines that do not
        fit go to ``{table}__rejects`` as raw text. ``fail``: such lines fail the table.
    nulls
        ``report`` nulls in columns declared non-null in the audit, or ``fail`` the table.
    digest
        Also observe a digest of the rows as they are written, so that a later
        reconciliation can read the table alone and leave the source text unread.
    split_bytes
        Input bytes for each task, hence each output file. Unset leaves it to Spark, which
        cuts finer as the cluster grows; large loads want 512 MB or so, to avoid many
        small files. Sets two settings of the session while the load runs; loads that do so
        wait for each other.
    parallel_tables
        Tables loaded side by side, so that small ones fill the tail of large ones.
    """

    data_root: str
    namespace: str
    format: str = "parquet"
    mode: str = "managed"
    table_root: str | None = None
    namespace_location: str | None = None
    if_exists: str = "fail"
    malformed: str = "null"
    nulls: str = "report"
    digest: bool = False
    options: Mapping[str, str] = field(default_factory=dict)
    layout: Layout = field(default_factory=Layout)
    registry: Registry = field(default_factory=tpcds)
    split_bytes: int | None = None
    parallel_tables: int = 4
    audit_table: str | None = None

    def __post_init__(self):
        _one_of("format", self.format, FILE_FORMATS + TABLE_FORMATS)
        _one_of("mode", self.mode, ("managed", "external"))
        _one_of("if_exists", self.if_exists, ("fail", "skip", "replace"))
        _one_of("malformed", self.malformed, ("null", "reject", "fail"))
        _one_of("nulls", self.nulls, ("report", "fail"))
        if self.mode == "external" and not self.table_root:
            raise ValueError("an external load needs table_root")
        if self.mode == "external" and self.format == "iceberg":
            raise ValueError("iceberg does not adopt files; load it managed")
        clashes = [t for t in self.registry if f"{t}__rejects" in self.registry]
        if self.malformed == "reject" and clashes:
            raise ValueError(f"the rejects of {clashes} would go where other tables are")
        if self.parallel_tables < 1:
            raise ValueError("parallel_tables must be at least 1")
        if self.split_bytes is not None and self.split_bytes < 1:
            raise ValueError("split_bytes must be positive")

    @classmethod
    def for_variant(
        cls,
        system: str,
        scale: int,
        table_format: str,
        file_format: str | None = None,
        data_parent: str = "/spark",
        suffix: str = "",
        **settings,
    ) -> LoadSpec:
        """The spec for one benchmark variant.

        ``scale`` is in GB and comes in whole TB: 3000 reads ``tpcds-dataset-3TB`` and is
        labelled ``s3k``. ``system`` labels the storage under test and is part of the
        namespace, so runs on two systems do not meet. An Iceberg table stores its data in
        ``file_format``, parquet unless named; Delta stores parquet only, and ``table_format``
        ``files`` means plain files of that format.
        """
        if not _NAME.fullmatch(system):
            raise ValueError(f"not a usable system label: {system!r}")
        if scale < 1000 or scale % 1000:
            raise ValueError(f"scale must be a multiple of 1000, not {scale}")
        _one_of("table_format", table_format, (*TABLE_FORMATS, "files"))
        _one_of("file_format", file_format or "parquet", FILE_FORMATS)
        if table_format == "delta" and file_format not in (None, "parquet"):
            raise ValueError("delta stores parquet only")

        thousands = scale // 1000
        file_format = file_format or "parquet"
        label = [system.lower(), table_format, f"s{thousands}k"]
        settings = {"data_root": f"{data_parent.rstrip('/')}/tpcds-dataset-{thousands}TB"} | settings
        if table_format == "delta":
            settings = {"mode": "external", "format": "delta"} | settings
        elif table_format == "iceberg":
            label.append(file_format)
            options = {"write.format.default": file_format, **settings.pop("options", {})}
            settings = {"format": "iceberg", "options": options} | settings
        else:
            label.append(file_format)
            settings = {"format": file_format} | settings
        return cls(namespace="_".join(label) + suffix, **settings)

    def source_path(self, table: str) -> str:
        return f"{self.data_root.rstrip('/')}/{table}.dat"

    def table_name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def external_root(self) -> str:
        """Where this namespace's external tables lie, apart from those of others."""
        return f"{self.table_root.rstrip('/')}/{self.namespace}"

    def rejects_name(self, table: str) -> str:
        return f"{self.namespace}.{table}__rejects"

    def sketch_name(self, table: str) -> str:
        return f"{self.namespace}.{table}__sketch"
