import pytest

from lakeload.cli import parser, spec_from
from lakeload.plans.spec import LoadSpec
from lakeload.sources.delimited import Layout


@pytest.mark.parametrize("system", ["s1", "S2"])
@pytest.mark.parametrize("scale, label", [(3000, "3"), (10000, "10")])
@pytest.mark.parametrize("file_format", ["parquet", "avro", "orc"])
def test_iceberg_variants(system, scale, label, file_format):
    spec = LoadSpec.for_variant(system, scale, "iceberg", file_format)
    assert spec.namespace == f"{system.lower()}_iceberg_s{label}k_{file_format}"
    assert spec.source_path("item") == f"/spark/tpcds-dataset-{label}TB/item.dat"
    assert spec.options == {"write.format.default": file_format}
    assert (spec.format, spec.mode) == ("iceberg", "managed")


def test_the_system_keeps_namespaces_apart():
    names = {
        LoadSpec.for_variant(s, 3000, "iceberg", "orc", suffix="_test").namespace
        for s in ("s1", "s2")
    }
    assert names == {"s1_iceberg_s3k_orc_test", "s2_iceberg_s3k_orc_test"}


def test_delta_variant_is_external():
    spec = LoadSpec.for_variant("s1", 3000, "delta", table_root="s3a://bucket/tables")
    assert (spec.namespace, spec.format, spec.mode) == ("s1_delta_s3k", "delta", "external")


def test_file_format_defaults_to_parquet():
    assert LoadSpec.for_variant("s1", 3000, "files").format == "parquet"
    iceberg = LoadSpec.for_variant("s1", 3000, "iceberg")
    assert iceberg.options == {"write.format.default": "parquet"}


@pytest.mark.parametrize(
    "variant",
    [
        ("s1", 3500, "iceberg", "parquet"),
        ("s1", 0, "iceberg", "parquet"),
        ("s1", 3000, "hudi", "parquet"),
        ("s1", 3000, "iceberg", "csv"),
        ("s1", 3000, "delta", "orc"),
        ("s1; DROP", 3000, "iceberg", "orc"),
        ("", 3000, "iceberg", "orc"),
    ],
)
def test_unknown_variants_raise(variant):
    with pytest.raises(ValueError):
        LoadSpec.for_variant(*variant)


@pytest.mark.parametrize(
    "settings",
    [
        {"format": "text"},
        {"mode": "temporary"},
        {"mode": "external"},
        {"if_exists": "maybe"},
        {"malformed": "drop"},
        {"nulls": "ignore"},
        {"parallel_tables": 0},
        {"split_bytes": 0},
    ],
)
def test_bad_settings_raise(settings):
    with pytest.raises(ValueError):
        LoadSpec("/data", "ns", **settings)


def test_wide_encodings_are_refused():
    with pytest.raises(ValueError):
        Layout(encoding="utf-16le")


def test_command_line():
    words = "--system s1 --scale 10000 --nodes 16 --table-format iceberg --file-format orc"
    spec = spec_from(parser().parse_args(words.split()))
    assert spec.namespace == "s1_iceberg_s10k_orc"
    assert spec.audit_table == "s1_iceberg_s10k_orc.load_audit"
    assert spec.split_bytes == 512 * 1024 * 1024


def test_command_line_types_and_layout():
    words = "--system s1 --scale 3000 --table-format files --encoding ISO-8859-1"
    words += " --no-trailing-separator --type store_sales.ss_ticket_number=bigint"
    spec = spec_from(parser().parse_args(words.split()))
    assert spec.registry["store_sales"]["ss_ticket_number"].dataType.simpleString() == "bigint"
    assert spec.layout == Layout(trailing_separator=False, encoding="ISO-8859-1")
    with pytest.raises(ValueError):
        spec_from(parser().parse_args((words + " --type ss_ticket_number=bigint").split()))


def test_command_line_needs_a_root_for_delta():
    with pytest.raises(ValueError):
        spec_from(parser().parse_args("--system s1 --scale 3000 --table-format delta".split()))
