import pytest

from lakeload import cli
from lakeload.operators.catalog import read_table

REASON = ["1|AAAA|Did not fit|", "2|BBBB|Wrong size|"]


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    data = tmp_path / "tpcds-dataset-3TB"
    data.mkdir()
    (data / "reason.dat").write_text("".join(f"{line}\n" for line in REASON))
    monkeypatch.setattr(cli, "build_session", lambda *args, **settings: spark)
    system = "sys_" + tmp_path.name.replace("-", "_")

    def run(*words):
        variant = ["--system", system, "--scale", "3000", "--table-format", "files"]
        places = ["--data-parent", str(tmp_path), "--table-root", str(tmp_path / "tables")]
        return cli.main([*variant, *places, *words]), f"{system}_files_s3k_parquet"

    return run


def test_a_load_reports_each_table(spark, run, capsys):
    code, namespace = run("--table", "reason")
    assert code == 0
    out = capsys.readouterr().out
    assert "reason\tok\t2" in out
    assert out.splitlines()[-1].startswith("total\t")
    assert read_table(spark, f"{namespace}.reason").count() == 2
    assert read_table(spark, f"{namespace}.load_audit").head().status == "ok"


def test_a_failed_table_gives_a_failing_exit(spark, run, capsys):
    code, namespace = run("--table", "item", "--table", "reason")
    assert code == 1
    out = capsys.readouterr().out
    assert "item\tfailed" in out and "reason\tok" in out
    assert read_table(spark, f"{namespace}.reason").count() == 2


def test_a_bad_variant_ends_before_a_session_starts(monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda *a, **k: pytest.fail("session started"))
    with pytest.raises(ValueError):
        cli.main("--system s1 --scale 17 --table-format files".split())
