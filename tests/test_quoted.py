"""Records with line breaks in quoted values, however a file is split."""

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from lakeload.sources import delimited, quoted

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("note", T.StringType())]
)
LAYOUT = delimited.Layout(quoted_breaks=True)
PARTS = ["a", "b c", "\n", "\n\n", "\r\n", "|", '"', "\\", "é", "漢", "1", "", " x"]


@pytest.fixture
def splits(spark):
    """Sets the size of splits, and puts it back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def set_size(size):
        for name, value in zip(names, (size, 0, 1), strict=True):
            spark.conf.set(name, str(value))

    yield set_size
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def drawn(count, seed, longest=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randint(1, longest))).strip() or None
    return [(i, word(), word()) for i in range(count)]


def scanner(text, separator="|", quote='"', escape="\\"):
    """Records of a text, a character at a time."""
    out, now, inside, begins, hidden = [], "", False, True, False
    for c in text:
        if inside:
            now += c
            if hidden:
                hidden = False
            elif c == escape:
                hidden = True
            elif c == quote:
                inside, begins = False, False
        elif c == "\n":
            out.append(now)
            now, begins = "", True
        else:
            now += c
            if begins and c == quote:
                inside = True
            begins = c == separator
    last = now.removesuffix("\n") if inside else now  # the end of a file's last line
    return [r.removesuffix("\r") for r in (out + [last] if now else out)]


@pytest.mark.parametrize("size", [64, 333, 1_000_000])
def test_written_rows_come_back(spark, tmp_path, splits, size):
    rows = drawn(400, size)
    path = str(tmp_path / "t.dat")
    delimited.write_delimited(spark.createDataFrame(rows, SCHEMA).coalesce(2), path, LAYOUT)
    splits(size)
    read = delimited.scan(spark, path, SCHEMA, LAYOUT)
    assert sorted(tuple(r) for r in read.collect()) == rows
    parsed = delimited.parse(spark, path, SCHEMA, LAYOUT)
    assert parsed.where(delimited.MALFORMED).count() == 0 and parsed.count() == len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_records_against_a_scanner(spark, tmp_path, splits, seed):
    """Any text, well written or not: the same records for each size of splits."""
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS + ['"', '|"', '"|', "\n"]) for _ in range(300)) for _ in range(3)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.txt").write_bytes(text.encode())
    expected = sorted(r for text in texts for r in scanner(text))
    for size in (7, 50, 10_000):
        splits(size)
        assert sorted(r.record for r in quoted.records(spark, str(tmp_path)).collect()) == expected


def test_awkward_files(spark, tmp_path, splits):
    splits(40)
    folder = tmp_path / "t.dat"
    folder.mkdir()
    (folder / "empty").write_bytes(b"")
    (folder / "open").write_bytes(b'1|"never\nclosed|\n2|x|y|\n')
    (folder / "plain").write_bytes(b'3|5" pipe|it is 6" long|\r\n4|a|b|\r\n')
    (folder / "no_end").write_bytes(b'5|"two\nlines"|z|')
    rows = sorted(tuple(r) for r in delimited.scan(spark, str(folder), SCHEMA, LAYOUT).collect() if r.id != 1)
    assert rows == [(3, '5" pipe', 'it is 6" long'), (4, "a", "b"), (5, "two\nlines", "z")]
    (tmp_path / "none.dat").write_bytes(b"")
    assert delimited.scan(spark, str(tmp_path / "none.dat"), SCHEMA, LAYOUT).count() == 0


def test_long_values_and_many_escapes(spark, tmp_path, splits):
    text = ("line \\\" \\\\ \n" * 20_000) + "|" * 1000
    (tmp_path / "t.dat").write_text(f'1|"{text}"|end|\n2|b|c|\n')
    splits(10_000)
    rows = delimited.scan(spark, str(tmp_path / "t.dat"), SCHEMA, delimited.Layout(quoted_breaks=True, options={"maxCharsPerColumn": "-1"})).collect()
    found = {r.id: r for r in rows}
    assert found[1].name == text.replace('\\"', '"').replace("\\\\", "\\") and found[1].note == "end"
    assert tuple(found[2]) == (2, "b", "c")


def test_other_encodings_and_refusals(spark, tmp_path, splits):
    splits(16)
    (tmp_path / "t.dat").write_bytes('1|"é\nü"|ß|\n2|x|y|\n'.encode("latin-1"))
    layout = delimited.Layout(quoted_breaks=True, encoding="ISO-8859-1")
    rows = delimited.scan(spark, str(tmp_path / "t.dat"), SCHEMA, layout).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "é\nü", "ß"), (2, "x", "y")]
    with pytest.raises(ValueError):
        delimited.Layout(quoted_breaks=True, options={"header": "true"})


def test_states_compose():
    rng = np.random.default_rng(1)
    for _ in range(50):
        out, into = rng.random((2, 30)) < 0.4
        for first in (0, 1):
            state, expected = first, [first]
            for a, b in zip(out, into, strict=True):
                state = int(b if state else a)
                expected.append(state)
            assert quoted._states(first, out, into).tolist() == expected
    assert quoted._states(1, np.empty(0, bool), np.empty(0, bool)).tolist() == [1]
