import re

import pytest
from pyspark.sql import functions as F

from lakeload.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def expected_targets(sizes: dict) -> dict:
    """Shares by weight; what is above three times a size is reshared until none is."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, fixed, left = {}, set(), float(sum(sizes.values()))
    while len(fixed) < len(names):
        free = [s for s in names if s not in fixed]
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            fixed.add(s)
    return target


def check(frame, result):
    given = {}
    for r in frame.select("doc_id", "text", "source").collect():
        given.setdefault(r.source, []).append(len(WORDS.findall(r.text or "")))
    sizes = {s: sum(v) for s, v in given.items()}
    wanted = expected_targets(sizes)
    got = result.collect()
    assert len(got) == sum(map(len, given.values()))
    assert sorted(r["size"] for r in got) == sorted(n for v in given.values() for n in v)
    taken = {}
    for r in got:
        taken[(r.source_size, round(r.target, 3))] = taken.get((r.source_size, round(r.target, 3)), 0) + r.taken
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
    for s, size in sizes.items():
        assert any(k[0] == size and k[1] == pytest.approx(wanted[s], abs=0.01) for k in taken)
    return given, wanted, taken


def test_on_the_given_documents(given):
    docs = given("documents")
    _, wanted, taken = check(docs, mixing.mix(docs))
    for (_, target), got in taken.items():
        assert abs(got - target) <= max(0.05 * target, 2000)


def test_same_again_and_however_partitioned(given):
    docs = given("documents")
    first, second = mixing.mix(docs), mixing.mix(docs.repartition(5))
    assert sorted(first.collect()) == sorted(second.collect())


def test_awkward_rows(awkward):
    check(awkward, mixing.mix(awkward))


def test_small_sources_are_repeated_and_large_ones_cut(make):
    rows = [(i, "w " * 10, "big") for i in range(1000)]
    rows += [(2000 + i, "w " * 10, "small") for i in range(10)] + [(3000, "w " * 10, None)]
    result = mixing.mix(make(rows)).groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("target").alias("g"))
    by = {r.source_size: r for r in result.collect()}
    assert by[100].t == 300 and by[10].t == 30 and by[10].g == 30
    assert abs(by[10000].t - by[10000].g) <= 10


def test_no_rows_and_no_words(nothing, make):
    assert mixing.mix(nothing).collect() == []
    assert [r.taken for r in mixing.mix(make([(1, ""), (2, None)])).collect()] == [0, 0]


def test_rows_of_the_mix_agree_with_the_counts(given):
    docs = given("documents")
    counts = mixing.mix(docs).where("size > 0").selectExpr("doc_id", "taken / size AS times")
    wanted = {r.doc_id: int(r.times) for r in counts.collect() if r.times}
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    got = {r.doc_id: r["count"] for r in mixed.where(mixing.word_count("text") > 0).groupBy("doc_id").count().collect()}
    assert got == wanted


def test_rows_of_the_mix_keep_clashing_columns(awkward):
    assert mixing.mixed_rows(awkward).columns == awkward.columns


def test_no_python(given):
    plan = mixing.mix(given("documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_equal_rows_are_taken_in_part(make):
    """Targets end among rows equal in id and text: as many go in as come nearest."""
    rows = [(None, "w " * 10, "a")] * 10_000 + [(7, "v " * 10, None)] * 300 + [(i, "u " * 10, "b") for i in range(50)]
    docs = make(rows).repartition(3)
    result = mixing.mix(docs)
    _, wanted, taken = check(docs, result)
    for (_, target), got in taken.items():
        assert abs(got - target) <= 5
    assert sorted(taken.values()) == sorted(round(t / 10) * 10 for t in wanted.values())
    kept = mixing.mixed_rows(docs)
    assert kept.columns == docs.columns
    of = {r.source: r["count"] for r in kept.groupBy("source").count().collect()}
    assert of == {s: round(t / 10) for s, t in wanted.items()}
    assert sorted(mixing.mix(docs.repartition(5)).groupBy("size", "taken").count().collect()) == sorted(
        result.groupBy("size", "taken").count().collect()
    )
