import re
from collections import defaultdict

import numpy as np
import pytest

from lakeload.llm import near_sets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingles(text, width):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width=4, percent=85):
    sets = [shingles(t, width) for _, t in rows]
    near = defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if rows[i][0] == rows[j][0] and sets[i] and sets[j] or both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((own, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def found(frame, **settings):
    return sorted([tuple(r) for r in near_sets.near_classes(frame, **settings).collect()], key=str)


def near_copies(seed=1, documents=60, copies=25, words=120):
    """Texts with copies that differ in some words, and passages that others share."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = list(rng.choice(vocabulary, 40))
    rows, number = [], 0
    for d in range(documents):
        text = list(rng.choice(vocabulary, words + int(rng.integers(0, 30))))
        if d % 3 == 0:
            text[10:50] = passage
        for c in range(copies if d % 10 == 0 else 1 + d % 3):
            own = list(text)
            for at in rng.integers(0, len(own), int(rng.integers(0, 4))):
                own[at] = f"n{number}x{at}"
            rows.append((number, " ".join(own)))
            number += 1
    order = rng.permutation(len(rows))
    return [(int(order[i]), t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("seed, width, percent", [(1, 4, 85), (2, 5, 80)])
def test_against_all_pairs(make, seed, width, percent):
    rows = near_copies(seed)
    assert found(make(rows), width=width, percent=percent) == brute(rows, width, percent)


def test_long_lists_are_split(make, monkeypatch):
    monkeypatch.setattr(near_sets, "LIST_ROWS", 10)
    monkeypatch.setattr(near_sets, "ROUNDS", 1)
    rows = near_copies(3)
    assert found(make(rows)) == brute(rows)


def test_order_by_hash_alone_gives_the_same(make, monkeypatch):
    monkeypatch.setattr(near_sets, "MOST_KEYS", 0)
    rows = near_copies(4, documents=30)
    assert found(make(rows)) == brute(rows)


def test_pairs_of_groups_are_expanded_to_members(spark):
    """One pair of groups gives all pairs of their members, or each member with one of the other."""
    members = spark.createDataFrame(
        [(b"g", u, 9, 1) for u in (1, 2, 3, 6)] + [(b"h", u, 9, 1) for u in (4, 5)],
        "group binary, unit long, n long, degree long",
    )
    parts = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)], "id long, component long")
    held, cells = near_sets._cells(members, parts)
    assert sorted((r.cell, r.units) for r in cells.collect()) == [(1, 3), (4, 2), (6, 1)]
    pair = spark.createDataFrame([(1, 4)], "a long, b long")
    both = {(r.a, r.b) for r in near_sets._expanded(pair, held).collect()}
    assert both == {(a, b) for a in (1, 2, 3) for b in (4, 5)}
    assert {(r.a, r.b) for r in near_sets._expanded(pair, held, cells).collect()} == {(1, 4), (2, 4), (3, 4)}


def test_members_of_one_group(make, monkeypatch):
    """Sets of one prefix and size: some are similar, some share little more than the prefix."""
    monkeypatch.setattr(near_sets, "MOST_KEYS", 1 << 20)
    rare = [f"r{i}" for i in range(33)]
    parts = [[f"p{k}w{i}" for i in range(70)] for k in range(4)]
    rows, number = [], 0
    for k in range(4):
        for j in range(12):
            own = list(parts[k])
            if j % 3 == 1:
                own[-3:] = [f"p{k}z{i}" for i in range(3)]
            rows.append((number, " ".join(rare[: 17 + k % 2 * 16] + own)))
            rows += [(number + 1000, " ".join(own)), (number + 2000, " ".join(own))]
            number += 1
    for rounds in (0, 6):
        monkeypatch.setattr(near_sets, "ROUNDS", rounds)
        assert found(make(rows), width=1) == brute(rows, 1)


def test_given_documents(given):
    docs = given("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == brute(rows)


def test_at_the_threshold(make):
    words = [f"a{i}" for i in range(103)]  # 100 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:88])), (3, " ".join(words[:87]))]
    assert found(make(rows)) == brute(rows)


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    assert found(nothing) == []


def test_one_of_each_group_stays(make, awkward):
    rows = near_copies(5, documents=20)
    kept = near_sets.deduplicated(make(rows))
    least = {c for _, _, c in brute(rows, 5, 80)}
    assert {r.doc_id for r in kept.collect()} == least and kept.columns == make([]).columns
    stay = near_sets.deduplicated(awkward).collect()
    assert sorted(str(r.doc_id) for r in stay) == ["1", "3", "4", "5", "6", "7", "8", "None"]
    assert near_sets.deduplicated(make([])).collect() == []


def test_cells_alike_are_tested_as_one_form(spark, monkeypatch):
    """Forty cells of one component share a list with each of ten documents, two with one more."""
    rows, stored = {}, near_sets.saved

    def noted(frame, label):
        out = stored(frame, label)
        rows[label] = out.row_count
        return out

    monkeypatch.setattr(near_sets, "saved", noted)
    lists = [(s, at, 1, cell, 147) for cell in range(1, 41) for s, at in ((7, 2), (8, 3))]
    lists += [(7, 2, d, d, 147) for d in range(100, 110)] + [(7, 1, 110, 110, 147), (8, 2, 110, 110, 147)]
    labelled = spark.createDataFrame(lists, "shingle long, at int, component long, cell long, n long")
    got = {(r.a, r.b) for r in near_sets._pairs_across(labelled, 85).collect()}
    assert got == {(cell, 110) for cell in range(1, 41)}  # sets of 147 need two shared shingles
    assert rows["forms"] == 14 and rows["forms-met"] == 2
