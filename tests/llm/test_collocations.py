"""Collocations against a plain count, and the summaries against their guarantee."""

import re
from collections import Counter

import numpy as np
import pytest

from lakeload.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold=30, top=2000, share=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    held = {k: a for k, a in f.items() if a >= threshold and len(k[1]) > 1}
    inside = Counter()
    for (lang, words), a in held.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                inside[key] = max(inside[key], a)
    out = []
    by_lang = {}
    for (lang, words), a in held.items():
        if (lang, words) in inside and 100 * inside[lang, words] >= share * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def given_rows(docs):
    return [(r.text, r.lang) for r in docs.select("text", "lang").collect()]


def test_given_documents(given):
    docs = given("documents")
    expected = brute(given_rows(docs))
    assert expected and got(co.collocations(docs)) == expected


@pytest.mark.parametrize("threshold, top, share", [(2, 7, 80), (3, 2000, 50), (5, 40, 101)])
def test_other_parameters(spark, threshold, top, share):
    rng = np.random.default_rng(threshold)
    words = ["a", "A", "b", "Cc", "é", "É", "x.", "y,", "z\n", "\t", "q!r", "ß\r\nü"]
    rows = [(" ".join(rng.choice(words, size=rng.integers(0, 40))), ["en", "de", None][i % 3]) for i in range(120)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert got(co.collocations(docs, threshold, top, share)) == brute(rows, threshold, top, share)


def test_small_summaries_give_the_same(given, monkeypatch):
    """Many slices, flushes and merges, which drop counts of what is rare."""
    docs = given("documents").repartition(6)
    for name, value in (("SLICE_BYTES", 20_000), ("FLUSH_GRAMS", 30_000)):
        monkeypatch.setattr(co, name, value)
    for slack, bits in ((1, 1), (2, 16)):
        monkeypatch.setattr(co, "SLACK", slack)
        monkeypatch.setattr(co, "FILTER_BITS", bits)
        assert got(co.collocations(docs)) == brute(given_rows(docs))


def test_frequent_keys_survive_all_merges():
    rng = np.random.default_rng(3)
    drawn = (rng.zipf(1.3, size=60_000) % 5000).astype(np.uint64)
    for threshold in (30, 100):
        summary = co.Summary(len(drawn) // threshold + 1)
        for part in np.array_split(drawn, 200):
            keys, counts = np.unique(part, return_counts=True)
            summary.add(keys, counts)
        keys, counts = np.unique(drawn, return_counts=True)
        left = summary.at_least(threshold)
        assert summary.lost > 0 and len(summary.keys) <= summary.capacity
        assert set(keys[counts >= threshold]) <= set(left) and len(left) < len(keys)


def test_hashes_that_meet_are_counted_apart():
    ids = np.array([[0, 1], [0, 2], [0, 1], [0, 3]])
    first, counts = co._by_words(ids, np.array([5, 5, 5, 9], np.uint64))
    assert sorted(zip(ids[first].tolist(), counts.tolist(), strict=True)) == [([0, 1], 2), ([0, 2], 1), ([0, 3], 1)]


def test_awkward_rows(awkward, nothing, spark):
    rows = [(r.text, r.lang) for r in awkward.collect()]
    assert got(co.collocations(awkward)) == brute(rows)
    assert got(co.collocations(nothing)) == []
    same = [("Very same words; very same", None)] * 5000 + [(None, "en"), ("", "en"), (". .\n", "en")]
    frame = spark.createDataFrame(same, "text string, lang string")
    for name in ("phrase", "words", "f", "a", "score", "hash", "range", "n", "rank"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    assert got(co.collocations(frame)) == brute(same)
