import math
import re
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from lakeload.llm import hidden_markov as hmm

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def tokens(text):
    return [*WORDS.findall((text or "").translate(LOWER)), None]


def base_of(rows):
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(t for (_, text), out in zip(rows, held) if not out for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, text), h in zip(rows, held):
        own = tokens(text)
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((i, h, len(own), sum(counts[t] > 0 for t in own), n, score))
    return out


def check(frame, result):
    want = sorted(base_of([(r.doc_id, r.text) for r in frame.collect()]), key=str)
    got = result.collect()
    mine = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=str)
    assert [g[:5] for g in mine] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in mine], [w[5] for w in want])
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    return got


def test_given_documents_and_a_better_score_on_held_out_ones(given):
    got = check(given("documents"), hmm.score(given("documents")))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("chars", [32_000_000, 20_000])
def test_blocks_do_not_matter(given, monkeypatch, chars):
    whole = {r.doc_id: r.score for r in hmm.score(given("documents"), rounds=1).collect()}
    monkeypatch.setattr(hmm, "GROUP_TOKENS", 5_000)
    split = hmm.score(given("documents").repartition(4, "doc_id"), rounds=1).collect()
    assert np.allclose([whole[r.doc_id] for r in split], [r.score for r in split], rtol=0.02)


def chain(states=3):
    rng = np.random.default_rng(0)
    some = lambda *s: rng.random(s) + 0.1
    move, start = some(states, states), some(states)
    return hmm.Chain(start / start.sum(), move / move.sum(1, keepdims=True), some(states) * 9, some(states), some(states), 50, 5, 3)


def test_forward_and_expected_counts_against_all_paths():
    c, rng = chain(), np.random.default_rng(1)
    emit = rng.random((5, 3))
    docs = [[0, 1, 2, 4], [3, 4], [4]]  # the last row is the end
    running = np.array([3, 2, 1, 1])
    token = np.array([0, 3, 4, 1, 4, 2, 4])
    log, _, _ = hmm._forward(running, token, emit, c, False)
    posterior, moves, starts = hmm._expected(running, token, emit, c)
    want_moves, want_starts, want = np.zeros((3, 3)), np.zeros(3), []
    for doc, got in zip(docs, log):
        total = {}
        for path in product(range(3), repeat=len(doc)):
            p = c.start[path[0]] * emit[doc[0], path[0]]
            for i in range(1, len(doc)):
                p *= c.move[path[i - 1], path[i]] * emit[doc[i], path[i]]
            total[path] = p
        likelihood = sum(total.values())
        assert got == pytest.approx(math.log(likelihood))
        for path, p in total.items():
            want_starts[path[0]] += p / likelihood
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += p / likelihood
        want.append([sum(p for path, p in total.items() if path[-1] == k) / likelihood for k in range(3)])
    assert np.allclose(moves, want_moves) and np.allclose(starts, want_starts)
    assert np.allclose(posterior[[6, 4, 2]], want)


def plain_expected(running, token, emit, c):
    """The textbook recursions, token rows with a state in each column."""
    values, scales, at, now = np.empty((len(token), emit.shape[1])), np.empty(len(token)), 0, None
    for count in running:
        own = slice(at, at + count)
        now = emit[token[own]] * (c.start if now is None else now[:count] @ c.move)
        scales[own] = now.sum(1)
        now /= scales[own][:, None]
        values[own] = now
        at += count
    moves, after = np.zeros_like(c.move), None
    for count, end in zip(running[::-1], np.cumsum(running)[::-1]):
        own, back = slice(end - count, end), np.ones((count, emit.shape[1]))
        if after is not None:
            back[: len(after)] = after @ c.move.T
            moves += values[own][: len(after)].T @ after
        after = emit[token[own]] * back / scales[own][:, None]
        values[own] *= back
        values[own] /= values[own].sum(1)[:, None]
    return values, moves * c.move, values[: running[0]].sum(0)


def test_recursions_equal_the_plain_ones_and_take_less_time():
    c, rng = chain(6), np.random.default_rng(2)
    c.move = np.diag(np.full(6, 1 - 1e-5)) + 1e-5 / 6  # nearly closed states, as at the start
    c.move /= c.move.sum(1, keepdims=True)
    emit = rng.random((50_000, 6)) ** 20 * 1e-3 + 1e-12
    running = np.sort(rng.integers(1, 1_000, 900))[::-1]
    token = rng.integers(-1, len(emit) - 1, int(running.sum()))

    def least(run):
        times = []
        for _ in range(4):
            start = time.process_time()
            out = run(running, token, emit, c)
            times.append(time.process_time() - start)
        return min(times), out

    (quick, got), (plain, want) = least(hmm._expected), least(plain_expected)
    for mine, textbook in zip(got, want):
        assert np.allclose(mine, textbook, rtol=1e-7, atol=1e-10)
    assert quick < 0.75 * plain


def test_a_long_text_is_scored_in_pieces_and_its_posteriors_stay_whole(monkeypatch):
    c, rng = chain(), np.random.default_rng(3)
    emit, running = rng.random((50, 3)) + 1e-9, np.array([2] * 7 + [1] * 200_000)
    token = rng.integers(-1, 49, int(running.sum()))
    whole, values, _ = hmm._forward(running, token, emit, c, True)
    posterior, _, _ = hmm._expected(running, token, emit, c)
    assert values.shape == (3, len(token)) and np.allclose(posterior.sum(1), 1, rtol=1e-10)
    for size in (1, 5, 1_000):
        monkeypatch.setattr(hmm, "GROUP_TOKENS", size)
        log, _, _ = hmm._forward(running, token, emit, c, False)
        assert np.allclose(log, whole, rtol=1e-12)


@pytest.mark.parametrize("rows", [1, 3, 2000])
def test_block_numbers_stand_for_the_words_in_any_slices(make, monkeypatch, rows):
    monkeypatch.setattr(hmm, "SLICE_ROWS", rows)
    monkeypatch.setattr(hmm.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    texts = ["B a\tb", None, "", "c A  d", " ", "é a É", "a" * 40, "d"]
    frame = make(list(enumerate(texts))).selectExpr("doc_id", "text", "false AS held_out").orderBy("doc_id")
    (row,) = pa.Table.from_batches(hmm._blocks(frame.toArrow().to_batches())).to_pylist()
    assert row["words"] == ["b", "a", "c", "d", "é", "É", "a" * 40] and row["n_words"] == 7
    got = [row["words"][k] for k in hmm._unpacked(row["tokens"])]
    assert got == [t for text in texts for t in tokens(text)[:-1]]
    assert row["lengths"] == [len(tokens(text)) - 1 for text in texts]


def test_emissions_sum_to_one():
    c = chain()
    counts = np.array([[3.0, 0, 1], [0, 2, 2], [1, 1, 1], [0, 0, 1]])
    seen = np.array([4, 4, 3, 1])
    c.ends, c.docs = np.array([1.0, 1, 1]), 3
    c.totals, c.tokens, c.words = counts.sum(0) + c.ends, 15, 5
    whole = c.emissions(np.vstack([counts, np.zeros((1, 3))]), np.append(seen, 0))
    assert np.allclose(whole.sum(0), 1)  # known words, the unknown symbol and the end


def test_more_rounds_raise_the_training_likelihood(given):
    docs = given("documents")
    total = [sum(r.score for r in hmm.score(docs, rounds=n).collect() if not r.held_out) for n in (1, 3)]
    assert total[1] > total[0]


def test_rounds_go_on_until_the_training_likelihood_levels_off(given, monkeypatch):
    seen, updated = [], hmm._updated

    def noted(chain, learned, states):
        out = updated(chain, learned, states)
        seen.append(out[1] / chain.tokens)
        return out

    docs = given("documents")
    one = sum(r.score for r in hmm.score(docs, rounds=1).collect() if not r.held_out)
    monkeypatch.setattr(hmm, "_updated", noted)
    whole = sum(r.score for r in hmm.score(docs).collect() if not r.held_out)
    assert whole > one
    gains = np.diff(seen)
    assert len(gains) and (gains[:-1] >= hmm.TOLERANCE).all() and gains[-1] < hmm.TOLERANCE


def test_counts_travel_as_one_row_for_each_block_and_range(given, monkeypatch):
    rows, stored = {}, hmm.saved

    def noted(frame, label):
        out = stored(frame, label)
        rows[label] = out.row_count
        return out

    monkeypatch.setattr(hmm, "saved", noted)
    monkeypatch.setattr(hmm, "RANGE_WORDS", 5_000)
    docs = given("documents").repartition(4, "doc_id")
    many = {r.doc_id: r.score for r in hmm.score(docs, rounds=2).collect()}
    assert 4 * 2 < rows["expected"] <= 4 * 50
    monkeypatch.setattr(hmm, "RANGE_WORDS", 10**9)
    few = {r.doc_id: r.score for r in hmm.score(docs, rounds=2).collect()}
    assert rows["token-blocks"] == 4 and rows["expected"] == 4 * 2
    assert many == pytest.approx(few, rel=1e-9)


def test_a_rare_kind_of_text_can_be_a_starting_state(make):
    rng = np.random.default_rng(5)
    word = lambda letters: "".join(rng.choice(list(letters), 6))
    rows = [(i, " ".join(word("abcdefghijklmnopqr") for _ in range(12))) for i in range(6_000)]
    rows += [(10_000 + i, " ".join(word("漢字仮名交") for _ in range(12))) for i in range(6)]
    blocks = make(rows).selectExpr("doc_id", "text", "false AS held_out").mapInArrow(hmm._blocks, hmm._BLOCK)
    centres = hmm.starting_centres(hmm.saved(blocks, "test-blocks"), 3)
    rare = hmm._profile(rows[-1][1])
    assert ((centres - rare) ** 2).sum(1).min() < 0.1


def test_awkward_rows(awkward, nothing, make):
    check(awkward, hmm.score(awkward))
    assert hmm.score(nothing).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(make([(held, "only held out")]), hmm.score(make([(held, "only held out")])))
