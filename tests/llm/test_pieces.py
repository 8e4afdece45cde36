import math
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import SF_DIR

from lakeload.llm import pieces, queries
from lakeload.llm.queries import tokenizer

MODEL = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(MODEL)


def all_segmentations(text, v):
    """Every segmentation of a short text with its probability."""
    word = "▁" + text.replace(" ", "▁")
    names = {v.model.id_to_piece(int(i)): (int(i), float(w)) for i, w in zip(v.ids, v.weights)}
    out = []

    def go(at, ids, log):
        if at == len(word):
            out.append((tuple(ids), log))
        for n in range(1, min(v.longest, len(word) - at) + 1):
            part = word[at : at + n]
            if part in names:
                go(at + n, [*ids, names[part][0]], log + names[part][1])
            elif n == 1:
                raw = part.encode()
                go(at + 1, ids + [v.bytes_from + b for b in raw], log + v.byte_weight * len(raw))

    go(0, [], 0.0)
    total = math.log(sum(math.exp(log) for _, log in out))
    return {ids: log - total for ids, log in out}


@pytest.mark.parametrize("text", ["to be é☃", "a  b", "x\ny z", " ▁q"])
def test_samples_follow_the_lattice_without_replacement(text, vocabulary):
    chances = all_segmentations(text, vocabulary)
    n, k = 4000, 3
    drawn = pieces.sample([text] * n, list(range(n)), MODEL, k)
    first, second = Counter(), Counter()
    for own in drawn:
        ids = [tuple(s[0].tolist()) for s in own]
        assert len(set(ids)) == len(ids) == min(k, len(chances))
        assert all(abs(chances[i] - s[1]) < 1e-4 for i, s in zip(ids, own))
        first[ids[0]] += 1
        if len(ids) > 1:
            second[ids[1]] += 1
    for ids in sorted(chances, key=lambda i: -chances[i])[:4]:
        p = math.exp(chances[ids])
        assert abs(first[ids] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 1e-3
        q = sum(math.exp(o) * p / (1 - math.exp(o)) for i, o in chances.items() if i != ids)
        assert len(chances) == 1 or abs(second[ids] / n - q) < 4 * math.sqrt(q * (1 - q) / n) + 2e-3
    # Probability over inclusion is an unbiased weight: it sums to one.
    weight = np.mean([sum(math.exp(s[1] - s[2]) for s in own) for own in drawn])
    assert abs(weight - 1) < 0.05


def test_few_segmentations_are_all_given(vocabulary):
    for text in ("", "é", "\n", "a"):
        chances = all_segmentations(text, vocabulary) if text else {(): 0.0}
        own = pieces.sample([text], [1], MODEL, 50)[0]
        assert {tuple(s[0].tolist()) for s in own} == set(chances)
        assert all(s[2] == 0 for s in own)


def test_round_trip_and_repeatability(given, vocabulary):
    docs = given("documents")
    drawn = pieces.sampled(docs, MODEL, 2, ["doc_id", "text"])
    back = pieces.decoded(drawn, MODEL).collect()
    assert len(back) == 2 * docs.count() and all(r.decoded == r.text for r in back)
    key = lambda f: sorted((r.doc_id, r["sample"], tuple(r.ids)) for r in f.collect())
    again = pieces.sampled(docs.repartition(3), MODEL, 2, ["doc_id"])
    assert key(drawn) == key(again)
    assert all(r.log_prob <= 1e-6 and r.log_inclusion <= 1e-6 for r in back)


def test_the_query_returns_ids_and_decodes_every_sample(spark, given, vocabulary):
    texts = {r.doc_id: r.text for r in given("documents").collect()}
    got = queries.op1_sentencepiece(spark, SF_DIR).collect()
    assert {r.doc_id for r in got} == set(texts) and all(r.decodes for r in got)
    assert all(r.n_pieces == len(r.ids) and vocabulary.decode(r.ids) == (texts[r.doc_id] or "").replace("▁", " ") for r in got)


def test_a_sample_that_does_not_give_the_text_is_reported(vocabulary):
    texts = ["one two", "one two", None, "a ▁"]
    drawn = [s[:1] for s in pieces.sample(texts, [1, 2, 3, 4], MODEL, 1)]
    drawn[1] = [(drawn[1][0][0][:-1], *drawn[1][0][1:])]
    assert pieces._decodes(pa.array(texts), drawn, vocabulary).to_pylist() == [True, False, True, True]


def test_awkward_rows(awkward, nothing):
    kept = pieces.sampled(awkward, MODEL, 2, ["doc_id", "text", "key"])
    back = pieces.decoded(kept, MODEL).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)
    assert {r.doc_id for r in back} == {r.doc_id for r in awkward.collect()}
    assert pieces.sampled(nothing, MODEL, 2, ["doc_id"]).collect() == []


def test_the_librarys_own_segmentation(awkward, vocabulary):
    for r in pieces.encoded(awkward.select("doc_id", "text"), MODEL).collect():
        assert r.ids == vocabulary.model.encode(r.text or "")
        if r.text:
            assert vocabulary.decode(r.ids) == r.text.replace("▁", " ")


def test_a_long_word_without_blanks():
    own = pieces.sample(["z" * 5000 + "漢" * 3000], [3], MODEL, 2)[0]
    v = pieces.vocabulary(MODEL)
    assert len(own) == 2 and all(v.decode(s[0]) == "z" * 5000 + "漢" * 3000 for s in own)


def test_pieces_are_found_by_table_also_where_several_share_a_place(vocabulary):
    v = vocabulary
    places = v.place(v.hashes)
    assert len(np.unique(places)) < len(places)
    several = np.bincount(places.astype(np.int64))[places.astype(np.int64)] > 1
    for h in np.flatnonzero(several).tolist()[:200]:
        name = v.model.id_to_piece(int(v.ids[h]))
        chars = np.frombuffer(name.encode("utf-32-le"), np.uint32)
        found = pieces.Lattices(v)._found(chars, np.arange(len(chars), 0, -1, dtype=np.int32))
        at, ids, _ = found[len(name) - 1]
        assert ids[at == 0].tolist() == [int(v.ids[h])]


def test_samples_that_differ_from_their_text_are_seen(vocabulary):
    texts = pa.array(["ab cd", "", None, "a▁b", " x", "�"], pa.string())
    drawn = [pieces.sample([t.as_py()], [1], MODEL, 1)[0][0] for t in texts]
    whole = pieces._decodes(texts, np.arange(6), drawn, np.concatenate([d[0] for d in drawn]), vocabulary)
    assert whole.to_pylist() == [True] * 6
    cut = [(d[0][:-1], *d[1:]) for d in drawn]
    seen = pieces._decodes(texts, np.arange(6), cut, np.concatenate([d[0] for d in cut]), vocabulary)
    assert seen.to_pylist() == [vocabulary.decode(d[0].tolist()) == (t.as_py() or "").replace("▁", " ") for d, t in zip(cut, texts)]
    assert seen.to_pylist()[:1] == [False]


def _freed_at_each_read(texts, size):
    """Arrow bytes still held, above the start, whenever the sampler asks for another batch."""
    start, held = pa.total_allocated_bytes(), []

    def batches():
        for i in range(0, len(texts), size):
            held.append(pa.total_allocated_bytes() - start)
            yield pa.RecordBatch.from_arrays([pa.array(range(i, i + size)), pa.array(texts[i : i + size])], ["key", "text"])
        held.append(pa.total_allocated_bytes() - start)

    rows = deque((b.num_rows for b in pieces._sample_batches(MODEL, 2, 1, 0.3, [], True)(batches())), maxlen=1)
    assert rows
    return held


def test_a_task_keeps_no_batch_and_leaves_no_tables():
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 40_000))) for _ in range(4)]
    assert max(_freed_at_each_read(texts, 1)) < min(map(len, texts))
    assert not pieces._kept


def test_tables_of_words_stay_within_what_two_workers_can_hold():
    rng = np.random.default_rng(4)
    most = 0
    for _ in range(8):
        pieces.sample([" ".join(map(str, rng.integers(0, 10**9, 20_000)))], [1], MODEL, 1)
        (known,) = pieces._kept.values()
        most = max(most, len(known.first))
        arrays = [x for x in vars(known).values() if isinstance(x, np.ndarray)]
        assert sum(x.nbytes for x in arrays) <= 16 * len(known.to) + 4 * len(known.first)
    pieces._kept.clear()
    assert most < 800_000


def test_places_of_edges(vocabulary):
    lattices = pieces.Lattices(vocabulary)
    lattices.add(["to", "be"])
    lattices.add(["or", "not☃"])
    counts = np.diff(lattices.first)
    expected = np.repeat(np.arange(len(counts)), counts)
    assert lattices.owner(np.arange(len(lattices.to))).tolist() == expected.tolist()
