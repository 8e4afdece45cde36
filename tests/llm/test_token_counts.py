import pytest
from tokenizers import Tokenizer

from lakeload import scratch
from lakeload.llm import token_counts
from lakeload.llm.queries import tokenizer

PATH = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    known = Tokenizer.from_file(PATH)
    return lambda text: len(known.encode(text or "", add_special_tokens=False).ids)


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b  ", "\n a", "a \nb", "a\n b \t c", "don't they'll", "x<|endoftext|>y",
    "x <|endoftext|> y", " <|endoftext|>", "<|endoftext|", "é ß 漢字 🙂 ok", "a b   c", "1 2  33 4,5", "  a  ",
    "a\x1cb \x1c c", "word " * 50, "!!! ??? ...  #", "tab\t\tend ", "é á", "　 a 　b",
]


def test_counts_of_pieces_add_up(whole):
    assert token_counts.count(TEXTS, PATH) == [whole(t) for t in TEXTS]


def test_given_documents_and_a_second_run_that_encodes_nothing(spark, given, whole, monkeypatch):
    docs = given("documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    cache = scratch.new_dir(spark, "cache")
    first = token_counts.count_tokens(docs, cache, PATH).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in first} == {
        i: (len((t or "").encode()), whole(t)) for i, t in texts.items()
    }
    stored = spark.read.parquet(cache)
    assert stored.count() == len(set(texts.values()))

    def forbidden(path):
        def run(batches):
            for batch in batches:
                raise AssertionError("nothing should be encoded")
                yield batch

        return run

    monkeypatch.setattr(token_counts, "_encode", forbidden)
    second = token_counts.count_tokens(docs.repartition(3), cache, PATH).collect()
    assert sorted(first) == sorted(second)
    assert spark.read.parquet(cache).count() == stored.count()


def test_awkward_rows(spark, awkward, nothing, whole, monkeypatch):
    want = sorted((len((r.text or "").encode()), whole(r.text)) for r in awkward.collect())
    for limit in (500_000, 1):  # misses sent to the texts, or joined by a shuffle
        monkeypatch.setattr(token_counts.maybe_broadcast, "__defaults__", (limit,))
        counted = token_counts.count_tokens(awkward, scratch.new_dir(spark, "cache"), PATH)
        assert sorted((r.n_bytes, r.n_tokens) for r in counted.collect()) == want
    assert token_counts.count_tokens(nothing, scratch.new_dir(spark, "cache"), PATH).collect() == []


def test_versions_do_not_mix(spark, make):
    cache = scratch.new_dir(spark, "cache")
    docs = make([(1, "Hello World")])
    other = tokenizer("word_bpe_49k.json")
    a = token_counts.count_tokens(docs, cache, PATH).collect()[0].n_tokens
    b = token_counts.count_tokens(docs, cache, other).collect()[0].n_tokens
    assert spark.read.parquet(cache).count() == 2 and a == 2 and b >= 1


def test_equal_rows_are_encoded_once(spark, make, whole):
    rows = [(None, "a hot text")] * 3000 + [(7, "twice")] * 2 + [(8, "twice"), (None, None), (None, "")]
    cache = scratch.new_dir(spark, "cache")
    counted = token_counts.count_tokens(make(rows), cache, PATH).collect()
    assert spark.read.parquet(cache).count() == 3
    want = sorted((i or 0, len((t or "").encode()), whole(t)) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in counted) == want
