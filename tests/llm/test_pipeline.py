"""Each stage against a plain version of the same rule, on what the stage before kept."""

from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from llm_samples import AWKWARD, SF_DIR
from lakeload.llm import common, mixing, pieces, quality, secrets
from lakeload.llm.queries import tokenizer
from test_near_sets import brute


@pytest.fixture(scope="module")
def kept(spark, given, tmp_path_factory):
    """The input and the result of each stage."""
    docs, out = given("documents"), [given("documents")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_in_order(kept):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_filter", "near_duplicates", "secret_scan", "source_mix", "piece_ids"]
    assert all(frame.columns == kept[0].columns for frame in kept[:5])


def test_quality(kept, given):
    scored = quality.classify(given("documents"), given("labels")).where("predicted = 1")
    assert Counter(r.doc_id for r in kept[1].collect()) == Counter(r.doc_id for r in scored.collect())


def test_near_duplicates(kept):
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    assert {r.doc_id for r in kept[2].collect()} == {c for _, _, c in brute(rows, 5, 80)}


def test_secrets(kept):
    before = {r.doc_id: r for r in kept[2].collect()}
    after = kept[3].collect()
    assert len(after) == len(before)
    for r in after:
        assert r.text == secrets.redact(before[r.doc_id].text) and r.n_chars == len(r.text)


def test_mix(kept):
    counts = mixing.mix(kept[3]).where("size > 0 AND taken > 0").collect()
    got = Counter(r.doc_id for r in kept[4].where(mixing.word_count("text") > 0).collect())
    assert got == Counter({r.doc_id: r.taken // r["size"] for r in counts})


def test_pieces(kept):
    model = tokenizer("piece_bpe_32k.model")
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    back = pieces.decoded(kept[5], model).collect()
    assert len(back) == sum(2 if t else 1 for t in (r.text for r in kept[4].collect()))
    assert all(r.decoded == texts[r.doc_id].replace("▁", " ") for r in back)


def test_awkward_documents_go_through_all_stages(spark, given, make, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(spark, docs, SF_DIR).cache()
            docs.count()
            assert docs.columns == before or stage is corpus_pipeline.piece_ids
    assert len(AWKWARD) == 10


def test_texts_go_to_python_in_small_batches(spark, given):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([b.nbytes], pa.int64())})

    wide = given("documents").selectExpr("repeat(text, 20) AS text").coalesce(1)
    before = spark.conf.get(common.BATCH_BYTES, None)
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "source_mix":  # it runs no Python
                continue
            spark.conf.unset(common.BATCH_BYTES)
            stage(spark, given("documents"), SF_DIR)
            largest = max(r.bytes for r in wide.mapInArrow(sizes, "bytes long").collect())
            assert largest < 2 * common.SLICE_BYTES, name
        spark.conf.set(common.BATCH_BYTES, "123456")
        common.small_batches(spark)
        assert spark.conf.get(common.BATCH_BYTES) == "123456"
    finally:
        spark.conf.unset(common.BATCH_BYTES) if before is None else spark.conf.set(common.BATCH_BYTES, before)
