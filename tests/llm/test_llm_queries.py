"""The registered queries on the given tables, and SQL where there is some."""

import __spark_entry__ as driver
import oracle
import pytest
from llm_samples import SF_DIR
from lakeload.llm import queries

COLUMNS = {
    "op2_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_top_products": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_near_vectors": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op8_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op9_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op11_bisector_clusters": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
    "op12_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op13_warc_captures": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    frame = queries.queries()[name](spark, SF_DIR)
    assert dict(frame.dtypes) == COLUMNS[name] and frame.count() > 0


def test_all_are_registered():
    assert {*queries.queries(), "pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql(spark, name):
    con = oracle.connect(SF_DIR)
    assert oracle.mismatch(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None
