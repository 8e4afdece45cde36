"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload import scratch

from . import (
    bisectors,
    collocations,
    hidden_markov,
    mixing,
    near_sets,
    near_vectors,
    pieces,
    quality,
    secrets,
    sharding,
    token_counts,
    top_products,
    warc,
)
from .common import given

SAMPLES = 2  # segmentations of each text


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer("piece_bpe_32k.model")
    drawn = pieces.sampled(given(spark, sf_dir, "documents"), model, SAMPLES, ["doc_id"], check=True)
    return drawn.select(
        "doc_id", "sample",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_prob", "log_inclusion", "ids", "decodes",
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(given(spark, sf_dir, "documents"))


def op3_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "embeddings")
    return top_products.search(rows, rows.where("vec_id % 100 = 0"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link(given(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(given(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(given(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(given(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = scratch.new_dir(spark, "token-cache")
    counted = token_counts.count_tokens(
        given(spark, sf_dir, "documents"), cache, tokenizer("byte_bpe_50k.json")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_near_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets.near_classes(given(spark, sf_dir, "documents"))


def op11_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster(given(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(given(spark, sf_dir, "documents"))


def op13_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_dir(spark, "warc")
    warc.write_archives(given(spark, sf_dir, "pages"), path)
    return warc.page_captures(warc.captures(warc.read_records(spark, path), payloads=False))


def queries() -> dict:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_mixing": op2_mixing,
        "op3_top_products": op3_top_products,
        "op4_near_vectors": op4_near_vectors,
        "op5_quality": op5_quality,
        "op6_hidden_markov": op6_hidden_markov,
        "op7_sharding": op7_sharding,
        "op8_secrets": op8_secrets,
        "op9_token_counts": op9_token_counts,
        "op10_near_sets": op10_near_sets,
        "op11_bisector_clusters": op11_bisector_clusters,
        "op12_collocations": op12_collocations,
        "op13_warc_captures": op13_warc_captures,
    }


def oracle_sql() -> dict[str, str]:
    from .sql import ORACLES

    return dict(ORACLES)
