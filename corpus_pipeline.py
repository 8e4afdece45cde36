"""The corpus pipeline: from raw documents to sampled token ids, in stages.

Each stage reads what the one before kept, calls one operator, and returns rows that are
written as Parquet before the next stage reads them. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeload import scratch
from lakeload.llm import mixing, near_sets, pieces, quality, secrets
from lakeload.llm.common import given, ship, small_batches
from lakeload.llm.queries import SAMPLES, tokenizer


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labels of the held-out fold teach nothing.

    Null, empty and very long texts are scored by the statistics of the whole text, like any
    other. Rows without an id have no label but a score. Repeated rows stay or go together.
    An empty table stays empty, and further columns are kept.
    """
    small_batches(spark)
    return quality.accepted(docs, given(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, over five words and a similarity of 0.8.

    The least id of a group stays. Rows without an id, and null and empty texts, stay; of rows
    that share an id and are in a group, the least by text stays. Texts are compared whole,
    however long. An empty table stays empty, and further columns are kept.
    """
    ship(spark)
    small_batches(spark)
    return near_sets.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked; n_chars follows the text.

    No row goes. Null stays null, with a null n_chars; empty and very long texts are scanned whole,
    and repeated rows are masked alike. An empty table stays empty, and further columns are kept.
    """
    ship(spark)
    small_batches(spark)
    masked = secrets.redacted(docs)
    return masked.selectExpr(
        *[c if c != "n_chars" else "cast(length(text) as bigint) AS n_chars" for c in docs.columns]
    )


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows left out, taken once, or repeated.

    Rows without a source are a source of their own. Null and empty texts have no words; a row
    without words is taken as often as its hash asks for. Of rows equal in id and text as many go
    in as come nearest to the target. An empty table stays empty, and further columns are kept.
    """
    return mixing.mixed_rows(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of each row, as ids, with their inclusion scores.

    Seeds come from doc_id and source, so repeated rows get the same samples. Null and empty
    texts, and texts with fewer segmentations than samples, are as ``pieces.sampled`` states.
    Very long texts are segmented whole. An empty table stays empty.
    """
    ship(spark)
    small_batches(spark)
    return pieces.sampled(docs, tokenizer("piece_bpe_32k.model"), SAMPLES, ["doc_id", "source"])


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("piece_ids", piece_ids),
]

# The classifier, the set join and the sampler can't be written in SQL; tests compare each
# stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored in the shared scratch folder."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch.new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
