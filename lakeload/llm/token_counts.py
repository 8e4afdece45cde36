"""Token counts through a cache of digests.

Counts are stored under two digests: of the content, and of the tokenizer's version. A
count is looked up by joining on both. Only distinct contents without a stored count are
encoded, and their counts are appended to the cache for later runs.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_groups, kept_tables, maybe_broadcast, saved

CACHE = T.StructType(
    [
        T.StructField("content", T.BinaryType()),
        T.StructField("version", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)

# The pre-tokenizer always cuts before a blank that stands between two other characters
# than white space, so tokens of such pieces can be counted one by one.
PIECE = re.compile(r".[^ ]*(?:(?: (?!\S)|(?<=\s) )[^ ]*)*", re.DOTALL)

# Pieces whose counts a worker remembers; it starts anew beyond that.
REMEMBERED = 400_000


def version(tokenizer_path: str) -> str:
    """A digest of the vocabulary file, the library's version and how it is called."""
    import tokenizers

    digest = hashlib.sha256(f"{tokenizers.__version__}|no added tokens|".encode())
    with open(tokenizer_path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


_remembered: dict[str, dict[str, int]] = {}
kept_tables.append(_remembered.clear)


def count(texts: list[str], path: str) -> list[int]:
    """Tokens in each text, as the library's ``encode`` gives them for the whole text."""
    known = _remembered.setdefault(path, {})
    if len(known) > REMEMBERED:
        known.clear()
    pieces = [PIECE.findall(text) for text in texts]
    new = list({p for each in pieces for p in each if p not in known})
    for start in range(0, len(new), 20_000):
        part = new[start : start + 20_000]
        encoded = _tokenizer(path).encode_batch_fast(part, add_special_tokens=False)
        known.update(zip(part, map(len, encoded), strict=True))
    get = known.__getitem__
    return [sum(map(get, each)) for each in pieces]


def _encode(path: str):
    def run(batches):
        for batch in batches:
            totals: list[int] = []
            texts = batch["text"].tolist()
            for start in range(0, len(texts), 500):
                totals += count(texts[start : start + 500], path)
            yield pd.DataFrame({"content": batch["content"], "n_tokens": totals})

    return run


def _stored(spark: SparkSession, cache_path: str, wanted: str) -> DataFrame:
    """Counts of this version, one for each content even if two runs appended the same."""
    rows = spark.read.schema(CACHE).parquet(cache_path).where(F.col("version") == wanted)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row; appends what the cache lacks.

    Null texts count as empty: no bytes, no tokens. Rows with equal texts, however many,
    are encoded once. Whole texts are encoded, however long. Null and repeated ids are
    fine. Other columns are ignored. The vocabulary file must be at the same path on
    every machine; ``cache_path`` must be a folder that all of them share.
    """
    spark = docs.sparkSession
    wanted = version(tokenizer_path)
    spark.createDataFrame([], CACHE).coalesce(1).write.mode("append").parquet(cache_path)
    content = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", content.alias("text")).withColumn(
        "content", F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    )
    rows = saved(keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "digests")
    # One row stands for each content: the one of the least id, and where rows of one content
    # are equal in the id too, any of them.
    pairs = rows.groupBy("content", "doc_id").agg(F.count(F.lit(1)).alias("equal"))
    contents = pairs.groupBy("content").agg(
        F.min("doc_id").alias("first_id"), (F.max("equal") > 1).alias("several"), F.sum("equal").alias("copies")
    )
    contents = saved(contents, "contents")
    misses = saved(contents.join(_stored(spark, cache_path, wanted), "content", "left_anti"), "misses")
    # Few misses are sent to the texts; many make the texts shuffle once.
    wanting = maybe_broadcast(misses.select(F.col("content").alias("missing"), "first_id", "several"))
    texts = keyed.join(
        wanting, (F.col("content") == F.col("missing")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    ).select("content", "text", "several")
    alike = texts.where("several").groupBy("content").agg(F.any_value("text").alias("text"))
    texts = texts.where("NOT several").select("content", "text").unionByName(alike)
    encoded = texts.mapInPandas(_encode(tokenizer_path), "content binary, n_tokens long")
    encoded.select("content", F.lit(wanted).alias("version"), "n_tokens").write.mode("append").parquet(cache_path)
    known = saved(contents.select("content", "copies").join(_stored(spark, cache_path, wanted), "content"), "counts")
    found = join_groups(rows, known, "content", "copies", rows.row_count)
    return found.select("doc_id", "n_bytes", "n_tokens")
