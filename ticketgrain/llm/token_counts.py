"""Token counts of documents through a cache of counts by content and tokenizer version.

The cache is a Parquet table (content_digest, tokenizer_digest, n_tokens).  Only contents it
does not hold are encoded, each once; their counts are appended to it.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ticketgrain.llm.common import id_and_text, map_texts, order_id, staged
from ticketgrain.llm.word_bpe import word_encoder

TOKEN_LIMIT = 2048
CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens long"
# Small, since the join that brings the texts needs an executor's memory at the same time.
MEMO_ENTRIES = 50_000
SLICE_BYTES = 1024 * 1024
_WHITE_SPACE = " \t\n\x0b\x0c\r"


def tokenizer_version(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    """The cache's rows, none if nothing was written there yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    limit: int = TOKEN_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit): one row for each row of ``docs``.

    Contents are compared without the white space around them, which the tokenizer drops.
    A null or empty text has 0 bytes and 0 tokens.  Rows may repeat, ids may be null.
    ``cache_path`` lies in a folder that all executors reach.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    keyed = id_and_text(docs, id_col, text_col).withColumn(
        "content_digest", F.sha2(F.trim(F.col("text"), F.lit(_WHITE_SPACE)), 256)
    )

    def stored() -> DataFrame:
        cache = read_cache(spark, cache_path).filter(F.col("tokenizer_digest") == version)
        # two runs may have appended the same content
        return cache.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))

    # One document stands for each missing content; (digest, id) spreads copies over all tasks.
    missing = (
        keyed.groupBy("content_digest")
        .agg(F.min(order_id()).alias("key"))
        .join(stored(), "content_digest", "left_anti")
    )
    texts = keyed.withColumn("key", order_id()).join(missing, ["content_digest", "key"], "left_semi")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoded = word_encoder(tokenizer_path, MEMO_ENTRIES).encode(batch.column("text").cast(pa.binary()).to_pylist())
        counts = pa.array([len(ids) // 4 for ids in encoded], pa.int64())
        return pa.record_batch([batch.column("content_digest"), counts], ["content_digest", "n_tokens"])

    (
        map_texts(
            texts.select("content_digest", "text"), encode, "content_digest string, n_tokens long", size=SLICE_BYTES
        )
        .groupBy("content_digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
        .select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens")
        .write.mode("append")
        .parquet(cache_path)
    )
    # a table of its own: the join may then split the rows of a content that many documents share
    counts = staged(stored(), "token-counts")
    return (
        keyed.select("doc_id", "content_digest", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(counts, "content_digest")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
