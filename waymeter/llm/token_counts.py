"""Token counts through a cache keyed by digests of content and tokenizer version.

The cache is a Parquet table (content_digest, tokenizer_digest, n_tokens) that only grows. A run joins the
digests of its texts with it, encodes one text of each missing digest and appends those counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.llm import bpe
from waymeter.llm.shared import text_slices

CACHE = "content_digest string, tokenizer_digest string, n_tokens long"


def tokenizer_digest(vocabulary: str) -> str:
    """SHA-256 of the vocabulary file: another version of a tokenizer never meets this one's counts."""
    with open(vocabulary, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def normalised(text: Column) -> Column:
    """Content that decides the count. The library changes nothing before splitting, so only null becomes empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException:  # no run has written yet
        return spark.createDataFrame([], CACHE)


def fill_cache(docs: DataFrame, vocabulary: str, cache: str) -> None:
    """Appends the counts of the distinct texts that the cache lacks.

    A text moves once, to the task of its digest. Copies are dropped before they move, so that a text with any
    number of copies costs one. Two runs at once may append the same count twice; readers take one of them.
    """
    version = tokenizer_digest(vocabulary)
    known = read_cache(docs.sparkSession, cache).where(F.col("tokenizer_digest") == version).select("content_digest")
    texts = docs.select(normalised(F.col("text")).alias("text"))
    # dropDuplicates keeps one row of a digest per task before the exchange and one after it.
    misses = texts.select(F.sha2("text", 256).alias("content_digest"), "text").dropDuplicates(["content_digest"])
    misses = misses.join(known, "content_digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            counts = bpe.counts(vocabulary, batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["content_digest", "tokenizer_digest", "n_tokens"])

    misses.mapInArrow(encode, CACHE).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, vocabulary: str, cache: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8), n_tokens, over_limit, for every row.

    A null text is the empty text, of 0 bytes and 0 tokens. Repeated rows and null doc_ids stay, other columns
    are not read, an empty table gives no rows. A digest with many rows is a skewed join that AQE splits.
    """
    fill_cache(docs, vocabulary, cache)
    stored = read_cache(docs.sparkSession, cache).where(F.col("tokenizer_digest") == tokenizer_digest(vocabulary))
    stored = stored.groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens"))
    rows = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("content_digest"))
    return rows.join(stored, "content_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
