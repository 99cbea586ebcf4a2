"""BPE ids of whole texts by forced-boundary splitting, and the texts decoded from them; see `bpe`."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm import bpe
from waymeter.llm.shared import slices, text_slices


def _mapped(rows: DataFrame, key: str, value: str, added: list[tuple[str, str, pa.DataType]], work) -> DataFrame:
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType)])
    for name, kind, _ in added:
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches) if value == "text" else slices(batches):
            columns = zip(*work(batch.column(1).to_pylist())) if batch.num_rows else [[]] * len(added)
            arrays = [pa.array(c, kind) for c, (_, _, kind) in zip(columns, added)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema.names)

    return rows.select(key, value).mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array of int) of every text; null is the empty text and has no ids.

    A map over the rows. Repeated rows and null doc_ids stay, other columns are not read.
    """
    def work(texts):
        return ((np.frombuffer(data, "<u4").astype(np.int32),) for data in bpe.encode_each(vocabulary, texts))

    return _mapped(docs.withColumn("text", F.col("text").cast("string")), "doc_id", "text", [("ids", "array<int>", pa.list_(pa.int32()))], work)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text for rows of doc_id, ids; special tokens are kept, null ids give the empty text."""
    def work(rows):
        return ((bpe.decoder(vocabulary).decode(ids or []),) for ids in rows)

    return _mapped(encoded, "doc_id", "ids", [("text", "string", pa.string())], work)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what `encode` and then `decode` give, by their digests.

    Both run in one pass, so that neither ids nor decoded texts travel; rows as for `encode`.
    """
    def work(texts):
        back = bpe.decoder(vocabulary)
        for data in bpe.encode_each(vocabulary, texts):
            ids = np.frombuffer(data, "<u4").tolist()
            yield (
                len(ids),
                hashlib.sha256(back.decimal(ids).encode()).hexdigest(),
                hashlib.sha256(back.decode(ids).encode()).hexdigest(),
            )

    added = [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _mapped(docs.withColumn("text", F.col("text").cast("string")), "doc_id", "text", added, work)
