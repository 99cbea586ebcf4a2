"""Packing by power-of-two decomposition.

A document of n tokens becomes n // width pieces of `width` tokens and, for the rest, one piece per binary
digit, longest first. Every piece is a sequence of its own and its length is a power of two, so no sequence
crosses documents and none is padded; trainers take batches from one bucket of equal lengths at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm import bpe
from waymeter.llm.shared import text_slices

WIDTH = 4096
END_ID = 2


def piece_lengths(tokens: int, width: int = WIDTH) -> list[int]:
    """`width`, itself a power of two, as often as it fits, then the binary digits of the rest in falling order."""
    rest = tokens % width
    return [width] * (tokens // width) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def id_kind(vocabulary: str) -> str:
    """Numbers in which narrow pieces hold ids: of 16 bits where the vocabulary has no more ids, else of 32."""
    return "<u2" if bpe.size(vocabulary) <= 1 << 16 else "<u4"


def ids_of(blob: bytes, vocabulary: str) -> np.ndarray:
    """The ids that a narrow piece holds."""
    return np.frombuffer(blob, id_kind(vocabulary)).astype(np.int64)


def pieces(docs: DataFrame, vocabulary: str, end_id: int = END_ID, width: int = WIDTH, with_ids: bool = True,
           narrow: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit, if `with_ids`; in the numbers of
    `id_kind` if `narrow`), ids_crc32 (of 32-bit ids), doc_tokens, sequence_id, offset, bucket (the length's binary
    logarithm).

    A map over the rows, without a shuffle. A null or empty text is its end id alone; a repeated row is packed
    again under its own sequences; a null doc_id stays null; other columns are not read; an empty table gives
    no rows. sequence_id is unique, not dense.
    """
    if width & (width - 1):
        raise ValueError("width must be a power of two")
    end, kind = np.array([end_id], "<u4").tobytes(), id_kind(vocabulary) if narrow else "<u4"
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)]).add("start", "long").add("length", "long")
    schema = (schema.add("ids", "binary") if with_ids else schema).add("ids_crc32", "long").add("doc_tokens", "long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            made: list[list] = [[] for _ in range(6)]
            for row, data in enumerate(bpe.encode_each(vocabulary, batch.column(1).to_pylist())):
                data += end
                start = 0
                for length in piece_lengths(len(data) // 4, width):
                    ids = data[4 * start:4 * (start + length)]
                    kept = np.frombuffer(ids, "<u4").astype(kind).tobytes() if with_ids else None
                    for column, value in zip(made, (row, start, length, kept, zlib.crc32(ids), len(data) // 4)):
                        column.append(value)
                    start += length
            rows = batch.column(0).take(pa.array(made[0], pa.int32()))
            columns = [rows, *(pa.array(m, pa.binary() if k == 2 else pa.int64()) for k, m in enumerate(made[1:]) if with_ids or k != 2)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)
    return found.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def bucketed(packed: DataFrame, folder: str) -> DataFrame:
    """The pieces written by `write_buckets`, read back; no file holds pieces of two lengths."""
    write_buckets(packed, folder)
    return packed.sparkSession.read.schema(packed.schema).parquet(folder).select(packed.columns)


def write_buckets(packed: DataFrame, folder: str) -> None:
    """A folder per length; AQE cuts a large bucket over many tasks and merges small ones."""
    packed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
