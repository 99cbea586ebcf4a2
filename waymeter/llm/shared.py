"""What the operators share: tables in the shared folder, hold-out remainders, files that workers write."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.session import new_run_folder


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` as a Parquet table in the shared folder: lineage ends here, and lost executors cost nothing."""
    path = new_run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def scan_partitions(df: DataFrame) -> int:
    """How many tasks read `df`; it grows with the input, and so does what is derived from it."""
    return max(1, df.rdd.getNumPartitions())


def power_of_two(at_least: int) -> int:
    return 1 << max(0, int(at_least) - 1).bit_length()


_STATE: dict = {}


def worker_state(key, make):
    """What a worker keeps across its tasks, such as an opened model: that of one operator at a time. What the
    operator before it kept is given back to the system, as a worker serves many operators in its life."""
    if key not in _STATE:
        if _STATE:
            _STATE.clear()
            give_back()
        _STATE[key] = make()
    return _STATE[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """The batches in small pieces, so that no worker holds the texts of a whole batch as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_slices(batches: Iterable[pa.RecordBatch], column: int = 1, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `size` bytes in the text column, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call and need none
        ctypes.CDLL("libc.so.6").malloc_trim(0)


# Files that tasks write beside Spark's own tables. A name holds a fresh id, so a task that runs again
# never touches an earlier attempt's file; only files named by the rows of a finished job are read.


def store_array(folder: str, label: str, values: np.ndarray) -> str:
    """Writes an array as raw little-endian numbers and returns its file's URI."""
    target = f"{folder}/{label}-{uuid.uuid4().hex}.bin"
    files, path = fs.FileSystem.from_uri(target)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(path) as out:
        out.write(memoryview(np.ascontiguousarray(values)).cast("B") if values.size else b"")
    return target


def mapped_array(uri: str, kind: str) -> np.ndarray:
    """The array of `store_array`, memory-mapped on a mounted file system and read whole from any other store."""
    files, path = fs.FileSystem.from_uri(uri)
    if files.get_file_info(path).size == 0:
        return np.empty(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=kind)


class MappedArrays:
    """Arrays of `mapped_array` by file, of which the `limit` used last are open: a mapped file holds a descriptor and
    a place among the process's maps. One that was closed is opened again when it is asked for."""

    def __init__(self, limit: int = 160):
        self.limit = limit
        self.open: OrderedDict[str, np.ndarray] = OrderedDict()

    def get(self, uri: str, kind: str) -> np.ndarray:
        held = self.open.pop(uri, None)
        if held is None:
            while len(self.open) >= self.limit:
                self.open.popitem(last=False)  # unmapped with its last reference
            held = mapped_array(uri, kind)
        self.open[uri] = held
        return held


def worker_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, as a URI that workers can open."""
    path = new_run_folder(spark, label)
    return path if "://" in path else "file://" + path.removeprefix("file:")


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes under zstd: high zero bytes of small numbers vanish."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view("<u8")


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as the differences between neighbours."""
    return packed(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpacked_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=np.uint64)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sum of each one's counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    every, number = np.concatenate(keys), np.concatenate(counts).astype(np.uint64)
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if every.size else np.empty(0, np.int64)
    return every[first], np.add.reduceat(number, first) if first.size else number
