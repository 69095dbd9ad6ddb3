"""What the text operators share: reading a table, Arrow columns as Python values."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only what the operators read; further columns, whatever their names, end here."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def row_key() -> Column:
    """Tells rows apart that share a doc_id but not their text; equal rows share it."""
    return F.xxhash64("doc_id", "text")


def raw_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each value of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else []
    view = memoryview(data) if data is not None else memoryview(b"")
    null = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield b"" if null[i] else bytes(view[starts[i] : starts[i + 1]])


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array for each row."""
    ends = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=ends[1:])
    flat = np.concatenate(values) if values else np.empty(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Rows with equal first ``n_keys`` columns, as they come in sorted order, across batches."""
    kept: list[pa.RecordBatch] = []
    last: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        change = np.zeros(b.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for a, e in zip(starts, starts[1:], strict=False):
            key = tuple(k[a] for k in keys)
            if kept and key != last:
                yield pa.Table.from_batches(kept)
                kept = []
            last = key
            kept.append(b.slice(a, e - a))
    if kept:
        yield pa.Table.from_batches(kept)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which the worker gives its free memory back.

    Workers are kept for later stages; what their allocators hold on to would count against the executor all the while.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It deletes them when the driver's collector drops what refers to them, which can take
    half an hour, so large steps that follow each other would hold all their files at once.
    """
    spark.sparkContext._jvm.System.gc()


class Remembered(dict):
    """What ``compute`` makes of a string or of bytes, remembered within a bound of bytes.

    There are two generations: when the young one is full it becomes the old one, and what is met again moves
    back. So frequent keys stay and rare ones go, at the cost of one look-up.
    """

    ENTRY = 200  # bytes that an entry takes besides its key and value

    def __init__(self, compute: Callable, most: int, longest: int):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest
        self.old: dict = {}
        self.held = 0

    def put(self, key: str | bytes, value: bytes) -> None:
        if len(key) <= self.longest:
            self.held += self.ENTRY + len(key) + len(value)
            if self.held > self.most // 2:
                self.old = dict(self)
                self.clear()
                self.held = self.ENTRY + len(key) + len(value)
            self[key] = value

    def put_all(self, keys: list, values: list) -> None:
        """As ``put``, for many at once."""
        if self.held > self.most // 2:
            self.old = dict(self)
            self.clear()
            self.held = 0
        before = len(self)
        self.update(zip(keys, values, strict=True))
        for key in [k for k in keys if len(k) > self.longest]:
            del self[key]
        if keys:
            each = (sum(map(len, keys)) + sum(map(len, values))) // len(keys)
            self.held += (self.ENTRY + each) * (len(self) - before)

    def __missing__(self, key: str | bytes) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value
