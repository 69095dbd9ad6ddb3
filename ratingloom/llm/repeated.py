"""Steps that both searches for repeated windows share.

A text is a sequence of units (bytes or words), a window so many consecutive ones. A run of
windows is told by its first window and its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.llm.common import id_and_text, raw_bytes, release
from ratingloom.llm.hashing import U64, Stretches, mix
from ratingloom.sources.durable import durable

KEY = ["doc_id", "row"]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text): ``row`` tells texts of one doc_id apart; equal rows share it.

    A null id is no key of a join and may be that of very many texts, so it becomes one of the least
    numbers, by 56 more bits of the text's hash; ids in that range are not told from null.
    """
    d = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    stand_in = F.lit(-(1 << 63)) + F.xxhash64("text").bitwiseAND(F.lit((1 << 56) - 1))
    return d.select(F.coalesce("doc_id", stand_in).alias("doc_id"), F.hash("text").alias("row"), "text")


def given_id() -> Column:
    """The doc_id of ``keyed`` as it was."""
    return F.when(F.col("doc_id") >= F.lit(-(1 << 63) + (1 << 56)), F.col("doc_id"))


def repeated_values(entries: DataFrame, column: str) -> DataFrame:
    """Values of a column that come more than once; counted before the shuffle.

    Written as a table, so that a join with it starts from two plain shuffles, of which
    adaptive execution can split the partition of a hot value.
    """
    found = durable(entries.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1").select(column))
    release(entries.sparkSession)
    return found


def runs_of(rows: DataFrame) -> DataFrame:
    """(doc_id, row, runs): runs (start, n) of each document in one array."""
    return rows.groupBy(*KEY).agg(F.collect_set(F.struct(F.col("start").cast("int").alias("start"), F.col("n").cast("int").alias("n"))).alias("runs"))


def with_runs(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """(doc_id, row, text, runs)"""
    return docs.join(marks, KEY, how).select(*KEY, "text", "runs")


def covered(n_units: int, window: int, runs: list[tuple[int, int]]) -> np.ndarray:
    """Which units lie in a window of one of the runs."""
    edge = np.zeros(n_units + 1, np.int64)
    for start, n in runs:
        edge[start] += 1
        edge[start + n - 1 + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def runs(column: pa.Array, i: int) -> list[tuple[int, int]]:
    """The runs of row ``i`` as pairs."""
    return [(r["start"], r["n"]) for r in column[i].as_py() or []]


def list_parts(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where the list of each row ends and the next begins, and the values of all lists, or each field of them; a null list is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten()
    size = np.diff(column.offsets.to_numpy()) * column.is_valid().to_numpy(zero_copy_only=False)
    parts = values.flatten() if pa.types.is_struct(values.type) else [values]
    return np.append(0, np.cumsum(size)), [p.to_numpy(zero_copy_only=False) for p in parts]


def both_hashes(one: Stretches, two: Stretches, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of stretches, their length included."""
    length = (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15)
    return mix(one.hash(start, end) ^ length).view(np.int64), mix(two.hash(start, end) + length).view(np.int64)


def by_text(batches: Iterator[pa.RecordBatch], text_at: int, make: Callable[[pa.RecordBatch, int, bytes], Iterator[tuple]], schema: pa.Schema, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows that ``make`` yields for each text, in batches of bounded size."""
    rows: list[tuple] = []
    for b in batches:
        for i, text in enumerate(raw_bytes(b.column(text_at))):
            rows.extend(make(b, i, text))
            if len(rows) >= most:
                yield _batch(rows, schema)
                rows = []
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
