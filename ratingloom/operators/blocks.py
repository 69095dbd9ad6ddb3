"""Products of sparse tables, block by block.

Similarities and scores are matrix products: ``sum over k of left(k, x) * right(k, y)``.
Written as a join on ``k`` and a group-by on ``(x, y)`` such a product emits every
pair of a key; one key with a third of the rows then makes the job quadratic in
rows. Here the ids of either side are hashed into blocks of bounded size, the
entries of one key and one block travel as one packed row, and a task multiplies
one left block by one right block in memory. A task hands on only what the
operator asked for (the best n, a summary, the non-zero cells), so pairs never
become rows of a shuffle.

Packs travel to the block pairs by a shuffle as long as both sides have few blocks
(``FEW``), so an entry is copied a few times only. Beyond that every side is written once,
a row for each group of blocks (``operators/strips.py``), and tasks read the rows they pair; nothing is copied.

A task reads its rows batch by batch into one dense block, so its memory does not
grow with the entries. If a block pair has very many entries (a hot id, very many
keys), its keys are split over several tasks, each of which emits the cells it
touched; these partial cells are added before the reduction. The result is the
same.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BLOCK = 1024  # ids per block: a dense block product is 8 MB
FEW = 4  # blocks of a side up to which packs are shuffled to the block pairs
HOT = 4_000_000  # entries of one id from which on its keys are always split
SHARE = 16  # left blocks of a key that one task of the join pairs
TASK_ENTRIES = 50_000_000  # packed entries one task should read
DENSE_SHARE = 400  # a key that fills more than 1/400 of the cells joins a dense product
DENSE_KEYS = 512  # keys of one dense product
PAIRS_AT_ONCE = 2_000_000  # products of entries expanded at a time

# kinds of rows a block task receives
LEFT, RIGHT, PRODUCT, PARTIAL, CELL = range(5)

_GROUP = "a int, b int, kind int, lids array<bigint>, lvals array<double>, rids array<bigint>, rvals array<double>"
_NO_IDS = "cast(array() as array<bigint>)"
_NO_VALS = "cast(array() as array<double>)"


@dataclass(frozen=True)
class Side:
    """One factor: entries ``(k, id, value)`` and its members ``(id, aux)``.

    ``aux`` is an ``array<double>`` handed to the reduction with the id (a norm,
    a vector). Members without entries still take part, with product 0.
    """

    entries: DataFrame | None
    members: DataFrame


@dataclass(frozen=True)
class Size:
    ids: int
    entries: int
    hottest: int


def measure(*sides: Side) -> list[Size]:
    """Number of ids, entries, and entries of the hottest id of each side, in one job."""
    parts = []
    for no, s in enumerate(sides):
        parts.append(s.members.select(F.lit(no).alias("side"), F.lit(1).alias("m"), F.lit(0).cast("bigint").alias("c")))
        if s.entries is not None:
            per_id = s.entries.groupBy("id").agg(F.count("*").alias("c"))
            parts.append(per_id.select(F.lit(no).alias("side"), F.lit(0).alias("m"), "c"))
    totals = reduce(DataFrame.unionByName, parts).groupBy("side").agg(
        F.sum("m").alias("m"), F.sum("c").alias("s"), F.max("c").alias("h")
    )
    sizes = {r["side"]: Size(r["m"], r["s"], r["h"]) for r in totals.collect()}
    return [sizes.get(no, Size(0, 0, 0)) for no in range(len(sides))]


def block_count(ids: int, parallelism: int) -> int:
    by_size = math.ceil(ids / BLOCK)
    by_cores = min(math.ceil(math.sqrt(parallelism)), math.ceil(ids / 64))
    return max(1, by_size, by_cores)


def _block(col: str, n: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int")


def _pack(entries: DataFrame, n: int, side: str) -> DataFrame:
    """One row per key and block; at most one entry per id of the block."""
    packed = entries.groupBy("k", _block("id", n).alias(side)).agg(
        F.collect_list(F.struct(F.col("id").cast("bigint").alias("i"), F.col("value").cast("double").alias("v"))).alias("e")
    )
    p = "l" if side == "a" else "r"
    return packed.select("k", side, F.col("e.i").alias(p + "ids"), F.col("e.v").alias(p + "vals"))


def _members(members: DataFrame, n: int, other_n: int, side: str) -> DataFrame:
    """The members of a block, once for every block of the other side."""
    packed = members.groupBy(_block("id", n).alias("own")).agg(
        F.collect_list(F.struct(F.col("id").cast("bigint").alias("i"), F.col("aux").alias("v"))).alias("e")
    )
    spread = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))
    ids, vals = F.col("e.i"), F.flatten("e.v")
    if side == "a":
        return spread.select(
            F.col("own").alias("a"), F.col("other").alias("b"), F.lit(LEFT).alias("kind"),
            ids.alias("lids"), vals.alias("lvals"), F.expr(_NO_IDS).alias("rids"), F.expr(_NO_VALS).alias("rvals"),
        )
    return spread.select(
        F.col("other").alias("a"), F.col("own").alias("b"), F.lit(RIGHT).alias("kind"),
        F.expr(_NO_IDS).alias("lids"), F.expr(_NO_VALS).alias("lvals"), ids.alias("rids"), vals.alias("rvals"),
    )


def _cells(cells: DataFrame, na: int, nb: int) -> DataFrame:
    """Per-cell rows ``(left_id, right_id, value)``, packed by left id and block."""
    packed = cells.groupBy(
        _block("left_id", na).alias("a"), _block("right_id", nb).alias("b"), F.col("left_id").cast("bigint").alias("l")
    ).agg(F.collect_list(F.struct(F.col("right_id").cast("bigint").alias("i"), F.col("value").cast("double").alias("v"))).alias("e"))
    return packed.select(
        "a", "b", F.lit(CELL).alias("kind"), F.array("l").alias("lids"), F.expr(_NO_VALS).alias("lvals"),
        F.col("e.i").alias("rids"), F.col("e.v").alias("rvals"),
    )


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column as one flat array and the length of each list."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return whole.flatten().to_numpy(zero_copy_only=False), whole.value_lengths().to_numpy(zero_copy_only=False)


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, … within each list."""
    starts = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) - np.repeat(starts, lengths)


def _accumulate(out: np.ndarray, rows: pa.Table, left: np.ndarray, right: np.ndarray) -> None:
    """Add the products and partial cells of some rows to the sums of a block pair."""
    partial = rows.filter(pc.equal(rows["kind"], PARTIAL))
    if partial.num_rows:
        r = np.searchsorted(left, _lists(partial["lids"])[0])
        c = np.searchsorted(right, _lists(partial["rids"])[0])
        out += np.bincount(r * len(right) + c, _lists(partial["lvals"])[0], out.size).reshape(out.shape)
    products = rows.filter(pc.equal(rows["kind"], PRODUCT))
    if not products.num_rows or not out.size:
        return
    ids, ln = _lists(products["lids"])
    l_at, l_val = np.searchsorted(left, ids), _lists(products["lvals"])[0]
    ids, rn = _lists(products["rids"])
    r_at, r_val = np.searchsorted(right, ids), _lists(products["rvals"])[0]
    l_start, r_start = np.cumsum(ln) - ln, np.cumsum(rn) - rn
    pairs = ln.astype(np.int64) * rn
    # a key with many cells is cheaper as part of a dense product
    dense = pairs > out.size // DENSE_SHARE
    for keys in np.array_split(np.flatnonzero(dense), max(1, -(-int(dense.sum()) // DENSE_KEYS))):
        if len(keys):
            slabs = []
            for at, val, start, n, width in ((l_at, l_val, l_start, ln, len(left)), (r_at, r_val, r_start, rn, len(right))):
                slab = np.zeros((len(keys), width))
                flat = np.repeat(start[keys], n[keys]) + _within(n[keys])
                slab[np.repeat(np.arange(len(keys)), n[keys]), at[flat]] = val[flat]
                slabs.append(slab)
            out += slabs[0].T @ slabs[1]
    sparse = np.flatnonzero(~dense)
    if len(sparse):
        bounds = np.cumsum(pairs[sparse]) // PAIRS_AT_ONCE
        for keys in np.split(sparse, np.flatnonzero(np.diff(bounds)) + 1):
            # every left entry of a key, once for every right entry of the key
            l_flat = np.repeat(l_start[keys], ln[keys]) + _within(ln[keys])
            per_entry = np.repeat(rn[keys], ln[keys])
            first = np.repeat(np.repeat(r_start[keys], ln[keys]), per_entry)
            r_flat = first + _within(per_entry)
            l_flat = np.repeat(l_flat, per_entry)
            cell = l_at[l_flat] * len(right) + r_at[r_flat]
            out += np.bincount(cell, l_val[l_flat] * r_val[r_flat], out.size).reshape(out.shape)


def _sorted_members(ids: pa.ChunkedArray, vals: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    i, v = _lists(ids)[0], _lists(vals)[0]
    if not len(i):
        return np.empty(0, dtype=np.int64), np.empty((0, 1))
    order = np.argsort(i)
    return i[order], v.reshape(len(i), -1)[order]


class _Gathered:
    """What one group adds up to, batch by batch.

    The rows of a group are sorted by kind: members first, so that the ids of
    both sides are known before the first product. Memory is one dense block and
    one batch, however many rows the group has.
    """

    def __init__(self, vectors: bool, marked: bool):
        self.vectors, self.marked = vectors, marked
        self.members: dict[int, list[pa.Table]] = {LEFT: [], RIGHT: []}
        self.sums: np.ndarray | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        rows = pa.Table.from_batches([batch])
        for kind, found in self.members.items():
            part = rows.filter(pc.equal(rows["kind"], kind))
            if part.num_rows:
                if self.sums is not None:
                    raise RuntimeError("members of a block after its products")
                found.append(part)
        rest = rows.filter(pc.greater(rows["kind"], RIGHT))
        if rest.num_rows:
            self.start()
            if not self.vectors:
                _accumulate(self.sums, rest, self.left, self.right)
            self.mark(rest.filter(pc.equal(rest["kind"], CELL)))

    def start(self) -> None:
        if self.sums is not None:
            return
        own, other = (self._table(kind) for kind in (LEFT, RIGHT))
        self.left, self.left_aux = _sorted_members(own["lids"], own["lvals"])
        self.right, self.right_aux = _sorted_members(other["rids"], other["rvals"])
        shape = (len(self.left), len(self.right))
        self.sums = self.left_aux @ self.right_aux.T if self.vectors and all(shape) else np.zeros(shape)
        self.seen = np.zeros(shape, dtype=bool)
        self.values = np.zeros(shape if self.marked else (1, 1))

    def _table(self, kind: int) -> pa.Table:
        return pa.concat_tables(self.members[kind]) if self.members[kind] else _NOTHING

    def mark(self, cells: pa.Table) -> None:
        if not cells.num_rows or not self.sums.size:
            return
        r_flat, n = _lists(cells["rids"])
        l_flat, v_flat = np.repeat(_lists(cells["lids"])[0], n), _lists(cells["rvals"])[0]
        r = np.minimum(np.searchsorted(self.left, l_flat), len(self.left) - 1)
        c = np.minimum(np.searchsorted(self.right, r_flat), len(self.right) - 1)
        known = (self.left[r] == l_flat) & (self.right[c] == r_flat)
        self.seen[r[known], c[known]] = True
        self.values[r[known], c[known]] = v_flat[known]

    def block(self) -> Block:
        return Block(self.sums, self.left, self.left_aux, self.right, self.right_aux, self.seen, self.values)


_LIST_I, _LIST_V = pa.list_(pa.int64()), pa.list_(pa.float64())
_NOTHING = pa.table({"lids": pa.array([], _LIST_I), "lvals": pa.array([], _LIST_V), "rids": pa.array([], _LIST_I), "rvals": pa.array([], _LIST_V)})


def _partial(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The non-zero cells of one share of the keys of a block pair."""
    g = _Gathered(False, False)
    for batch in batches:
        g.add(batch)
    if g.sums is not None:
        r, c = np.nonzero(g.sums)
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array([key[0].as_py()], pa.int32()), "b": pa.array([key[1].as_py()], pa.int32()),
             "kind": pa.array([PARTIAL], pa.int32()), "lids": pa.array([g.left[r]], _LIST_I), "lvals": pa.array([g.sums[r, c]], _LIST_V),
             "rids": pa.array([g.right[c]], _LIST_I), "rvals": pa.array([[]], _LIST_V)}
        )


def pack_pairs(packs_l: DataFrame, packs_r: DataFrame, na: int, symmetric: bool) -> DataFrame:
    """Packs of the two sides that have a key in common.

    The pairs of a key are as many as its packs squared, whatever its bytes, so the
    left packs are dealt into shares of ``SHARE`` blocks and every share gets its
    own copy of the right packs: a task does ``SHARE`` times the right blocks at most.
    """
    shares = math.ceil(na / SHARE)
    last = F.floor(F.col("b") / SHARE).cast("int") if symmetric else F.lit(shares - 1)
    left = packs_l.withColumn("share", F.floor(F.col("a") / SHARE).cast("int"))
    right = packs_r.withColumn("share", F.explode(F.sequence(F.lit(0), last)))
    pairs = left.join(right, ["k", "share"])
    return pairs.filter(F.col("a") <= F.col("b")) if symmetric else pairs


@dataclass
class Block:
    """What a reduction sees: sums, ids, aux values, cells marked by the caller."""

    sums: np.ndarray
    left: np.ndarray
    left_aux: np.ndarray
    right: np.ndarray
    right_aux: np.ndarray
    seen: np.ndarray  # True where the caller listed the cell
    values: np.ndarray  # the value it gave there, else 0
    bar: np.ndarray | None = None  # score below which a cell of the row is not among the best any more

    def flipped(self) -> Block:
        return Block(self.sums.T, self.right, self.right_aux, self.left, self.left_aux, self.seen.T, self.values.T)


def block_product(
    left: Side,
    right: Side,
    finish: Callable[[Block], pd.DataFrame],
    schema: str,
    cells: DataFrame | None = None,
    symmetric: bool = False,
    splits: int | None = None,
    vectors: bool = False,
    keep: int | None = None,
    merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    reach: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Multiply two sides block by block and ``finish`` every block product.

    What ``finish`` returns may be drawn together while a task goes through many blocks: with ``keep`` it is
    (left id, right id, score) and only the best ``keep`` of a left id count, ``merge`` adds rows up. ``reach``, with
    ``keep``, gives from the left aux values and a score for each row the least product that can reach that score: right
    ids whose length is too small for it are left out.

    ``cells`` marks ``(left_id, right_id, value)`` for the reduction. With
    ``symmetric`` both sides are the same table: a block pair is multiplied once
    and reduced in both directions. With ``vectors`` the product is that of the
    aux vectors of the members, and there are no entries.
    """
    spark = left.members.sparkSession
    cores = spark.sparkContext.defaultParallelism
    sizes = measure(left) * 2 if symmetric else measure(left, right)
    size_l, size_r = sizes
    na, nb = block_count(size_l.ids, cores), block_count(size_r.ids, cores)
    many = max(size_l.ids, size_r.ids) > FEW * BLOCK and max(size_l.hottest, size_r.hottest) <= HOT
    if splits is None and many:
        from ratingloom.operators.strips import strip_product

        return strip_product(left, right, sizes, finish, schema, cells, symmetric, vectors, keep, merge, reach)
    if splits is None:
        load = size_l.entries / na + size_l.hottest + size_r.entries / nb + size_r.hottest
        splits = max(1, math.ceil(load / TASK_ENTRIES))
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(na * nb, max(shuffle, 4 * cores))

    groups = _members(left.members, na, nb, "a").unionByName(_members(right.members, nb, na, "b"))
    if symmetric:
        groups = groups.filter(F.col("a") <= F.col("b"))
    if not vectors:
        packs_l = _pack(left.entries, na, "a")
        packs_r = _pack(right.entries, nb, "b")
        products = pack_pairs(packs_l, packs_r, na, symmetric)
        if splits > 1:
            salt = F.pmod(F.xxhash64("k"), F.lit(splits)).cast("int").alias("s")
            salted = products.select("a", "b", salt, F.lit(PRODUCT).alias("kind"), "lids", "lvals", "rids", "rvals")
            everywhere = groups.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))).select(salted.columns)
            products = (
                everywhere.unionByName(salted)
                .repartition(tasks * min(splits, 64), "a", "b", "s")
                .sortWithinPartitions("a", "b", "s", "kind")
                .groupBy("a", "b", "s")
                .applyInArrow(_partial, _GROUP)
            )
        else:
            products = products.select("a", "b", F.lit(PRODUCT).alias("kind"), "lids", "lvals", "rids", "rvals")
        groups = groups.unionByName(products)
    if cells is not None:
        groups = groups.unionByName(_cells(cells, na, nb))

    marked = cells is not None
    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _Gathered(vectors, marked)
        for batch in batches:
            g.add(batch)
        g.start()
        block = g.block()
        yield pa.RecordBatch.from_pandas(finish(block), out_schema, preserve_index=False)
        if symmetric and key[0] != key[1]:
            yield pa.RecordBatch.from_pandas(finish(block.flipped()), out_schema, preserve_index=False)

    return (
        groups.repartition(tasks, "a", "b")
        .sortWithinPartitions("a", "b", "kind")
        .groupBy("a", "b")
        .applyInArrow(run, schema)
    )


def best(score: np.ndarray, allowed: np.ndarray, block: Block, n: int, names: tuple[str, str, str]) -> pd.DataFrame:
    """The n best allowed cells of each row; ties go to the smaller right id."""
    if block.bar is not None:  # few cells still matter
        rows, cols = np.nonzero(allowed & (score > block.bar[:, None] - 1e-6))
        found = np.floor(score[rows, cols] * 1e6 + 0.5) / 1e6
        high = (found >= block.bar[rows]) & np.isfinite(found)
        rows, cols, found = rows[high], cols[high], found[high]
    else:
        score = np.where(allowed, np.floor(score * 1e6 + 0.5) / 1e6, -np.inf)
        if score.shape[1] > n:
            bar = np.partition(score, score.shape[1] - n, axis=1)[:, score.shape[1] - n]
        else:
            bar = np.full(len(score), -np.inf)
        rows, cols = np.nonzero((score >= bar[:, None]) & np.isfinite(score))
        found = score[rows, cols]
    order = np.lexsort((cols, -found, rows))
    rows, cols, found = rows[order], cols[order], found[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    top = place < n
    return pd.DataFrame({names[0]: block.left[rows[top]], names[1]: block.right[cols[top]], names[2]: found[top]})


def nonzero_cells(block: Block) -> pd.DataFrame:
    r, c = np.nonzero(block.sums)
    return pd.DataFrame({"left_id": block.left[r], "right_id": block.right[c], "value": block.sums[r, c]})
