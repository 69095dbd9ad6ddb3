"""Products of two sides with many blocks, without copying an entry for each block it meets.

The ids of a side are dealt by hash into strips. A strip is one row of a table that is written once: its ids, their aux
values and its entries, sorted, in blocks of ``BLOCK`` ids. The strips of both sides are paired by a cross
join of the two tables, which reads the right table again for the strips of a left partition and writes nothing. A task
holds one pair of strips and what is wanted of the left ids so far (their best n, sums), so its output
is n rows for a left id however many blocks it went through, and both memory and disk stay linear in the entries.

Within a strip longer ids come first. Where the caller can tell how large a product has to be (``reach``), blocks of ids
that are too short for it are passed over: a product is at most the product of the two lengths.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ratingloom.operators import blocks as B
from ratingloom.sources.durable import durable

STRIP_IDS = 8192  # ids of a strip
STRIP_ENTRIES = 1_000_000  # entries of a strip on average
GATHER = 400_000  # entries brought together before the shuffle
FAR = 64  # right strips for which a task draws its results together

_GATHERED = "strip int, kind int, ks array<bigint>, ids array<bigint>, vals array<double>"
_BYTES = ("ids", "aux", "norms", "tops", "bounds", "keys", "starts", "at", "vals", "cell_bounds", "cell_at", "cell_ids", "cell_vals")
_STRIP = "strip int, n int, null_at int, single boolean, " + ", ".join(f"{c} binary" for c in _BYTES)


def _numbered(sides: list[B.Side]) -> list[B.Side]:
    """The sides with 64-bit keys; of other keys a hash that tells all keys of these sides apart."""
    given = [s.entries for s in sides if s.entries is not None]
    whole = all(dict(e.dtypes)["k"] in ("bigint", "int", "smallint", "tinyint") for e in given)
    number = F.col("k").cast("bigint")
    if given and not whole:
        keys = reduce(DataFrame.unionByName, [e.select("k") for e in given]).distinct()
        seed = next(s for s in count() if keys.groupBy(F.xxhash64("k", F.lit(s))).count().filter("count > 1").isEmpty())
        number = F.xxhash64("k", F.lit(seed))
    # a key that is null meets no other
    return [s if s.entries is None else B.Side(s.entries.filter("k is not null").withColumn("k", number), s.members) for s in sides]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of a task, those of one strip and kind in one row."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        strip, kind = rows["strip"].to_numpy(), rows["kind"].to_numpy()
        order = np.lexsort((kind, strip))
        strip, kind = strip[order], kind[order]
        first = np.flatnonzero(np.r_[True, (strip[1:] != strip[:-1]) | (kind[1:] != kind[:-1])])
        offsets, taken = pa.array(np.r_[first, len(strip)], pa.int32()), rows.take(pa.array(order))
        lists = [pa.ListArray.from_arrays(offsets, taken[c].combine_chunks()) for c in ("k", "id", "value")]
        return pa.RecordBatch.from_arrays([pa.array(strip[first], pa.int32()), pa.array(kind[first], pa.int32()), *lists], ["strip", "kind", "ks", "ids", "vals"])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= GATHER:
            yield flush(held)
            held, n = [], 0
    if held:
        yield flush(held)


def _places(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted id is, and whether it is there; NaN stands for null."""
    at = np.minimum(np.searchsorted(ids, wanted), max(len(ids) - 1, 0))
    if not len(ids):
        return at, np.zeros(len(wanted), bool)
    return at, (ids[at] == wanted) | ((ids[at] != ids[at]) & (wanted != wanted))


def _packed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One strip: ids in blocks, longest ids in the first block, entries by block, key and id."""
    rows = pa.Table.from_batches(list(batches))
    parts = {kind: rows.filter(pc.equal(rows["kind"], kind)) for kind in (B.LEFT, B.PRODUCT, B.CELL)}
    ids, aux = B._sorted_members(parts[B.LEFT]["ids"], parts[B.LEFT]["vals"])
    at, known = _places(ids, B._lists(parts[B.PRODUCT]["ids"])[0])
    at, keys, vals = at[known], B._lists(parts[B.PRODUCT]["ks"])[0][known], B._lists(parts[B.PRODUCT]["vals"])[0][known]
    square = np.bincount(at, vals * vals, len(ids))
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(-square, kind="stable")] = np.arange(len(ids))
    order = np.lexsort((np.arange(len(ids)), rank // B.BLOCK))  # by block, then id
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    ids, aux, square = ids[order], aux[order], square[order]
    subs = -(-len(ids) // B.BLOCK)

    different, which = np.unique(keys, return_inverse=True)
    code = (place[at] // B.BLOCK * len(different) + which) * B.BLOCK + place[at] % B.BLOCK
    by = np.argsort(code, kind="stable")
    code, vals = code[by], vals[by]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.empty(0, np.int64)
    if len(first) < len(code):  # entries of one cell add up
        code, vals = code[first], np.add.reduceat(vals, first)
    pair = code // B.BLOCK
    starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.empty(0, np.int64)
    own = pair[starts]
    bounds = np.searchsorted(own, np.arange(subs + 1) * len(different)) if len(different) else np.zeros(subs + 1, np.int64)
    # sums of products of half steps below 2^22 are exact in single precision
    halves = bool((vals >= 0).all() and (np.rint(vals * 2) == vals * 2).all())
    square = np.bincount(code // B.BLOCK // max(len(different), 1) * B.BLOCK + code % B.BLOCK, vals * vals, len(ids)) if len(code) else square
    tops = [square[j * B.BLOCK : (j + 1) * B.BLOCK].max() if halves else np.inf for j in range(subs)]
    single = bool((vals.astype(np.float32) == vals).all())

    cell_left, known = _places(ids_sorted := np.sort(ids), B._lists(parts[B.CELL]["ids"])[0])
    cell_ids, cell_vals = B._lists(parts[B.CELL]["ks"])[0][known], B._lists(parts[B.CELL]["vals"])[0][known]
    cell_left = place[cell_left[known]]
    by = np.lexsort((cell_ids, cell_left // B.BLOCK))
    cell_left, cell_ids, cell_vals = cell_left[by], cell_ids[by], cell_vals[by]
    empty = ids != ids
    made = {
        "ids": np.where(empty, 0, ids).astype(np.int64), "aux": aux.astype(np.float64), "norms": np.sqrt(square), "tops": np.array(tops, np.float64),
        "bounds": bounds.astype(np.int64), "keys": (different[own % len(different)] if len(own) else own).astype(np.int64),
        "starts": np.r_[starts, len(code)].astype(np.int64), "at": (code % B.BLOCK).astype(np.int32), "vals": vals.astype(np.float32 if single else np.float64),
        "cell_bounds": np.searchsorted(cell_left // B.BLOCK, np.arange(subs + 1)).astype(np.int64), "cell_at": (cell_left % B.BLOCK).astype(np.int32),
        "cell_ids": cell_ids.astype(np.int64), "cell_vals": cell_vals.astype(np.float64),
    }
    yield pa.RecordBatch.from_pydict(
        {"strip": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
         "null_at": pa.array([int(np.argmax(empty)) if empty.any() else -1], pa.int32()), "single": pa.array([single])}
        | {c: pa.array([made[c].tobytes()], pa.binary()) for c in _BYTES}
    )


def _strips(side: B.Side, n: int, cells: DataFrame | None) -> DataFrame:
    """The strips of a side, written once."""
    columns = ["strip", "kind", "k", "id", "value"]
    parts = []
    if side.entries is not None:
        parts.append(side.entries.select(B._block("id", n).alias("strip"), F.lit(B.PRODUCT).alias("kind"), "k", F.col("id").cast("bigint").alias("id"), F.col("value").cast("double").alias("value")))
    if cells is not None:
        cells = cells.filter("left_id is not null and right_id is not null")  # null is not equal to null
        parts.append(cells.select(B._block("left_id", n).alias("strip"), F.lit(B.CELL).alias("kind"), F.col("right_id").cast("bigint").alias("k"), F.col("left_id").cast("bigint").alias("id"), F.col("value").cast("double").alias("value")))
    packed = side.members.groupBy(B._block("id", n).alias("strip")).agg(
        F.collect_list(F.struct(F.col("id").cast("bigint").alias("i"), F.col("aux").alias("v"))).alias("e")
    )
    rows = packed.select("strip", F.lit(B.LEFT).alias("kind"), F.expr(B._NO_IDS).alias("ks"), F.col("e.i").alias("ids"), F.flatten("e.v").alias("vals"))
    for part in parts:
        rows = rows.unionByName(part.select(columns).mapInArrow(_gather, _GATHERED))
    return durable(rows.repartition(n, "strip").groupBy("strip").applyInArrow(_packed, _STRIP))


class _Sub:
    """A block of a strip."""

    def __init__(self, strip: _Strip, j: int):
        a, b = j * B.BLOCK, min((j + 1) * B.BLOCK, strip.n)
        self.ids, self.aux, self.norms, self.top = strip.ids[a:b], strip.aux[a:b], strip.norms[a:b], strip.tops[j]
        if a <= strip.null_at < b:
            self.ids = self.ids.astype(np.float64)
            self.ids[strip.null_at - a] = np.nan
        low, high = strip.bounds[j], strip.bounds[j + 1]
        self.keys, ends = strip.keys[low:high], strip.starts[low : high + 1]
        self.starts, self.counts = ends[:-1] - ends[0], np.diff(ends)
        self.at, self.vals = strip.at[ends[0] : ends[-1]], strip.vals[ends[0] : ends[-1]]
        low, high = strip.cell_bounds[j], strip.cell_bounds[j + 1]
        self.cell_at, self.cell_ids, self.cell_vals = strip.cell_at[low:high], strip.cell_ids[low:high], strip.cell_vals[low:high]

    def only(self, wanted: np.ndarray) -> _Sub:
        """The block with some of its ids."""
        new = np.cumsum(wanted) - 1
        entry = wanted[self.at]
        out = object.__new__(_Sub)
        out.ids, out.aux, out.norms, out.top, out.keys = self.ids[wanted], self.aux[wanted], self.norms[wanted], self.top, self.keys
        out.at, out.vals = new[self.at[entry]], self.vals[entry]
        out.counts = np.add.reduceat(entry.astype(np.int64), self.starts) if len(self.starts) else self.counts
        out.starts = np.cumsum(out.counts) - out.counts
        return out


class _Strip:
    def __init__(self, batch: pa.RecordBatch, i: int, p: str):
        def part(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(batch.column(f"{p}_{name}")[i].as_py(), kind)

        self.no, self.n, self.null_at = (batch.column(f"{p}_{c}")[i].as_py() for c in ("strip", "n", "null_at"))
        self.ids, self.norms, self.tops = part("ids", np.int64), part("norms", np.float64), part("tops", np.float64)
        self.aux = part("aux", np.float64).reshape(self.n, -1) if self.n else np.empty((0, 1))
        self.bounds, self.keys, self.starts, self.at = part("bounds", np.int64), part("keys", np.int64), part("starts", np.int64), part("at", np.int32)
        self.vals = part("vals", np.float32 if batch.column(f"{p}_single")[i].as_py() else np.float64)
        self.cell_bounds, self.cell_at = part("cell_bounds", np.int64), part("cell_at", np.int32)
        self.cell_ids, self.cell_vals = part("cell_ids", np.int64), part("cell_vals", np.float64)
        self.subs = -(-self.n // B.BLOCK)


def _products(left: _Sub, right: _Sub) -> np.ndarray:
    """Sums of the products of two blocks."""
    shape = (len(left.ids), len(right.ids))
    out = np.zeros(shape)
    if not out.size or not len(left.keys) or not len(right.keys):
        return out
    to = np.minimum(np.searchsorted(right.keys, left.keys), len(right.keys) - 1)
    li = np.flatnonzero(right.keys[to] == left.keys)
    ri = to[li]
    pairs = left.counts[li] * right.counts[ri]
    li, ri, pairs = li[pairs > 0], ri[pairs > 0], pairs[pairs > 0]
    dense = np.flatnonzero(pairs > out.size // B.DENSE_SHARE)
    kind = np.float32 if left.top * right.top < 2.0**44 else np.float64
    for keys in np.array_split(dense, max(1, -(-len(dense) // B.DENSE_KEYS))):
        if len(keys):
            slabs = []
            for sub, of in ((left, li[keys]), (right, ri[keys])):
                n = sub.counts[of]
                flat = np.repeat(sub.starts[of], n) + B._within(n)
                slab = np.zeros((len(of), len(sub.ids)), kind)
                slab[np.repeat(np.arange(len(of)), n), sub.at[flat]] = sub.vals[flat]
                slabs.append(slab)
            out += slabs[0].T @ slabs[1]
    sparse = np.flatnonzero(pairs <= out.size // B.DENSE_SHARE)
    if len(sparse):
        cut = np.cumsum(pairs[sparse]) // B.PAIRS_AT_ONCE
        for keys in np.split(sparse, np.flatnonzero(np.diff(cut)) + 1):
            a, b = li[keys], ri[keys]
            ln, rn = left.counts[a], right.counts[b]
            l_flat = np.repeat(left.starts[a], ln) + B._within(ln)
            each = np.repeat(rn, ln)  # every left entry of a key, once for every right entry of the key
            r_flat = np.repeat(np.repeat(right.starts[b], ln), each) + B._within(each)
            cell = np.repeat(left.at[l_flat].astype(np.int64) * shape[1], each) + right.at[r_flat]
            out += np.bincount(cell, np.repeat(left.vals[l_flat].astype(np.float64), each) * right.vals[r_flat], out.size).reshape(shape)
    return out


def _marked(left: _Sub, right: _Sub, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    seen, values = np.zeros(shape, bool), np.zeros(shape)
    low, high = np.searchsorted(left.cell_ids, right.ids, "left"), np.searchsorted(left.cell_ids, right.ids, "right")
    n = high - low
    flat, col = np.repeat(low, n) + B._within(n), np.repeat(np.arange(len(right.ids)), n)
    seen[left.cell_at[flat], col] = True
    values[left.cell_at[flat], col] = left.cell_vals[flat]
    return seen, values


class _Held:
    """What is wanted of the ids of one left block so far."""

    def __init__(self, ids: np.ndarray, keep: int | None, merge: Callable[[pd.DataFrame], pd.DataFrame] | None):
        self.ids, self.keep, self.merge = ids, keep, merge
        self.frames: list[pd.DataFrame] = []
        self.rows, self.bar = 0, None

    def add(self, found: pd.DataFrame) -> None:
        if len(found):
            self.frames.append(found)
            self.rows += len(found)
        if self.rows > 2 * (self.keep or 4) * len(self.ids) or self.keep and self.bar is None:
            self.squeeze()

    def squeeze(self) -> None:
        if not self.frames:
            return
        rows = pd.concat(self.frames, ignore_index=True) if len(self.frames) > 1 else self.frames[0]
        if self.merge:
            rows = self.merge(rows)
        else:
            one, other, score = (rows[c].to_numpy() for c in rows.columns)
            at = np.searchsorted(self.ids, one)
            order = np.lexsort((other, -score, at))
            at = at[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            rows = rows.iloc[order[place < self.keep]]
            last = place == self.keep - 1
            self.bar = np.full(len(self.ids), -np.inf)
            self.bar[at[last]] = score[order[last]]
        self.frames, self.rows = [rows], len(rows)


def _long_enough(left: _Sub, right: _Sub, bar: np.ndarray, reach: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Right ids that are long enough for the bar of some left id; None: all."""
    if not np.isfinite(bar).all():
        return None
    least = reach(left.aux, bar)
    need = np.divide(least, left.norms, out=np.where(least > 0, np.inf, -np.inf), where=left.norms > 0).min()
    wanted = right.norms >= need * (1 - 1e-9) if need > 0 else np.ones(len(right.ids), bool)
    return None if wanted.all() else wanted


def strip_product(
    left: B.Side, right: B.Side, sizes: list[B.Size], finish: Callable[[B.Block], pd.DataFrame], schema: str, cells: DataFrame | None = None,
    symmetric: bool = False, vectors: bool = False, keep: int | None = None, merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    reach: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, score: Callable[[_Sub, _Sub], np.ndarray] | None = None,
) -> DataFrame:
    """As ``block_product``; ``score`` may take the place of the sums of products. Of two equal sides every pair is multiplied from both ends: the results of a left id stay in its task."""
    cores = left.members.sparkSession.sparkContext.defaultParallelism

    def number(size: B.Size) -> int:
        by_cores = min(2 * cores, math.ceil(size.ids / B.BLOCK))
        return max(1, math.ceil(size.ids / STRIP_IDS), math.ceil(size.entries / STRIP_ENTRIES), by_cores)

    nl, nr = number(sizes[0]), number(sizes[1])
    both = _numbered([left] if symmetric else [left, right])
    own = _strips(both[0], nl, cells)
    other = own if symmetric else _strips(both[-1], nr, None)
    tasks = min(nr, max(math.ceil(4 * cores / nl), math.ceil(nr / FAR)))
    held_back = [c for c in _BYTES if c.startswith("cell_")]
    # the rows of the second table are kept for a task, those of the first pass by
    pairs = (
        other.select([F.col(c).alias(f"r_{c}") if c not in held_back else F.lit(b"").alias(f"r_{c}") for c in other.columns])
        .withColumn("r_cell_bounds", F.col("r_bounds")).coalesce(tasks)
        .crossJoin(own.select([F.col(c).alias(f"l_{c}") for c in own.columns]))
    )
    marked = cells is not None
    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], _Held] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = _Strip(batch, i, "l"), _Strip(batch, i, "r")
                for j in range(x.subs):
                    a = _Sub(x, j)
                    h = held.setdefault((x.no, j), _Held(a.ids, keep, merge))
                    for m in range(y.subs):
                        b = _Sub(y, m)
                        if reach and h.bar is not None:
                            wanted = _long_enough(a, b, h.bar, reach)
                            if wanted is not None:
                                if not wanted.any():
                                    break  # the blocks after it are shorter
                                b = b.only(wanted)
                        shape = (len(a.ids), len(b.ids))
                        sums = score(a, b) if score else a.aux @ b.aux.T if vectors else _products(a, b)
                        seen, values = _marked(a, b, shape) if marked else (np.zeros(shape, bool), np.zeros((1, 1)))
                        found = finish(B.Block(sums, a.ids, a.aux, b.ids, b.aux, seen, values, h.bar))
                        if keep or merge:
                            h.add(found)
                        elif len(found):
                            yield pa.RecordBatch.from_pandas(found, out_schema, preserve_index=False)
        for h in held.values():
            h.squeeze()
            for rows in h.frames:
                yield pa.RecordBatch.from_pandas(rows, out_schema, preserve_index=False)

    return pairs.mapInArrow(run, schema)
