"""Near-duplicate vectors by an inverted multi-index, confirmed by cosine in double precision.

Unit vectors are cut into halves; each half has a codebook of its own, so the pairs of codes
form a product grid of cells. Codebooks are fitted by k-means on at most ``SAMPLE`` vectors, those of
smallest hashed id; every vector is put into its cell. A vector's near vectors may lie in other cells: cells
are visited from the nearest on, a multi-sequence walk over the two sorted lists of
codes by the sum of the squared distances that a point of the cell must at least have. The walk ends where
``TARGET`` of all links have been met. That sum is measured twice and the larger one holds: on the true links between
``QUERIES`` sampled vectors and all vectors, found exactly, and on sampled vectors turned by the wanted angle in random directions, for
tables in which the sample has few links. ``exact`` visits every cell. The number of codes grows with the
root of the rows, so that cells do not; the bounded sample bounds it, and crowded cells are cut into blocks anyway.

Each visited cell is a bucket in which visitors meet the members of larger id, so a link is seen once.
Buckets are cut into blocks of at
most about ``BLOCK`` vectors, and a pair of blocks is one matrix product, so a crowded
cell is spread over many tasks and its pairs are never written out: a block pair hands on a
count for each vector and as many links as its components need.

Equal vectors (by direction and length) are one class, which is compared once and counts as many
times as it has rows. Vectors that are null, zero, of another length than most, or hold null or
non-finite components link with nothing. Rows sharing a vec_id are one vector, and only differing rows are
compared. A null vec_id is linked with nothing, has a null component and is kept. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import groups, lists
from ratingloom.llm.components import components
from ratingloom.sources.durable import durable

SAMPLE = 10_000
CODES = 32
ROUNDS = 12
BLOCK = 1024
TARGET = 0.995
QUERIES = 1024  # sampled vectors whose true links are found to measure the walk
TRUE_TARGET = 0.999  # of those links; they are a sample, so more is asked for
CELL = 64  # about as many vectors are meant to share a cell
TURNED = 4000  # sampled vectors that are turned to measure the walk


@dataclass
class Grid:
    """The two codebooks and what the walk needs of them."""

    books: list[np.ndarray]  # (codes, width) of each half
    reach: float = 0.0  # sum of squared distances at which a walk ends

    @staticmethod
    def fit(sample: np.ndarray, least: float, codes: int = CODES, seed: int = 6) -> Grid:
        r, books = np.random.default_rng(seed), []
        cut = sample.shape[1] // 2
        for half in (sample[:, :cut], sample[:, cut:]):
            k = min(codes, len(half))
            book = half[r.choice(len(half), k, replace=False)] if k else np.zeros((1, half.shape[1]))
            for _ in range(ROUNDS if k else 0):
                near = _distances(half, book).argmin(1)
                n = np.bincount(near, minlength=k)
                sums = np.zeros_like(book)
                np.add.at(sums, near, half)
                book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
            books.append(np.unique(book, axis=0))
        grid = Grid(books)
        if len(sample):
            x = sample[r.integers(0, len(sample), TURNED)]
            u = r.standard_normal(x.shape)
            u -= (u * x).sum(1, keepdims=True) * x
            u /= np.sqrt((u * u).sum(1, keepdims=True)) + 1e-30
            met = grid.cells(least * x + np.sqrt(max(0.0, 1 - least * least)) * u)
            first, second = grid.bounds(x)
            rows, k = np.arange(len(x)), len(books[1])
            grid.reach = float(np.quantile(first[rows, met // k] + second[rows, met % k], TARGET))
        return grid

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.books[0].shape[1]], x[:, self.books[0].shape[1] :]]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_distances(h, book).argmin(1) for h, book in zip(self.halves(x), self.books, strict=True))
        return a * len(self.books[1]) + b

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half, the squared distance to a code's points that is certain."""
        out = []
        for half, book in zip(self.halves(x), self.books, strict=True):
            d = _distances(half, book)
            own = d.argmin(1)
            apart = np.sqrt(_distances(book, book))[own]
            # a point of the cell is nearer to its code than to ours: at least up to the plane between them
            least = (d - d[np.arange(len(d)), own][:, None]) / np.maximum(2 * apart, 1e-30)
            least[np.arange(len(d)), own] = 0
            out.append(np.maximum(least, 0) ** 2)
        return out

    def visited(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells that the walks from ``x`` visit."""
        first, second = self.bounds(x)
        order = np.argsort(second, 1, kind="stable")
        ordered = np.take_along_axis(second, order, 1)
        rows, cells = [], []
        for c in range(first.shape[1]):  # along the second list while the sum allows it
            row, k = np.nonzero(first[:, c, None] + ordered <= self.reach)
            rows.append(row)
            cells.append(c * second.shape[1] + order[row, k])
        return np.concatenate(rows), np.concatenate(cells)


def codes_for(rows: int, sample: int) -> int:
    """Codes of each half: their square times ``CELL`` follows the rows, with 8 sampled vectors a code at least."""
    return max(CODES, min(int((rows / CELL) ** 0.5), sample // 8))


def true_reach(classes: DataFrame, sample: np.ndarray, grid: Grid, least: float) -> float:
    """The sum of squared distances within which ``TRUE_TARGET`` of the true links of some sampled vectors lie; 0 without any."""
    spark, queries = classes.sparkSession, sample[np.random.default_rng(3).permutation(len(sample))[:QUERIES]]
    sent = spark.sparkContext.broadcast((queries, grid))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, g = sent.value
        first, second = g.bounds(asked)
        k = len(g.books[1])
        for b in batches:
            for a in range(0, b.num_rows, 512):
                x = _matrix(b.column(0).slice(a, 512), min(512, b.num_rows - a))
                q, at = np.nonzero(asked @ x.T >= least)
                if len(q):
                    cell = g.cells(x)[at]
                    yield pa.RecordBatch.from_arrays([pa.array(first[q, cell // k] + second[q, cell % k])], ["reach"])

    if not len(queries):
        return 0.0
    met = classes.select("embedding").mapInArrow(run, "reach double")
    found = met.agg(F.percentile("reach", F.lit(TRUE_TARGET)).alias("r")).first()
    return float(found.r or 0.0) * (1 + 1e-9)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0)


def _classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, n, members): distinct usable vectors, named by their smallest id."""
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = v.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine & F.exists("embedding", lambda c: c != 0))
    length = usable.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if length is None:
        return usable.select("vec_id", "embedding", F.lit(0).cast("bigint").alias("n")).limit(0)
    usable = usable.filter(F.size("embedding") == length.width)
    # 0.0 and -0.0 are one value
    usable = usable.withColumn("embedding", F.transform("embedding", lambda c: c + F.lit(0.0)))
    return usable.dropDuplicates(["vec_id", "embedding"]).groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    x = flat.to_numpy().reshape(n, -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _dealt(classes: DataFrame, grid: Grid) -> DataFrame:
    """(cell, home, vec_id, n, embedding): every class in its own cell and in those it visits."""
    sent = classes.sparkSession.sparkContext.broadcast(grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                if not part.num_rows:
                    continue
                x = _matrix(part.column(2), part.num_rows)
                home = sent.value.cells(x)
                row, cell = sent.value.visited(x)
                ids, n = part.column(0).to_numpy(), part.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(home[row] == cell), pa.array(ids[row]), pa.array(n[row]), lists(list(x[row]), pa.float64())],
                    ["cell", "home", "vec_id", "n", "unit"],
                )

    return classes.select("vec_id", "n", "embedding").mapInArrow(run, "cell bigint, home boolean, vec_id bigint, n bigint, unit array<double>")


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) that connect what ``linked`` connects: each node's way to its root."""
    rows, columns = linked.shape
    left, right = np.arange(rows), np.full(columns, rows + columns)
    while True:
        far = np.where(linked, left[:, None], rows + columns).min(0)
        near = np.minimum(left, np.where(linked, far, rows + columns).min(1))
        if (near == left).all() and (far == right).all():
            break
        left, right = near, far
    out = set()
    seen_l, seen_r = np.arange(rows) == left, np.zeros(columns, bool)
    seen_l &= linked.any(1)
    while True:  # breadth first from every root
        new_r = linked[seen_l].any(0) & ~seen_r if seen_l.any() else np.zeros(columns, bool)
        reached = np.flatnonzero(seen_l)
        out.update((int(reached[linked[reached, c].argmax()]), int(c)) for c in np.flatnonzero(new_r))
        seen_r |= new_r
        new_l = linked[:, seen_r].any(1) & ~seen_l
        reached = np.flatnonzero(seen_r)
        out.update((int(r), int(reached[linked[r, reached].argmax()])) for r in np.flatnonzero(new_l))
        seen_l |= new_l
        if not new_r.any() and not new_l.any():
            return list(out)


def _compare(dealt: DataFrame, least: float) -> DataFrame:
    """(kind, a, b): 0 for b more links of class a, 1 for a link of the spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, 3):
            home = g.column("home").to_numpy().astype(bool)
            ids, n = g.column("vec_id").to_numpy(), g.column("n").to_numpy()
            x = _matrix(g.column("unit"), len(ids))
            member = np.flatnonzero(home)
            if not len(member):
                continue
            guest = np.arange(len(ids))[g.column("guest").to_numpy().astype(bool)]
            for a in range(0, len(guest), 256):
                rows = guest[a : a + 256]
                linked = (x[rows] @ x[member].T >= least) & (ids[rows][:, None] < ids[member])
                if not linked.any():
                    continue
                here, there = linked @ n[member], n[rows] @ linked
                one, two = np.array([(ids[rows[r]], ids[member[c]]) for r, c in _spanning(linked)]).T
                kind = np.repeat([0, 1], [len(rows) + len(member), len(one)])
                first, second = np.concatenate([ids[rows], ids[member], one]), np.concatenate([here, there, two])
                keep = (second != 0) | (kind == 1)
                yield pa.RecordBatch.from_arrays([pa.array(kind[keep]), pa.array(first[keep]), pa.array(second[keep])], ["kind", "a", "b"])

    keys = ["cell", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "kind bigint, a bigint, b bigint")


def near_duplicates(vectors: DataFrame, least: float = 0.95, exact: bool = False) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    classes = durable(_classes(vectors))
    rows = classes.select("embedding", F.xxhash64("vec_id").alias("k"), "vec_id").orderBy("k", "vec_id").limit(SAMPLE).toArrow()
    width = len(rows.column(0)[0]) if rows.num_rows else 1
    sample = _matrix(rows.column(0), rows.num_rows) if rows.num_rows else np.zeros((0, width))
    grid = Grid.fit(sample, least, codes_for(classes.count(), len(sample)))
    grid.reach = float("inf") if exact else max(grid.reach, true_reach(classes, sample, grid, least))
    dealt = durable(_dealt(classes, grid))
    # members of a cell are cut into blocks, guests too; each pair of a guest block and a member block is one product
    sizes = dealt.groupBy("cell").agg(F.count_if("home").alias("members"), F.count("*").alias("guests"))
    cut = dealt.join(sizes.filter("members > 0"), "cell")
    blocks = {k: F.ceil(F.col(k) / BLOCK).cast("int") for k in ("members", "guests")}
    place = {k: F.pmod(F.xxhash64("vec_id"), b).cast("int") for k, b in blocks.items()}
    as_guest = cut.select(
        "cell", place["guests"].alias("i"), F.explode(F.sequence(F.lit(0), blocks["members"] - 1)).alias("j"),
        F.lit(False).alias("home"), F.lit(True).alias("guest"), "vec_id", "n", "unit",
    )
    as_member = cut.filter("home").select(
        "cell", F.explode(F.sequence(F.lit(0), blocks["guests"] - 1)).alias("i"), place["members"].alias("j"),
        F.lit(True).alias("home"), F.lit(False).alias("guest"), "vec_id", "n", "unit",
    )
    found = durable(_compare(as_guest.union(as_member), least))
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("vec_id")).agg(F.sum("b").alias("links"))
    named = components(found.filter("kind = 1").select("a", "b")).toDF("vec_id", "component")
    per_class = classes.join(counts, "vec_id", "left").join(named, "vec_id", "left")
    per_class = per_class.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component"))
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), lambda c: c + F.lit(0.0)).alias("embedding"))
    out = every.join(per_class, "embedding", "left")
    usable = F.col("vec_id").isNotNull()
    return out.select(
        "vec_id",
        F.when(usable, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(usable, F.coalesce("component", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
