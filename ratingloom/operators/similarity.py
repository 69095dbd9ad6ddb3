"""Similar users and similar items: cosine and inverse euclidean."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions.numeric import snap
from ratingloom.operators.blocks import Block, Side, best, block_product
from ratingloom.operators.rank import top_n

NEIGHBOR = "id bigint, other_id bigint, similarity double"


def norms(df: DataFrame, ident: str, value: str) -> DataFrame:
    """``(id, aux=[norm])`` of every row vector."""
    squares = F.sum(F.col(value) * F.col(value))
    return df.groupBy(F.col(ident).alias("id")).agg(F.array(F.sqrt(squares)).alias("aux"))


def entries(df: DataFrame, key: str, ident: str, value: str | Column) -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return df.select(F.col(key).alias("k"), F.col(ident).alias("id"), value.cast("double").alias("value"))


def side(df: DataFrame, key: str, ident: str, value: str) -> Side:
    return Side(entries(df, key, ident, value), norms(df, ident, value))


def similarity_of(block: Block, metric: str) -> np.ndarray:
    """Similarity of each cell from the dot products and the two norms."""
    nl, nr = block.left_aux[:, :1], block.right_aux[:, 0]
    if metric == "cosine":
        scale = nl * nr
        return np.divide(block.sums, scale, out=np.zeros_like(block.sums), where=scale > 0)
    squared = np.maximum(np.rint((nl * nl) * 1e6) / 1e6 + np.rint((nr * nr) * 1e6) / 1e6 - 2 * block.sums, 0.0)
    distance = np.sqrt(squared)
    return 1.0 / np.where(distance == 0, 1e-6, distance)


def _neighbors(n: int, metric: str):
    def reduce(block: Block) -> pd.DataFrame:
        other = block.left[:, None] != block.right
        return best(similarity_of(block, metric), other, block, n, ("id", "other_id", "similarity"))

    return reduce


def _rank_neighbors(found: DataFrame, n: int) -> DataFrame:
    return top_n(found, n, [F.col("similarity").desc(), F.col("other_id").asc()], "id")


def nearest(df: DataFrame, key: str, ident: str, value: str, n: int, metric: str = "cosine", **how) -> DataFrame:
    """The n most similar other ids of every id, with similarity and rank.

    All other ids take part, also those that share no key (cosine 0).
    """
    s = side(df, key, ident, value)
    found = block_product(s, s, _neighbors(n, metric), NEIGHBOR, symmetric=True, keep=n, **how)
    return _rank_neighbors(found, n)


def nearest_between(queries: DataFrame, pool: DataFrame, key: str, ident: str, value: str, n: int, metric: str = "cosine") -> DataFrame:
    """As ``nearest``, from the ids of one table to the ids of another.

    Used by leave-one-out: the query rows lack the held-out rating while the
    pool has all ratings of everybody else.
    """
    found = block_product(
        side(queries, key, ident, value), side(pool, key, ident, value), _neighbors(n, metric), NEIGHBOR, keep=n
    )
    return _rank_neighbors(found, n)


def similar_pairs(df: DataFrame, key: str, ident: str, value: str, at_least: float, metric: str = "cosine") -> DataFrame:
    """Every ordered pair of ids whose similarity reaches ``at_least``.

    The result is as large as the caller asks for: a bound of 0 is the whole
    matrix. The work and the shuffles do not depend on the bound.
    """

    def finish(block: Block) -> pd.DataFrame:
        sim = np.floor(similarity_of(block, metric) * 1e6 + 0.5) / 1e6
        r, c = np.nonzero((sim >= at_least) & (block.left[:, None] != block.right))
        return pd.DataFrame({"id": block.left[r], "other_id": block.right[c], "similarity": sim[r, c]})

    s = side(df, key, ident, value)
    return block_product(s, s, finish, NEIGHBOR, symmetric=True)


def similarity_summary(df: DataFrame, key: str, ident: str, value: str, metric: str = "cosine") -> DataFrame:
    """The row sums of the full similarity matrix, without writing the matrix.

    Per id: how many other ids have a positive similarity, their sum and maximum.
    """

    def reduce(block: Block) -> pd.DataFrame:
        sim = np.where(block.left[:, None] != block.right, similarity_of(block, metric), 0.0)
        return pd.DataFrame(
            {"id": block.left, "n_similar": (sim > 0).sum(axis=1), "sim_sum": sim.sum(axis=1),
             "sim_max": sim.max(axis=1, initial=0.0)}
        )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        found = rows.groupby("id", as_index=False, dropna=False)
        return found.agg({"n_similar": "sum", "sim_sum": "sum", "sim_max": "max"})

    s = side(df, key, ident, value)
    parts = block_product(
        s, s, reduce, "id bigint, n_similar bigint, sim_sum double, sim_max double", symmetric=True, merge=add
    )
    return parts.groupBy("id").agg(
        F.sum("n_similar").alias("n_similar"),
        snap(F.sum("sim_sum")).alias("sim_sum"),
        snap(F.max("sim_max")).alias("sim_max"),
    )
