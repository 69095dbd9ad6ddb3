"""Memory-based collaborative filtering for all users at once.

The score of an item is the similarity-weighted mean of the ratings of all other
users. With ``n_v`` the norm of user v's ratings it factors into an item-by-item
table ``M(j,i) = sum_v R(v,j) R(v,i) / n_v`` and item sums ``S(j) = sum_v R(v,j) / n_v``,
so no user-by-user table is ever built, and leave-one-out needs no refit per
fold: the query side is the training rows, the candidate side all ratings, and a
user's own contribution is taken out again.

All functions take ``rated(user_id, item_id, rating, is_test)``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ratingloom.functions.numeric import snap
from ratingloom.operators.blocks import Block, Side, best, block_product, nonzero_cells
from ratingloom.operators.rank import top_n, top_scores
from ratingloom.operators.similarity import nearest_between
from ratingloom.sources.durable import durable

CELLS = "left_id bigint, right_id bigint, value double"
EPS = 1e-6


def as_split(ratings: DataFrame) -> DataFrame:
    """Ratings without a held-out part."""
    return ratings if "is_test" in ratings.columns else ratings.withColumn("is_test", F.lit(False))


def train_of(rated: DataFrame) -> DataFrame:
    return as_split(rated).filter(~F.col("is_test")).select("user_id", "item_id", "rating")


def _norm(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("user_id").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias(name))


def item_ids(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("item_id").alias("id")).distinct().withColumn("aux", F.array(F.lit(0.0)))


def item_table(rated: DataFrame) -> DataFrame:
    """``M``: co-rating weight of every item pair, as ``(left_id, right_id, value)``."""
    weighted = rated.join(_norm(rated, "n_v"), "user_id").select(
        F.col("user_id").alias("k"),
        F.col("item_id").alias("id"),
        (F.col("rating") / F.sqrt("n_v")).alias("value"),
    )
    s = Side(weighted, item_ids(rated))
    return durable(block_product(s, s, nonzero_cells, CELLS, symmetric=True))


def rater_table(rated: DataFrame) -> DataFrame:
    """``N(j,i)``: as ``M``, over the raters of i but without their rating of i."""
    weighted = rated.join(_norm(rated, "n_v"), "user_id")
    members = item_ids(rated)
    key, ident = F.col("user_id").alias("k"), F.col("item_id").alias("id")
    left = Side(weighted.select(key, ident, (F.col("rating") / F.col("n_v")).alias("value")), members)
    right = Side(rated.select(key, ident, F.lit(1.0).alias("value")), members)
    return durable(block_product(left, right, nonzero_cells, CELLS))


def _user_terms(rated: DataFrame) -> DataFrame:
    """Per user: norm of the training rows, own share, sum of similarities."""
    train = train_of(rated)
    all_norm, train_norm = _norm(rated, "n_u"), _norm(train, "t_u")
    sums = (
        rated.join(all_norm, "user_id")
        .groupBy("item_id")
        .agg(F.sum(F.col("rating") / F.col("n_u")).alias("s"))
    )
    dots = train.join(sums, "item_id").groupBy("user_id").agg(F.sum(F.col("rating") * F.col("s")).alias("ts"))
    # training rows are rows of the same user's full ratings: own dot product = t_u^2
    return (
        train_norm.join(all_norm, "user_id")
        .join(dots, "user_id")
        .select(
            "user_id",
            "t_u",
            (F.col("t_u") * F.col("t_u") / F.col("n_u")).alias("own"),
            "ts",
        )
        .withColumn("den", (F.col("ts") - F.col("own")) / F.col("t_u"))
    )


def _cells(rated: DataFrame) -> DataFrame:
    """Training cells are marked -1, held-out cells carry their rating."""
    value = F.when(F.col("is_test"), F.col("rating")).otherwise(F.lit(-1.0))
    return rated.select(
        F.col("user_id").alias("left_id"), F.col("item_id").alias("right_id"), value.alias("value")
    )


def _query_side(rated: DataFrame) -> Side:
    aux = F.array("t_u", "own", "den")
    return Side(
        train_of(rated).select(F.col("item_id").alias("k"), F.col("user_id").alias("id"), F.col("rating").alias("value")),
        _user_terms(rated).select(F.col("user_id").alias("id"), aux.alias("aux")),
    )


def _table_side(table: DataFrame, members: DataFrame) -> Side:
    return Side(table.select(F.col("left_id").alias("k"), F.col("right_id").alias("id"), "value"), members)


def memory_cf(rated: DataFrame, n: int) -> DataFrame:
    """Top-n unrated items per user by similarity-weighted mean rating."""
    rated = as_split(rated)

    def reduce(block: Block) -> pd.DataFrame:
        t, own, den = block.left_aux[:, :1], block.left_aux[:, 1:2], block.left_aux[:, 2:3]
        held_out = np.maximum(block.values, 0.0)
        score = (block.sums - own * held_out) / t / (den + EPS)
        return best(score, ~(block.seen & (block.values < 0)), block, n, ("user_id", "item_id", "score"))

    found = block_product(
        _query_side(rated),
        _table_side(item_table(rated), item_ids(rated)),
        reduce,
        "user_id bigint, item_id bigint, score double",
        cells=_cells(rated),
        keep=n,
    )
    return top_scores(found, n)


def memory_cf_predict(rated: DataFrame, top_k: int = 0, metric: str = "cosine") -> DataFrame:
    """Predicted rating of every held-out cell: ``(user_id, item_id, rating, predicted)``.

    The mean runs over the users who rated the item; ``top_k`` restricts it to
    the k most similar users, the user included.
    """
    rated = as_split(rated)
    wanted = rated.filter("is_test").select("user_id", "item_id", "rating")
    if top_k:
        return _predict_from_neighbors(rated, wanted, top_k, metric)
    asked = wanted.select(
        F.col("user_id").alias("left_id"), F.col("item_id").alias("right_id"), F.col("rating").alias("value")
    )

    def share(rater_part: bool):
        def reduce(block: Block) -> pd.DataFrame:
            r, c = np.nonzero(block.seen)
            t, own = block.left_aux[r, 0], block.left_aux[r, 1]
            mine = own * (1.0 if rater_part else block.values[r, c])
            return pd.DataFrame({"user_id": block.left[r], "item_id": block.right[c], "part": (block.sums[r, c] - mine) / t})

        return reduce

    query, members = _query_side(rated), item_ids(rated)
    schema = "user_id bigint, item_id bigint, part double"
    above = block_product(query, _table_side(item_table(rated), members), share(False), schema, cells=asked)
    below = block_product(query, _table_side(rater_table(rated), members), share(True), schema, cells=asked)
    keys = ["user_id", "item_id"]
    return (
        wanted.join(above.withColumnRenamed("part", "num"), keys, "left")
        .join(below.withColumnRenamed("part", "den"), keys, "left")
        .select(*keys, "rating", snap(F.col("num") / (F.col("den") + EPS)).alias("predicted"))
    )


def _predict_from_neighbors(rated: DataFrame, wanted: DataFrame, top_k: int, metric: str) -> DataFrame:
    train = train_of(rated)
    found = nearest_between(train, rated, "item_id", "user_id", "rating", top_k, metric).select(
        F.col("id").alias("user_id"), F.col("other_id").alias("v"), "similarity"
    )
    # the user itself has similarity 1 but, in the fold, no rating of the item
    kept = top_n(
        found.unionByName(
            train.select("user_id", F.col("user_id").alias("v"), F.lit(1.0).alias("similarity")).distinct()
        ),
        top_k,
        [F.col("similarity").desc(), F.col("v").asc()],
    ).filter(F.col("v") != F.col("user_id"))
    others = rated.select(F.col("user_id").alias("v"), "item_id", F.col("rating").alias("other"))
    sums = (
        wanted.join(kept, "user_id")
        .join(others, ["v", "item_id"])
        .groupBy("user_id", "item_id")
        .agg(F.sum(F.col("similarity") * F.col("other")).alias("num"), F.sum("similarity").alias("den"))
    )
    return wanted.join(sums, ["user_id", "item_id"], "left").select(
        "user_id",
        "item_id",
        "rating",
        snap(F.coalesce("num", F.lit(0.0)) / (F.coalesce("den", F.lit(0.0)) + EPS)).alias("predicted"),
    )
