"""Leave-one-out and random splits: one table with an ``is_test`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ratingloom.functions.numeric import seeded_hash

STEP = 0.5


def newest(ratings: DataFrame) -> DataFrame:
    """The newest rating of each user. One aggregation, no window."""
    pick = F.max_by(F.struct("item_id", "rating"), F.struct("ts", "event_id")).alias("r")
    return ratings.groupBy("user_id").agg(pick).select("user_id", "r.item_id", "r.rating")


def random_pick(ratings: DataFrame, seed: int = 30) -> DataFrame:
    """One rating of each user, chosen by a seeded hash of the ids."""
    key = F.struct(seeded_hash(F.col("user_id"), F.col("item_id"), seed), F.col("item_id"))
    pick = F.min_by(F.struct("item_id", "rating"), key).alias("r")
    return ratings.groupBy("user_id").agg(pick).select("user_id", "r.item_id", "r.rating")


def effective_thresholds(ratings: DataFrame, threshold: float, at_least: int = 1) -> DataFrame:
    """Per user, the threshold lowered in half steps until enough ratings reach it.

    With x the ``at_least``-th largest rating, the number of steps is known at
    once. Ratings are counted per level first, so the window sees levels only. A
    user with fewer ratings keeps all of them.
    """
    levels = ratings.groupBy("user_id", "rating").agg(F.count("*").alias("c"))
    above = W.partitionBy("user_id").orderBy(F.col("rating").desc()).rowsBetween(W.unboundedPreceding, 0)
    reached = levels.withColumn("upto", F.sum("c").over(above))
    x = reached.groupBy("user_id").agg(
        F.coalesce(F.max(F.when(F.col("upto") >= at_least, F.col("rating"))), F.min("rating")).alias("x")
    )
    steps = F.greatest(F.lit(0.0), F.ceil((F.lit(threshold) - F.col("x")) / F.lit(STEP)).cast("double"))
    return x.select("user_id", (F.lit(threshold) - F.lit(STEP) * steps).alias("effective"))


def positive_ratings(ratings: DataFrame, threshold: float, at_least: int = 1) -> DataFrame:
    limits = effective_thresholds(ratings, threshold, at_least)
    return ratings.join(limits, "user_id").filter(F.col("rating") >= F.col("effective"))


def mark_test(ratings: DataFrame, test: DataFrame) -> DataFrame:
    """All ratings, with ``is_test`` set on the rows of ``test``."""
    marked = test.select("user_id", "item_id", F.lit(True).alias("_t"))
    return ratings.join(marked, ["user_id", "item_id"], "left").withColumn("is_test", F.coalesce("_t", F.lit(False))).drop("_t")


def leave_one_out(ratings: DataFrame, pick: str = "newest", threshold: float | None = None, seed: int = 30) -> DataFrame:
    """One test rating per user. The threshold limits the pick, not the train rows."""
    pool = ratings if threshold is None else positive_ratings(ratings, threshold).drop("effective")
    return mark_test(ratings, newest(pool) if pick == "newest" else random_pick(pool, seed))


def thresholded_leave_last_out(ratings: DataFrame, threshold: float | None = None) -> DataFrame:
    """Leave-last-out over the positive ratings only, at least two rows per user."""
    pool = ratings if threshold is None else positive_ratings(ratings, threshold, 2).drop("effective")
    return mark_test(pool, newest(pool))


def random_split(ratings: DataFrame, train_tenths: int = 8, seed: int = 123) -> DataFrame:
    bucket = F.pmod(seeded_hash(F.col("user_id"), F.col("item_id"), seed), F.lit(10))
    return ratings.withColumn("is_test", bucket >= train_tenths)
