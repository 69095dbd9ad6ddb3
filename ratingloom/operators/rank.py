"""Ranking: top-n per entity, ranks over a whole table, first unseen entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ratingloom.functions.numeric import snap
from ratingloom.sources.durable import durable

STRETCH = 65_536  # positions of one user that one window group may hold


def top_n(scored: DataFrame, n: int, by: list[Column] | None = None, entity: str = "user_id") -> DataFrame:
    """The n best rows of each entity with their rank.

    ``row_number() <= n`` is planned as a group limit before and after the
    shuffle, so a hot entity sends n rows per task, not all of its rows.
    """
    order = by or [F.col("score").desc(), F.col("item_id").asc()]
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy(entity).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint"))


def top_scores(scored: DataFrame, n: int) -> DataFrame:
    """Top-n on the published score grid."""
    return top_n(scored.withColumn("score", snap(F.col("score"))), n).select(
        "user_id", "item_id", "score", "rank"
    )


def exclude_seen(scored: DataFrame, seen: DataFrame) -> DataFrame:
    return scored.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def positions(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """Number all rows 1..N in a given total order without a one-task window.

    The rows are range-partitioned and written once; each partition numbers its
    own rows and adds the row count of the partitions before it. The only
    table-wide window runs over one row per partition.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # written with its partition id: a rerun of a task cannot split the rows anew
    spread = durable(
        df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    )
    sizes = spread.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return (
        spread.withColumn("_row", within)
        .join(offsets, "_part")
        .withColumn(name, (F.col("_before") + F.col("_row")).cast("bigint"))
        .drop("_part", "_row", "_before")
    )


def free_ranges(users: DataFrame, taken: DataFrame, size: int) -> DataFrame:
    """All free positions of 1..size of each user, as ranges.

    ``taken`` holds ``(user_id, pos)``. A range ``(first_pos, last_pos)`` lies
    between two taken positions; ``before`` counts the free positions before it.
    A user has at most one range more than taken positions, so the result holds
    the whole product of users and positions minus the taken ones in linear space.
    Neighbouring positions are found within stretches of bounded length and
    across stretches, so a user who took very many positions is several groups.
    """
    edges = users.select("user_id", F.lit(0).cast("bigint").alias("pos")).distinct().unionByName(
        taken.select("user_id", "pos").distinct()
    ).withColumn("stretch", F.floor(F.col("pos") / F.lit(STRETCH)))
    within = W.partitionBy("user_id", "stretch").orderBy("pos")
    stretches = edges.groupBy("user_id", "stretch").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    in_order = W.partitionBy("user_id").orderBy("stretch")
    context = stretches.select(
        "user_id",
        "stretch",
        F.coalesce(F.sum("n").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
        F.lead("first", 1, size + 1).over(in_order).alias("next_first"),
    )
    linked = (
        edges.withColumn("nth", F.row_number().over(within))
        .withColumn("next_in", F.lead("pos").over(within))
        .join(context, ["user_id", "stretch"])
    )
    # position 0 is an edge but not taken: free before a range = pos - taken up to pos
    return linked.select(
        "user_id",
        (F.col("pos") + 1).alias("first_pos"),
        (F.coalesce("next_in", "next_first") - 1).cast("bigint").alias("last_pos"),
        (F.col("pos") - (F.col("earlier") + F.col("nth") - 1)).cast("bigint").alias("before"),
    ).filter(F.col("last_pos") >= F.col("first_pos"))


def first_unseen(users: DataFrame, taken: DataFrame, size: int, n: int | Column) -> DataFrame:
    """The first n free positions of 1..size for each user: ``(user_id, pos, nth)``.

    Only positions of the free ranges are generated: n rows per user and never
    the product of users and items. ``n`` may be a column of ``users``.
    """
    wanted = n if isinstance(n, Column) else F.lit(n)
    users = users.select("user_id", wanted.cast("bigint").alias("_n")).distinct()
    ranges = free_ranges(users, taken, size).join(users, "user_id").filter(F.col("before") < F.col("_n"))
    last = F.least(F.col("last_pos"), F.col("first_pos") - 1 + F.col("_n") - F.col("before"))
    return ranges.select(
        "user_id", "first_pos", "before", F.explode(F.sequence(F.col("first_pos"), last)).alias("pos")
    ).select("user_id", "pos", (F.col("before") + F.col("pos") - F.col("first_pos") + 1).alias("nth"))
