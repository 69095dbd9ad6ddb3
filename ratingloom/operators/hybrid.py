"""Combining the ranked lists of several methods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ratingloom.functions.numeric import snap
from ratingloom.operators.rank import top_n


def union_methods(methods: dict[str, DataFrame]) -> DataFrame:
    """Ranked lists of all methods with the method name and its 0-based place."""
    tagged = [
        recs.select("user_id", "item_id", "rank", F.lit(name).alias("method"), F.lit(i).cast("bigint").alias("method_no"))
        for i, (name, recs) in enumerate(methods.items())
    ]
    return reduce(DataFrame.unionByName, tagged)


def average_hybrid(methods: dict[str, DataFrame], n: int) -> DataFrame:
    """Items by their mean place over the lists that contain them, smallest first."""
    lists = union_methods(methods)
    mean = lists.groupBy("user_id", "item_id").agg(snap(F.avg(F.col("rank") - 1)).alias("score"))
    return top_n(mean, n, [F.col("score").asc(), F.col("item_id").asc()]).select("user_id", "item_id", "score", "rank")


def predicate_hybrid(methods: dict[str, DataFrame], route: Column, n: int) -> DataFrame:
    """Each item from the method its route names; the lists are taken in turn.

    ``route`` is an expression over ``user_id`` and ``item_id`` that gives the
    number of a method. An item keeps its first place.
    """
    lists = union_methods(methods).filter(F.col("method_no") == route)
    # places after filtering; a list is at most as long as the method's top list
    place = F.row_number().over(W.partitionBy("user_id", "method_no").orderBy("rank"))
    replaced = lists.withColumn("rank", place.cast("bigint"))
    first = replaced.groupBy("user_id", "item_id").agg(F.min(F.struct("rank", "method_no")).alias("p"))
    order = [F.col("p.rank").asc(), F.col("p.method_no").asc()]
    return top_n(first, n, order).select(
        "user_id", "item_id", F.col("p.rank").cast("double").alias("score"), "rank"
    )
