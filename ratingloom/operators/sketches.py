"""Approximate distinct counts from sketches that are stored by day and merged for any range."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

LOG_SIZE = 12  # 2^12 registers: about 4 KB a sketch at most


def error_bound(log_size: int = LOG_SIZE, deviations: float = 3.0) -> float:
    """The relative error that is exceeded with a probability below 0.3 percent."""
    return deviations * 1.04 / math.sqrt(1 << log_size)


def daily_sketches(events: DataFrame, columns: list[str], log_size: int = LOG_SIZE) -> DataFrame:
    """``(day, <column>_sketch…)``: one row a day, built with map-side merging; null ids do not count."""
    parts = [F.hll_sketch_agg(F.col(c), F.lit(log_size)).alias(f"{c}_sketch") for c in columns]
    return events.groupBy(F.to_date("ts").alias("day")).agg(*parts)


def merged(sketches: DataFrame, columns: list[str], period: Column) -> DataFrame:
    """``(period, <column>_estimate…)``: distinct values of each period from the stored days alone."""
    parts = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).cast("bigint").alias(f"{c}_estimate") for c in columns]
    return sketches.groupBy(period.alias("period")).agg(*parts)


def checked(events: DataFrame, estimates: DataFrame, columns: list[str], period: Column, bound: float) -> DataFrame:
    """Exact counts of each period and whether the estimate is within the bound."""
    exact = events.groupBy(period.alias("period")).agg(*[F.count_distinct(c).alias(c) for c in columns])
    near = [
        (F.abs(F.col(f"{c}_estimate") - F.col(c)) <= F.greatest(F.lit(bound) * F.col(c), F.lit(1.0))).alias(f"{c}_within") for c in columns
    ]
    return exact.join(estimates, "period").select("period", *columns, *near)
