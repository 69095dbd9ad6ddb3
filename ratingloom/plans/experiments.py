"""Experiments: methods side by side, parameter grids, repeats, reports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratingloom.functions.numeric import snap
from ratingloom.operators import cf, cluster, content, hybrid, knn, learned, rules, sequence, strata, svd
from ratingloom.plans import metrics, split
from ratingloom.sources.durable import durable

Recommender = Callable[[DataFrame], DataFrame]

LIST_LENGTH = 30
HYBRID_LENGTH = 50


def evaluate(recommenders: dict[str, Recommender], ratings: DataFrame, threshold: float | None = None) -> DataFrame:
    """Hits of any recommenders on one leave-one-out split.

    A recommender is a function of the split ratings that returns ranked rows.
    """
    rated = split.leave_one_out(ratings, threshold=threshold)
    return metrics.compare({name: fit(rated) for name, fit in recommenders.items()}, rated)


def offline_comparison(ratings: DataFrame, bow: DataFrame, items: DataFrame, threshold: float | None = None) -> DataFrame:
    """Hits of memory-based CF, user-kNN, weighted profile and their mean hybrid."""
    rated = split.leave_one_out(ratings, threshold=threshold)
    train = rated.filter(~F.col("is_test"))
    memory = cf.memory_cf(rated, HYBRID_LENGTH)
    profile = content.weighted_profile(train, bow, items, HYBRID_LENGTH)
    methods = {
        "memory_cf": memory.filter(F.col("rank") <= LIST_LENGTH),
        "user_knn": knn.user_knn(rated, LIST_LENGTH),
        "weighted_profile": profile.filter(F.col("rank") <= LIST_LENGTH),
        "average_hybrid": hybrid.average_hybrid({"memory_cf": memory, "weighted_profile": profile}, LIST_LENGTH),
    }
    return metrics.compare(methods, rated)


def all_methods(
    ratings: DataFrame, events: DataFrame, bow: DataFrame, items: DataFrame, clusters: DataFrame, vectors: DataFrame,
    support: float, confidence: float, threshold: float | None = None, n: int = LIST_LENGTH,
) -> DataFrame:
    """Hits of every method on one leave-one-out split; ``events`` of held-out (user, item) pairs take part in no fit."""
    rated = durable(split.leave_one_out(ratings, threshold=threshold))
    train = durable(rated.filter(~F.col("is_test")))
    paths = durable(events.join(metrics.test_rows(rated), ["user_id", "item_id"], "left_anti"))
    mined = rules.association_rules(rules.frequent_itemsets(train, support), confidence)
    factors = svd.truncated_svd(train, 16)
    assigned, centers = cluster.user_clusters(train, vectors)
    methods = {
        "memory_cf": cf.memory_cf(rated, n),
        "svd": svd.factor_recs(factors.users, factors.items, train, n),
        "als": learned.latent_factor_recs(train, n),
        "ranking_factors": strata.ranking_recs(train, n),
        "user_knn": knn.user_knn(rated, n),
        "item_knn": knn.item_knn(train, bow, items, n, 5),
        "weighted_profile": content.weighted_profile(train, bow, items, n),
        "rules": rules.rule_recs(train, mined, n),
        "item_clusters_sampled": cluster.cluster_sample_recs(train, clusters, n),
        "item_clusters_popular": cluster.cluster_popular_recs(train, clusters, n),
        "user_clusters": cluster.user_cluster_recs(assigned, centers, train, vectors, n),
        "markov": sequence.markov_recs(paths, n),
        "trajectory": sequence.trajectory_recs(paths, vectors, n),
    }
    return metrics.compare(methods, rated)


def neighbor_grid(ratings: DataFrame, similarities: list[str], thresholds: list[float | None], n: int = LIST_LENGTH) -> DataFrame:
    """Hits of user-kNN for each similarity and each threshold of the test pick."""
    runs = []
    for threshold in thresholds:
        rated = split.leave_one_out(ratings, threshold=threshold)
        for metric in similarities:
            row = metrics.hit_rate(knn.user_knn(rated, n, metric=metric), rated)
            runs.append(
                row.select(
                    F.lit(metric).alias("metric"), F.lit(threshold).cast("double").alias("threshold"), "hits", "users", "rate"
                )
            )
    return reduce(DataFrame.unionByName, runs)


def item_neighbor_grid(
    ratings: DataFrame, bow: DataFrame, items: DataFrame, similarities: list[str], thresholds: list[float | None], k: int = 50, n: int = LIST_LENGTH
) -> DataFrame:
    """Hits of item-kNN for each distance and each threshold of the ratings."""
    runs = []
    for threshold in thresholds:
        rated = split.thresholded_leave_last_out(ratings, threshold)
        train = rated.filter(~F.col("is_test")).select("user_id", "item_id", "rating")
        for metric in similarities:
            row = metrics.hit_rate(knn.item_knn(train, bow, items, n, k, metric), rated)
            runs.append(
                row.select(
                    F.lit(metric).alias("metric"), F.lit(threshold).cast("double").alias("threshold"), "hits", "users", "rate"
                )
            )
    return reduce(DataFrame.unionByName, runs)


def repeated_sampling(ratings: DataFrame, clusters: DataFrame, repeats: int = 10, n: int = LIST_LENGTH) -> DataFrame:
    """Mean hits of cluster sampling over several seeds, all seeds in one plan."""
    rated = split.leave_one_out(ratings)
    train = rated.filter(~F.col("is_test"))
    users = train.select("user_id").distinct().withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    recs = cluster.cluster_sample_runs(train, clusters, users, n)
    hits = recs.join(metrics.test_rows(rated), ["user_id", "item_id"], "left_semi").groupBy("seed").agg(F.count("*").alias("h"))
    return hits.agg(snap(F.sum("h") / F.lit(repeats)).alias("mean_hits"))


def report(rated: DataFrame, recs: DataFrame, titles: DataFrame) -> DataFrame:
    """Rated, recommended and held-out titles of every user, one row each."""
    sections = [
        rated.filter(~F.col("is_test")).select("user_id", F.lit("rated").alias("section"), "item_id", F.col("rating").alias("score")),
        recs.select("user_id", F.lit("recommended").alias("section"), "item_id", F.col("rank").cast("double").alias("score")),
        rated.filter("is_test").select("user_id", F.lit("test").alias("section"), "item_id", F.col("rating").alias("score")),
    ]
    rows = reduce(DataFrame.unionByName, sections)
    return rows.join(titles.select("item_id", "title"), "item_id", "left").select(
        "user_id", "section", "item_id", F.coalesce("title", F.col("item_id").cast("string")).alias("title"), "score"
    )
