"""Cluster-based recommenders over items and users."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ratingloom.functions.numeric import MODULUS, next_prime, seeded_hash, snap
from ratingloom.operators.blocks import Block, Side, block_product
from ratingloom.operators.features import in_vocabulary, spread
from ratingloom.operators.lists import ranked_lists, walk_lists
from ratingloom.operators.rank import exclude_seen, top_n
from ratingloom.sources.durable import durable
from ratingloom.sources.readers import first_values

TASK_ROWS = 50_000  # rows of a partition of an iterative fit; part of the model, as sums of doubles depend on them


def training_tasks(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Partitions of an iterative fit, from its rows and never from the cluster."""
    return max(1, -(-df.count() // rows))


def training_rows(df: DataFrame, *key: str) -> DataFrame:
    """Rows for an iterative fit, dealt by their key and sorted, so that neither the
    size of the cluster nor the order of arrival changes the model."""
    return df.repartition(training_tasks(df), *key).sortWithinPartitions(*key)


@F.pandas_udf(T.LongType())
def _next_prime(sizes: pd.Series) -> pd.Series:
    return sizes.map(next_prime)


def fit_kmeans(points: DataFrame, k: int, restarts: int = 10, max_iter: int = 500, seed: int = 0) -> KMeansModel:
    """K-means on a ``features`` vector column beside an id, the first column; the cheapest of several starts."""
    data = training_rows(points, points.columns[0]).select("features").persist()
    cores = points.sparkSession.sparkContext.defaultParallelism
    try:
        data.count()  # kept before the starts read it
        # a start has few tasks a step, so several starts run side by side; each is what it is alone
        with ThreadPoolExecutor(max(1, min(restarts, cores))) as pool:
            models = list(pool.map(lambda i: KMeans(k=k, seed=seed + i, maxIter=max_iter).fit(data), range(restarts)))
    finally:
        data.unpersist()
    return min(models, key=lambda m: m.summary.trainingCost)


def text_clusters(
    docs: DataFrame, text_tokens: Column, k: int, min_df: int = 3, restarts: int = 10, max_iter: int = 500, rounds: int = 2, seed: int = 0
) -> DataFrame:
    """``(item_id, cluster)`` by k-means on the counts of tokens that at least ``min_df`` items have.

    Seeds come from k-means||, steps run until no item changes its cluster (``max_iter`` is a guard), and the cheapest of
    several starts is kept. Everything is a table of (token, array): the centroids of all starts still moving lie side
    by side, so one join with the token counts serves all of them, and neither the
    vocabulary nor a centroid is ever on the driver or whole in a task. An item
    without a token is at the origin; an emptied cluster keeps its centroid.
    """
    words = spread(docs).select("item_id", F.explode(text_tokens).alias("token")).groupBy("item_id", "token").agg(F.count("*").alias("cnt"))
    counts = durable(in_vocabulary(words, min_df).withColumn("cnt", F.col("cnt").cast("double")))
    squares = counts.groupBy("item_id").agg(F.sum(F.col("cnt") * F.col("cnt")).alias("x"))
    items = docs.select("item_id").distinct().join(squares, "item_id", "left")
    items = durable(items.select("item_id", F.coalesce("x", F.lit(0.0)).alias("x")))
    if items.filter("x > 0").isEmpty():
        return items.select("item_id", F.lit(0).cast("bigint").alias("cluster"))
    starts = list(range(seed, seed + restarts))
    centroids = seed_centroids(counts, items, k, starts, rounds)
    return _lloyd(counts, items, centroids, k, restarts, max_iter)[1]


def _dots(counts: DataFrame, matrix: DataFrame, width: int) -> DataFrame:
    """(item_id, dots): products of each item with the ``width`` columns of ``matrix`` (token, w array)."""
    products = [F.sum(F.col("cnt") * F.col("w")[j]) for j in range(width)]
    return counts.join(matrix, "token").groupBy("item_id").agg(F.array(*products).alias("dots"))


def _lengths(matrix: DataFrame, width: int) -> list[float]:
    row = matrix.agg(*[F.sum(F.col("w")[j] * F.col("w")[j]).alias(f"q{j}") for j in range(width)]).first()
    return [q or 0.0 for q in row]


def _columns(entries: DataFrame, width: int) -> DataFrame:
    """(token, w) from entries (token, col, value): one array of ``width`` sums for each token."""
    parts = [F.sum(F.when(F.col("col") == j, F.col("value")).otherwise(0.0)) for j in range(width)]
    return entries.groupBy("token").agg(F.array(*parts).alias("w"))


def _distances(items: DataFrame, dots: DataFrame, lengths: list[float]) -> DataFrame:
    """``items`` with ``d``: squared distances to each column; an item without a common token has product 0."""
    q = F.array(*[F.lit(v) for v in lengths])
    products = F.coalesce("dots", F.array(*[F.lit(0.0)] * len(lengths)))
    apart = F.zip_with(products, q, lambda p, v: F.greatest(snap(F.col("x") + v - 2 * p), F.lit(0.0)))
    return items.join(dots, "item_id", "left").withColumn("d", apart).drop("dots")


def _nearest(first: int, columns: list[int]) -> Column:
    """(distance, place in ``columns``) of the nearest of some columns of ``d``, numbered from ``first``."""
    return F.array_min(F.array(*[F.struct(F.col("d")[j].alias("d"), F.lit(first + n).cast("bigint").alias("c")) for n, j in enumerate(columns)]))


def seed_centroids(counts: DataFrame, items: DataFrame, k: int, starts: list[int], rounds: int = 2) -> DataFrame:
    """(token, w) with k seeds for each start: k-means|| on tables.

    In every round each item becomes a candidate with a probability in proportion to its squared distance
    from the candidates so far, 2 k of them on average; candidates of all starts are measured by one join. Then a candidate
    weighs as many items as are nearest to it, and the driver clusters the weighted candidates by
    their dot products alone (about 2 k * rounds of them a start, whatever the input). Seeds are weighted means of candidates.
    """
    spark = counts.sparkSession
    kept: list[tuple[int, int]] = []  # candidates: start, item
    state: DataFrame | None = None
    full = items.filter("x > 0")
    new = []
    for s in starts:
        order = [seeded_hash(F.col("item_id"), F.lit(s), 29), F.col("item_id")]
        new.append((s, full.orderBy(*order).first().item_id))
    for turn in range(rounds + 1):
        chosen = spark.createDataFrame([(i, c) for c, (_, i) in enumerate(new)], "item_id bigint, col int")
        matrix = durable(_columns(counts.join(chosen, "item_id").select("token", "col", F.col("cnt").alias("value")), len(new)))
        measured = _distances(items, _dots(counts, matrix, len(new)), _lengths(matrix, len(new)))
        near = []
        for n, s in enumerate(starts):
            columns = [j for j, (t, _) in enumerate(new) if t == s]
            found = _nearest(len(kept) + columns[0], columns) if columns else F.lit(None)
            near.append((F.least(found, F.col(f"n{n}")) if state is not None and columns else found if columns else F.col(f"n{n}")).alias(f"n{n}"))
        old = measured if state is None else measured.join(state, "item_id")
        state = durable(old.select("item_id", *near))
        kept += new
        if turn == rounds:
            break
        totals = state.agg(*[F.sum(F.col(f"n{n}.d")).alias(f"t{n}") for n in range(len(starts))]).first()
        new = []
        for n, s in enumerate(starts):
            if totals[n]:
                chance = (seeded_hash(F.col("item_id"), F.lit(turn), s + 31) + F.lit(0.5)) / F.lit(float(MODULUS))
                drawn = state.filter(chance < F.lit(2.0 * k / totals[n]) * F.col(f"n{n}.d")).select("item_id")
                new += [(s, i) for (i,) in sorted(drawn.collect())]
        if not new:
            break
    chosen = spark.createDataFrame([(i, c) for c, (_, i) in enumerate(kept)], "item_id bigint, col int")
    entries = durable(counts.join(chosen, "item_id").select("token", "col", F.col("cnt").alias("value")))
    gram = np.zeros((len(kept), len(kept)))
    both = entries.join(entries.toDF("token", "other", "times"), "token").groupBy("col", "other").agg(F.sum(F.col("value") * F.col("times")).alias("g"))
    for r in both.collect():
        gram[r["col"], r.other] = r.g
    share: list[tuple[int, int, float]] = []  # candidate, seed, weight in it
    for n, s in enumerate(starts):
        own = [c for c, (t, _) in enumerate(kept) if t == s]
        weight = dict(map(tuple, state.groupBy(f"n{n}.c").count().collect()))
        w = np.array([weight.get(c, 0) for c in own], float)
        for c, group, part in zip(own, *_recluster(gram[np.ix_(own, own)], w, k, s), strict=True):
            if part > 0:
                share.append((c, n * k + group, part))
    shares = spark.createDataFrame(share, "col int, seed int, part double")
    means = entries.join(shares, "col").select("token", F.col("seed").alias("col"), (F.col("value") * F.col("part")).alias("value"))
    return durable(_columns(means, len(starts) * k))


def _recluster(gram: np.ndarray, weight: np.ndarray, k: int, seed: int) -> tuple[list[int], list[float]]:
    """Group of each weighted point and its share of the group's mean, from dot products alone.

    Greedy k-means++ seeds, then weighted steps to a fixed point.
    """
    r, n = np.random.default_rng(seed), len(gram)
    square = np.diag(gram)
    apart = np.maximum(square[:, None] + square - 2 * gram, 0)
    weight = np.where(weight.sum() > 0, weight, 1.0)
    picks = [int(r.choice(n, p=weight / weight.sum()))]
    nearest = apart[picks[0]]
    while len(picks) < k and (weight * nearest).sum() > 0:
        odds = weight * nearest
        tries = r.choice(n, 2 + int(np.log(k)), p=odds / odds.sum())
        best = min(tries.tolist(), key=lambda t: (weight * np.minimum(nearest, apart[t])).sum())
        picks.append(best)
        nearest = np.minimum(nearest, apart[best])
    group = apart[:, picks].argmin(1)
    for _ in range(100):
        member = np.equal.outer(np.arange(len(picks)), group) * weight
        total = member.sum(1, keepdims=True)
        member = np.divide(member, total, out=np.zeros_like(member), where=total > 0)
        inner = member @ gram
        distance = np.where(total > 0, (inner * member).sum(1, keepdims=True) - 2 * inner, np.inf)
        moved = distance.argmin(0)
        if (moved == group).all():
            break
        group = moved
    total = np.bincount(group, weight, minlength=k).tolist()
    return group.tolist(), [w / total[g] if total[g] else 0.0 for w, g in zip(weight.tolist(), group.tolist(), strict=True)]


def _lloyd(counts: DataFrame, items: DataFrame, centroids: DataFrame, k: int, starts: int, max_iter: int) -> tuple[float, DataFrame]:
    """Cost and clusters ``(item_id, cluster)`` of the cheapest start; all starts move together until each stands still."""
    moving = list(range(starts))
    before: dict[int, int] = {}
    best: tuple[float, DataFrame] | None = None
    for turn in range(max_iter):
        width = len(moving) * k
        measured = _distances(items, _dots(counts, centroids, width), _lengths(centroids, width))
        near = [_nearest(0, list(range(n * k, n * k + k))).alias(f"n{n}") for n in range(len(moving))]
        assigned = durable(measured.select("item_id", *near))
        told = []
        for n in range(len(moving)):
            told += [F.sum(f"n{n}.d").alias(f"cost{n}"), F.sum(F.xxhash64("item_id", f"n{n}.c").cast("decimal(38,0)")).alias(f"state{n}")]
            told += [F.count_if(F.col(f"n{n}.c") == c).alias(f"size{n}_{c}") for c in range(k)]
        seen = assigned.agg(*told).first()
        still = [n for n, s in enumerate(moving) if before.get(s) == seen[f"state{n}"] or turn == max_iter - 1]
        for n in still:
            if best is None or seen[f"cost{n}"] < best[0]:
                best = seen[f"cost{n}"], assigned.select("item_id", F.col(f"n{n}.c").alias("cluster"))
        go = [n for n in range(len(moving)) if n not in still]
        if not go:
            break
        before = {moving[n]: seen[f"state{n}"] for n in go}
        sizes = [[seen[f"size{n}_{c}"] for c in range(k)] for n in go]
        sums = counts.join(assigned, "item_id").groupBy("token").agg(
            F.array(*[F.sum(F.when(F.col(f"n{n}.c") == c, F.col("cnt")).otherwise(0.0)) for n in go for c in range(k)]).alias("s")
        )
        flat = [m for each in sizes for m in each]
        w = F.zip_with("s", F.array(*[F.lit(float(m or 1)) for m in flat]), lambda a, m: a / m)
        if 0 in flat:
            old = F.array(*[F.col("w")[n * k + c] if sizes[g][c] == 0 else F.lit(0.0) for g, n in enumerate(go) for c in range(k)])
            zero = F.array(*[F.lit(0.0)] * len(flat))
            w = F.zip_with(F.coalesce(w, zero), F.coalesce(old, zero), lambda a, o: a + o)
            sums = sums.join(centroids, "token", "full")
        centroids = durable(sums.select("token", w.alias("w")))
        moving = [moving[n] for n in go]
    return best


def item_clusters(items: DataFrame, k: int, restarts: int = 10) -> DataFrame:
    """``(item_id, cluster)`` from a ``vector array<double>`` column."""
    points = items.select("item_id", array_to_vector("vector").alias("features"))
    model = fit_kmeans(points, k, restarts)
    return model.transform(points).select("item_id", F.col("prediction").cast("bigint").alias("cluster"))


def item_popularity(items: DataFrame, metadata: DataFrame) -> DataFrame:
    """First known popularity of every item; an item without one stops the job."""
    first = first_values(metadata, "id", F.col("ord"), ["popularity"])
    joined = items.join(first, items.item_id == first.id, "left")
    missing = F.raise_error(F.concat(F.lit("no popularity for item "), F.col("item_id").cast("string")))
    return joined.select("item_id", F.when(F.col("popularity").isNull(), missing).otherwise(F.col("popularity")).alias("popularity"))


def cluster_scores(ratings: DataFrame, clusters: DataFrame) -> DataFrame:
    """Mean rating and count per (user, cluster), and the cluster's rank for the user."""
    scores = (
        ratings.join(clusters.select("item_id", "cluster"), "item_id")
        .groupBy("user_id", "cluster")
        .agg(F.avg("rating").alias("mean_rating"), F.count("*").alias("n_ratings"))
    )
    order = W.partitionBy("user_id").orderBy(F.col("mean_rating").desc(), F.col("n_ratings").desc(), F.col("cluster").asc())
    return scores.withColumn("rank", F.row_number().over(order).cast("bigint"))


def cluster_popularity(clusters: DataFrame) -> DataFrame:
    """Items of each cluster by popularity: ``(list_id, pos, item_id, popularity)``."""
    order = [F.col("popularity").desc(), F.col("item_id").asc()]
    return ranked_lists(clusters.select("cluster", "item_id", "popularity"), "cluster", order, ["item_id", "popularity"])


def cluster_popular_recs(ratings: DataFrame, clusters: DataFrame, n: int) -> DataFrame:
    """Best cluster first, most popular item first, next cluster when one is used up."""
    heads = cluster_scores(ratings, clusters).select(
        "user_id", F.col("cluster").alias("list_id"), F.col("rank").alias("list_rank"), F.col("mean_rating").alias("score")
    )
    return walk_lists(heads, cluster_popularity(clusters).select("list_id", "pos", "item_id"), ratings, n)


def cluster_probabilities(ratings: DataFrame, clusters: DataFrame, a: float = 1.0, b: float = 5.0) -> DataFrame:
    """Probability of each of a user's clusters, linear and exponential in the rating."""
    weights = (
        ratings.join(clusters.select("item_id", "cluster"), "item_id")
        .groupBy("user_id", "cluster")
        .agg(
            F.sum("rating").alias("lin"),
            F.sum(F.pow(F.lit(2.0), F.lit(a) + F.lit(b) * F.col("rating"))).alias("exp"),
            F.count("*").alias("rated"),
        )
    )
    totals = weights.groupBy("user_id").agg(F.sum("lin").alias("lin_all"), F.sum("exp").alias("exp_all"))
    return weights.join(totals, "user_id").select(
        "user_id",
        "cluster",
        "rated",
        snap(F.col("lin") / F.col("lin_all")).alias("p_linear"),
        snap(F.col("exp") / F.col("exp_all")).alias("p_exponential"),
    )


def cluster_sample_runs(ratings: DataFrame, clusters: DataFrame, runs: DataFrame, n: int, exponential: bool = False) -> DataFrame:
    """Unseen items of a user's clusters, sampled without replacement.

    ``runs(user_id, run)`` lists the seeds wanted per user; the result carries
    the seed. An item is drawn with weight ``P(cluster) / size(cluster)``. The
    items of one cluster have equal weights, so their exponential arrival times
    are generated in order and given to a seeded walk around the cluster's ring
    of items; n plus the user's rated items of that cluster are enough to find n
    unseen ones.
    """
    seeds = runs.select("user_id", F.col("run").cast("bigint").alias("seed")).distinct()
    probability = "p_exponential" if exponential else "p_linear"
    ring = ranked_lists(
        clusters.select("cluster", "item_id").withColumn("h", seeded_hash(F.col("item_id"), F.col("cluster"), 17)),
        "cluster",
        [F.col("h").asc(), F.col("item_id").asc()],
        ["item_id"],
    )
    sizes = ring.groupBy("list_id").agg(F.max("pos").alias("m"))
    # one row for each cluster: a walk goes around a ring of prime size and passes over places without an item
    sizes = durable(sizes.withColumn("p_size", _next_prime("m")))
    m, ring_size = F.col("m"), F.col("p_size")
    need = F.least(ring_size, F.lit(n) + F.col("rated") + ring_size - m)
    pair = seeded_hash(F.col("user_id"), F.col("list_id"), 5)
    stride = F.pmod(seeded_hash(F.col("list_id"), F.col("user_id"), F.col("seed") + 1), ring_size - 1) + 1
    uniform = (seeded_hash(pair, F.col("nth"), F.col("seed") + 3) + F.lit(0.5)) / F.lit(float(MODULUS))
    arrivals = (
        cluster_probabilities(ratings, clusters)
        .select("user_id", F.col("cluster").alias("list_id"), "rated", F.col(probability).alias("p"))
        .filter(F.col("p") > 0)
        .join(seeds, "user_id")
        .join(sizes, "list_id")
        .withColumn("offset", F.pmod(seeded_hash(F.col("user_id"), F.col("list_id"), F.col("seed")), ring_size))
        .withColumn("stride", stride)
        .withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), need - 1)))
        .withColumn("pos", F.pmod(F.col("offset") + F.col("step") * F.col("stride"), ring_size) + 1)
        .filter(F.col("pos") <= m)
        .withColumn("nth", F.row_number().over(W.partitionBy("user_id", "seed", "list_id").orderBy("step")) - 1)
        .withColumn("wait", -F.log(uniform) * m / ((m - F.col("nth")) * F.col("p")))
    )
    so_far = W.partitionBy("user_id", "seed", "list_id").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    timed = arrivals.withColumn("time", F.sum("wait").over(so_far)).join(ring, ["list_id", "pos"])
    order = W.partitionBy("user_id", "seed").orderBy(F.col("time").asc(), F.col("item_id").asc())
    drawn = exclude_seen(timed, ratings).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return drawn.select("user_id", "seed", "item_id", (-F.col("time")).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def cluster_sample_recs(ratings: DataFrame, clusters: DataFrame, n: int, seed: int = 0, exponential: bool = False) -> DataFrame:
    """One sample per user, see ``cluster_sample_runs``."""
    runs = ratings.select("user_id").distinct().withColumn("run", F.lit(seed))
    return cluster_sample_runs(ratings, clusters, runs, n, exponential).select("user_id", "item_id", "score", "rank")


def user_vectors(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Sum of item vectors weighted by rating/5, per user."""
    weighted = ratings.join(items.select("item_id", "vector"), "item_id").select(
        "user_id",
        array_to_vector(F.transform("vector", lambda x: x * F.col("rating") / F.lit(5.0))).alias("v"),
    )
    return weighted.groupBy("user_id").agg(Summarizer.sum(F.col("v")).alias("features"))


def user_clusters(ratings: DataFrame, items: DataFrame, k: int = 10, restarts: int = 10) -> tuple[DataFrame, DataFrame]:
    """``(user_id, cluster)`` and ``(cluster, centroid)``."""
    points = user_vectors(ratings, items)
    model = fit_kmeans(points, k, restarts)
    spark = ratings.sparkSession
    centers = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster bigint, centroid array<double>"
    )
    assigned = model.transform(points).select("user_id", F.col("prediction").cast("bigint").alias("cluster"))
    return assigned, centers


def centroid_distances(centers: DataFrame, items: DataFrame) -> DataFrame:
    """Squared distance of every item to each of the k centroids."""

    def reduce(block: Block) -> pd.DataFrame:
        left = (block.left_aux**2).sum(axis=1)[:, None]
        right = (block.right_aux**2).sum(axis=1)
        r, c = np.indices(block.sums.shape).reshape(2, -1)
        distance = np.maximum(left + right - 2 * block.sums, 0.0)
        return pd.DataFrame({"cluster": block.left[r], "item_id": block.right[c], "distance": distance[r, c]})

    left = Side(None, centers.select(F.col("cluster").alias("id"), F.col("centroid").alias("aux")))
    right = Side(None, items.select(F.col("item_id").alias("id"), F.col("vector").alias("aux")))
    found = block_product(left, right, reduce, "cluster bigint, item_id bigint, distance double", vectors=True)
    return found.withColumn("distance", snap(F.col("distance")))


def nearest_to_centroid(centers: DataFrame, items: DataFrame, n: int) -> DataFrame:
    return top_n(centroid_distances(centers, items), n, [F.col("distance").asc(), F.col("item_id").asc()], "cluster")


def label_centroids(items: DataFrame) -> DataFrame:
    """Mean vector per given label."""
    mean = items.groupBy("cluster").agg(Summarizer.mean(array_to_vector(F.col("vector"))).alias("m"))
    return mean.select("cluster", vector_to_array("m").alias("centroid"))


def user_cluster_recs(assigned: DataFrame, centers: DataFrame, ratings: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Unrated items closest to the centroid of the user's cluster."""
    ranked = ranked_lists(
        centroid_distances(centers, items), "cluster", [F.col("distance").asc(), F.col("item_id").asc()],
        ["item_id", (-F.col("distance")).alias("score")],
    )
    heads = assigned.select("user_id", F.col("cluster").alias("list_id"), F.lit(1).alias("list_rank"), F.lit(0.0).alias("score"))
    return walk_lists(heads, ranked, ratings, n)


def user_cluster_predict(assigned: DataFrame, centers: DataFrame, pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Mean of the non-zero products of centroid and item vector, times 5."""
    rows = pairs.join(assigned, "user_id").join(centers, "cluster").join(items.select("item_id", "vector"), "item_id")
    products = F.filter(F.zip_with("centroid", "vector", lambda x, y: x * y), lambda p: p != 0.0)
    total = F.aggregate(products, F.lit(0.0), lambda s, p: s + p)
    return rows.select(
        "user_id", "item_id", "rating", snap(total / F.nullif(F.size(products), F.lit(0)) * F.lit(5.0)).alias("predicted")
    )
