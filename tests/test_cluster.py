import numpy as np
import pytest
from helpers import check_recs, rows
from pyspark.sql import functions as F

from ratingloom.operators import cluster


@pytest.fixture(scope="module")
def clusters(spark):
    return spark.createDataFrame(
        [(i, i % 4, float((i * 7) % 5)) for i in range(1, 31)], "item_id bigint, cluster bigint, popularity double"
    ).persist()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centers = np.eye(4) * 5
    return spark.createDataFrame(
        [(i, [float(x) for x in centers[i % 4] + rng.normal(0, 0.1, 4)]) for i in range(1, 31)],
        "item_id bigint, vector array<double>",
    ).persist()


def test_popular_recs_equal_brute_force(random_ratings, clusters):
    frame, cells = random_ratings
    got = {}
    recs = cluster.cluster_popular_recs(frame, clusters, 9)
    for r in recs.collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"]))
    for u in {u for u, _ in cells}:
        mine = {}
        for (v, i), r in cells.items():
            if v == u:
                mine.setdefault(i % 4, []).append(r)
        order = sorted(mine, key=lambda c: (-np.mean(mine[c]), -len(mine[c]), c))
        want = []
        for c in order:
            items = sorted((i for i in range(1, 31) if i % 4 == c), key=lambda i: (-((i * 7) % 5), i))
            want += [i for i in items if (u, i) not in cells]
        assert [i for _, i in sorted(got.get(u, []))] == want[:9]
    check_recs(recs, set(cells), 9)


def test_probabilities_sum_to_one(random_ratings, clusters):
    p = cluster.cluster_probabilities(random_ratings[0], clusters)
    for r in p.groupBy("user_id").agg(F.sum("p_linear").alias("l"), F.sum("p_exponential").alias("e")).collect():
        assert abs(r["l"] - 1) < 1e-4 and abs(r["e"] - 1) < 1e-4


def test_sampling_stays_in_the_users_clusters(random_ratings, clusters):
    frame, cells = random_ratings
    recs = cluster.cluster_sample_recs(frame, clusters, 7, seed=4)
    per_user = check_recs(recs, set(cells), 7)
    for u, got in per_user.items():
        own = {i % 4 for v, i in cells if v == u}
        assert {i % 4 for _, i in got} <= own
        free = [i for i in range(1, 31) if i % 4 in own and (u, i) not in cells]
        assert len(got) == min(7, len(free))
    same = cluster.cluster_sample_recs(frame.repartition(9), clusters, 7, seed=4)
    assert rows(same, "user_id", "rank", "item_id") == rows(recs, "user_id", "rank", "item_id")
    other = cluster.cluster_sample_recs(frame, clusters, 7, seed=5)
    assert rows(other, "user_id", "rank", "item_id") != rows(recs, "user_id", "rank", "item_id")


def test_sampling_follows_the_cluster_weights(spark):
    """A user rated one item of cluster 0 with 4.0 and one of cluster 1 with 1.0."""
    items = spark.createDataFrame([(i, i % 2) for i in range(200)], "item_id bigint, cluster bigint")
    rated = spark.createDataFrame([(1, 0, 4.0), (1, 1, 1.0)], "user_id bigint, item_id bigint, rating double")
    runs = spark.range(800).selectExpr("1L as user_id", "id as run")
    first = cluster.cluster_sample_runs(rated, items, runs, 1)
    share = first.filter(F.col("item_id") % 2 == 0).count() / first.count()
    assert 0.74 < share < 0.86  # 4 of 5 first draws
    assert first.select("item_id").distinct().count() > 100


def test_kmeans_finds_the_groups(vectors):
    got = rows(cluster.item_clusters(vectors, 4, restarts=3), "item_id", "cluster")
    groups = {}
    for i, c in got:
        groups.setdefault(c, set()).add(i % 4)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == 4


def test_nearest_to_centroid(vectors):
    labeled = vectors.withColumn("cluster", F.col("item_id") % 4)
    got = cluster.nearest_to_centroid(cluster.label_centroids(labeled), labeled, 3).collect()
    data = {r["item_id"]: np.array(r["vector"]) for r in vectors.collect()}
    for c in range(4):
        center = np.mean([v for i, v in data.items() if i % 4 == c], axis=0)
        want = sorted(data, key=lambda i: ((data[i] - center) ** 2).sum())[:3]
        assert [r["item_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["cluster"] == c] == want


def test_user_clusters(random_ratings, vectors):
    frame, cells = random_ratings
    assigned, centers = cluster.user_clusters(frame, vectors, 3, restarts=2)
    recs = cluster.user_cluster_recs(assigned, centers, frame, vectors, 5)
    assert len(check_recs(recs, set(cells), 5)) == 40
    cell = {r["user_id"]: r["cluster"] for r in assigned.collect()}
    center = {r["cluster"]: np.array(r["centroid"]) for r in centers.collect()}
    data = {r["item_id"]: np.array(r["vector"]) for r in vectors.collect()}
    predicted = cluster.user_cluster_predict(assigned, centers, frame.limit(20), vectors).collect()
    for r in predicted:
        p = center[cell[r["user_id"]]] * data[r["item_id"]]
        assert r["predicted"] == pytest.approx(p[p != 0].mean() * 5, abs=1e-5)


def test_text_clusters_are_a_fixed_point_of_lloyd(spark):
    rng = np.random.default_rng(8)
    topics = [["sea", "ship", "sail"], ["bread", "oven", "flour"], ["star", "moon", "orbit"]]
    texts = [" ".join(rng.choice(topics[i % 3], 8)) + " the" for i in range(45)] + [""]
    docs = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    got = dict(rows(cluster.text_clusters(docs, F.split("text", " "), 3, 1, restarts=2), "item_id", "cluster"))
    vocabulary = sorted(set(" ".join(texts).split(" ")))
    x = np.array([[t.split(" ").count(w) for w in vocabulary] for t in texts], float)
    labels = np.array([got[i] for i in range(len(texts))])
    centres = {c: x[labels == c].mean(0) for c in set(labels)}
    distance = np.array([[((v - centres[c]) ** 2).sum() for c in sorted(centres)] for v in x])
    assert np.allclose(distance.min(1), [((v - centres[c]) ** 2).sum() for v, c in zip(x, labels)])
    assert len(centres) == 3


def test_every_text_its_own_cluster(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "a c"), (3, "a b")], "item_id bigint, text string")
    groups = dict(rows(cluster.text_clusters(docs, F.split("text", " "), 3, 1, restarts=1), "item_id", "cluster"))
    assert len(set(groups.values())) == 3


def test_text_cluster_cost_equals_that_of_the_library(spark):
    """On overlapping topics, where a poor start ends in a poor fixed point."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(12)
    words = np.array([f"w{i}" for i in range(60)])
    mix = rng.dirichlet(np.full(60, 0.08), 9)
    texts = [" ".join(rng.choice(words, int(rng.integers(5, 40)), p=mix[i % 9])) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    got = dict(rows(cluster.text_clusters(docs, F.split("text", " "), 7, 1, restarts=4), "item_id", "cluster"))
    x = np.array([[t.split(" ").count(w) for w in words] for t in texts], float)
    labels = np.array([got[i] for i in range(len(texts))])
    cost = sum(((x[labels == c] - x[labels == c].mean(0)) ** 2).sum() for c in set(labels))
    frame = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["features"]).coalesce(1).persist()
    library = min(KMeans(k=7, seed=s, maxIter=500, tol=0.0).fit(frame).summary.trainingCost for s in range(10))
    assert cost <= 1.01 * library
    again = dict(rows(cluster.text_clusters(docs.repartition(7), F.split("text", " "), 7, 1, restarts=4), "item_id", "cluster"))
    assert again == got


def test_reclustering_knows_only_products():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, (20, 3)) for c in (0, 4, 9)])
    weight = rng.integers(1, 5, 60).astype(float)
    group, share = cluster._recluster(x @ x.T, weight, 3, 0)
    assert sorted(len(set(group[a : a + 20])) for a in (0, 20, 40)) == [1, 1, 1] and len(set(group)) == 3
    assert np.allclose(np.bincount(group, share), 1)
    assert cluster._recluster(np.ones((4, 4)), np.zeros(4), 3, 0)[1] == [0.25] * 4  # equal points
