import threading
from types import SimpleNamespace

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ratingloom.operators import cluster, strata


def _trained(monkeypatch, table):
    monkeypatch.setattr(strata, "PAIR_TABLE", table)
    rng = np.random.default_rng(2)
    row, column = np.nonzero(rng.random((40, 15)) < 0.5)
    s = strata.Stratum(rng.random((40, 4)), rng.random((15, 4)), row, column, rng.random(len(row)), np.random.default_rng(3))
    order, step = s.random.permutation(len(row)), strata.pairwise_step()
    for a in range(0, len(order), 32):
        step(s, order[a : a + 32], 0.1)
    return s


def test_examples_are_found_in_a_table_and_by_search_alike(monkeypatch):
    found, searched = _trained(monkeypatch, 10_000), _trained(monkeypatch, 0)
    assert found.table.sum() == len(searched.known) and searched.table is None
    assert np.array_equal(found.rows, searched.rows) and np.array_equal(found.columns, searched.columns)


def test_changes_of_an_id_add_up_over_the_root_of_their_number():
    table = np.zeros((4, 2))
    strata._add(table, np.array([2, 0, 2, 2]), np.array([[1.0, 2], [5, 5], [3, 4], [5, 6]]))
    strata._add(table, np.empty(0, np.int64), np.empty((0, 2)))
    assert np.allclose(table, [[5, 5], [0, 0], [9 / np.sqrt(3), 12 / np.sqrt(3)], [0, 0]])


def test_starts_of_kmeans_run_side_by_side_and_the_first_of_the_cheapest_is_kept(spark, monkeypatch):
    met = threading.Barrier(2)

    class Start:
        def __init__(self, k, seed, maxIter):
            self.seed = seed

        def fit(self, data):
            met.wait(60)  # breaks if the other start waits for this one
            return SimpleNamespace(seed=self.seed, summary=SimpleNamespace(trainingCost=1.0))

    monkeypatch.setattr(cluster, "KMeans", Start)
    points = spark.range(4).select("id", array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    assert cluster.fit_kmeans(points, 2, restarts=2, seed=5).seed == 5
