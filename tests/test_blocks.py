import numpy as np
import pytest
from helpers import rows, snap
from pyspark.sql import functions as F

from ratingloom.operators import blocks
from ratingloom.operators.blocks import Side, best, block_product, nonzero_cells
from ratingloom.operators.similarity import nearest, similarity_summary


@pytest.fixture(scope="module")
def sparse(spark):
    rng = np.random.default_rng(1)
    dense = np.where(rng.random((60, 90)) < 0.08, rng.integers(1, 5, (60, 90)), 0).astype(float)
    dense[:, 0] = 1.0  # a key every id has
    dense[3, :] = 2.0  # an id that has every key
    r, k = np.nonzero(dense)
    frame = spark.createDataFrame(
        [(int(a), int(b), float(dense[a, b])) for a, b in zip(r, k)], "id bigint, k bigint, value double"
    )
    return frame.persist(), dense


def _side(frame):
    members = frame.select("id").distinct().withColumn("aux", F.array(F.lit(0.0)))
    return Side(frame.select("k", "id", "value"), members)


@pytest.mark.parametrize("splits", [1, 3])
@pytest.mark.parametrize("symmetric", [False, True])
@pytest.mark.parametrize("small", [False, True])
def test_product_equals_dense(sparse, splits, symmetric, small, monkeypatch):
    frame, dense = sparse
    if small:  # many blocks, everything expanded pair by pair in small steps
        monkeypatch.setattr(blocks, "BLOCK", 16)
        monkeypatch.setattr(blocks, "DENSE_SHARE", 1)
        monkeypatch.setattr(blocks, "PAIRS_AT_ONCE", 50)
        monkeypatch.setattr(blocks, "SHARE", 2)
    s = _side(frame)
    out = block_product(
        s, s, nonzero_cells, "left_id bigint, right_id bigint, value double", symmetric=symmetric, splits=splits
    )
    want = dense @ dense.T
    got = np.zeros_like(want)
    for r in out.collect():
        assert got[r["left_id"], r["right_id"]] == 0
        got[r["left_id"], r["right_id"]] = r["value"]
    assert np.array_equal(got, want)


def test_best_matches_full_sort():
    rng = np.random.default_rng(2)
    score = rng.integers(0, 4, (20, 30)).astype(float)
    allowed = rng.random((20, 30)) < 0.7
    block = blocks.Block(score, np.arange(20), score, np.arange(30), score, allowed, score)
    out = best(score, allowed, block, 5, ("l", "r", "s"))
    for row in range(20):
        cols = np.flatnonzero(allowed[row])
        want = cols[np.lexsort((cols, -score[row, cols]))][:5]
        assert out[out.l == row].r.tolist() == want.tolist()


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_nearest_equals_brute_force(sparse, metric):
    frame, dense = sparse
    got = nearest(frame, "k", "id", "value", 4, metric, splits=2).collect()
    norm = np.linalg.norm(dense, axis=1)
    dots = dense @ dense.T
    if metric == "cosine":
        sim = dots / np.outer(norm, norm)
    else:
        d = np.sqrt(np.maximum(np.rint(norm**2)[:, None] + np.rint(norm**2) - 2 * dots, 0))
        sim = 1 / np.where(d == 0, 1e-6, d)
    np.fill_diagonal(sim, -1)
    for i in range(len(dense)):
        order = np.lexsort((np.arange(len(dense)), -snap(sim[i])))[:4]
        mine = sorted((r["rank"], r["other_id"]) for r in got if r["id"] == i)
        assert [o for _, o in mine] == order.tolist()


def test_ids_without_common_key_take_part(spark):
    frame = spark.createDataFrame([(1, 1, 1.0), (2, 2, 1.0), (3, 2, 1.0)], "id bigint, k bigint, value double")
    assert rows(nearest(frame, "k", "id", "value", 2), "id", "rank", "other_id", "similarity") == [
        (1, 1, 2, 0.0), (1, 2, 3, 0.0), (2, 1, 3, 1.0), (2, 2, 1, 0.0), (3, 1, 2, 1.0), (3, 2, 1, 0.0)
    ]


def test_summary(sparse):
    frame, dense = sparse
    norm = np.linalg.norm(dense, axis=1)
    sim = dense @ dense.T / np.outer(norm, norm)
    np.fill_diagonal(sim, 0)
    for r in similarity_summary(frame, "k", "id", "value").collect():
        assert r["n_similar"] == (sim[r["id"]] > 0).sum()
        assert abs(r["sim_sum"] - sim[r["id"]].sum()) < 2e-6
        assert abs(r["sim_max"] - sim[r["id"]].max()) < 2e-6


def test_partitions_do_not_change_the_result(spark, sparse):
    frame, _ = sparse
    before = rows(nearest(frame, "k", "id", "value", 3), "id", "rank", "other_id", "similarity")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(nearest(frame, "k", "id", "value", 3), "id", "rank", "other_id", "similarity") == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("symmetric", [False, True])
def test_pairs_of_a_key_in_all_rows_go_to_many_join_keys(spark, monkeypatch, symmetric):
    monkeypatch.setattr(blocks, "SHARE", 4)
    entries = spark.range(640).select(F.lit(1).cast("bigint").alias("k"), "id", F.lit(1.0).alias("value"))
    left, right = blocks._pack(entries, 40, "a"), blocks._pack(entries, 40, "b")
    pairs = blocks.pack_pairs(left, right, 40, symmetric)
    each = {(r.a, r.b): r.share for r in pairs.select("a", "b", "share").collect()}
    assert set(each) == {(a, b) for a in range(40) for b in range(40) if a <= b or not symmetric}
    assert pairs.count() == len(each) and len(set(each.values())) == 10  # ten tasks may share the work of one key
