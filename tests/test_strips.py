import numpy as np
import pytest
from helpers import rows, snap
from pyspark.sql import functions as F

from ratingloom.operators import blocks, content, knn, strips
from ratingloom.operators.blocks import Side, block_product, nonzero_cells
from ratingloom.operators.similarity import nearest, nearest_between, similar_pairs, similarity_summary

CELLS = "left_id bigint, right_id bigint, value double"


@pytest.fixture
def many(monkeypatch):
    """Few ids count as many: what is multiplied goes through strips."""
    monkeypatch.setattr(blocks, "FEW", 0)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(strips, "STRIP_IDS", 20)


@pytest.fixture(scope="module", params=["bigint", "string"])
def sparse(spark, request):
    rng = np.random.default_rng(4)
    dense = np.where(rng.random((70, 90)) < 0.08, rng.integers(1, 5, (70, 90)) / 2, 0)
    dense[:, 0] = 1.0  # a key every id has
    dense[3, :] = 2.0  # an id that has every key
    r, k = np.nonzero(dense)
    frame = spark.createDataFrame([(int(a), int(b), float(dense[a, b])) for a, b in zip(r, k)], "id bigint, k bigint, value double")
    return frame.withColumn("k", F.col("k").cast(request.param)).persist(), dense


def _side(frame):
    return Side(frame.select("k", "id", "value"), frame.select("id").distinct().withColumn("aux", F.array(F.lit(0.0))))


@pytest.mark.parametrize("symmetric", [False, True])
def test_product_equals_dense(sparse, many, symmetric):
    frame, dense = sparse
    s = _side(frame)
    out = block_product(s, s, nonzero_cells, CELLS, symmetric=symmetric)
    want, got = dense @ dense.T, np.zeros((70, 70))
    for r in out.collect():
        assert got[r["left_id"], r["right_id"]] == 0
        got[r["left_id"], r["right_id"]] = r["value"]
    assert np.array_equal(got, want)


def test_no_entry_is_copied_to_the_blocks_it_meets(sparse, many):
    s = _side(sparse[0])
    plan = block_product(s, s, nonzero_cells, CELLS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_results_are_those_of_few_blocks(sparse, monkeypatch, metric):
    frame, _ = sparse

    def found():
        asked = frame.filter("id < 30 or value = 1")
        return [
            rows(nearest(frame, "k", "id", "value", 4, metric), "id", "rank", "other_id", "similarity"),
            rows(nearest_between(asked, frame, "k", "id", "value", 3, metric), "id", "rank", "other_id", "similarity"),
            rows(similar_pairs(frame, "k", "id", "value", 0.3, metric), "id", "other_id", "similarity"),
            rows(similarity_summary(frame, "k", "id", "value", metric), "id", "n_similar", "sim_sum", "sim_max"),
        ]

    before = found()
    monkeypatch.setattr(blocks, "FEW", 0)
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(strips, "STRIP_IDS", 20)
    assert found() == before


def test_null_ids_and_null_keys(spark, monkeypatch):
    frame = spark.createDataFrame([(1, 1, 1.0), (None, 1, 2.0), (3, None, 1.0), (4, 2, 2.0), (None, 2, 1.0)], "id bigint, k bigint, value double")
    wanted = {(r.id, r.other_id, r.similarity) for r in nearest(frame, "k", "id", "value", 9).collect()}
    monkeypatch.setattr(blocks, "FEW", 0)
    monkeypatch.setattr(blocks, "BLOCK", 1)
    assert {(r.id, r.other_id, r.similarity) for r in nearest(frame, "k", "id", "value", 9).collect()} == wanted


def test_long_and_short_items_give_the_same_profile_lists(spark, monkeypatch):
    """3,000 items in several blocks of a strip: short ones are passed over, the lists are those of all items."""
    rng = np.random.default_rng(6)
    long = rng.integers(1, 200, 3000)
    bow = spark.createDataFrame([(i, f"w{t}", int(n)) for i in range(3000) for t, n in zip(rng.choice(12, 3, False), rng.integers(1, 1 + long[i], 3))], "item_id bigint, token string, cnt bigint").persist()
    ratings = spark.createDataFrame([(u, int(i), float(r)) for u in range(30) for i, r in zip(rng.choice(3000, 8, False), rng.integers(1, 11, 8) / 2)], "user_id bigint, item_id bigint, rating double").persist()
    items = bow.select("item_id").distinct()
    wanted = rows(content.weighted_profile(ratings, bow, items, 5), "user_id", "rank", "item_id", "score")
    monkeypatch.setattr(blocks, "FEW", 1)
    assert rows(content.weighted_profile(ratings, bow, items, 5), "user_id", "rank", "item_id", "score") == wanted
    assert len(wanted) == 150


def test_blocks_too_short_for_the_bar_are_found():
    def sub(ids, norms, bar=None):
        out = object.__new__(strips._Sub)
        out.ids, out.norms, out.aux = np.array(ids), np.array(norms, float), np.ones((len(ids), 1))
        return out

    left, right = sub([1, 2], [2.0, 1.0]), sub([5, 6, 7], [3.0, 1.0, 4.0])
    reach = lambda aux, bar: bar * aux[:, 0]
    assert strips._long_enough(left, right, np.array([6.0, 3.0]), reach).tolist() == [True, False, True]
    assert strips._long_enough(left, right, np.array([6.0, -np.inf]), reach) is None
    assert not strips._long_enough(left, right, np.array([60.0, 30.0]), reach).any()


def test_snapped_scores_at_the_bar_stay():
    score = np.array([[0.5, 0.4999996, 0.4999994, 0.7]])
    block = blocks.Block(score, np.array([1]), score, np.array([1, 2, 3, 4]), score, score > 0, score, np.array([0.5]))
    assert blocks.best(score, score > 0, block, 3, ("l", "r", "s")).r.tolist() == [4, 1, 2]
    assert snap(0.4999996) == 0.5


def _block(entries, ids, aux, cells=((), ())):
    """A block of a strip from (key, place of the id, value)."""
    out = object.__new__(strips._Sub)
    out.ids, out.aux = np.arange(ids), np.asarray(aux, float).reshape(ids, 1)
    out.norms, out.top = np.ones(ids), 1.0
    key, out.at, out.vals = (np.array(c) for c in zip(*sorted(entries)))
    out.keys, out.counts = np.unique(key, return_counts=True)
    out.starts = np.cumsum(out.counts) - out.counts
    out.cell_ids, out.cell_vals = np.array(cells[0]), np.array(cells[1], float)
    out.cell_at = out.at
    return out


@pytest.mark.parametrize("metric", ["cosine", "minkowski"])
@pytest.mark.parametrize("k", [1, 3, 9])
def test_users_scored_together_and_one_by_one_agree(monkeypatch, metric, k):
    rng = np.random.default_rng(k)
    monkeypatch.setattr(knn, "ITEM_BLOCK", 7)
    rated = rng.random((30, 12)) < 0.5
    users, keys = np.nonzero(rated)
    norm = rng.integers(1, 9, 12)
    left = _block([(j, u, float(rng.integers(1, 11)) / 2) for u, j in zip(users, keys)], 30, np.zeros(30))
    left.cell_ids, left.cell_vals = np.sort(keys), norm[np.sort(keys)].astype(float)
    # item 0 is the same as rated item 0: distance 0
    right = _block([(j, i, float(norm[j] ** 2) if i == j == 0 else 1.0) for j in range(12) for i in range(20) if rng.random() < 0.6 or i == j == 0], 20, np.r_[norm[0], rng.integers(9, 20, 19)])
    together = knn.item_scores(left, right, k, metric)
    monkeypatch.setattr(knn, "DENSE_KEYS", 0)
    assert np.allclose(together, knn.item_scores(left, right, k, metric), atol=1e-12)


def test_item_knn_does_not_copy_products_to_user_blocks(spark):
    ratings = spark.createDataFrame([(1, 1, 5.0), (2, 2, 3.0)], "user_id bigint, item_id bigint, rating double")
    bow = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1)], "item_id bigint, token string, cnt bigint")
    recs = knn.item_knn(ratings, bow, bow.select("item_id"), 2, 2)
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "user_id" not in x]
    assert rows(recs, "user_id", "item_id", "score") == [(1, 2, 5.0), (1, 3, 5.0), (2, 1, 3.0), (2, 3, 3.0)]
