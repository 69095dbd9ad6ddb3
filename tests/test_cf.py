import numpy as np
import pytest
from helpers import check_recs, matrix, snap

from ratingloom.operators import cf
from ratingloom.plans import split


@pytest.fixture(scope="module")
def folds(random_ratings):
    """The split, and per user what one refit with its test row removed gives."""
    frame, cells = random_ratings
    users, items = sorted({u for u, _ in cells}), sorted({i for _, i in cells})
    rated = split.leave_one_out(frame).persist()
    test = {r["user_id"]: r["item_id"] for r in rated.filter("is_test").collect()}
    full = matrix(cells, users, items)
    out = {}
    for x, u in enumerate(users):
        fold = full.copy()
        fold[x, items.index(test[u])] = 0
        norm = np.linalg.norm(fold, axis=1)
        out[u] = (fold, fold @ fold[x] / (norm * norm[x]), x)
    return rated, test, users, items, out


def test_recommendations_equal_refitting_every_fold(folds):
    rated, _, users, items, refits = folds
    got = {}
    for r in cf.memory_cf(rated, 8).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"], r["score"]))
    for u in users:
        fold, sim, x = refits[u]
        others = np.arange(len(users)) != x
        score = snap(sim[others] @ fold[others] / (sim[others].sum() + 1e-6))
        free = np.flatnonzero(fold[x] == 0)
        want = free[np.lexsort((free, -score[free]))][:8]
        assert [items[w] for w in want] == [i for _, i, _ in sorted(got.get(u, []))], u
        assert np.allclose([s for _, _, s in sorted(got.get(u, []))], score[want], atol=2e-6)


@pytest.mark.parametrize("top_k", [0, 6])
def test_predictions_equal_refitting_every_fold(folds, top_k):
    rated, test, users, items, refits = folds
    got = {r["user_id"]: r["predicted"] for r in cf.memory_cf_predict(rated, top_k).collect()}
    for u in users:
        fold, sim, x = refits[u]
        column = fold[:, items.index(test[u])]
        if top_k:
            keep = np.lexsort((np.arange(len(users)), -snap(sim)))[:top_k]
            sim, column = sim[keep], column[keep]
        want = sim @ column / (sim[column != 0].sum() + 1e-6)
        assert got[u] == pytest.approx(want, abs=1e-5), u


def test_no_holdout_recommends_unrated_only(random_ratings):
    frame, cells = random_ratings
    per_user = check_recs(cf.memory_cf(frame, 5), set(cells), 5)
    assert len(per_user) == 40


def test_any_recommender_can_be_evaluated(random_ratings):
    from ratingloom.plans import experiments

    table = experiments.evaluate(
        {"three": lambda rated: cf.memory_cf(rated, 3), "all": lambda rated: cf.memory_cf(rated, 25)}, random_ratings[0]
    )
    rows = {r["method"]: r for r in table.collect()}
    assert rows["all"]["hits"] == rows["all"]["users"] == 40
    assert rows["three"]["hits"] < 40
