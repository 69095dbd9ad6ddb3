import pytest
from helpers import rows

from ratingloom.plans import metrics, split

COLUMNS = "user_id bigint, item_id bigint, rating double, ts bigint, event_id bigint"


@pytest.fixture(scope="module")
def low_raters(spark):
    data = [
        (1, 1, 2.0, 1, 1), (1, 2, 1.0, 2, 2),
        (2, 1, 5.0, 3, 3), (2, 2, 4.0, 4, 4), (2, 3, 3.0, 5, 5),
        (3, 1, 3.5, 6, 6), (3, 2, 3.5, 7, 7), (3, 3, 1.0, 8, 8),
    ]
    return spark.createDataFrame(data, COLUMNS)


def test_threshold_is_lowered_per_user(low_raters):
    assert rows(split.effective_thresholds(low_raters, 4.0), "user_id", "effective") == [(1, 2.0), (2, 4.0), (3, 3.5)]
    got = rows(split.positive_ratings(low_raters, 4.0), "user_id", "item_id")
    assert got == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2)]


def test_threshold_for_two_rows(low_raters):
    assert rows(split.effective_thresholds(low_raters, 4.0, 2), "user_id", "effective") == [(1, 1.0), (2, 4.0), (3, 3.5)]


def test_threshold_between_steps(spark):
    df = spark.createDataFrame([(1, 1, 3.2, 1, 1)], COLUMNS)
    assert rows(split.effective_thresholds(df, 4.0), "user_id", "effective") == [(1, 3.0)]


def test_leave_one_out(low_raters):
    newest = split.leave_one_out(low_raters)
    assert rows(metrics.test_rows(newest), "user_id", "item_id") == [(1, 2), (2, 3), (3, 3)]
    positive = split.leave_one_out(low_raters, threshold=4.0)
    assert rows(metrics.test_rows(positive), "user_id", "item_id") == [(1, 1), (2, 2), (3, 2)]
    # the threshold limits the test pick only
    assert positive.count() == low_raters.count()


def test_leave_last_out_drops_low_ratings(low_raters):
    got = rows(split.thresholded_leave_last_out(low_raters, 4.0), "user_id", "item_id", "is_test")
    assert got == [(1, 1, False), (1, 2, True), (2, 1, False), (2, 2, True), (3, 1, False), (3, 2, True)]


def test_random_pick_is_seeded(low_raters):
    first = rows(split.random_pick(low_raters), "user_id", "item_id")
    assert first == rows(split.random_pick(low_raters.repartition(7)), "user_id", "item_id")
    assert len(first) == 3
    assert len({tuple(rows(split.random_pick(low_raters, s), "user_id", "item_id")) for s in range(6)}) > 1


def test_random_split_share(spark):
    df = spark.range(20000).selectExpr("id % 300 as user_id", "id as item_id", "1.0D as rating")
    share = split.random_split(df).filter("is_test").count() / 20000
    assert 0.18 < share < 0.22


def test_hits(spark, low_raters):
    rated = split.leave_one_out(low_raters)
    recs = spark.createDataFrame([(1, 2), (2, 9), (3, 2)], "user_id bigint, item_id bigint")
    assert metrics.hit_rate(recs, rated).first().asDict() == {"hits": 1, "users": 3, "rate": 0.333333}
    both = metrics.compare({"a": recs, "b": recs.limit(0)}, rated)
    assert rows(both, "method", "hits") == [("a", 1), ("b", 0)]


def test_scaled_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "rating double, predicted double")
    assert metrics.scaled_mse(df).first()["mse"] == 0.5  # constant predictions scale to 0
    df = spark.createDataFrame([(1.0, 10.0), (3.0, 30.0), (5.0, 20.0)], "rating double, predicted double")
    assert metrics.scaled_mse(df).first()["mse"] == pytest.approx((0 + 0.25 + 0.25) / 3, abs=1e-6)
