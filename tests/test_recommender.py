import pytest
from helpers import check_recs, rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from ratingloom.operators import features, recommender, sketches
from ratingloom.sources import sinks


@pytest.mark.parametrize("method", recommender.METHODS)
def test_fit_save_load_score(random_ratings, tmp_path, method):
    frame, cells = random_ratings
    model = recommender.FactorRecommender(method=method, rank=4).fit(frame)
    model.write().overwrite().save(str(tmp_path / method))
    again = recommender.FactorModel.load(str(tmp_path / method))
    assert again.uid == model.uid and again.getOrDefault("method") == method
    pairs = frame.select("user_id", "item_id").limit(30)
    assert rows(again.transform(pairs), "user_id", "item_id", "prediction") == rows(model.transform(pairs), "user_id", "item_id", "prediction")
    assert len(check_recs(again.recommend(frame, 3), set(cells), 3)) >= 38
    other = pairs.sparkSession.createDataFrame([(1, 999), (None, 1)], "user_id bigint, item_id bigint")
    assert [r.prediction for r in again.transform(other).collect()] == [None, None]


def test_parameter_search_and_copies(random_ratings, tmp_path):
    frame, _ = random_ratings
    estimator = recommender.FactorRecommender(method="svd")
    grid = ParamGridBuilder().addGrid(estimator.rank, [1, 20]).build()
    judge = RegressionEvaluator(labelCol="rating", predictionCol="prediction")
    scored = [judge.evaluate(estimator.fit(frame, g).transform(frame)) for g in grid]
    assert scored[1] < scored[0]  # more factors reconstruct what was fitted better
    search = TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid, evaluator=judge, trainRatio=0.95, seed=1)
    assert search.fit(frame).bestModel.users.count() > 0
    estimator.write().overwrite().save(str(tmp_path / "e"))
    assert recommender.FactorRecommender.load(str(tmp_path / "e")).getOrDefault("method") == "svd"
    with pytest.raises(ValueError, match="unknown method"):
        recommender.FactorRecommender(method="x").fit(frame)


def test_sketches_merge_to_any_range(spark):
    events = spark.range(40_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 200).alias("ts"), (F.col("id") % 9000).alias("user_id"), (F.col("id") % 3).alias("item_id")
    )
    ids = ["user_id", "item_id"]
    stored = sketches.daily_sketches(events, ids)
    for period in (F.lit("all"), F.date_format("day", "yyyy-MM")):
        merged = sketches.merged(stored, ids, period)
        match = F.lit("all") if merged.count() == 1 else F.date_format("ts", "yyyy-MM")
        got = sketches.checked(events, merged, ids, match, sketches.error_bound()).collect()
        assert got and all(r.user_id_within and r.item_id_within and r.item_id == 3 for r in got)
    assert sketches.merged(sketches.daily_sketches(events.limit(0), ids), ids, F.lit("all")).count() == 0


def test_bucketed_tables_are_joined_without_a_shuffle(spark, random_ratings, tmp_path):
    frame, cells = random_ratings
    one = sinks.save_bucketed(frame.select("user_id", "item_id"), "bucketed_one", "user_id", 4, str(tmp_path))
    two = sinks.save_bucketed(frame.groupBy("user_id").agg(F.count("*").alias("c")), "bucketed_two", "user_id", 4, str(tmp_path))
    joined = one.hint("merge").join(two, "user_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == len(cells)
    spark.sql("DROP TABLE bucketed_one")
    spark.sql("DROP TABLE bucketed_two")


def test_hashed_vectors_add_up(spark):
    bow = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 4), (2, "b", 2), (3, "c", 1)], "item_id bigint, token string, cnt bigint")
    items = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "item_id bigint")
    got = dict(rows(features.hashed_vectors(items, bow, 16), "item_id", "vector"))
    assert got[1] == pytest.approx(got[2]) and got[4] == [0.0] * 16
    assert all(sum(x * x for x in got[i]) == pytest.approx(1) for i in (1, 2, 3))
