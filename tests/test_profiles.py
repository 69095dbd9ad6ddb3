from helpers import rows

from ratingloom.operators import content, features


def _tables(spark):
    ratings = [(1, 1, 5.0), (1, 2, 2.5), (2, 2, 1.0), (3, 9, 4.0), (None, 1, 5.0)]
    counts = [(1, "red", 2), (1, "car", 1), (2, "red", 3), (5, "blue", 1)]
    return spark.createDataFrame(ratings, "user_id bigint, item_id bigint, rating double"), spark.createDataFrame(counts, "item_id bigint, token string, cnt bigint")


def test_profiles_of_few_rated_items_do_not_shuffle_the_pairs(spark):
    ratings, bow = _tables(spark)
    for made in (content.user_profile(ratings, bow), content.weighted_user_features(ratings, bow)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert not any("Exchange hashpartitioning" in x and "token" in x for x in plan.split("\n"))


def test_profiles_are_weighted_sums(spark):
    ratings, bow = _tables(spark)
    got = {(r.user_id, r.token): round(r.weight, 4) for r in content.user_profile(ratings, bow).collect()}
    assert got == {(1, "red"): round(17.5 / 22.5, 4), (1, "car"): round(5 / 22.5, 4), (2, "red"): 1.0}
    features = content.weighted_user_features(ratings, bow).filter("user_id is not null")
    assert rows(features, "user_id", "token", "weight") == [(1, "car", 1.0), (1, "red", 3.5), (2, "red", 0.6)]
    assert content.weighted_user_features(ratings, bow).filter("user_id is null").count() == 2


def test_counting_tokens_moves_texts_and_no_tokens(spark):
    docs = spark.createDataFrame([(1, "red car red"), (2, "car"), (1, "red"), (3, None)], "item_id bigint, text string")
    counts = features.bag_of_words(docs, "item_id", "text")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.split("\n") if "Exchange" in x] and not [x for x in plan.split("\n") if "Exchange" in x and "token" in x]
    assert rows(counts, "item_id", "token", "cnt") == [(1, "car", 1), (1, "red", 3), (2, "car", 1)]
