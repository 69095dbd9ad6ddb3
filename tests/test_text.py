from helpers import rows
from pyspark.sql import functions as F

from ratingloom.functions import text as X
from ratingloom.operators import features


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


def test_parse_literals(spark):
    assert one(spark, "[{'id': 1, 'name': 'A'}, {'id': 2, 'name': \"Child's Play\"}]", X.parse_names) == ["A", "Child's Play"]
    assert one(spark, "[{'id': None, 'name': 'B'}]", X.parse_names) == ["B"]
    assert one(spark, "[{'name': 'O\\'Hara'}]", X.parse_names) == ["O'Hara"]
    assert one(spark, "[]", X.parse_names) == []
    assert one(spark, None, X.parse_names) is None


def test_cleaners(spark):
    names = lambda c: X.clean_keywords(F.split(c, "\\|"))
    assert one(spark, "Love, Actually|true love|", names) == "love actually true"
    joined = lambda c: X.clean_elements(F.split(c, "\\|"))
    assert one(spark, "Tom O'Hanks|Science Fiction", joined) == "tomohanks sciencefiction"
    assert one(spark, "No overview found.", X.drop_placeholder) == ""
    assert one(spark, "No overview foundX", X.drop_placeholder) == "No overview foundX"


def test_word_degrees(spark):
    text = "Red car and the red car. A fast red car"
    df = spark.createDataFrame([(1, text), (2, None), (3, "the of and")], "id bigint, text string")
    got = rows(features.key_words(df, "id", F.col("text"), 7), "id", "rank", "word", "degree")
    # phrases: red car | red car | fast red car
    assert got == [(1, 1, "car", 7), (1, 2, "red", 7), (1, 3, "fast", 3)]


def test_adjacent_stopwords_and_limit(spark):
    df = spark.createDataFrame([(1, "alpha of the and beta beta gamma")], "id bigint, text string")
    got = rows(features.key_words(df, "id", F.col("text"), 2), "rank", "word", "degree")
    assert got == [(1, "beta", 6), (2, "gamma", 3)]


def test_tokens(spark):
    assert one(spark, "Éa b c3 x_y, Ünï", X.tokens) == ["éa", "c3", "x_y", "ünï"]


def test_vocabulary(spark):
    df = spark.createDataFrame([(1, "aa aa bb"), (2, "aa cc"), (3, "aa bb")], "id bigint, text string")
    bow = features.bag_of_words(df, "id", "text")
    assert rows(bow, "id", "token", "cnt") == [(1, "aa", 2), (1, "bb", 1), (2, "aa", 1), (2, "cc", 1), (3, "aa", 1), (3, "bb", 1)]
    assert rows(features.vocabulary(bow, 2), "token", "df") == [("aa", 3), ("bb", 2)]


def test_combined_features_skip_nulls(spark):
    merged = spark.createDataFrame(
        [(1, "t", 1.0, "No overview found.", None, "[{'name': 'k k'}]", None, "[{'name': 'Sci Fi'}]")],
        "id bigint, title string, popularity double, overview string, tagline string, keywords string, cast string, genres string",
    )
    assert features.combined_features(merged).first()["combined"] == "k scifi"
    assert features.combined_features(merged, unique=True).first()["combined"] == "k scifi"


def test_merged_metadata_takes_the_first_value_of_every_frame(spark):
    from ratingloom.operators import features

    meta = spark.createDataFrame([("1", 1, "T", 1.0, None, "tag", "[]"), ("1", 2, None, None, "the quick fox", None, None)], "id string, ord bigint, title string, popularity double, overview string, tagline string, genres string")
    lists = spark.createDataFrame([("1", 1, None), ("1", 2, "[{'name': 'One'}]"), ("1", 3, "[{'name': 'Two'}]"), ("x", 4, "[]")], "id string, ord bigint, v string")
    merged = features.merge_metadata(meta, lists.withColumnRenamed("v", "keywords"), lists.withColumnRenamed("v", "cast"))
    got = merged.collect()
    assert [(r.id, r.title, r.overview, r.keywords, r.cast) for r in got] == [(1, "T", "the quick fox", "[{'name': 'One'}]", "[{'name': 'One'}]")]
    assert features.key_words(merged, "id", merged.overview, 7).agg({"degree": "max"}).first()[0] == 2
