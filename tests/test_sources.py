import pytest
from helpers import rows
from pyspark.sql import functions as F

from ratingloom.operators.cluster import item_popularity
from ratingloom.sources import readers, sinks, tables
from ratingloom.sources.durable import durable, shared_folder


def test_csv_ratings_and_roles(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text("userId,movieId,rating,timestamp\n1,31,2.5,1260759144\n1,1029,3.0,1260759179\n")
    df = readers.read_ratings(spark, str(path))
    assert rows(df, "user_id", "item_id", "rating", "ts") == [(1, 31, 2.5, 1260759144), (1, 1029, 3.0, 1260759179)]
    other = readers.ColumnRoles(user="u", item="i", rating="r", ts="t")
    df.toDF("u", "i", "r", "t").write.parquet(str(tmp_path / "p"))
    assert rows(readers.read_ratings(spark, str(tmp_path / "p"), "parquet", other), "user_id", "rating") == [(1, 2.5), (1, 3.0)]


def test_csv_metadata_with_quotes_and_lines(spark, tmp_path):
    path = tmp_path / "meta.csv"
    path.write_text('id,title\n1,"A ""quoted""\ntitle"\n1997-08-20,bad\n')
    df = readers.read_metadata(spark, str(path), ["id", "title"])
    assert rows(readers.clean_ids(df), "id", "title") == [(1, 'A "quoted"\ntitle')]


def test_outer_join_and_first_values(spark):
    a = spark.createDataFrame([(1, "x", 2), (1, None, 1), (2, "y", 1)], "id bigint, c string, ord int")
    assert rows(readers.first_values(a, "id", F.col("ord"), ["c"]), "id", "c") == [(1, "x"), (2, "y")]
    assert rows(readers.keep_first(a, "id", F.col("ord")), "id", "ord") == [(1, 1), (2, 1)]
    b = spark.createDataFrame([(2, "b"), (3, "c")], "id bigint, d string")
    c = spark.createDataFrame([(4, "e")], "id bigint, e string")
    joined = readers.outer_join_all([a.filter("ord = 1").drop("ord"), b, c])
    assert sorted(r["id"] for r in joined.collect()) == [1, 2, 3, 4]


def test_latest_rating_wins(spark):
    events = spark.createDataFrame(
        [(1, 5, 4.0, 10, 1), (1, 5, 1.0, 20, 2), (1, 5, 3.0, 20, 1)], "user_id bigint, item_id bigint, rating double, ts bigint, event_id bigint"
    )
    assert rows(tables.latest_ratings(events), "user_id", "item_id", "rating", "event_id") == [(1, 5, 1.0, 2)]


def test_sink_policy(spark, tmp_path):
    path = str(tmp_path / "features")
    sinks.save_features(spark.range(3), path)
    sinks.save_features(spark.range(5), path)
    assert sinks.load_features(spark, path).count() == 3
    sinks.save_features(spark.range(5), path, override=True)
    assert sinks.load_features(spark, path).count() == 5
    sinks.save_model({"users": spark.range(2), "items": spark.range(4)}, str(tmp_path / "m"))
    assert {k: v.count() for k, v in sinks.load_model(spark, str(tmp_path / "m"), ["users", "items"]).items()} == {"users": 2, "items": 4}


def test_durable_copies_once(spark):
    df = durable(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    assert shared_folder(spark) in df.inputFiles()[0]
    assert shared_folder(spark) == shared_folder(spark)


def test_popularity_guard(spark):
    meta = spark.createDataFrame([(1, 5.0, 2), (1, 4.0, 1), (2, None, 1)], "id bigint, popularity double, ord int")
    items = spark.createDataFrame([(1,)], "item_id bigint")
    assert rows(item_popularity(items, meta), "item_id", "popularity") == [(1, 4.0)]
    with pytest.raises(Exception, match="no popularity for item"):
        item_popularity(items.union(spark.createDataFrame([(9,)], "item_id bigint")), meta).collect()


def test_views_and_build_once(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "four.parquet"))
    readers.register_tables(spark, str(tmp_path), ["four"])
    assert spark.sql("SELECT count(*) AS c FROM four").first()["c"] == 4
    calls = []

    def build():
        calls.append(1)
        return spark.range(6)

    path = str(tmp_path / "clean")
    assert sinks.build_once(spark, path, build).count() == 6
    assert sinks.build_once(spark, path, build).count() == 6
    assert len(calls) == 1
