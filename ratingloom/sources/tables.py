"""The rating, item and raw-metadata views over a folder of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.functions.text import NO_OVERVIEW


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rating_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every rating event; an item may be rated again by the same user."""
    half_steps = F.ceil(F.col("value") / F.lit(12.5)).cast("double") * F.lit(0.5)
    return table(spark, folder, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.least(F.lit(5.0), F.greatest(F.lit(0.5), half_steps)).alias("rating"),
        "ts",
        "event_id",
    )


def latest_ratings(events: DataFrame) -> DataFrame:
    """One row per (user, item): the newest event wins."""
    newest = F.struct("ts", "event_id")
    return events.groupBy("user_id", "item_id").agg(
        F.max_by("rating", newest).alias("rating"),
        F.max("ts").alias("ts"),
        F.max_by("event_id", newest).alias("event_id"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return latest_ratings(rating_events(spark, folder))


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """A larger rating table: what a customer ordered, quantity as the rating."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    rating = F.ceil(F.col("l_quantity") / F.lit(5.0)).cast("double") * F.lit(0.5)
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.max(rating).alias("rating"))
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Every part and every document as an item; one may be without the other."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("item_id"), "text", "lang", "source"
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_size").cast("double").alias("popularity"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
    )
    return docs.join(parts, "item_id", "full")


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Given item clusters with the popularity of the item."""
    labels = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("label").cast("bigint").alias("cluster")
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_size").cast("double").alias("popularity")
    )
    return labels.join(parts, "item_id")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label").cast("bigint").alias("cluster"),
    )


def raw_metadata(spark: SparkSession, folder: str, repeated: bool = False) -> dict[str, DataFrame]:
    """Three dirty metadata frames on a string id.

    The ids do not line up (parts, documents and embeddings cover different
    ranges), some are dates, some rows come twice with an empty overview, and
    the list columns are literals with both kinds of quotes. With ``repeated``, some
    ids of the key words and credits come twice too, first with null or other lists.
    """
    part = table(spark, folder, "part")
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    described = (
        part.join(docs, part.p_partkey == docs.doc_id, "left")
        .join(labels, "doc_id", "left")
        .select(
            F.when(
                F.col("p_brand") == "Brand#13",
                F.concat(F.lit("1997-08-"), F.lpad(F.col("p_size").cast("string"), 2, "0")),
            )
            .otherwise(F.col("p_partkey").cast("string"))
            .alias("id"),
            F.col("p_partkey").alias("ord"),
            F.col("p_size").alias("size"),
            F.col("p_name").alias("title"),
            F.col("p_size").cast("double").alias("popularity"),
            F.when(F.col("quality") == 0, F.lit(NO_OVERVIEW)).otherwise(F.col("text")).alias("overview"),
            F.concat_ws(" ", F.lit("The"), "p_name", F.lit("of the"), "p_type", F.lit("kind by"), "p_brand").alias(
                "tagline"
            ),
            F.concat(
                F.lit("[{'id': "),
                F.when(F.col("p_size") < 10, F.lit("None")).otherwise(F.col("p_size").cast("string")),
                F.lit(", 'name': '"),
                F.col("p_type"),
                F.lit("'}, {'id': 0, 'name': '"),
                F.col("p_brand"),
                F.lit("'}]"),
            ).alias("genres"),
        )
    )
    emptied = described.filter(F.col("size") > 45).select(
        "id",
        (F.col("ord") - F.lit(1000000000)).alias("ord"),
        "size",
        "title",
        "popularity",
        F.lit(None).cast("string").alias("overview"),
        "tagline",
        "genres",
    )
    meta = described.unionByName(emptied).drop("size")
    keywords = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        (F.col("vec_id") * 2 + 1).alias("ord"),
        F.concat(
            F.lit("[{'id': "),
            F.col("label").cast("string"),
            F.lit(", 'name': 'Group "),
            F.col("label").cast("string"),
            F.lit(", a group'}, {'id': 7, 'name': \"Vector's Group\"}]"),
        ).alias("keywords"),
    )
    cast = docs.select(
        F.col("doc_id").cast("string").alias("id"),
        (F.col("doc_id") * 2 + 1).alias("ord"),
        F.when(F.col("n_chars") < 100, F.lit("[]"))
        .otherwise(
            F.concat(
                F.lit("[{'cast_id': 1, 'name': \"O'"),
                F.col("source"),
                F.lit(" Senior\"}, {'cast_id': None, 'name': 'Lang "),
                F.col("lang"),
                F.lit("'}]"),
            )
        )
        .alias("cast"),
    )
    if repeated:
        even = F.col("ord") % 4 == 1
        early = F.when(even, F.lit("[{'id': 1, 'name': 'Early'}]"))
        keywords = keywords.union(keywords.filter("ord % 10 = 1").select("id", F.col("ord") - 1, early))
        cast = cast.union(cast.filter("ord % 14 = 1").select("id", F.col("ord") - 1, F.when(even, F.lit("[]"))))
    return {"meta": meta, "keywords": keywords, "credits": cast}
