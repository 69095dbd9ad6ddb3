"""Item features from raw metadata: cleaned columns, key words, combined text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions import text as X
from ratingloom.operators.rank import top_n
from ratingloom.sources.readers import clean_ids, first_values, outer_join_all

FEATURES = ["overview", "tagline", "keywords", "cast", "genres"]


TASK_BYTES = 1 << 20  # of a small table that one task should read
TASK_TEXT = 32 << 20  # of a large table that one task should count
UNKNOWN_BYTES = 1 << 46  # a plan of that size is one whose size Spark does not know
SPLIT_BYTES = 128 << 20  # a table of more than this for each core is split by its files alone


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small table dealt to all cores before they are worked on.

    A file is split between row groups only, so a table in one group would be tokenised by one task. A large table
    has tasks enough and is not moved. Results do not depend on it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df if size > cores * SPLIT_BYTES else df.repartition(max(1, min(cores, -(-size // TASK_BYTES))))


def by_id(df: DataFrame, ident: str) -> DataFrame:
    """All rows of an id in one of about as many tasks as the cores and the bytes ask for."""
    spark = df.sparkSession
    # of the tables that are read: the estimate of a join is the product of its sides
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    usual = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_size = size // TASK_TEXT if size < UNKNOWN_BYTES else 0
    return df.repartition(max(1, min(usual, -(-size // TASK_BYTES)), by_size), ident)


def merge_metadata(meta: DataFrame, keywords: DataFrame, credits: DataFrame) -> DataFrame:
    """One row per digit-only id: the first non-null value of every column of each frame, in
    the order of its ``ord``, then a full outer join."""
    frames = [
        (meta, ("title", "popularity", "overview", "tagline", "genres")),
        (keywords, ("keywords",)),
        (credits, ("cast",)),
    ]
    return outer_join_all([first_values(clean_ids(f), "id", F.col("ord"), list(c)) for f, c in frames])


def key_words(df: DataFrame, ident: str, text: Column, n: int) -> DataFrame:
    """The n words of highest degree per text: ``(ident, word, degree, rank)``.

    The degree of a word is the sum of the lengths of the phrases it occurs in.
    Every occurrence counts; ties go to the smaller word.
    """
    rows = spread(df.select(ident, F.coalesce(text, F.lit("")).alias("_text")))
    words = rows.select(ident, F.explode(X.phrase_words(F.col("_text"))).alias("w"))
    degrees = words.groupBy(ident, F.col("w.word").alias("word")).agg(F.sum("w.degree").alias("degree"))
    return top_n(degrees, n, [F.col("degree").desc(), F.col("word").asc()], ident)


def key_word_text(df: DataFrame, ident: str, text: Column, n: int, name: str) -> DataFrame:
    """The key words of a text in one string, best first; at most n words a row."""
    found = key_words(df, ident, text, n)
    listed = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return found.groupBy(ident).agg(F.concat_ws(" ", F.transform(listed, lambda r: r["word"])).alias(name))


def combined_features(merged: DataFrame, unique: bool = False) -> DataFrame:
    """The feature columns of each item and their concatenation."""
    overview = key_word_text(merged, "id", X.drop_placeholder(F.col("overview")), 7, "overview")
    tagline = key_word_text(merged, "id", F.col("tagline"), 3, "tagline")
    cleaned = merged.select(
        "id",
        "title",
        "popularity",
        X.clean_keywords(X.parse_names(F.col("keywords"))).alias("keywords"),
        X.clean_elements(X.parse_names(F.col("cast"))).alias("cast"),
        X.clean_elements(X.parse_names(F.col("genres"))).alias("genres"),
    )
    joined = cleaned.join(overview, "id", "left").join(tagline, "id", "left")
    parts = [F.when(F.col(c) != "", F.col(c)) for c in FEATURES]
    both = X.combine(*parts)
    return joined.withColumn("combined", X.unique_words(both) if unique else both)


def bag_of_words(df: DataFrame, ident: str, text: str) -> DataFrame:
    """Token counts per item: ``(ident, token, cnt)``.

    Texts, not tokens, are what is moved: all rows of an id come to one task and are counted there.
    """
    return (
        by_id(df.select(ident, text), ident)
        .select(ident, F.explode(X.tokens(F.col(text))).alias("token"))
        .groupBy(ident, "token")
        .agg(F.count("*").alias("cnt"))
    )


def vocabulary(bow: DataFrame, min_df: int) -> DataFrame:
    """Tokens that occur in at least ``min_df`` items."""
    return bow.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") >= min_df)


def in_vocabulary(bow: DataFrame, min_df: int) -> DataFrame:
    return bow.join(vocabulary(bow, min_df).select("token"), "token", "left_semi")


def hashed_vectors(items: DataFrame, bow: DataFrame, width: int = 64) -> DataFrame:
    """``(item_id, vector)``: token counts hashed into ``width`` signed places, scaled to length 1.

    Hashing is linear, so the rating-weighted sum of these vectors is the hashed form of the rating-weighted
    token counts of a user, and no vocabulary is needed. An item without tokens is zero.
    """
    place, sign = F.pmod(F.xxhash64("token"), F.lit(width)), F.pmod(F.xxhash64("token", F.lit("sign")), F.lit(2)) * 2 - 1
    signed = bow.select("item_id", place.alias("place"), (sign * F.col("cnt")).cast("double").alias("v"))
    sums = signed.groupBy("item_id").agg(F.array(*[F.sum(F.when(F.col("place") == j, F.col("v")).otherwise(0.0)) for j in range(width)]).alias("s"))
    length = F.sqrt(F.aggregate("s", F.lit(0.0), lambda t, x: t + x * x))
    scaled = F.when(length > 0, F.transform("s", lambda x: x / length)).otherwise(F.col("s"))
    every = items.select("item_id").distinct().join(sums, "item_id", "left")
    return every.select("item_id", F.coalesce(scaled, F.array(*[F.lit(0.0)] * width)).alias("vector"))
