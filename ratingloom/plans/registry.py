"""Every query by name: ``(spark, folder) -> DataFrame`` over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.functions import text as X
from ratingloom.functions.numeric import snap
from ratingloom.operators import (
    cf, cluster, content, features, hybrid, knn, learned, rank, recommender, rules, sequence, similarity, sketches, strata, svd,
)
from ratingloom.plans import experiments, metrics, split
from ratingloom.sources import readers, sinks, tables as T
from ratingloom.sources.durable import durable, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

N = 10  # length of a registered recommendation list
# The usual setting of the rule method.
SUPPORT = 0.15
CONFIDENCE = 0.2
BUCKETS = 8  # of the registered bucketed tables
STARTS = 4  # of the registered text clusterings


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(items: str) -> Column:
    return F.concat_ws(",", F.col(items).cast("array<string>"))


def _bow(spark: SparkSession, d: str, min_df: int = 3) -> DataFrame:
    docs = T.table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "text")
    counts = durable(features.bag_of_words(docs, "item_id", "text"))
    return durable(features.in_vocabulary(counts, min_df))


def _ratings(spark: SparkSession, d: str) -> DataFrame:
    """Deduplicated ratings, written once, for plans that read them many times."""
    return durable(T.ratings(spark, d))


def _all_items(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select(F.col("doc_id").alias("item_id"))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def _itemsets(spark: SparkSession, d: str) -> DataFrame:
    return rules.frequent_itemsets(T.ratings(spark, d), SUPPORT)


# --- scans, sources, sinks -------------------------------------------------


@query
def scan_ratings(spark, d):
    return T.rating_events(spark, d).select("user_id", "item_id", "rating", "event_id")


@query
def scan_catalog(spark, d):
    return T.items(spark, d).select("item_id", "title", "popularity", "price", "brand", "type", "text", "lang", "source")


@query
def clean_ids(spark, d):
    return readers.clean_ids(T.raw_metadata(spark, d)["meta"]).select("id", "title", "popularity", "tagline", "genres")


@query
def feature_sink(spark, d):
    """Write features once, try to write others over them, read back the first."""
    path = f"{shared_folder(spark)}/features-{uuid.uuid4().hex}"
    merged = _merged(spark, d)
    sinks.save_features(features.combined_features(merged), path)
    sinks.save_features(merged.limit(0), path)
    return sinks.load_features(spark, path).select("id", "title", "combined")


@query
def model_roundtrip(spark, d):
    """Fitted factor tables written, read back and used."""
    ratings = _ratings(spark, d)
    users, items = learned.latent_factors(learned.training_pairs(ratings))
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    sinks.save_model({"users": users, "items": items}, path)
    model = sinks.load_model(spark, path, ["users", "items"])
    return svd.factor_recs(model["users"], model["items"], ratings, N)


@query
def estimator_roundtrip(spark, d):
    """A recommender fitted on the training rows, saved, loaded and asked for the held-out rows."""
    rated = split.leave_one_out(_ratings(spark, d))
    path = f"{shared_folder(spark)}/recommender-{uuid.uuid4().hex}"
    recommender.FactorRecommender(method="ranking", rank=8).fit(rated.filter(~F.col("is_test"))).save(path)
    scored = recommender.FactorModel.load(path).transform(rated.filter("is_test"))
    return scored.select("user_id", "item_id", "rating", snap(F.col("prediction")).alias("predicted"))


@query
def bucketed_history(spark, d):
    """Ratings and users' totals in tables bucketed by user, joined without a shuffle."""
    tag, folder = uuid.uuid4().hex, shared_folder(spark)
    ratings = T.ratings(spark, d).select("user_id", "item_id", "rating")
    rows = sinks.save_bucketed(ratings, f"ratings_{tag}", "user_id", BUCKETS, folder)
    totals = rows.groupBy("user_id").agg(F.count("*").alias("n_ratings"), F.sum("rating").alias("rating_sum"))
    return rows.join(totals, "user_id").select("user_id", "item_id", "rating", "n_ratings", "rating_sum")


# --- projections, filters ---------------------------------------------------


@query
def rating_triples(spark, d):
    return T.rating_events(spark, d).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"), "rating"
    )


@query
def normalized_ratings(spark, d):
    return T.purchases(spark, d).select("user_id", "item_id", (F.col("rating") / F.lit(5.0)).alias("rating"))


@query
def ratings_with_metadata(spark, d):
    return T.purchases(spark, d).join(_all_items(spark, d), "item_id", "left_semi").select("user_id", "item_id", "rating")


@query
def rated_catalog(spark, d):
    return T.items(spark, d).join(T.rating_events(spark, d), "item_id", "left_semi").select("item_id", "title", "popularity")


@query
def positive_ratings(spark, d):
    return split.positive_ratings(T.ratings(spark, d), 5.0, 2).select("user_id", "item_id", "rating", "effective")


@query
def unseen_items(spark, d):
    """For every user the most rated items the user has not rated."""
    ratings = T.ratings(spark, d)
    counts = ratings.groupBy("item_id").agg(F.count("*").alias("c"))
    placed = rank.positions(counts, [F.col("c").desc(), F.col("item_id").asc()])
    taken = ratings.select("user_id", "item_id").join(placed, "item_id")
    free = rank.first_unseen(ratings.select("user_id"), taken, placed.count(), N)
    return free.join(placed, "pos").select("user_id", "item_id", F.col("nth").alias("rank"))


@query
def item_lookup(spark, d):
    return T.items(spark, d).filter(F.col("item_id") == 42).select("item_id", "title", "popularity", "text")


@query
def user_history(spark, d):
    """All ratings, best first within each user; a range sort, no task per user."""
    order = [F.col("user_id").asc(), F.col("rating").desc(), F.col("item_id").asc()]
    return T.purchases(spark, d).orderBy(*order).select("user_id", "item_id", "rating")


# --- joins --------------------------------------------------------------------


@query
def metadata_outer_join(spark, d):
    raw = T.raw_metadata(spark, d)
    frames = [readers.clean_ids(raw[k]) for k in ("meta", "keywords", "credits")]
    return readers.outer_join_all(frames).select("id", "title", "overview", "keywords", "cast", "genres")


@query
def recs_with_titles(spark, d):
    recs = cf.memory_cf(_ratings(spark, d), 5)
    return recs.join(_titles(spark, d), "item_id", "left").select("user_id", "rank", "item_id", "title")


@query
def item_popularity(spark, d):
    meta = readers.clean_ids(T.raw_metadata(spark, d)["meta"])
    known = meta.select(F.col("id").alias("item_id"))
    rated = T.rating_events(spark, d).select("item_id").distinct().join(known, "item_id", "left_semi")
    return cluster.item_popularity(rated, meta)


@query
def candidate_pairs(spark, d):
    """All unrated items of every user, as ranges of places in item id order."""
    ratings = T.ratings(spark, d)
    placed = rank.positions(_all_items(spark, d), [F.col("item_id").asc()])
    taken = ratings.select("user_id", "item_id").join(placed, "item_id")
    ranges = rank.free_ranges(ratings.select("user_id"), taken, placed.count())
    return ranges.select("user_id", "first_pos", "last_pos", (F.col("last_pos") - F.col("first_pos") + 1).alias("n_items"))


# --- aggregations ---------------------------------------------------------------


@query
def metadata_first(spark, d):
    meta = readers.clean_ids(T.raw_metadata(spark, d)["meta"])
    return readers.first_values(meta, "id", F.col("ord"), ["title", "popularity", "overview", "tagline", "genres"])


@query
def user_rating_totals(spark, d):
    return T.purchases(spark, d).groupBy("user_id").agg(F.sum("rating").alias("rating_sum"), F.count("*").alias("n_ratings"))


def _item_stats(spark, d):
    return T.purchases(spark, d).groupBy("item_id").agg(
        F.count("*").alias("n_ratings"), snap(F.avg("rating")).alias("mean_rating")
    )


@query
def most_rated_items(spark, d):
    return _item_stats(spark, d).orderBy(F.col("n_ratings").desc(), F.col("item_id").asc()).limit(10)


@query
def top_rated_items(spark, d):
    return _item_stats(spark, d).orderBy(F.col("mean_rating").desc(), F.col("item_id").asc()).limit(10)


@query
def rating_profile(spark, d):
    events = T.rating_events(spark, d)
    return events.agg(
        *[F.count(c).alias(f"n_{c}") for c in ("user_id", "item_id", "rating", "ts")],
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
    )


@query
def distinct_by_month(spark, d):
    """Users and items of each month, exact, and whether sketches merged from stored days agree."""
    events, ids = T.rating_events(spark, d), ["user_id", "item_id"]
    stored = durable(sketches.daily_sketches(events, ids))
    estimates = sketches.merged(stored, ids, F.date_format("day", "yyyy-MM"))
    return sketches.checked(events, estimates, ids, F.date_format("ts", "yyyy-MM"), sketches.error_bound())


@query
def dedup_catalog(spark, d):
    meta = readers.clean_ids(T.raw_metadata(spark, d)["meta"])
    return readers.keep_first(meta, "id", F.col("ord")).select("id", "title", "popularity", "overview", "genres")


@query
def duplicate_ids(spark, d):
    meta = T.raw_metadata(spark, d)["meta"]
    return meta.groupBy("id").agg(F.count("*").alias("occurrences")).filter(F.col("occurrences") > 1)


@query
def latest_rating(spark, d):
    return T.ratings(spark, d).select("user_id", "item_id", "rating", "event_id")


@query
def user_baskets(spark, d):
    baskets = rules.user_baskets(T.ratings(spark, d))
    return baskets.select("user_id", _joined("items").alias("items"), F.size("items").cast("bigint").alias("n_items"))


@query
def vocabulary(spark, d):
    docs = T.table(spark, d, "documents").select("doc_id", "text")
    return features.vocabulary(features.bag_of_words(docs, "doc_id", "text"), 3)


@query
def dense_ids(spark, d):
    return learned.dense_ids(T.rating_events(spark, d), "user_id", "event_id")


# --- splits -----------------------------------------------------------------------


@query
def loo_newest(spark, d):
    return split.newest(T.ratings(spark, d))


@query
def loo_random(spark, d):
    return split.random_pick(T.ratings(spark, d))


@query
def loo_split(spark, d):
    return split.leave_one_out(T.ratings(spark, d)).select("user_id", "item_id", "rating", "is_test")


@query
def loo_positive_split(spark, d):
    return split.leave_one_out(T.ratings(spark, d), threshold=5.0).select("user_id", "item_id", "rating", "is_test")


@query
def per_user_training_rows(spark, d):
    return split.thresholded_leave_last_out(T.ratings(spark, d), 4.0).select("user_id", "item_id", "rating", "is_test")


@query
def split_80_20(spark, d):
    return split.random_split(T.purchases(spark, d)).select("user_id", "item_id", "rating", "is_test")


# --- text -------------------------------------------------------------------------


def _raw(spark, d, name):
    return readers.clean_ids(T.raw_metadata(spark, d)[name])


@query
def parse_names(spark, d):
    return _raw(spark, d, "credits").select("id", F.concat_ws("|", X.parse_names(F.col("cast"))).alias("names"))


@query
def clean_keywords(spark, d):
    return _raw(spark, d, "keywords").select("id", X.clean_keywords(X.parse_names(F.col("keywords"))).alias("keywords"))


@query
def clean_elements(spark, d):
    return _raw(spark, d, "credits").select("id", X.clean_elements(X.parse_names(F.col("cast"))).alias("cast"))


@query
def text_keywords(spark, d):
    docs = T.table(spark, d, "documents").select("doc_id", "text")
    return features.key_words(docs, "doc_id", X.drop_placeholder(F.col("text")), 7)


def _merged(spark, d):
    raw = T.raw_metadata(spark, d, repeated=True)
    return features.merge_metadata(raw["meta"], raw["keywords"], raw["credits"])


@query
def combined_features(spark, d):
    return features.combined_features(_merged(spark, d)).select("id", "title", "combined")


@query
def bag_of_words(spark, d):
    return features.bag_of_words(T.table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


# --- similarity ------------------------------------------------------------------


@query
def user_cosine(spark, d):
    s = similarity.similarity_summary(_ratings(spark, d), "item_id", "user_id", "rating")
    return s.withColumnRenamed("id", "user_id")


@query
def item_cosine(spark, d):
    s = similarity.similarity_summary(_bow(spark, d), "token", "item_id", "cnt")
    return s.withColumnRenamed("id", "item_id")


@query
def similar_user_pairs(spark, d):
    found = similarity.similar_pairs(_ratings(spark, d), "item_id", "user_id", "rating", 0.45)
    return found.select(F.col("id").alias("user_id"), F.col("other_id").alias("neighbor_id"), "similarity")


@query
def similar_item_pairs(spark, d):
    found = similarity.similar_pairs(_bow(spark, d), "token", "item_id", "cnt", 0.8)
    return found.select(F.col("id").alias("item_id"), F.col("other_id").alias("similar_id"), "similarity")


def _neighbors(spark, d, metric):
    found = similarity.nearest(_ratings(spark, d), "item_id", "user_id", "rating", N, metric)
    return found.select(F.col("id").alias("user_id"), F.col("other_id").alias("neighbor_id"), "similarity", "rank")


@query
def user_neighbors(spark, d):
    return _neighbors(spark, d, "cosine")


@query
def user_euclidean(spark, d):
    return _neighbors(spark, d, "euclidean")


@query
def similar_items(spark, d):
    return content.similar_items(_bow(spark, d), 3)


@query
def similar_items_report(spark, d):
    return content.similar_items_report(_bow(spark, d), _titles(spark, d), 3, 30)


def _feature_bow(spark, d):
    """Token counts of the combined features: the way from raw metadata to the content methods."""
    combined = features.combined_features(_merged(spark, d)).select(F.col("id").alias("item_id"), "combined")
    return durable(features.in_vocabulary(durable(features.bag_of_words(combined, "item_id", "combined")), 3))


@query
def similar_feature_items(spark, d):
    return content.similar_items(_feature_bow(spark, d), 3)


@query
def feature_profile_recs(spark, d):
    bow = _feature_bow(spark, d)
    return content.weighted_profile(_ratings(spark, d), bow, bow.select("item_id").distinct(), N)


@query
def fitted_cluster_recs(spark, d):
    """The three item-cluster recommenders on clusters fitted to the token counts."""
    ratings, docs = _ratings(spark, d), T.table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "text")
    fitted = durable(cluster.text_clusters(docs, X.tokens(F.col("text")), 10, restarts=STARTS))
    popularity = ratings.groupBy("item_id").agg(F.count("*").cast("double").alias("popularity"))
    lists = durable(fitted.join(popularity, "item_id", "left").select("item_id", "cluster", F.coalesce("popularity", F.lit(0.0)).alias("popularity")))
    made = {
        "linear": cluster.cluster_sample_recs(ratings, lists, N),
        "exponential": cluster.cluster_sample_recs(ratings, lists, N, exponential=True),
        "popularity": cluster.cluster_popular_recs(ratings, lists, N),
    }
    named = [r.select(F.lit(name).alias("selection"), "user_id", "item_id", snap(F.col("score")).alias("score"), "rank") for name, r in made.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def user_profile(spark, d):
    return content.user_profile(_ratings(spark, d), _bow(spark, d))


@query
def weighted_user_features(spark, d):
    return content.weighted_user_features(_ratings(spark, d), _bow(spark, d, 20))


@query
def nearest_to_centroid(spark, d):
    items = T.vectors(spark, d)
    return cluster.nearest_to_centroid(cluster.label_centroids(items), items, N)


# --- recommenders --------------------------------------------------------------------


@query
def memory_cf_recs(spark, d):
    return cf.memory_cf(_ratings(spark, d), N)


@query
def memory_cf_predict(spark, d):
    return cf.memory_cf_predict(split.leave_one_out(_ratings(spark, d)))


@query
def memory_cf_predict_topk(spark, d):
    return cf.memory_cf_predict(split.leave_one_out(_ratings(spark, d)), top_k=20)


@query
def scaled_mse(spark, d):
    return metrics.scaled_mse(cf.memory_cf_predict(split.leave_one_out(_ratings(spark, d))))


@query
def user_knn_recs(spark, d):
    return knn.user_knn(_ratings(spark, d), N)


@query
def user_knn_euclid_recs(spark, d):
    return knn.user_knn(_ratings(spark, d), N, metric="euclidean")


@query
def item_knn_recs(spark, d):
    return knn.item_knn(_ratings(spark, d), _bow(spark, d), _all_items(spark, d), N, 5)


@query
def item_knn_euclid_recs(spark, d):
    return knn.item_knn(_ratings(spark, d), _bow(spark, d), _all_items(spark, d), N, 50, "minkowski")


@query
def weighted_profile_recs(spark, d):
    return content.weighted_profile(_ratings(spark, d), _bow(spark, d), _all_items(spark, d), N)


@query
def svd_recs(spark, d):
    ratings = _ratings(spark, d)
    f = svd.truncated_svd(ratings, 16)
    return svd.factor_recs(f.users, f.items, ratings, N)


@query
def svd_predict(spark, d):
    rated = split.leave_one_out(_ratings(spark, d))
    f = svd.truncated_svd(rated.filter(~F.col("is_test")), 16)
    return svd.factor_predict(f.users, f.items, rated.filter("is_test"))


@query
def frequent_itemsets(spark, d):
    return _itemsets(spark, d).select(_joined("items").alias("items"), "freq", snap(F.col("support")).alias("support"))


@query
def itemsets_with_titles(spark, d):
    return rules.itemsets_with_titles(_itemsets(spark, d), _titles(spark, d))


@query
def association_rules(spark, d):
    measures = [snap(F.col(c)).alias(c) for c in ("support", "confidence", "lift", "leverage", "conviction")]
    return rules.association_rules(_itemsets(spark, d), CONFIDENCE).select(
        _joined("antecedents").alias("antecedents"), _joined("consequents").alias("consequents"), *measures
    )


@query
def rule_count_by_confidence(spark, d):
    # The confidence levels that are compared.
    thresholds = [0.6, 0.4, 0.3, 0.2, 0.15, 0.1]
    return rules.rule_counts(rules.association_rules(_itemsets(spark, d), min(thresholds)), thresholds)


@query
def rule_recs(spark, d):
    found = rules.association_rules(_itemsets(spark, d), CONFIDENCE)
    return rules.rule_recs(_ratings(spark, d), found, N)


@query
def cluster_scores(spark, d):
    scores = cluster.cluster_scores(_ratings(spark, d), T.clusters(spark, d))
    return scores.withColumn("mean_rating", snap(F.col("mean_rating")))


@query
def cluster_popularity(spark, d):
    return cluster.cluster_popularity(T.clusters(spark, d)).select(
        F.col("list_id").alias("cluster"), "item_id", "popularity", F.col("pos").alias("rank")
    )


@query
def cluster_probabilities(spark, d):
    return cluster.cluster_probabilities(_ratings(spark, d), T.clusters(spark, d))


@query
def cluster_popular_recs(spark, d):
    recs = cluster.cluster_popular_recs(_ratings(spark, d), T.clusters(spark, d), N)
    return recs.withColumn("score", snap(F.col("score")))


@query
def item_clusters(spark, d):
    return cluster.item_clusters(T.vectors(spark, d), 10)


@query
def item_text_clusters(spark, d):
    docs = T.table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return cluster.text_clusters(docs, X.tokens(F.col("text")), 10, restarts=STARTS)


@query
def cluster_sample_recs(spark, d):
    recs = cluster.cluster_sample_recs(_ratings(spark, d), T.clusters(spark, d), N)
    return recs.withColumn("score", snap(F.col("score")))


@query
def cluster_sample_exponential_recs(spark, d):
    recs = cluster.cluster_sample_recs(_ratings(spark, d), T.clusters(spark, d), N, exponential=True)
    return recs.withColumn("score", snap(F.col("score")))


@query
def user_cluster_recs(spark, d):
    ratings, items = _ratings(spark, d), T.vectors(spark, d)
    assigned, centers = cluster.user_clusters(ratings, items)
    return cluster.user_cluster_recs(assigned, centers, ratings, items, N)


@query
def user_cluster_predict(spark, d):
    rated, items = split.leave_one_out(_ratings(spark, d)), T.vectors(spark, d)
    assigned, centers = cluster.user_clusters(rated.filter(~F.col("is_test")), items)
    return cluster.user_cluster_predict(assigned, centers, rated.filter("is_test"), items)


@query
def markov_transitions(spark, d):
    t = sequence.markov_transitions(T.rating_events(spark, d))
    return t.withColumn("probability", snap(F.col("probability")))


@query
def markov_recs(spark, d):
    recs = sequence.markov_recs(T.rating_events(spark, d), N)
    return recs.withColumn("score", snap(F.col("score")))


@query
def trajectory_recs(spark, d):
    return sequence.trajectory_recs(T.rating_events(spark, d), T.vectors(spark, d), N)


@query
def w2v_recs(spark, d):
    events = T.rating_events(spark, d)
    return sequence.trajectory_recs(events, strata.item_embeddings(events), N)


@query
def negative_samples(spark, d):
    return learned.negative_samples(_ratings(spark, d))


@query
def training_pairs(spark, d):
    return learned.training_pairs(_ratings(spark, d))


@query
def latent_factor_recs(spark, d):
    return learned.latent_factor_recs(_ratings(spark, d), N)


@query
def ranking_factor_recs(spark, d):
    return strata.ranking_recs(_ratings(spark, d), N)


@query
def content_text_recs(spark, d):
    """The content regression on hashed token counts, its penalty chosen on held-out rows."""
    items = durable(features.hashed_vectors(_all_items(spark, d), _bow(spark, d)))
    return learned.content_regression_recs(_ratings(spark, d), items, N, penalties=[1e-4, 1e-2])


@query
def content_regression_recs(spark, d):
    return learned.content_regression_recs(_ratings(spark, d), T.vectors(spark, d), N)


def _two_methods(spark, d):
    ratings = _ratings(spark, d)
    return {
        "memory_cf": cf.memory_cf(ratings, 50),
        "weighted_profile": content.weighted_profile(ratings, _bow(spark, d), _all_items(spark, d), 50),
    }


@query
def hybrid_average(spark, d):
    return hybrid.average_hybrid(_two_methods(spark, d), N)


@query
def hybrid_predicate(spark, d):
    route = F.pmod(F.col("user_id") + F.col("item_id"), F.lit(2))
    return hybrid.predicate_hybrid(_two_methods(spark, d), route, N)


# --- evaluation ------------------------------------------------------------------------


@query
def hit_rate(spark, d):
    rated = split.leave_one_out(_ratings(spark, d))
    return metrics.hit_rate(cf.memory_cf(rated, experiments.LIST_LENGTH), rated)


@query
def hit_rate_repeated(spark, d):
    return experiments.repeated_sampling(_ratings(spark, d), T.clusters(spark, d))


@query
def hit_rate_grid(spark, d):
    return experiments.neighbor_grid(_ratings(spark, d), ["cosine", "euclidean"], [None, 4.0])


@query
def method_comparison(spark, d):
    return experiments.offline_comparison(_ratings(spark, d), _bow(spark, d), _all_items(spark, d))


@query
def all_methods(spark, d):
    """Leave-one-out hits of every method, each fitted on the training rows."""
    return experiments.all_methods(
        _ratings(spark, d), T.rating_events(spark, d), _bow(spark, d), _all_items(spark, d), T.clusters(spark, d), T.vectors(spark, d), SUPPORT, CONFIDENCE
    )


@query
def hit_rate_item_grid(spark, d):
    return experiments.item_neighbor_grid(
        _ratings(spark, d), _bow(spark, d), _all_items(spark, d), ["cosine", "minkowski"], [4.0, None]
    )


@query
def method_comparison_positive(spark, d):
    return experiments.offline_comparison(_ratings(spark, d), _bow(spark, d), _all_items(spark, d), 4.0)


@query
def recommendation_report(spark, d):
    rated = split.leave_one_out(_ratings(spark, d))
    recs = cluster.cluster_popular_recs(rated.filter(~F.col("is_test")), T.clusters(spark, d), experiments.LIST_LENGTH)
    return experiments.report(rated, recs, _titles(spark, d))
