"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ratingloom.plans.registry import QUERIES  # noqa: E402
from ratingloom.sources.session import local_session  # noqa: E402

HEADLINE = [
    "latest_rating", "most_rated_items", "unseen_items", "loo_positive_split", "metadata_first",
    "text_keywords", "combined_features", "bag_of_words", "user_neighbors", "user_euclidean",
    "user_profile", "similar_items", "memory_cf_recs", "memory_cf_predict", "user_knn_recs",
    "item_knn_recs", "weighted_profile_recs", "association_rules", "rule_recs",
    "cluster_popular_recs", "cluster_sample_recs", "markov_recs", "trajectory_recs",
    "negative_samples", "svd_recs", "latent_factor_recs", "hybrid_average", "hit_rate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
