import datetime as dt

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ratingloom.operators import hybrid, sequence, strata


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(9)
    start = dt.datetime(2024, 1, 1)
    data = [
        (int(rng.integers(1, 5)), int(rng.integers(1, 9)), start + dt.timedelta(hours=int(rng.integers(0, 240))), n) for n in range(150)
    ]
    return spark.createDataFrame(data, "user_id bigint, item_id bigint, ts timestamp, event_id bigint").persist(), data


def _paths(data):
    out = {}
    for u, i, ts, n in sorted(data, key=lambda r: (r[2], r[3])):
        out.setdefault(u, []).append(i)
    return out


def test_next_items_cross_days(events):
    frame, data = events
    want = sorted((u, a, b) for u, p in _paths(data).items() for a, b in zip(p, p[1:]))
    assert rows(sequence.next_items(frame), "user_id", "item_id", "next_item") == want


def test_markov(events):
    frame, data = events
    counts = {}
    for p in _paths(data).values():
        for a, b in zip(p, p[1:]):
            counts[a, b] = counts.get((a, b), 0) + 1
    for r in sequence.markov_transitions(frame).collect():
        total = sum(c for (a, _), c in counts.items() if a == r["item_id"])
        assert r["cnt"] == counts[r["item_id"], r["next_item"]]
        assert r["probability"] == pytest.approx(r["cnt"] / total)


def test_markov_recs_skip_seen(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    data = [(1, 1, t[0], 1), (1, 2, t[1], 2), (2, 2, t[0], 3), (2, 3, t[1], 4), (3, 2, t[0], 5), (3, 3, t[1], 6), (4, 2, t[2], 7), (4, 4, t[3], 8), (5, 2, t[2], 9), (5, 1, t[3], 10)]
    df = spark.createDataFrame(data, "user_id bigint, item_id bigint, ts timestamp, event_id bigint")
    # successors of 2: item 3 twice, items 4 and 1 once; user 1 has seen item 1
    assert rows(sequence.markov_recs(df, 5).filter("user_id = 1"), "rank", "item_id", "score") == [(1, 3, 0.5), (2, 4, 0.25)]


def test_trajectory(spark, events):
    frame, data = events
    rng = np.random.default_rng(3)
    vec = {i: rng.normal(0, 1, 3) for i in range(1, 20)}
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vec.items()], "item_id bigint, vector array<double>")
    got = {}
    for r in sequence.trajectory_recs(frame, vectors, 4).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"]))
    for u, p in _paths(data).items():
        steps = np.mean([vec[b] - vec[a] for a, b in zip(p, p[1:])], axis=0)
        target = vec[p[-1]] + steps
        free = [i for i in vec if i not in p]
        want = sorted(free, key=lambda i: np.linalg.norm(target - vec[i]))[:4]
        assert [i for _, i in sorted(got[u])] == want


def test_word_vectors_cover_the_items(events):
    frame, data = events
    got = strata.item_embeddings(frame, size=4)
    assert {r["item_id"] for r in got.collect()} == {i for _, i, _, _ in data}


@pytest.fixture(scope="module")
def three_lists(spark):
    lists = {"a": [1, 2, 3, 4], "b": [3, 1, 5, 2], "c": [6, 1]}
    return {
        name: spark.createDataFrame(
            [(1, i, 0.0, k + 1) for k, i in enumerate(items)], "user_id bigint, item_id bigint, score double, rank bigint"
        )
        for name, items in lists.items()
    }


def test_average_place_without_penalty(three_lists):
    # 6 only in c at place 0; 1 at (0+1+1)/3; 3 at (2+0)/2; 2 at (1+3)/2; 5 at 2; 4 at 3
    got = rows(hybrid.average_hybrid(three_lists, 5), "rank", "item_id", "score")
    assert [i for _, i, _ in got] == [6, 1, 3, 2, 5]
    assert got[1][2] == pytest.approx(2 / 3, abs=1e-6)


def test_predicate_takes_the_lists_in_turn(three_lists):
    route = F.when(F.col("item_id").isin(1, 4), 0).when(F.col("item_id").isin(5, 2, 3), 1).otherwise(2)
    # a keeps 1, 4; b keeps 3, 5, 2; c keeps 6
    got = rows(hybrid.predicate_hybrid(three_lists, route, 10), "rank", "item_id")
    assert [i for _, i in got] == [1, 3, 6, 4, 5, 2]
    assert [i for _, i in rows(hybrid.predicate_hybrid(three_lists, route, 2), "rank", "item_id")] == [1, 3]
