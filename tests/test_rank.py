import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ratingloom.operators.lists import ranked_lists, walk_lists
from ratingloom.operators import rank
from ratingloom.operators.rank import first_unseen, positions, top_n


def test_positions_number_all_rows(spark):
    values = [(i, (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(values, "item_id bigint, c int")
    got = rows(positions(df, [F.col("c").desc(), F.col("item_id").asc()]), "pos", "item_id")
    want = sorted(values, key=lambda v: (-v[1], v[0]))
    assert got == [(p + 1, v[0]) for p, v in enumerate(want)]


@pytest.mark.parametrize("stretch", [7, 65536])
def test_first_unseen_equals_brute_force(spark, stretch, monkeypatch):
    monkeypatch.setattr(rank, "STRETCH", stretch)
    rng = random.Random(3)
    size, n = 40, 6
    taken = {u: set(rng.sample(range(1, size + 1), k)) for u, k in enumerate([0, 1, 5, 20, 37, 39, 40])}
    taken[7] = set(range(1, 30))
    users = spark.createDataFrame([(u,) for u in taken], "user_id bigint")
    cells = spark.createDataFrame([(u, p) for u, ps in taken.items() for p in ps], "user_id bigint, pos bigint")
    want = []
    for u, ps in taken.items():
        free = [p for p in range(1, size + 1) if p not in ps][:n]
        want += [(u, p, k + 1) for k, p in enumerate(free)]
    assert rows(first_unseen(users, cells, size, n), "user_id", "pos", "nth") == sorted(want)
    covered = {u: [] for u in taken}
    for r in rank.free_ranges(users, cells, size).orderBy("user_id", "first_pos").collect():
        assert r["before"] == len(covered[r["user_id"]])
        covered[r["user_id"]] += range(r["first_pos"], r["last_pos"] + 1)
    assert covered == {u: [p for p in range(1, size + 1) if p not in ps] for u, ps in taken.items()}


def test_top_n_breaks_ties_by_item(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (1, 3, 2.0), (1, 9, 3.0)], "user_id bigint, item_id bigint, score double")
    assert rows(top_n(df, 2), "rank", "item_id") == [(1, 9), (2, 3)]


def test_walk_lists_equals_brute_force(spark):
    rng = random.Random(4)
    entries = {c: rng.sample(range(100), 12) for c in range(3)}
    seen = {u: set(rng.sample(range(100), 30)) for u in range(8)}
    order = {u: rng.sample(range(3), rng.randint(1, 3)) for u in range(8)}
    flat = [(c, i, p) for c, items in entries.items() for p, i in enumerate(items)]
    lists = ranked_lists(spark.createDataFrame(flat, "c bigint, item_id bigint, p int"), "c", [F.col("p").asc()], ["item_id"])
    heads = spark.createDataFrame(
        [(u, c, k + 1, 0.0) for u, cs in order.items() for k, c in enumerate(cs)], "user_id bigint, list_id bigint, list_rank int, score double"
    )
    rated = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id bigint, item_id bigint")
    got = {}
    # an item of two lists may come twice; only lists without common items are walked in practice
    for r in walk_lists(heads, lists, rated, 9).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["item_id"])
    for u, cs in order.items():
        want = [i for c in cs for i in entries[c] if i not in seen[u]][:9]
        assert got.get(u, []) == want
