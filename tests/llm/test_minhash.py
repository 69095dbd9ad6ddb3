import re

import numpy as np
import pytest

from ratingloom.llm import minhash as M
from ratingloom.llm.components import components
from ratingloom.llm.queries import QUERIES


def brute(rows, percent=85):
    """Components by comparing all pairs of sets of word tuples."""
    sets = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                a, b = find(rows[x][0]), find(rows[y][0])
                root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets, strict=True))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    for share in (0.5, 0.85, 0.95):
        n = 400
        both = int(2 * n * share / (1 + share))
        est = []
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
            a, b = M.packed(M.signature(pool[:n])), M.packed(M.signature(pool[n - both :]))
            est.append(M.estimate(a[None], b[None])[0, 0])
        assert abs(np.mean(est) - both / (2 * n - both)) < 0.02
        assert np.std(est) < 0.07


def test_components_of_a_long_chain_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 130)] + [(7, 7), (129, 200), (200, 129)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    want = {n: 0 for n in range(61)} | {n: 100 for n in [*range(100, 130), 200]}
    assert {r.node: r.component for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0


def test_a_large_group_of_near_copies_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(int(rng.integers(0, 5))):
            words[int(rng.integers(0, 120))] = f"x{int(rng.integers(0, 10**6))}"
        rows.append((i * 3, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(M.near_duplicates(frame, 85)) == brute(rows)


def test_rows_of_every_kind(spark):
    text = " ".join(f"a{k}" for k in range(60))
    rows = [(5, text), (2, text.upper() + "\n"), (9, None), (8, ""), (7, " \t\n"), (11, "one two"), (12, "ONE  two"), (13, "one two three"), (14, text + " end")]
    frame = spark.createDataFrame([(*r, "x") for r in rows] + [(None, text, "x")], "doc_id bigint, text string, packed string")
    out = {r.doc_id: r for r in M.near_duplicates(frame, 85).collect()}
    assert (out[None].component_id, out[None].kept) == (None, True)
    assert [(i, out[i].n_shingles, out[i].component_id, out[i].kept) for i in sorted(i for i, _ in rows)] == brute(rows)
    twice = frame.filter("doc_id is not null")
    assert M.near_duplicates(twice.union(twice), 85).filter("kept").count() == 2 * M.near_duplicates(twice, 85).filter("kept").count()
    assert M.near_duplicates(frame.limit(0), 85).count() == 0


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op3_minhash"](spark, d)) == brute(rows)
