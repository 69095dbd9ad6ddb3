import math

import numpy as np
import pytest

from ratingloom.llm import whitening as X

COLUMNS = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def brute(rows, components=16):
    """The definition on the whole matrix: per vec_id its deviation and whitened values."""
    x = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    white = {i: (np.array(v, float) - mean) @ vectors[:, order] / np.sqrt(values[order]) for i, v in x.items()}
    return n, deviation, white, values[order] / values.sum()


def compare(found, rows, components=16):
    n, deviation, white, explained = brute(rows, components)
    k = min(components, len(rows[0][1]))
    by = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(rows) * k and set(by) == {(i, c) for i, _ in rows for c in range(1, k + 1)}
    for c in range(k):
        got = np.array([by[i, c + 1].whitened for i, _ in rows])
        want = np.array([white[i][c] for i, _ in rows])
        sign = np.sign(got @ want)
        assert np.allclose(got * sign, want, atol=1e-6)
        assert all(abs(by[i, c + 1].explained / explained[c] - 1) < 1e-6 for i, _ in rows)
    assert all(by[i, 1].n == n and by[i, 1].deviation == deviation[i] for i, _ in rows)
    assert {r.identity_error for r in found} and max(r.identity_error for r in found) < 1e-8


@pytest.mark.parametrize("width", [5, 24])
def test_equals_the_whole_matrix(spark, monkeypatch, width):
    monkeypatch.setattr(X, "BLOCK", 16)
    monkeypatch.setattr(X, "TASK_BLOCKS", 2)
    r = np.random.default_rng(width)
    base = r.standard_normal((150, width)) @ r.standard_normal((width, width))
    rows = [(i * 3, base[0 if i % 3 == 0 else i % 150].tolist()) for i in range(400)]  # a third are copies
    frame = spark.createDataFrame([(*row, "x") for row in rows], "vec_id bigint, embedding array<double>, idx string").repartition(3)
    compare(X.whiten(frame).collect(), rows)


def test_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect() if r.embedding is not None]
    compare(X.whiten(frame).collect(), rows)


def test_rows_of_every_kind(spark):
    r = np.random.default_rng(2)
    good = [(i, r.standard_normal(3).tolist()) for i in range(20)]
    bad = [(30, None), (31, [1.0, None, 2.0]), (32, [float("nan"), 1.0, 2.0]), (33, [float("inf"), 1.0, 2.0])]
    odd = [(40, [1.0, 2.0]), (41, [])]
    schema = "vec_id bigint, embedding array<double>"
    frame = spark.createDataFrame([*good, *bad, *odd, (None, good[0][1]), good[1]], schema)
    found = X.whiten(frame).collect()
    usual = [f for f in found if f.vec_id is not None and f.component is not None]
    assert len(found) == 22 * 3 + 2 and sum(f.vec_id == 1 for f in usual) == 6
    seen = {(f.vec_id, f.component): f for f in usual}
    compare(list(seen.values()), good)
    assert all(f[c] is None for f in found if f.vec_id in (40, 41) for c in COLUMNS[1:])
    assert {f.component for f in found if f.vec_id is None} == {1, 2, 3}


def test_tables_that_do_not_vary(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert X.whiten(spark.createDataFrame([], schema)).count() == 0
    assert X.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    one = X.whiten(spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], schema)).collect()
    assert [(f.n, f.deviation, f.whitened, f.explained, f.identity_error) for f in one] == [(1, 0, None, None, None)] * 4
    flat = X.whiten(spark.createDataFrame([(k, [float(k), 1.0]) for k in range(5)], schema)).collect()
    assert all((f.whitened is None) == (f.component == 2) and f.identity_error < 1e-9 for f in flat)
    assert {f.explained for f in flat if f.component == 2} == {0.0}
    far = X.whiten(spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 1.0]), (3, [1.0, 5.0])], schema)).collect()
    assert len(far) == 6 and {f.deviation for f in far} == {None}
    none = X.whiten(spark.createDataFrame([(1, [])], schema)).collect()
    assert [(f.vec_id, f.component) for f in none] == [(1, None)]
