import numpy as np
import pytest

from ratingloom.llm import vectors as V


def brute(rows, least=0.95):
    """Counts and components from the whole matrix of cosines."""
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    label = np.array([r[0] for r in rows])
    while True:
        new = np.minimum(label, np.where(near, label, 1 << 60).min(1))
        if (new == label).all():
            break
        label = new
    return sorted((r[0], int(near[k].sum()), int(label[k]), int(label[k]) == r[0]) for k, r in enumerate(rows))


def got(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def fixture():
    r = np.random.default_rng(2)
    base, rows = r.standard_normal((60, 16)), []
    for i in range(400):
        v = base[0 if i % 3 == 0 else i % 60] + r.standard_normal(16) * [0.0, 0.15, 0.25][i % 5 % 3]
        rows.append((i * 2 + 1, v.tolist()))
    return rows


def test_links_equal_brute_force_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 32)
    rows = fixture()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want, found = brute(rows), got(V.near_duplicates(frame))
    assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in want)
    assert all(f[1] <= w[1] and f[2] >= w[2] for f, w in zip(found, want, strict=True))  # no link too many
    assert got(V.near_duplicates(frame, exact=True)) == want


def test_rows_of_every_kind(spark):
    one, two = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.1]
    rows = [(5, one), (4, two), (9, one), (1, None), (2, [0.0] * 4), (3, [1.0, None, 3.0, 4.0]), (6, [float("nan"), 2.0, 3.0, 4.0]), (7, [float("inf"), 2.0, 3.0, 4.0]), (8, []), (10, [1.0, 2.0]), (11, [-0.0, 1.0, 0.0, 0.0]), (12, [0.0, 1.0, -0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows] + [(None, one, "x")], "vec_id bigint, embedding array<double>, cell string")
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in V.near_duplicates(frame).collect()}
    assert len(out) == len(rows) + 1 and out[None] == (0, None, True)
    assert out[4] == (2, 4, True) and out[5] == (2, 4, False) == out[9]
    assert out[11] == (1, 11, True) and out[12] == (1, 11, False)
    assert all(out[k] == (0, k, True) for k in (1, 2, 3, 6, 7, 8, 10))
    assert V.near_duplicates(frame.limit(0)).count() == 0
    assert V.near_duplicates(frame.filter("vec_id in (1, 2)")).count() == 2


def test_a_spanning_forest_connects_what_the_links_connect():
    r = np.random.default_rng(0)
    for _ in range(100):
        m = r.random((int(r.integers(1, 12)), int(r.integers(1, 12)))) < 0.2
        links = V._spanning(m)
        assert all(m[a, b] for a, b in links)

        def label(pairs):
            lab = list(range(sum(m.shape)))
            for _ in lab:
                for a, b in pairs:
                    lab[a] = lab[m.shape[0] + b] = min(lab[a], lab[m.shape[0] + b])
            return lab

        assert label(links) == label(np.argwhere(m).tolist())


def test_recall_on_the_given_vectors(spark):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect() if r.embedding is not None]
    r = np.random.default_rng(9)
    rows += [(1_000_000 + i, (np.array(rows[i * 7 % len(rows)][1]) + r.standard_normal(64) * 0.02).tolist()) for i in range(1000)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = V.Grid.fit(x, 0.95)
    cell = grid.cells(x)
    met = set(zip(*map(np.ndarray.tolist, grid.visited(x)), strict=True))
    pairs = [(a, b) for a, b in np.argwhere(x @ x.T >= 0.95).tolist() if a < b]
    assert len(pairs) > 500 and np.mean([(a, cell[b]) in met for a, b in pairs]) >= 0.99


@pytest.mark.parametrize(("width", "rank", "decay"), [(64, 3, 0), (64, 8, 0), (256, 3, 0), (256, 6, 0), (64, None, 1.5), (256, None, 1.0)])
def test_recall_where_vectors_differ_in_few_directions(spark, width, rank, decay):
    """Neighbours that differ along the directions that also part the codes: the walk must reach further."""
    r = np.random.default_rng(width)
    if rank:
        x = r.standard_normal((3000, rank)) @ r.standard_normal((rank, width))
    else:
        x = r.standard_normal((3000, width)) * (np.arange(1, width + 1) ** -decay)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want, found = brute(rows), got(V.near_duplicates(frame))
    assert sum(w[1] for w in want) > 100 and sum(f[1] for f in found) >= 0.99 * sum(w[1] for w in want)
    assert all(f[1] <= w[1] for f, w in zip(found, want, strict=True))


def test_codes_grow_with_the_rows():
    assert [V.codes_for(n, 10_000) for n in (0, 1000, 1_000_000, 10**9)] == [32, 32, 125, 1250]
