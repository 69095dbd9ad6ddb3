import numpy as np


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def snap(x):
    return np.floor(x * 1e6 + 0.5) / 1e6


def matrix(cells, users, items):
    out = np.zeros((len(users), len(items)))
    for (u, i), r in cells.items():
        out[users.index(u), items.index(i)] = r
    return out


def check_recs(recs, seen, n):
    """Ranks 1..m without gaps, at most n rows, nothing the user has seen."""
    per_user = {}
    for r in recs.collect():
        assert (r["user_id"], r["item_id"]) not in seen
        per_user.setdefault(r["user_id"], []).append((r["rank"], r["item_id"]))
    for user, got in per_user.items():
        assert [k for k, _ in sorted(got)] == list(range(1, len(got) + 1)), user
        assert len(got) <= n and len({i for _, i in got}) == len(got), user
    return per_user
