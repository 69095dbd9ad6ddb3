import itertools

import numpy as np
import regex

from ratingloom.llm import decontaminate as D
from ratingloom.llm.queries import QUERIES


def words(text):
    return regex.findall(r"[0-9a-z\u0080-\U0010FFFF]+", (text or "").lower())


def brute(docs, items):
    """Pairs by laying every item at every shift of every document."""
    out = set()
    for doc, t in docs:
        w = words(t)
        for item, u in items:
            v = words(u)
            for shift in range(-len(v) + D.WINDOW, len(w) - D.WINDOW + 1):
                a, e = max(0, -shift), min(len(v), len(w) - shift)
                equal = [v[k] == w[k + shift] for k in range(a, e)]
                if any(sum(equal[k : k + D.WINDOW]) >= D.WINDOW - D.SUBSTITUTED for k in range(len(equal) - D.WINDOW + 1)):
                    out.add((doc, item))
                    break
    return out


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def test_masks_meet_every_window_with_two_substitutions():
    for wrong in itertools.combinations(range(D.WINDOW), D.SUBSTITUTED):
        assert any(all(p + k not in wrong for p in places) for places in D._PLACES for k in range(D.WINDOW - places[-1]))


def test_substitutions_and_rows_of_every_kind(spark, monkeypatch):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcde"), 3))
    items = [(i, " ".join(word() for _ in range(int(rng.integers(5, 40))))) for i in range(30)] + [(31, None), (32, ""), (None, " ".join(f"n{k}" for k in range(20)))]
    docs = []
    for i in range(120):
        own = [word() for _ in range(60)]
        passage = items[i % 30][1].split()[: int(rng.integers(8, 40))]
        for _ in range(int(rng.integers(0, 4))):
            passage[int(rng.integers(0, len(passage)))] = "zz"
        own[10 : 10 + len(passage)] = [f"{p.upper()}," for p in passage]
        docs.append((i, "\n".join(own)))
    docs += [(200, None), (201, ""), (None, items[-1][1]), (5, docs[5][1])]
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, doc_id string")
    want = brute(docs, items)
    assert 20 < len(want) and (None, None) in want
    assert pairs(D.overlaps(frame, bench)) == want
    kept = [r.doc_id for r in D.clean(frame, bench).collect()]
    assert sorted(k for k in kept) == sorted(i for i, _ in docs if i not in {d for d, _ in want})
    monkeypatch.setattr(D, "BLOCK_WORDS", 50)  # the benchmark in many blocks
    assert pairs(D.overlaps(frame, bench)) == want
    assert pairs(D.overlaps(frame.limit(0), bench)) == set() == pairs(D.overlaps(frame, bench.limit(0)))


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{d}/{t}.parquet").select(i, "text").collect() for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert pairs(QUERIES["op8_decontaminate"](spark, d)) == brute(docs, items)
