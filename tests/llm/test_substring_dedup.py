import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ratingloom.llm import substring_dedup as S
from ratingloom.llm.queries import QUERIES


def brute(rows, window=35):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_the_cover_meets_every_pair_of_places():
    for i in range(S.PERIOD):
        for j in range(S.PERIOD):
            assert any((i + k) % S.PERIOD in S.COVER and (j + k) % S.PERIOD in S.COVER for k in range(S.PERIOD))


def test_passages_of_any_length_and_rows_of_every_kind(spark):
    r = np.random.default_rng(4)
    word = lambda n: [f"w{int(x)}" for x in r.integers(0, 10**6, n)]
    passages = [word(int(n)) for n in (33, 34, 35, 36, 40, 60, 120, 300)]
    rows = []
    for i in range(60):
        w = word(int(r.integers(0, 80)))
        for _ in range(int(r.integers(0, 3))):
            p = passages[int(r.integers(0, 8))]
            a = int(r.integers(0, max(1, len(p) - 30)))
            w += p[a:] + word(int(r.integers(0, 30)))
        rows.append((i, " ".join(w)))
    rows += [(100, "same " * 34), (101, "tick tock " * 200), (102, None), (103, ""), (104, " \n\t"), (None, " ".join(passages[5])), (None, None)]
    rows += [rows[3], rows[8], (9, " ".join(passages[7]) + "\n")]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "doc_id bigint, text string, row int")
    assert got(S.digests(frame)) == brute(rows)
    assert S.digests(frame.limit(0)).count() == 0


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op7_substring_dedup"](spark, d)) == brute(rows)


def test_null_ids_whose_texts_share_a_short_hash(spark):
    made = spark.range(300_000).selectExpr("repeat(concat('w', id, ' '), cast(36 + id % 9 as int)) AS text")
    same = made.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("texts")).filter("size(texts) > 1")
    rows = [(None, t) for r in same.collect() for t in r.texts]
    assert len(rows) > 3
    assert got(S.digests(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)
