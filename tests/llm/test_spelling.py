import itertools
import re
import zlib
from collections import Counter

import numpy as np

from ratingloom.llm import spelling as S

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=5):
    form, near = {}, {}
    for w in counts:
        others = [o for o in counts if o != w and one_edit(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], near[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_all_short_words_over_a_small_alphabet(spark):
    r = np.random.default_rng(3)
    every = ["".join(t) for size in range(1, 6) for t in itertools.product("aÿb", repeat=size)]
    counts = {w: int(r.choice([1, 2, 2, 30, 200, 5000])) for w in every}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = got(S.variants(frame))
    assert found == brute(counts)
    assert any(a != f and f is not None for _, f, a, *_ in found)  # roots beyond the form


def test_whole_texts_equal_brute_force(spark):
    r = np.random.default_rng(4)
    base = ["colour", "color", "colours", "honour", "Éclairs", "straße", "grüßen", "aaaaaa", "aaaaaaa", "xyz", "neighbour"]
    docs = []
    for i in range(300):
        words = []
        for w in r.choice(base, 40, p=np.array([9, 1, 3, 6, 2, 4, 4, 3, 1, 1, 6]) / 40):
            if r.random() < 0.3:
                k = int(r.integers(len(w)))
                w = w[:k] + "eÿ"[int(r.integers(2))] + w[k + 1 :]
            words.append(w.upper() if r.random() < 0.1 else w)
        docs.append((i if i % 7 else None, ["  ", ", ", "1", "Ā"][i % 4].join(words)))
    docs += [(1, None), (2, ""), (3, "×÷ 123"), docs[5], docs[5]]
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, word int, prefix string")
    found = got(S.report(frame))
    assert found == brute(counts) and len(found) > 20


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 10)
    text = "colour1colours " * 50 + "x" * 40
    assert "".join(S._slices(text, re.compile("[^a-z]"))) == text
    counts = {r.word: r.n for r in S.word_counts(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), noise=0).collect()}
    assert counts == {"colour": 50, "colours": 50, "x" * 40: 1}


def test_empty_tables_and_the_terminator(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.report(docs).count() == 0
    words = spark.createDataFrame([("ab\x00", 3), ("ab", 50), ("abc", 1)], "word string, n bigint")
    assert got(S.variants(words)) == [("ab", None, "ab", 50, 1, None), ("ab\x00", None, "ab\x00", 3, 0, None), ("abc", "ab", "ab", 1, 1, 50)]


def test_groups_survive_batches_and_partitions(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        counts = {a + "bcde" + b: k + 1 for k, (a, b) in enumerate(itertools.product("abcdefgh", repeat=2))}
        frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
        assert got(S.variants(frame, least_ratio=2)) == brute(counts, 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
