import hashlib
from collections import Counter

import numpy as np
import pytest

from ratingloom.llm import suffix_dedup as S
from ratingloom.llm.queries import QUERIES


def brute(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    key = lambda t, i: hashlib.blake2b(t[i : i + length], digest_size=16).digest()
    count = Counter(key(t, i) for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[key(t, i)] > 1:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        out.append((doc, len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("text", [b"", b"a", b"1234567", b"12345678", b"123456789", bytes(range(256)) * 5])
def test_phrases_begin_at_zero_and_at_triggers(text):
    grams = np.array([int.from_bytes(text[i : i + 8], "little") for i in range(len(text) - 7)], np.uint64)
    want = {0} | set(np.flatnonzero(S.mix(grams) % S.U64(S.EVERY) == 0).tolist())
    assert S.phrase_starts(text).tolist() == sorted(want)


def test_equal_strings_are_parsed_alike():
    r = np.random.default_rng(0)
    shared, left, right = (bytes(r.integers(97, 123, n).tolist()) for n in (2000, 777, 333))
    one = {p - 777 for p in S.phrase_starts(left + shared) if p >= 777}
    two = {p - 333 for p in S.phrase_starts(right + shared) if p >= 333}
    assert one - {0} == two - {0} and len(one) > 10


def test_passages_of_any_length_and_rows_of_every_kind(spark):
    r = np.random.default_rng(4)
    word = lambda n: "".join(r.choice(list("abcdefgh éß"), n))
    passages = [word(int(n)) for n in (380, 398, 399, 400, 401, 420, 500, 900, 2500)]
    rows = []
    for i in range(60):
        w = word(int(r.integers(0, 700)))
        for _ in range(int(r.integers(0, 3))):
            p = passages[int(r.integers(0, 9))]
            w += p[int(r.integers(0, max(1, len(p) - 350))) :] + word(int(r.integers(0, 200)))
        rows.append((i, w))
    rows += [(100, "x" * 400), (101, "x" * 399), (102, None), (103, ""), (104, "Orre " * 300), (105, "ab" * 1000), (None, passages[7]), (None, None)]
    rows += [rows[3], rows[8], (9, passages[8] + "\n"), (106, "Orre " * 90)]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "doc_id bigint, text string, row int")
    assert got(S.digests(frame)) == brute(rows)
    assert S.digests(frame.limit(0)).count() == 0


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op1_suffix_dedup"](spark, d)) == brute(rows)


def brute_repeated(rows, length=400):
    """Bytes of each row in repeated windows or in repeated stretches of half a window from phrase to trigger."""
    texts = [(t or "").encode() for _, t in rows]
    windows = [[(i, i + length) for i in range(len(t) - length + 1)] for t in texts]
    stretches = []
    for t in texts:
        starts = S.phrase_starts(t).tolist()
        ends = [s + S.TRIGGER for s in starts[1:]]
        first = [(s, next((e for e in ends if e >= s + length // 2), None)) for s in starts]
        stretches.append([(s, e) for s, e in first if e])
    out = [np.zeros(len(t), bool) for t in texts]
    for kind in (windows, stretches):
        count = Counter(t[a:e] for t, spans in zip(texts, kind, strict=True) for a, e in spans)
        for gone, t, spans in zip(out, texts, kind, strict=True):
            for a, e in spans:
                if count[t[a:e]] > 1:
                    gone[a:e] = True
    return sorted(((doc, int(g.sum())) for (doc, _), g in zip(rows, out, strict=True)), key=str)


def repeated(df):
    return sorted(((r.doc_id, r.n_repeated) for r in df.collect()), key=str)


def test_passages_below_a_window_are_reported_and_stay(spark):
    r = np.random.default_rng(8)
    word = lambda n: "".join(r.choice(list("abcdefgh éß"), n))
    passages = [word(int(n)) for n in (60, 150, 200, 230, 300, 330, 360, 700)]
    rows = [(i, word(int(r.integers(0, 500))) + passages[i % 8] + word(int(r.integers(0, 500)))) for i in range(40)]
    rows += [(50, passages[4]), (51, passages[4] + "é"), (52, word(1500)), (None, passages[3]), (None, None), (53, "That " * 70)]
    rows += [rows[3], (54, passages[5]), (54, passages[5])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = S.digests(frame)
    assert got(found) == brute(rows)
    assert repeated(found) == brute_repeated(rows)
    by_doc = {x.doc_id: x for x in found.collect()}
    for doc in (4, 5, 6):  # 300 to 360 characters, some of two bytes
        passage = len(passages[doc].encode())
        assert by_doc[doc].n_repeated > passage // 2 or by_doc[doc].n_removed
    assert by_doc[50].n_removed == 0 and by_doc[50].n_repeated > 150
    assert by_doc[52].n_repeated == 0


def test_repeated_bytes_of_a_whole_table_equal_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op1_suffix_dedup"](spark, d)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"]
    assert repeated(found) == brute_repeated(rows)
    assert any(x.n_repeated and not x.n_removed for x in found.collect())
