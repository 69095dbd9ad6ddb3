import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratingloom.llm import language_id as L
from ratingloom.llm.queries import QUERIES


def tree(text: bytes) -> L.Tree:
    data = np.frombuffer(bytes(3) + text, np.uint8).astype(np.int64)
    keys, n = np.unique(data[3:] | data[2:-1] << 8 | data[1:-2] << 16 | data[:-3] << 24, return_counts=True)
    return L.Tree(keys, n)


def brute_bits(learned: bytes, gram: bytes) -> float:
    """Code length by counting afresh, one context at a time."""
    padded = bytes(3) + learned
    follow = defaultdict(Counter)
    for i in range(3, len(padded)):
        for k in range(4):
            follow[padded[i - k : i]][padded[i]] += 1
    cost, out = 0.0, set()
    for k in (3, 2, 1, 0):
        context = gram[3 - k : 3]
        if context not in follow:
            continue
        left = {s: c for s, c in follow[context].items() if s not in out}
        n, d = sum(left.values()), len(left)
        if gram[3] in left:
            return cost + math.log2((n + d) / left[gram[3]])
        if d:
            cost += math.log2((n + d) / d)
        out = set(follow[context])
    return cost + math.log2(256 - len(out))


def test_code_lengths_equal_counting():
    rng = np.random.default_rng(1)
    learned = bytes(rng.choice(list(b"abcab d"), 400).tolist())
    grams = [bytes(rng.choice(list(b"abcd xyz\0"), 4).tolist()) for _ in range(500)]
    got = tree(learned).bits(np.array([int.from_bytes(g, "big") for g in grams]))
    assert np.allclose(got, [brute_bits(learned, g) for g in grams])


@pytest.mark.parametrize("context", [b"abc", b"\0\0\0", b"zzz", b"za ", b"bca"])
def test_probabilities_of_all_bytes_sum_to_one(context):
    bits = tree(b"abcabdabcabca bab").bits(np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)]))
    assert abs(np.exp2(-bits).sum() - 1) < 1e-9


def test_whole_texts_are_summed_at_any_cut(monkeypatch):
    model = L.Model(["x", "y"], [tree(b"the cat and the hat"), tree("le chat et l'été".encode())])
    texts = [b"", b"t", b"the", b"the cat" * 50, "été".encode() * 70, bytes(5)]
    want = []
    for t in texts:
        p = bytes(3) + t
        want.append([sum(tr.bits(np.array([int.from_bytes(p[i - 3 : i + 1], "big")]))[0] for i in range(3, len(p))) for tr in model.trees])
    for piece in (7, 100, 1 << 18):
        monkeypatch.setattr(L, "PIECE", piece)
        assert np.allclose(model.total_bits(texts), want, rtol=1e-5)


def test_rows_of_every_kind(spark):
    docs = [(i, "the cat sat on the mat and ran", "en") for i in range(20)] + [(i, "der hund und die katze sind", "de") for i in range(20, 40)]
    docs += [(50, None, "en"), (51, "", None), (52, "123 ... 456", "de"), (53, "the rat", None), (None, "die hand", "zz"), (53, "the rat", None)]
    frame = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id bigint, text string, lang string, score string")
    got = L.identify(frame).collect()
    assert len(got) == len(docs)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert [by[k][0].lang_pred for k in (0, 20, 50, 51, 52, 53, None)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert len(by[53]) == 2
    assert L.identify(frame.limit(0)).count() == 0
    assert {r.lang_pred for r in L.identify(frame.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op4_language_id"](spark, d)
    lang = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    held = got.join(lang, "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
