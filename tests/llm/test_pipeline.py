import hashlib

import public_tokenizers as P
import tiktoken
import base64
from test_decontaminate import brute as tainted
from test_minhash import brute as groups
from test_personal_data import brute as spans

import corpus_pipeline as C

D = "/root/testdata/sf0.001"


def test_every_stage_by_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").select("item_id", "text").collect()]
    frames = [docs]
    for _, stage in C.STAGES:
        frames.append(stage(spark, frames[-1], D).persist())
    rows = [{r.doc_id: r for r in f.collect()} for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert set(rows[1]) == set(rows[0])  # every document has letters and a known language
    assert sum(rows[1][i].lang == rows[0][i].lang for i in rows[1]) > 0.97 * len(rows[1])
    texts = [(i, r.text) for i, r in sorted(rows[1].items())]
    assert set(rows[2]) == {i for i, _, _, kept in groups(texts, 80) if kept}
    assert set(rows[3]) == set(rows[2]) - {d for d, _ in tainted([(i, r.text) for i, r in rows[2].items()], items)}
    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        before = rows[3][i].text
        assert r.n_chars == len(r.text)
        assert all(before[a:e] not in r.text or len(before[a:e]) < 8 for _, a, e in spans(before))
        if not any(c.isdigit() or c == "@" for c in before):
            assert r.text == before
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(rows[5]) == set(rows[4])
    for i, r in rows[5].items():
        ids = library.encode_ordinary(rows[4][i].text)
        assert list(r.token_ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[4][i].text.encode()).hexdigest()


def test_rows_of_every_kind(spark):
    text = " ".join(f"word{k} wort" for k in range(30))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, text, "en", None, None), (3, None, None, "s", 0), (4, "", "en", "s", 0), (5, "12 34", "en", "s", 5), (None, "some other words here", "en", "s", 2), (6, "mail a.b@c.de now", "en", "s", 9)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, judged string")
    got = docs
    for _, stage in C.STAGES:
        got = stage(spark, got, D).persist()
    assert sorted((r.doc_id for r in got.collect()), key=str) == [1, 6, None]
    none = docs.limit(0)
    for _, stage in C.STAGES:
        none = stage(spark, none, D)
    assert none.count() == 0
