import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ratingloom.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def texts():
    r = np.random.default_rng(7)
    words = ["the", "Größe", "don't", "x" * 70, "日本語テキスト", "été", "́", "12345", "a b", "a\x1cb", "İstanbul", "ΣΑΣ,", "👍🏽", "well-known", "foo bar"]
    gaps = [" ", "\n", "  ", "\t\r\n", "\v", "\f "]
    out = []
    for i in range(400):
        n = int(r.integers(1, 60)) if i % 5 else int(r.integers(1, 3000))
        out.append("".join(w + g for w, g in zip(r.choice(words, n), r.choice(gaps, n), strict=True)))
    return [*out, "", None, " ", out[3], "word " * 9000]


def checked(rows, want, sizes=P.TIERS):
    """Every id of every document in one piece, gapless sequences; returns tokens and padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for doc, ids in want.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0 and r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    padding, groups = 0, defaultdict(int)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= sizes[0] and len({(r.tier, r.step_group) for r in pieces}) == 1
        padding += 0 if at & (at - 1) == 0 else sizes[0] - at
        groups[pieces[0].step_group] += at
    return sum(map(len, want.values())), padding, groups, by_sequence


def test_ids_equal_those_of_whole_texts(vocabulary, whole, monkeypatch):
    monkeypatch.setattr(P, "SLICE", 500)
    own = P.Coder(vocabulary)
    for text in texts():
        ids = b"".join(own.slices((text or "").encode()))
        assert np.frombuffer(ids, "<u4").tolist() == whole(text)[:-1]


def test_a_worker_forgets_and_stays_right(vocabulary, whole, monkeypatch):
    monkeypatch.setattr(P, "BYTES_KEPT", 3000)
    own = P.Coder(vocabulary)
    for text in texts()[:60]:
        assert np.frombuffer(own.encode([(text or "").encode()])[0], "<u4").tolist() == whole(text)[:-1]


def test_each_id_lies_in_one_piece(spark, vocabulary, whole):
    docs = list(enumerate(texts()))
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, length int, tier string").repartition(5)
    rows = P.pack(frame, vocabulary).collect()
    tokens, padding, _, sequences = checked(rows, {i: whole(t) for i, t in docs})
    assert tokens > 50_000 and padding < 2048
    assert {r.tier for r in rows} >= set(P.TIERS)
    cut = [i for i in {r.doc_id for r in rows} if sum(r.doc_id == i for r in rows) > 1 and len(whole(docs[i][1])) <= 2048]
    assert len(cut) <= len(sequences)


def test_packs_of_a_task_hand_on_their_open_window(spark, vocabulary, whole, monkeypatch):
    docs = list(enumerate(texts()))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(P, "PACK_TOKENS", 20_000)
    monkeypatch.setattr(P, "SLICE", 3000)
    # workers import the module afresh, so the generator is run here with the small sizes
    rows, own, current, out = P.Rows(0, 8192), P.Coder(vocabulary), P.Pack(), []
    for i, slices in own.read((i, (text or "").encode()) for i, text in docs):
        P._read(i, slices, 2048, rows, current)
        if current.tokens >= P.PACK_TOKENS:
            full, last = current.windows()
            out += rows.batch(full, 2048).to_pylist()
            current = P.Pack()
            for document, start, length in last.pieces if last else ():
                current.add(document, start, length)
    full, last = current.windows()
    out += rows.batch([*full, *([last] if last else [])], 2048).to_pylist()
    tokens, padding, groups, _ = checked([type("R", (), r) for r in out], {i: whole(t) for i, t in docs})
    assert padding < 2048 and tokens / 8192 * 0.8 < len(groups) < tokens / 8192 * 1.5
    assert frame.rdd.getNumPartitions() == 1 and sum(r.length for r in P.pack(frame, vocabulary).collect()) == tokens


def test_step_groups_are_even():
    r = np.random.default_rng(1)
    sizes = r.choice(P.TIERS, 2000).tolist()
    group = P.step_groups(sizes, 65_536)
    sums = np.bincount(group, sizes)
    assert sums.max() - sums.min() <= 256 and abs(sums.mean() / 65_536 - 1) < 0.02


def test_longer_pieces_first_and_gaps_from_shorter_tiers():
    pack = P.Pack((8, 4, 2))
    for k, n in enumerate([5, 3, 4, 2, 1, 1]):
        pack.add(P.Document(k, n, bytes(4 * n), 0), 0, n)
    full, last = pack.windows()
    assert [[(d.doc_id, n) for d, _, n in w.pieces] for w in full] == [[(0, 5), (1, 3)], [(2, 4)], [(3, 2)], [(5, 1), (4, 1)]] and last is None
    pack = P.Pack((8, 4, 2))
    for k, n in enumerate([7, 6]):
        pack.add(P.Document(k, n, bytes(4 * n), 0), 0, n)
    full, last = pack.windows()
    assert [[(d.doc_id, s, n) for d, s, n in w.pieces] for w in full] == [[(0, 0, 7), (1, 0, 1)]] and [(d.doc_id, s, n) for d, s, n in last.pieces] == [(1, 1, 5)]


def test_empty_tables_null_ids_and_repeated_rows(spark, vocabulary, whole):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert P.pack(frame, vocabulary).count() == 0
    frame = spark.createDataFrame([(None, "one two"), (None, None), (4, "same"), (4, "same")], "doc_id bigint, text string")
    rows = P.pack(frame, vocabulary).collect()
    want = sum(len(whole(t)) for t in ("one two", None, "same", "same"))
    assert sum(r.length for r in rows) == want and len(rows) == 4 and len({r.sequence_id for r in rows}) == 1
    assert sorted(r.offset for r in rows)[0] == 0
