import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from ratingloom.llm import byte_bpe

RANKS = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
CODER = byte_bpe.Coder(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


SPACES = ["a b", "a  b", " a", "  a", "a ", "a  ", "a \nb", "a\n b", "a\n ", "a \n b", "\n \n", "a\u3000 \u00a0b  c", " ", "  ", " 's 't", "a\x1c \x1cb", "a\x85 b \x85 c"]
TEXTS = [*SPACES, "", " ", "\n\n", "a", "It's 12345 ünïcode — ñandú's 日本語 🎉", "x" * 5000, "ab" * 3000, "é" * 999, " " * 300 + "end", "\x00\x01<|endoftext|>"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(library, text):
    ids = CODER.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


def test_slices_of_long_texts(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE", 7)
    rng = np.random.default_rng(1)
    for _ in range(300):
        text = "".join(rng.choice(list("aab12é' .,  \n\t"), 60))
        want = library.encode_ordinary(text)
        n, ids, decoded, slices = CODER.digest(text)
        assert np.frombuffer(b"".join(slices), np.int32).tolist() == want and n == len(want)
        assert ids == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest() and decoded == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabcdestihnérüñß  .,'\n\t0129*#日🎉")), max_size=80))
def test_any_text_equals_the_library(text):
    lib = test_any_text_equals_the_library.library
    assert CODER.encode(text).tolist() == lib.encode_ordinary(text)


test_any_text_equals_the_library.library = tiktoken.Encoding(
    "own", pat_str=P.PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())},
)


def test_digests_over_rows_with_nulls_and_clashing_names(spark, library):
    rows = [(1, "one two", "x", 7), (2, None, "y", 8), (3, "", None, None), (1, "one two", "x", 7), (None, "z", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, token_ids bigint")
    got = sorted(byte_bpe.digests(docs, RANKS, P.PATTERN).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [1, 1, 2, 3, None]
    for r, text in zip(got, ["one two", "one two", "", "", "z"], strict=True):
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.digests(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_forgetting_does_not_change_ids(monkeypatch):
    monkeypatch.setattr(byte_bpe, "BYTES_KEPT", 500)
    monkeypatch.setattr(byte_bpe, "PAIRS_KEPT", 2)
    text = "several words that come, several words that go again"
    assert np.array_equal(byte_bpe.Coder(RANKS, P.PATTERN).encode(text), CODER.encode(text))
