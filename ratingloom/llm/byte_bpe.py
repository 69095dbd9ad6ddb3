"""Byte-level BPE: encode whole texts with the ranks of a given vocabulary, decode the ids again.

Each match of the pattern is encoded by itself. Bytes are written as Latin-1
characters, so that an Aho-Corasick automaton finds the longest token at every
position in one pass; the encoder takes longest matches from left to right and goes
back to a shorter one where two neighbours would not stand beside each other in an
encoded text. Whether they do depends on the pair alone and is remembered.
A position that failed is not tried again, so the work is linear in the text.

The ids of a piece are remembered by the worker, within a bound of bytes. Where no match of the pattern reaches over a
single space but begins with it (``SPACED``), very long texts are cut before such spaces and worked off in slices.

Null text counts as empty and gives no ids. Every row is encoded by itself: equal rows
give equal results, an empty table gives an empty one, texts of any length are taken whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ratingloom.llm.common import Remembered, id_and_text, lists, raw_bytes, tidy

# Sizes at which a worker forgets what it has remembered; results do not depend on them.
BYTES_KEPT = 112 << 20
PAIRS_KEPT = 350_000
LONG_WORD = 64
BATCH_IDS = 1 << 20  # ids that a worker gathers before it hands them on
SLICE = 1 << 18  # characters of a text that are encoded at once

# Patterns whose matches hold a space at their beginning only, or in a run of white space.
SPACED = frozenset({public_tokenizers.PATTERN})
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> bytes:
    """The rank file as it is: lines of base64 token and rank."""
    with open(path, "rb") as f:
        return f.read()


class Coder:
    def __init__(self, ranks: bytes, pattern: str):
        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes = {r: t for t, r in self.rank.items()}
        self.size = {r: len(t) for t, r in self.rank.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, r in self.rank.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), r))
        self.automaton.make_automaton()
        # the longest other token that a token begins with
        self.shorter: dict[int, int | None] = {}
        for token, r in self.rank.items():
            cuts = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[r] = next((self.rank[c] for c in cuts if c in self.rank), None)
        self.pairs: dict[int, bool] = {}  # left + 1, then right
        self.some = max(self.bytes) + 1
        self.pieces = Remembered(lambda piece: array("i", self.encode_piece(piece.encode())).tobytes(), BYTES_KEPT, LONG_WORD)
        self.spaced = pattern in SPACED
        self.digits = {r: str(r) for r in self.bytes}

    def merged(self, piece: bytes) -> list[int]:
        """Merge by lowest rank, leftmost first: the definition, for strings of a token or two."""
        rank, none = self.rank.get, 1 << 60
        parts = [piece[i : i + 1] for i in range(len(piece))]
        next_merge = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while next_merge and (least := min(next_merge)) < none:
            i = next_merge.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del next_merge[i]
            if i:
                next_merge[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(next_merge):
                next_merge[i] = rank(parts[i] + parts[i + 1], none)
        return [rank(p) for p in parts]

    def stands(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` (-1: begin the piece)."""
        if left < 0:
            known = self.merged(self.bytes[right]) == [right]
        else:
            known = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[(left + 1) * self.some + right] = known
        return known

    def longest_matches(self, text: str) -> list[int] | None:
        """The longest matches from left to right, if each can follow the one before: then nothing is to go back to."""
        pairs, some = self.pairs, self.some
        ids, left = [], -1
        for _, (_, token) in self.automaton.iter_long(text):
            known = pairs.get((left + 1) * some + token)
            if known is None:
                known = self.stands(left, token)
            if not known:
                return None
            ids.append(token)
            left = token
        return ids

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n, text = len(piece), piece.decode("latin-1")
        straight = self.longest_matches(text)
        if straight is not None:
            return straight
        longest = [-1] * n
        for end, (size, token) in self.automaton.iter(text):
            longest[end + 1 - size] = token  # longer matches from a position come later
        shorter, size_of, pairs, some = self.shorter, self.size, self.pairs, self.some
        failed = bytearray(n + 1)
        ids: list[int] = []
        at, left, token = 0, -1, longest[0]
        while True:
            while token is not None:
                end = at + size_of[token]
                if not failed[end]:
                    known = pairs.get((left + 1) * some + token)
                    if known or known is None and self.stands(left, token):
                        break
                token = shorter[token]
            if token is None:
                failed[at] = 1
                token = ids.pop()
                at -= size_of[token]
                token = shorter[token]
                left = ids[-1] if ids else -1
            else:
                ids.append(token)
                if end == n:
                    return ids
                at, left, token = end, token, longest[end]

    def slices(self, text: str) -> Iterator[bytes]:
        """The ids of a text as 32-bit numbers, slice by slice, in order."""
        at = 0
        while at < len(text):
            cut = SINGLE_SPACE.search(text, at + SLICE) if self.spaced and len(text) - at > SLICE else None
            end = cut.start() if cut else len(text)
            part = text[at:end] if at or cut else text
            yield b"".join(map(self.pieces.__getitem__, self.pattern.findall(part)))
            at = end

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.slices(text)), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def digest(self, text: str) -> tuple[int, str, str, list[bytes]]:
        """Number and hash of the ids, hash of the bytes decoded from them, and the ids in slices."""
        n, ids_hash, decoded_hash, slices = 0, hashlib.sha256(), hashlib.sha256(), []
        for part in self.slices(text):
            ids = np.frombuffer(part, np.int32).tolist()
            if ids:
                ids_hash.update(("," * bool(n) + ",".join(map(self.digits.__getitem__, ids))).encode())
                decoded_hash.update(b"".join(map(self.bytes.__getitem__, ids)))
                n += len(ids)
                slices.append(part)
        return n, ids_hash.hexdigest(), decoded_hash.hexdigest(), slices


    def forget(self) -> None:
        """Give back most of what was remembered: the worker may serve other operators next."""
        self.pieces.clear()
        self.pieces.old, self.pieces.held = {}, 0


_coders: dict[tuple[int, str], Coder] = {}


def coder(ranks: bytes, pattern: str) -> Coder:
    """One coder for each worker process and vocabulary."""
    key = (hash(ranks), pattern)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(ranks, pattern)
    return _coders[key]


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, token_ids array<int>) for every row of ``docs`` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(sent.value, pattern)
        for b in batches:
            ids = [own.encode(t.decode()) for t in raw_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), lists(ids, pa.int32())], ["doc_id", "token_ids"])

    return id_and_text(docs).mapInArrow(tidy(run), "doc_id bigint, token_ids array<int>")


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, token_ids, decoded binary): the bytes that the ids stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(sent.value, pattern)
        for b in batches:
            column = b.column(1)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            decoded = [own.decode(flat[ends[i] : ends[i + 1]]) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([b.column(0), column, pa.array(decoded, pa.binary())], ["doc_id", "token_ids", "decoded"])

    ids = encoded.select("doc_id", "token_ids")
    return ids.mapInArrow(tidy(run), "doc_id bigint, token_ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks: bytes, pattern: str, with_ids: bool = False) -> DataFrame:
    """Counts and hashes of each document's ids and of the bytes decoded from them.

    One pass: a text is encoded, its ids decoded and both hashed by one worker, text by text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids"] if with_ids else [])]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        doc_id, counts, first, second, ids = zip(*rows, strict=True)
        columns = [pa.array(doc_id, pa.int64()), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
        tokens = [lists([np.frombuffer(b"".join(i), np.int32) for i in ids], pa.int32())] if with_ids else []
        return pa.RecordBatch.from_arrays(columns + tokens, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(sent.value, pattern)
        for b in batches:
            rows, held = [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), raw_bytes(b.column(1)), strict=True):
                n, first, second, ids = own.digest(text.decode())
                rows.append((doc_id, n, first, second, ids if with_ids else None))
                held += n if with_ids else 1
                if held >= BATCH_IDS:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)
        own.forget()

    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    return id_and_text(docs).mapInArrow(tidy(run), kinds)
