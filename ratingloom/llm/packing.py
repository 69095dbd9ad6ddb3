"""Hierarchical packing of documents into token sequences of several lengths.

A document is routed by its length to the tier of the smallest context size that holds it; of a document above
the largest size, whole windows of that size are cut first and what is left over is routed. Each tier is packed
into windows of its size, from the longest tier down: a window is opened by the longest piece of its tier,
and its gap is filled by the longest pieces that fit, of its own and of shorter tiers. Where nothing fits, the shortest piece
is cut to fill the gap exactly. So every window but the last of a pack is full, and no full window needs
padding as the sizes are powers of two. The windows of a pack are dealt to step groups, the
largest first to the group of least tokens, so that all groups of a pack hold about equally many.

Texts are packed where they are read: a task packs about ``PACK_TOKENS`` tokens at a time and hands the pieces of its last
open window on to the next pack. Only what is open at the end of a task, less than one window, is
sent on: the open windows of ``TASKS_GATHERED`` tasks are packed by one task in the same way. Of that pack the last
window may be padded: less than one window for so many tasks.

Text is cut at ASCII white space, across which the tokenizer merges nothing, and a worker remembers the
ids of the stretches it has met, up to ``BYTES_KEPT``. Very long texts are encoded in slices and their whole windows are
settled on the way, so a task holds one slice and not their ids; only a text without white space is one slice. Shorter
texts are encoded together, ``GATHERED`` bytes at a time, each different stretch once.
Special tokens of the vocabulary that stand in a text are ordinary text there.

Null text is an empty document, which consists of the closing id alone. Rows are documents of their own, also if
they share a doc_id or are equal; a null doc_id stays null. An empty table gives an empty result. Further columns are
not read. Which documents share a sequence depends on how the table is split into tasks.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from ratingloom.llm.common import Remembered, id_and_text, raw_bytes, tidy
from ratingloom.sources.durable import durable

TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 1 << 16
PACK_TOKENS = 1 << 21
TASKS_GATHERED = 1024
CLOSING = 1  # the id after each document
SLICE = 1 << 20  # bytes of a text that are encoded at once
GATHERED = 32 << 20  # bytes of shorter texts that are encoded together
TOGETHER = 200  # unknown stretches in one call of the tokenizer
LONG_STRETCH = 48
WORD_END = "</w>"  # the end of tokens that end a word, in the vocabulary
STOPS = frozenset(".,;:!?")
BYTES_KEPT = 128 << 20  # about how much a worker remembers
PACKS = 1 << 32  # sequence ids: task, then number in the task
WHITE = re.compile(rb"[ \t\n\r\v\f]")
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_group bigint"
OPEN = "ids binary"


class Coder:
    """Ids of texts, as bytes of little-endian 32-bit numbers."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.known = Remembered(None, BYTES_KEPT, LONG_STRETCH)  # what is missing is encoded together
        tokens = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(tokens.values()) + 1, bool)
        self.ends_word[[i for t, i in tokens.items() if t.endswith(WORD_END)]] = True

    def _unknown(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches, encoded as a few texts.

        Where the words of a stretch are known to be one or two, the ids that end a word tell
        whose ids they are, otherwise the places that the tokenizer gives.
        """
        plain, other = [], []
        for s in stretches:
            (plain if s.isascii() and (s.isalpha() or s[:-1].isalpha() and s[-1] in STOPS) else other).append(s)
        out: dict[str, bytes] = {}
        for part, exact in ((k[a : a + TOGETHER], k is plain) for k in (plain, other) for a in range(0, len(k), TOGETHER)):
            text = " ".join(part)
            if exact:
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                last = np.cumsum([1 if s[-1].isalpha() else 2 for s in part]) - 1
                ends = (np.flatnonzero(self.ends_word[ids]) + 1)[last]
            else:
                encoded = self.tokenizer.encode(text, add_special_tokens=False)
                ids, at = np.array(encoded.ids, "<u4"), np.array(encoded.offsets, np.int64).reshape(-1, 2)[:, 0]
                begins = np.cumsum([0, *(len(s) + 1 for s in part[:-1])])
                ends = np.cumsum(np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=len(part)))
            raw, cuts = ids.tobytes(), (4 * ends).tolist()
            out |= zip(part, [raw[x:y] for x, y in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True)
        return [out[s] for s in stretches]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Stretches are told apart once for all texts, so that each is looked up once."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = words.flatten().dictionary_encode()
        # of other letters the case may decide whether they are composed with a mark
        stretches = [s.lower() if s.isascii() else s for s in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        which, bounds = coded.indices.to_numpy(), words.offsets.to_numpy()
        ids = list(map(self.known.get, stretches))
        if None in ids:
            missing = list(dict.fromkeys([s for s, i in zip(stretches, ids, strict=True) if i is None]))
            values = list(map(self.known.old.get, missing))
            new = iter(self._unknown([s for s, i in zip(missing, values, strict=True) if i is None]))
            values = [next(new) if i is None else i for i in values]
            self.known.put_all(missing, values)
            met = dict(zip(missing, values, strict=True))
            ids = [met[s] if i is None else i for s, i in zip(stretches, ids, strict=True)]
        size = np.array([len(i) // 4 for i in ids], np.int64)
        pool, begin = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        out = []
        for x, y in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            own = which[x:y]
            n = size[own]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(pool[np.repeat(begin[own] - ends + n, n) + np.arange(total)].tobytes())
        return out

    def slices(self, text: bytes) -> Iterator[bytes]:
        """Ids of a text slice by slice, in order."""
        at = 0
        while len(text) - at > SLICE and (white := WHITE.search(text, at + SLICE)):
            yield self.encode([text[at : white.start()]])[0]
            at = white.start()
        yield self.encode([text[at:] if at else text])[0]

    def read(self, docs: Iterator[tuple[int | None, bytes]]) -> Iterator[tuple[int | None, Iterator[bytes]]]:
        """Documents with the slices of their ids, in order; short texts are encoded together."""
        ids, texts, held = [], [], 0
        for doc_id, text in docs:
            if held + len(text) > GATHERED or len(text) > SLICE:
                yield from ((i, iter([e])) for i, e in zip(ids, self.encode(texts), strict=True))
                ids, texts, held = [], [], 0
            if len(text) > SLICE:
                yield doc_id, self.slices(text)
            else:
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
        yield from ((i, iter([e])) for i, e in zip(ids, self.encode(texts), strict=True))


_coders: dict[int, Coder] = {}


def coder(vocabulary: str) -> Coder:
    """One coder for each worker process and vocabulary."""
    key = hash(vocabulary)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(vocabulary)
    return _coders[key]


@dataclass
class Document:
    doc_id: int | None
    tokens: int  # of the whole document
    ids: bytes  # from ``start`` on
    start: int

    def cut(self, start: int, length: int) -> bytes:
        at = 4 * (start - self.start)
        return self.ids[at : at + 4 * length]


@dataclass
class Window:
    size: int
    pieces: list[tuple[Document, int, int]] = field(default_factory=list)  # document, start, length


class Pack:
    """Pieces by length, and the windows made of them."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.by_length: list[list[tuple[Document, int]]] = [[] for _ in range(tiers[0] + 1)]
        self.lengths = 0  # bit n: there is a piece of length n
        self.tokens = 0

    def add(self, document: Document, start: int, length: int) -> None:
        self.tokens += length
        self._put(document, start, length)

    def _put(self, document: Document, start: int, length: int) -> None:
        self.by_length[length].append((document, start))
        self.lengths |= 1 << length

    def _take(self, length: int) -> tuple[Document, int]:
        stack = self.by_length[length]
        piece = stack.pop()
        if not stack:
            self.lengths ^= 1 << length
        return piece

    def _longest(self, most: int) -> int:
        """Of the pieces no longer than ``most``; 0 if there is none."""
        return max(0, (self.lengths & (1 << (most + 1)) - 1).bit_length() - 1)

    def windows(self) -> tuple[list[Window], Window | None]:
        """All full windows, and the one that is left open."""
        full: list[Window] = []
        for size, below in zip(self.tiers, (*self.tiers[1:], 0), strict=True):
            while (length := self._longest(size)) > below:
                window, gap = Window(size), size
                while gap and self.lengths:
                    if length:
                        document, start = self._take(length)
                    else:  # cut the shortest
                        shortest = (self.lengths & -self.lengths).bit_length() - 1
                        document, start = self._take(shortest)
                        self._put(document, start + gap, shortest - gap)
                        length = gap
                    window.pieces.append((document, start, length))
                    gap -= length
                    length = self._longest(gap)
                if gap:
                    return full, window
                full.append(window)
        return full, None


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each window, so that the groups hold about ``step_tokens`` and equally many."""
    groups = [(0, g) for g in range(max(1, round(sum(sizes) / step_tokens)))]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        tokens, g = groups[0]
        heapq.heapreplace(groups, (tokens + sizes[k], g))
        out[k] = g
    return out


class Rows:
    """Collects the rows of full windows; numbers sequences and step groups of one task."""

    def __init__(self, task: int, step_tokens: int):
        self.task, self.step_tokens = task, step_tokens
        self.sequences = self.groups = 0
        self.settled: list[tuple[int | None, int, int, int, int]] = []  # whole windows of long documents: id, start, length, crc, tokens

    def batch(self, full: list[Window], size: int) -> pa.RecordBatch:
        sizes = [w.size for w in full] + [size] * len(self.settled)
        group = step_groups(sizes, self.step_tokens)
        rows = []
        for k, window in enumerate(full):
            offset, key = 0, (self.task * PACKS + self.sequences + k, self.task * PACKS + self.groups + group[k])
            for document, start, length in window.pieces:
                crc = zlib.crc32(document.cut(start, length))
                rows.append((document.doc_id, start, length, crc, document.tokens, key[0], offset, window.size, key[1]))
                offset += length
        for k, (doc_id, start, length, crc, tokens) in enumerate(self.settled, len(full)):
            rows.append((doc_id, start, length, crc, tokens, self.task * PACKS + self.sequences + k, 0, size, self.task * PACKS + self.groups + group[k]))
        self.sequences += len(sizes)
        self.groups += max(group, default=-1) + 1
        self.settled = []
        return _batch(rows, False)


def _batch(rows: list[tuple], opened: bool) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()] + [pa.binary()] * opened
    names = [part.split()[0] for part in (f"{PIECE}, {OPEN}" if opened else PIECE).split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _with_ids(b: pa.RecordBatch, ids: list[bytes] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary()) if ids else pa.nulls(b.num_rows, pa.binary())], [*b.schema.names, "ids"])


def _read(doc_id: int | None, slices: Iterator[bytes], size: int, rows: Rows, pack: Pack) -> None:
    """One document: whole windows of the largest size are settled, the rest goes into the pack."""
    held, start, whole = b"", 0, []
    for ids in slices:
        held = held + ids if held else ids
        cut = 0
        while len(held) - cut > 4 * size:  # more than a window: the closing id is still to come
            whole.append((start, zlib.crc32(held[cut : cut + 4 * size])))
            cut, start = cut + 4 * size, start + size
        held = held[cut:] if cut else held
    held += CLOSING.to_bytes(4, "little")
    if len(held) > 4 * size:
        whole.append((start, zlib.crc32(held[: 4 * size])))
        held, start = held[4 * size :], start + size
    tokens = start + len(held) // 4
    rows.settled.extend((doc_id, s, size, crc, tokens) for s, crc in whole)
    pack.add(Document(doc_id, tokens, held, start), start, tokens - start)


def pack(docs: DataFrame, vocabulary: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): where each lies in its document and in its sequence.

    ``vocabulary`` is the JSON of a tokenizer, ``tiers`` are falling powers of two. ``ids_crc32`` is taken over the ids as
    little-endian 32-bit numbers; ``tier`` is the size of the sequence and ``step_group`` names those that are trained on together.
    """
    size = tiers[0]
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, current = coder(sent.value), Pack(tiers)
        rows = Rows(TaskContext.get().partitionId(), step_tokens)
        for b in batches:
            for doc_id, slices in own.read(zip(b.column(0).to_pylist(), raw_bytes(b.column(1)), strict=True)):
                _read(doc_id, slices, size, rows, current)
                if current.tokens + size * len(rows.settled) >= PACK_TOKENS:
                    full, last = current.windows()
                    yield _with_ids(rows.batch(full, size))
                    current = Pack(tiers)
                    for document, start, length in last.pieces if last else ():
                        current.add(document, start, length)
        own.known = Remembered(None, BYTES_KEPT, LONG_STRETCH)  # the worker may serve other operators next
        full, last = current.windows()
        yield _with_ids(rows.batch(full, size))
        if last:
            left = [(d.doc_id, s, n, 0, d.tokens, rows.task, 0, 0, 0) for d, s, n in last.pieces]
            yield _with_ids(_batch(left, False), [d.cut(s, n) for d, s, n in last.pieces])

    first = durable(id_and_text(docs).mapInArrow(tidy(run), f"{PIECE}, {OPEN}"))
    opened = first.filter(F.col("ids").isNotNull()).withColumn("gathered", F.floor(F.col("sequence_id") / TASKS_GATHERED).cast("bigint"))

    def again(t: pa.Table) -> pa.Table:
        """The open windows of many tasks, packed once more; the last window stays as it is."""
        order = sorted(t.to_pylist(), key=lambda r: (r["sequence_id"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids"]))
        rows, current = Rows(-1 - order[0]["gathered"], step_tokens), Pack(tiers)  # negative: no task of the first pass
        for r in order:
            current.add(Document(r["doc_id"], r["doc_tokens"], r["ids"], r["start"]), r["start"], r["length"])
        full, last = current.windows()
        if last:
            held = sum(n for *_, n in last.pieces)
            last.size = held if held & (held - 1) == 0 else size
            full.append(last)
        return pa.Table.from_batches([rows.batch(full, size)])

    closed = first.filter(F.col("ids").isNull()).drop("ids")
    return closed.union(opened.groupBy("gathered").applyInArrow(again, PIECE))
