"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case, so neither punctuation nor line breaks
hide a passage. Two fixed masks of nine words ignore three of them each; between them they
meet every stretch of ``WINDOW`` = 13 words of which at most ``SUBSTITUTED`` = 2 differ.
Seeds of the texts are joined with those of the benchmark, and around each hit the two word
sequences are laid side by side and compared word by word: a document is contaminated by an item if
some 13 aligned words agree in at least 11.

The benchmark is the query set: its words are sent to the tasks in blocks of at most ``BLOCK_WORDS``
words, and each block passes over all documents, so its size may grow without bound.
The documents are not shuffled; only hits leave the tasks.

Items of fewer than 13 words contaminate nothing, nor do null and empty texts. Rows sharing a
doc_id or an item_id count as one document or item. Rows with null ids are reported under the null id.
Texts are taken whole; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import id_and_text, tidy
from ratingloom.llm.hashing import BASE, U64, Stretches, mix

# Fixed masks: found by search so that one of them fits between any two of 13 words.
MASKS = ("110100111", "110011101")
WINDOW = 13
SUBSTITUTED = 2
BLOCK_WORDS = 1_000_000

_PLACES = [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == ord("1")) for m in MASKS]
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_hashes(text: str | None) -> np.ndarray:
    data = (text or "").lower().encode()
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[np.frombuffer(data, np.uint8)]
    change = np.diff(inside)
    return Stretches.of_bytes(data).hash(np.flatnonzero(change == 1), np.flatnonzero(change == -1))


def seeds(words: np.ndarray, mask: int) -> np.ndarray:
    """The seed at every position where the mask fits."""
    places = _PLACES[mask]
    n = len(words) - int(places[-1])
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, mask, np.uint64)
    for k, p in enumerate(places):
        total += words[p : p + n] * U64(pow(BASE[0], 2 * k + 3, 1 << 64))
    return mix(total)


class Index:
    """Seeds of one block of the benchmark."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.items = items
        hashes, item, at = [], [], []
        for i, (_, words) in enumerate(items):
            for mask in range(len(MASKS)):
                s = seeds(words, mask) if len(words) >= WINDOW else np.empty(0, np.uint64)
                hashes.append(s)
                item.append(np.full(len(s), i))
                at.append(np.arange(len(s)))
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.item = np.concatenate(item)[order] if item else order
        self.at = np.concatenate(at)[order] if at else order
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.hashes >> U64(44)] = True

    def hits(self, words: np.ndarray) -> list[tuple[int | None, int, int, int]]:
        """(item_id, first word, words laid side by side, of these equal) of each contaminating item."""
        pairs = set()
        for mask in range(len(MASKS)):
            own = seeds(words, mask)
            place = np.flatnonzero(self.sieve[own >> U64(44)])
            if not len(place):
                continue
            first = np.searchsorted(self.hashes, own[place], "left")
            last = np.searchsorted(self.hashes, own[place], "right")
            n = last - first
            row = np.repeat(np.arange(len(place)), n)
            if not len(row):
                continue
            entry = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            both = np.unique(np.stack([self.item[entry], place[row] - self.at[entry]]), axis=1)
            pairs.update(zip(*both.tolist(), strict=True))
        best: dict[int | None, tuple[int, int, int]] = {}
        for i, shift in pairs:
            item_id, item = self.items[i]
            a, e = max(0, -shift), min(len(item), len(words) - shift)
            if e - a < WINDOW:
                continue
            equal = item[a:e] == words[a + shift : e + shift]
            sums = np.cumsum(np.concatenate([[0], equal]))
            if (sums[WINDOW:] - sums[:-WINDOW]).max() >= WINDOW - SUBSTITUTED:
                found = (int(equal.sum()), -(a + shift), e - a)
                best[item_id] = max(best.get(item_id, found), found)
        return [(i, -f, n, m) for i, (m, f, n) in best.items()]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.length("text") / 4 + 1)).first()[0] or 0
    n = int(size // BLOCK_WORDS) + 1
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r.item_id, word_hashes(r.text)) for r in block.distinct().toLocalIterator()]


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, n_equal): one row for every document and item that contaminates it.

    The alignment with most equal words is told; of several, the first in the document.
    """
    spark, text = docs.sparkSession, id_and_text(docs)
    schema = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, n_equal bigint"
    found = spark.createDataFrame([], schema)
    for items in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value)
            for b in batches:
                rows = []
                for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    rows += [(doc, *h) for h in index.hits(word_hashes(t))]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                names = ["doc_id", "item_id", "first_word", "n_words", "n_equal"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        found = found.union(text.mapInArrow(tidy(run), schema))
    most = F.max(F.struct("n_equal", (-F.col("first_word")).alias("f"), "n_words")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(most).select(
        "doc_id", "item_id", (-F.col("m.f")).alias("first_word"), F.col("m.n_words").alias("n_words"), F.col("m.n_equal").alias("n_equal")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    tainted = overlaps(docs, benchmark).select("doc_id").distinct()
    return docs.join(tainted, docs["doc_id"].eqNullSafe(tainted["doc_id"]), "left_anti")
