"""Repeated passages of at least 35 words, by difference-cover anchors.

Only word positions whose remainder modulo 21 is in ``COVER`` are anchors. The differences of the five
remainders give every number modulo 21, so wherever a passage lies in two texts, some shift below
21 brings both onto anchors: two equal windows of 35 words share an aligned anchor
of 35 - 20 = 15 words. Hashes of these are counted over the whole corpus, and a window is
a candidate if it holds an anchor that comes twice.

Candidates are then extended to whole windows. They are cut into blocks where the text says so (so
copies are cut alike), and blocks are compared as wholes first: all windows of a block that comes
twice are repeated. Windows of blocks that come once, at the edges of passages, are
compared one by one with all windows of distinct blocks.

Words and order are those of ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts have no words; a
text of fewer than 35 words keeps all. Equal rows, also of one doc_id, are repetitions of each other. A
null doc_id is handled like any other and returned as null. Texts are taken whole; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import lists, raw_bytes, release
from ratingloom.llm.hashing import U64, Stretches, shingle_hashes, word_hashes
from ratingloom.llm.repeated import KEY, both_hashes, by_text, covered, given_id, keyed, repeated_values, runs, runs_of, with_runs
from ratingloom.sources.durable import durable

PERIOD = 21
COVER = np.array([3, 6, 7, 12, 14])  # a perfect difference set
WINDOW = 35
CUT_WORDS, CUT_EVERY = 4, 16  # a block begins where four words say so, every 16 words or so


def anchor_places(n_words: int, window: int) -> np.ndarray:
    """Positions of the anchors of a text, in order."""
    length = window - PERIOD + 1
    every = (np.arange(0, n_words // PERIOD + 1)[:, None] * PERIOD + COVER).ravel()
    return every[every + length <= n_words] if n_words >= window else every[:0]


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, row, nth, h): the hash of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in raw_bytes(b.column(2)):
                words = word_hashes(text)
                place = anchor_places(len(words), window)
                out.append(shingle_hashes(words, window - PERIOD + 1)[place].view(np.int64) if len(place) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists(out, pa.int64())], [*KEY, "hashes"])

    hashed = docs.mapInArrow(run, "doc_id bigint, row int, hashes array<bigint>")
    return hashed.select(*KEY, F.posexplode("hashes").alias("nth", "h"))


def _blocks(matched: DataFrame, window: int) -> DataFrame:
    """(doc_id, row, start, n, a, b, windows): blocks of candidate windows with their hashes."""
    kind = pa.schema([("doc_id", pa.int64()), ("row", pa.int32()), ("start", pa.int32()), ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("windows", pa.list_(pa.int64()))])

    def blocks(b: pa.RecordBatch, i: int, text: bytes) -> Iterator[tuple]:
        words = word_hashes(text)
        n = len(words) - window + 1
        place = anchor_places(len(words), window)[np.array(b.column(3)[i].as_py())]
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, np.clip(place - PERIOD + 1, 0, n), 1)
        np.add.at(edge, np.clip(place + 1, 0, n), -1)
        candidate = np.cumsum(edge)[:n] > 0
        cut = (shingle_hashes(words, CUT_WORDS)[:n] % U64(CUT_EVERY)) == 0
        before = np.concatenate([[False], candidate[:-1]])
        start = np.flatnonzero(candidate & (cut | ~before))
        if not len(start):
            return
        after = np.concatenate([candidate[1:], [False]])
        ends = np.concatenate([cut[1:], [True]])
        end = np.flatnonzero(candidate & (ends | ~after)) + 1
        one, two = both_hashes(Stretches(words, 0), Stretches(words, 1), start, end + window - 1)
        hashes = shingle_hashes(words, window).view(np.int64)
        doc, row = b.column(0)[i].as_py(), b.column(1)[i].as_py()
        for s, e, x, y in zip(start.tolist(), end.tolist(), one.tolist(), two.tolist(), strict=True):
            yield doc, row, s, e - s, x, y, hashes[s:e]

    schema = "doc_id bigint, row int, start int, n int, a bigint, b bigint, windows array<bigint>"
    return matched.mapInArrow(lambda batches: by_text(batches, 2, blocks, kind), schema)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, row, runs): the runs of windows whose words also start anywhere else. ``docs`` is keyed."""
    spark = docs.sparkSession
    anchors = _anchors(docs, window)
    matched = durable(anchors.join(repeated_values(anchors, "h"), "h").groupBy(*KEY).agg(F.collect_set("nth").alias("runs")))
    release(spark)
    blocks = durable(_blocks(with_runs(docs, matched, "inner"), window))
    release(spark)
    # equal blocks have equal windows, so one of them stands for all
    classes = durable(blocks.groupBy("a", "b").agg(F.count("*").alias("times"), F.first("windows").alias("windows")))
    windows = classes.select("a", "b", "times", F.posexplode("windows").alias("nth", "h"))
    again = durable(windows.groupBy("h").agg(F.sum(F.least("times", F.lit(2))).alias("s")).filter("s > 1").select("h"))
    single = windows.filter("times = 1").join(again, "h").groupBy("a", "b").agg(F.collect_list("nth").alias("hit"))
    many = classes.filter("times > 1").select("a", "b", F.lit(None).cast("array<int>").alias("hit"))
    found = blocks.select(*KEY, "start", "n", "a", "b").join(many.union(single), ["a", "b"])
    # a block that comes twice counts whole, another by its windows
    each = F.when(F.col("hit").isNull(), F.array(F.struct("start", "n"))).otherwise(
        F.transform("hit", lambda k: F.struct((F.col("start") + k).alias("start"), F.lit(1).alias("n")))
    )
    marked = durable(runs_of(found.select(*KEY, F.inline(each).alias("start", "n"))))
    release(spark)
    return marked


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text): what is left after
    all words in repeated windows are removed, joined by single spaces."""
    given = keyed(docs)
    marked = with_runs(given, repeated_windows(given, window), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, kept = [], [], []
            marks = b.column(3)
            for i, text in enumerate(raw_bytes(b.column(2))):
                words = text.split()
                gone = covered(len(words), window, runs(marks, i)) if marks[i].is_valid else np.zeros(len(words), bool)
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g] if removed[-1] else words).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    out = marked.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
    return out.withColumn("doc_id", given_id())


def digests(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
