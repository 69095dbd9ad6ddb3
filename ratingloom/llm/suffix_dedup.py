"""Repeated byte strings of at least 400 bytes, by prefix-free parsing.

Eight bytes whose hash is a multiple of ``EVERY`` are a trigger. Every text is parsed into phrases, from one
trigger to the end of the next, so equal strings are parsed alike wherever they stand. Each suffix of the corpus is
the suffix of a phrase followed by the suffix of the parse after it, and suffixes that agree in their first
400 bytes stand side by side in the order that the two give. Only that neighbourhood is needed here, not the
rank, so suffixes are brought together by hashes of their first 400 bytes instead of being sorted:

1. dictionary: phrases are counted; a suffix can only be repeated if all phrases inside its first 400
   bytes are, which leaves the repetitive part of the corpus;
2. parse: of what is left, each phrase occurrence with the bytes that all suffixes starting in it
   read; if this comes twice, all of them are repeated, and one occurrence stands for the rest;
3. both: suffixes of single occurrences, at the edges of repeats, are compared one by
   one with each other and with those of the representatives that are followed by the same phrase.

Repeats too short to be removed are told from the parse alone: a stretch from where a phrase begins to the end of
the first trigger that lies half a window or more behind, with which another phrase begins too.

No step gathers the occurrences of a string: hashes are counted before the shuffle, and what each
text needs to know of its phrases comes back by a join.

A text's bytes are those of its UTF-8 form; null counts as empty. Equal rows, also of one doc_id, repeat each
other. A null doc_id is handled like any other and returned as null. Texts are taken whole; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import lists, raw_bytes, release
from ratingloom.llm.hashing import U64, Stretches, mix
from ratingloom.llm.repeated import KEY, both_hashes, by_text, given_id, keyed, list_parts, repeated_values, runs_of, with_runs
from ratingloom.sources.durable import durable

LENGTH = 400
TRIGGER = 8
EVERY = 32  # bytes of a phrase on average; few windows of 400 bytes are then without a whole phrase


def phrase_starts(text: bytes) -> np.ndarray:
    """Where phrases begin: at 0 and at every trigger."""
    n = len(text) - TRIGGER + 1
    grams = np.empty(max(n, 0), np.uint64)
    for k in range(min(TRIGGER, n)):
        grams[k::TRIGGER] = np.frombuffer(text, "<u8", (n - k + TRIGGER - 1) // TRIGGER, k)
    found = np.flatnonzero((mix(grams) & U64(EVERY - 1)) == 0)
    return found if len(found) and found[0] == 0 else np.concatenate([[0], found])


def _phrase_hashes(text: bytes, starts: np.ndarray, whole: Stretches) -> np.ndarray:
    """Of each phrase with the trigger that ends it; the last one ends with the text."""
    return whole.hash(starts, np.minimum(np.append(starts[1:] + TRIGGER, len(text)), len(text)))


def _phrases(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, row, nth, h) of all phrases of texts that have half a window at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in raw_bytes(b.column(2)):
                if len(text) < length // 2:
                    out.append(np.empty(0, np.int64))
                    continue
                out.append(_phrase_hashes(text, phrase_starts(text), Stretches.of_bytes(text)).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists(out, pa.int64())], [*KEY, "hashes"])

    hashed = docs.mapInArrow(run, "doc_id bigint, row int, hashes array<bigint>")
    return hashed.select(*KEY, F.posexplode("hashes").alias("nth", "h"))


def _spots(matched: DataFrame, length: int) -> DataFrame:
    """(doc_id, row, start, n, a, b, follows, loose, size, c): in each phrase the suffixes that may be
    repeated, with a hash of all they read, the phrase that follows, and whether there are
    suffixes among them that hold no whole phrase; and the bytes and the hash of the stretch of half a window or
    more that begins with the phrase. ``n`` and ``size`` are 0 where there is none that may be repeated."""
    names = [("doc_id", pa.int64()), ("row", pa.int32()), ("start", pa.int32()), ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("follows", pa.int64()), ("loose", pa.bool_()), ("size", pa.int32()), ("c", pa.int64())]

    def spots(text: bytes, repeated: np.ndarray) -> tuple[np.ndarray, ...] | None:
        if len(text) < length // 2:
            return None
        starts = phrase_starts(text)
        ends = np.append(starts[1:], len(text))
        closed = ends + TRIGGER
        closed[-1] = len(text) + length + 1  # ended by the text, not by a trigger: in no window as a whole
        one = Stretches.of_bytes(text)
        again = np.zeros(len(starts), bool)
        again[repeated] = True
        # the first phrase behind this one that is unique must not end inside the window
        unique = np.where(again, len(text) + length + 1, closed)
        bound = np.append(np.minimum.accumulate(unique[::-1])[::-1][1:], len(text) + length + 1)
        n = np.minimum(np.minimum(ends, len(text) - length + 1), bound - length) - starts
        n = np.maximum(n, 0)
        last = np.searchsorted(closed, starts + length // 2)  # the phrase whose trigger ends the stretch
        uniques = np.append(0, np.cumsum(~again))
        stretch = (last < len(starts) - 1) & (uniques[last + 1] == uniques[:-1])
        some = np.flatnonzero((n > 0) | stretch)
        if not len(some):
            return None
        s, n, stretch = starts[some], n[some], stretch[some]
        size = np.where(stretch, closed[last[some]] - s, 0)
        c = np.where(stretch, one.hash(s, s + size).view(np.int64), 0)
        a, k = both_hashes(one, Stretches.of_bytes(text, 1), s, np.where(n > 0, s + n - 1 + length, s))
        phrases = _phrase_hashes(text, starts, one).view(np.int64)
        follows = np.append(phrases, 0)[some + 1]
        loose = np.append(closed, len(text) + length)[some + 1] > s + length
        return s, n, a, k, follows, loose, size, c

    def batch(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), kind) for c, (_, kind) in zip(zip(*held, strict=True), names, strict=True)], schema=pa.schema(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            docs, nth_row = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ends, (nth,) = list_parts(b.column(3))
            for i, text in enumerate(raw_bytes(b.column(2))):
                found = spots(text, nth[ends[i] : ends[i + 1]])
                if found is None:
                    continue
                held.append((np.full(len(found[0]), docs[i]), np.full(len(found[0]), nth_row[i]), *found))
                rows += len(found[0])
                if rows >= 20_000:
                    yield batch(held)
                    held, rows = [], 0
        if held:
            yield batch(held)

    schema = "doc_id bigint, row int, start int, n int, a bigint, b bigint, follows bigint, loose boolean, size int, c bigint"
    return matched.mapInArrow(run, schema)


SINGLE, STANDING, SURE = 0, 1, 2


def _suffixes(opened: DataFrame, length: int) -> DataFrame:
    """(doc_id, row, kind, at, hashes) of the opened spots of each text: SINGLE suffixes with their places; one of
    each that stands for several; and SURE runs (first place, number) of what comes twice in the text itself,
    so a periodic text does not hand on each of its suffixes."""
    names = [("doc_id", pa.int64()), ("row", pa.int32()), ("kind", pa.int32()), ("at", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))]

    def suffixes(b: pa.RecordBatch, i: int, text: bytes) -> Iterator[tuple]:
        spots = b.column(3)[i].as_py()
        at = np.concatenate([np.arange(p["start"], p["start"] + p["n"]) for p in spots])
        single = np.repeat([p["single"] for p in spots], [p["n"] for p in spots])
        h = Stretches.of_bytes(text).hash(at, at + length).view(np.int64)
        _, back, times = np.unique(h, return_inverse=True, return_counts=True)
        alone = single & (times[back] == 1)
        sure = np.sort(at[single & ~alone])
        first = np.flatnonzero(np.diff(sure, prepend=-2) > 1)
        doc, row = b.column(0)[i].as_py(), b.column(1)[i].as_py()
        yield doc, row, SINGLE, at[alone], h[alone]
        yield doc, row, STANDING, at[:0], np.unique(h[~alone])
        yield doc, row, SURE, sure[first], np.diff(np.append(first, len(sure)))

    schema = "doc_id bigint, row int, kind int, at array<int>, hashes array<bigint>"
    return opened.mapInArrow(lambda batches: by_text(batches, 2, suffixes, pa.schema(names), 500), schema)


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, row, runs): runs of positions whose next ``length`` bytes also start anywhere else. ``docs`` is keyed.

    A repeated stretch of ``size`` bytes is a run of ``size - length + 1`` windows; those of less than a window,
    but half of one at least, come as runs of 0 or fewer."""
    spark = docs.sparkSession
    phrases = _phrases(docs, length)
    matched = durable(phrases.join(repeated_values(phrases, "h"), "h").groupBy(*KEY).agg(F.collect_set("nth").alias("runs")))
    release(spark)
    found = durable(_spots(with_runs(docs, matched, "left"), length))  # a long phrase may hold a whole repeat
    release(spark)
    shared = repeated_values(found.filter("size > 0"), "c")
    spots = found.filter("n > 0")
    place = F.struct(*KEY, "start")
    classes = durable(spots.groupBy("a", "b").agg(F.count("*").alias("times"), F.min(place).alias("first")))
    release(spark)
    stands = place == F.col("first")
    told = spots.join(classes, ["a", "b"]).withColumns({"stands": stands, "follows": F.when((F.col("times") == 1) | stands, F.col("follows"))})
    # what no later step reads of the many that are repeated is left out
    told = told.withColumns({c: F.when(F.col("times") == 1, F.col(c)) for c in ("size", "c")})
    named = durable(told.select(*KEY, "start", "n", "follows", "loose", "size", "c", "times", "stands"))
    release(spark)
    single = named.filter("times = 1")
    behind = single.select("follows").distinct()
    standing = named.filter("times > 1 and stands")
    opened = single.union(standing.filter("loose")).union(standing.filter("not loose").join(behind, "follows", "left_semi").select(*named.columns))
    # equal rows of one doc_id would open a spot once for each, which counts it as often; it is a repeat anyway
    opened = opened.groupBy(*KEY).agg(F.collect_set(F.struct("start", "n", (F.col("times") == 1).alias("single"))).alias("runs"))
    suffixes = durable(_suffixes(with_runs(docs, durable(opened), "inner"), length))
    release(spark)
    pairs = suffixes.select(*KEY, "kind", F.explode(F.arrays_zip("at", "hashes")).alias("p"))
    each = pairs.filter(F.col("kind") != SURE).select(*KEY, F.col("p.at").alias("start"), F.lit(1).alias("n"), "kind", F.col("p.hashes").alias("h"))
    again = durable(each.groupBy("h").agg(F.sum(F.when(F.col("kind") == SINGLE, 1).otherwise(2)).alias("s")).filter("s > 1").select("h"))
    release(spark)
    edges = each.filter(F.col("kind") == SINGLE).join(again, "h").select(*KEY, "start", "n")
    sure = pairs.filter(F.col("kind") == SURE).select(*KEY, F.col("p.at").alias("start"), F.col("p.hashes").cast("int").alias("n"))
    # a stretch is not longer than the window of a repeated spot, or its windows are told repeated one by one
    columns = [*KEY, "start", "size", "c"]
    short = found.filter("n = 0").select(columns).union(single.filter("size > 0").select(columns))
    stretches = short.join(shared, "c").select(*KEY, "start", (F.col("size") - length + 1).alias("n"))
    marked = durable(runs_of(named.filter("times > 1").select(*KEY, "start", "n").union(edges).union(sure).union(stretches)))
    release(spark)
    return marked


def _covered(n_bytes: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which bytes lie in one of the stretches."""
    edge = np.bincount(start, minlength=n_bytes + 1) - np.bincount(end, minlength=n_bytes + 1)
    return np.cumsum(edge[:-1]) > 0


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary, n_repeated) for every row of ``docs`` (doc_id, text): what
    is left after all bytes in repeated strings are removed, and from how many places; and the bytes in
    those strings and in repeated stretches of half a ``length`` or more, which stay."""
    given = keyed(docs)
    marked = with_runs(given, repeated_windows(given, length), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, spans, kept, repeated = [], [], [], [], []
            ends, (start, n) = list_parts(b.column(3))
            for i, text in enumerate(raw_bytes(b.column(2))):
                total.append(len(text))
                if ends[i] == ends[i + 1]:
                    removed.append(0)
                    spans.append(0)
                    kept.append(text)
                    repeated.append(0)
                    continue
                s, k = start[ends[i] : ends[i + 1]], n[ends[i] : ends[i + 1]]
                gone = _covered(len(text), s[k > 0], (s + k - 1 + length)[k > 0])
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                repeated.append(int(_covered(len(text), s, s + k - 1 + length).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in (total, removed, spans)), pa.array(kept, pa.binary()), pa.array(repeated, pa.int64())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_repeated"],
            )

    out = marked.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, n_repeated bigint")
    return out.withColumn("doc_id", given_id())


def digests(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")
