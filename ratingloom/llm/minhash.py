"""Near-duplicate texts by b-bit MinHash, confirmed on whole shingle sets.

A text is the set of its runs of five words (ASCII letters in lower case; the whole sequence
if it has fewer words). Texts with equal sets are one class, which its smallest id stands
for. Of every class's signature of 128 minima, 25 bands of five make buckets, and four bits of each
minimum are packed into eight longs: a bit count of two packed signatures gives the share
that agrees, which is corrected for chance agreement.

Links are confirmed on the full sets in two rounds that together leave no candidate out:

1. every class with the smallest id of each of its buckets (one pair for each row);
2. in buckets that still hold more than one component, all pairs from different components,
   compared in blocks of bounded size without writing them out: the estimate may be at most
   ``MARGIN`` below the bound, then short hashes of the full sets are counted. Only the
   best of a text's pairs with another component goes on, and those too near the bound to tell.

A link within a component that is already found cannot change the result and is not looked
for. At the bound of 0.85, a pair shares no bucket with probability (1 - 0.85**5)**25 < 1e-6,
and its estimate lies 0.17 (five standard deviations) too low as rarely.

Null and empty texts have no set and no links. Rows with one doc_id are one document
(linked, if any of its texts is). A null doc_id is linked with nothing: it gets a null component and is
kept. Texts are taken whole; further columns are not read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import groups, id_and_text, lists, raw_bytes, release, tidy
from ratingloom.llm.components import components
from ratingloom.llm.hashing import U64, mix, shingle_hashes, word_hashes
from ratingloom.sources.durable import durable

WIDTH = 5
MINIMA = 128
BANDS, BAND_ROWS = 25, 5
BITS = 4
BLOCK = 512
MARGIN = 0.17

_random = np.random.default_rng(7)
FACTORS = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1)
ADDED = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
BAND_FACTORS = _random.integers(1, 1 << 63, (BANDS, BAND_ROWS), dtype=np.uint64) | U64(1)
LOW_BITS = U64(0x1111111111111111)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted hashes of a text's shingles."""
    return np.unique(shingle_hashes(word_hashes(text.lower()), WIDTH))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 128 minima of a non-empty set."""
    short = (shingles >> U64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(short), 256):
        part = short[a : a + 256, None] * FACTORS
        part += ADDED
        np.minimum(least, part.min(0), out=least)
    return least


def bands(minima: np.ndarray) -> np.ndarray:
    """A bucket number for each band; different bands have different numbers."""
    rows = minima[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64) + U64(1)
    return mix((rows * BAND_FACTORS).sum(1, dtype=np.uint64)).view(np.int64)


def packed(minima: np.ndarray) -> np.ndarray:
    """The low four bits of each minimum, sixteen to a long."""
    low = (minima & np.uint32(15)).astype(np.uint64).reshape(-1, 16)
    return np.bitwise_or.reduce(low << (np.arange(16, dtype=np.uint64) * U64(BITS)), axis=1).view(np.int64)


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarities (left, right) from packed signatures, corrected for chance agreement."""
    differ = np.zeros((len(left), len(right)), np.uint16)
    for k in range(left.shape[1]):
        x = left[:, k, None].view(np.uint64) ^ right[None, :, k].view(np.uint64)
        x |= x >> U64(1)
        x |= x >> U64(2)
        differ += np.bitwise_count(x & LOW_BITS)
    chance = 2.0**-BITS
    return ((1 - differ / MINIMA) - chance) / (1 - chance)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, packed) for every row; empty sets have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for b in batches:
            n, keys, band, pack = [], [], [], []
            for text in raw_bytes(b.column(1)):
                s = shingle_set(text)
                n.append(len(s))
                keys.append((np.bitwise_xor.reduce(mix(s)), s.sum(dtype=np.uint64)) if len(s) else (0, 0))
                minima = signature(s) if len(s) else None
                band.append(none if minima is None else bands(minima))
                pack.append(none if minima is None else packed(minima))
            key = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(key[:, 0]), pa.array(key[:, 1]), lists(band, pa.int64()), lists(pack, pa.int64())],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "packed"],
            )

    return id_and_text(docs).mapInArrow(
        tidy(run), "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, packed array<bigint>"
    )


def _full_set(text: bytes) -> frozenset:
    words = text.lower().split()
    if len(words) < WIDTH:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(WIDTH)), strict=False))


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets have 100 * intersection >= percent * union. ``texts`` is (doc_id, text)."""
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[bytes, frozenset] = OrderedDict()
        held = 0

        def full(t: bytes) -> frozenset:
            nonlocal held
            s = recent.get(t)
            if s is None:
                s = _full_set(t)
                recent[t] = s
                held += len(s)
                while held > 200_000 and len(recent) > 1:
                    held -= len(recent.popitem(last=False)[1])
            else:
                recent.move_to_end(t)
            return s

        for b in batches:
            keep = []
            for x, y in zip(raw_bytes(b.column(2)), raw_bytes(b.column(3)), strict=True):
                x, y = full(x), full(y)
                small, large = min(len(x), len(y)), max(len(x), len(y))
                shared = len(x & y) if 100 * small >= percent * large else 0
                keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], ["a", "b"])

    return both.mapInArrow(tidy(run), "a bigint, b bigint")


def _short_sets(texts: DataFrame) -> DataFrame:
    """(rep, shingles): sorted 32-bit hashes of each text's shingles. Two of them share at least
    what the sets share, so they rule out pairs without error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique((shingle_set(t) >> U64(32)).astype(np.uint32)).view(np.int32) for t in raw_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), lists(sets, pa.int32())], ["rep", "shingles"])

    return texts.mapInArrow(tidy(run), "rep bigint, shingles array<int>")


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components within a bucket's pair of blocks that the estimate and the
    short sets allow: for each text and other component the most similar one, and every one
    so near the bound that a chance agreement of two hashes could decide."""
    least = percent / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, 3):
            ids, label, block = (g.column(c).to_numpy() for c in ("rep", "component", "block"))
            if (label == label[0]).all():
                continue
            sign = g.column("packed").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            column = g.column("shingles").combine_chunks()
            flat, ends = column.flatten().to_numpy().view(np.uint32), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            size = np.diff(ends)
            i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            likely = estimate(sign[left], sign[right]) >= least
            likely &= label[left][:, None] != label[right]
            likely &= 100 * np.minimum(size[left][:, None], size[right]) >= percent * np.maximum(size[left][:, None], size[right]) - 200
            if i == j:
                likely &= ids[left][:, None] < ids[right]
            out = []
            for row in np.flatnonzero(likely.any(1)):
                x, others = left[row], right[likely[row]]
                own = flat[ends[x] : ends[x + 1]]
                each = np.concatenate([flat[ends[y] : ends[y + 1]] for y in others])
                same = own[np.minimum(np.searchsorted(own, each), len(own) - 1)] == each
                shared = np.add.reduceat(same, np.concatenate([[0], np.cumsum(size[others])[:-1]]), dtype=np.int64)
                over = 100 * shared - percent * (size[x] + size[others] - shared)
                best: dict[int, int] = {}
                for k in np.flatnonzero(over >= -200):  # a short set may lack an element or two
                    c = int(label[others[k]])
                    if over[k] <= 600:
                        out.append((ids[x], ids[others[k]]))
                    elif c not in best or over[k] > over[best[c]]:
                        best[c] = k
                out += [(ids[x], ids[others[k]]) for k in best.values()]
            if out:
                pairs = np.sort(np.array(out, np.int64), 1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    n = F.col("blocks")
    copies = members.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1))).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "component", "block", "packed", "shingles"
    )
    keys = ["bucket", "i", "j"]
    dealt = copies.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(tidy(run), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    sets = durable(sketches(docs))
    classes = durable(sets.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")))
    # one sketch for each class
    own = sets.select("doc_id", "set_a", "set_b", "bands", "packed").join(
        classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_a", "set_b"], "left_semi"
    )
    own = durable(own.dropDuplicates(["doc_id", "set_a", "set_b"]).select(F.col("doc_id").alias("rep"), "bands", "packed"))
    entries = own.select("rep", F.explode("bands").alias("bucket"))
    buckets = durable(
        entries.groupBy("bucket").agg(F.min("rep").alias("centre"), F.max("rep").alias("last"), F.count("*").alias("n")).filter("n > 1 and centre <> last")
    )
    shared = durable(entries.join(buckets, "bucket"))
    packs = own.select("rep", "packed")
    # the texts of classes that share a bucket. The ids grow with the corpus, so they are merged at every size, never sent to all
    candidates = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = durable(id_and_text(docs).join(candidates.hint("merge"), "doc_id", "left_semi"))
    release(docs.sparkSession)

    stars = shared.filter("rep <> centre").select("centre", "rep").distinct()
    stars = stars.join(packs.toDF("centre", "pack_c"), "centre").join(packs, "rep")
    agree = sum(
        F.bit_count(_fold(F.col("pack_c")[k].bitwiseXOR(F.col("packed")[k]))) for k in range(MINIMA * BITS // 64)
    )
    chance = 2.0**-BITS
    likely = ((F.lit(1.0) - agree / MINIMA) - chance) / (1 - chance) >= percent / 100 - MARGIN
    first = durable(confirm(durable(stars.filter(likely).select(F.col("centre").alias("a"), F.col("rep").alias("b"))), texts, percent))
    found = durable(components(first))

    labelled = shared.join(found.toDF("rep", "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = durable(labelled.select("bucket", "rep", "component", "n"))
    open_ = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    members = durable(labelled.join(open_, "bucket"))
    asked = texts.toDF("rep", "text").join(members.select("rep").distinct().hint("merge"), "rep", "left_semi")
    members = members.join(packs, "rep").join(_short_sets(asked), "rep")
    members = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    pairs = durable(_cross_pairs(members, percent))
    release(docs.sparkSession)
    second = durable(confirm(pairs, texts, percent))
    final = durable(components(first.union(second)))

    named = classes.join(final.toDF("rep", "component"), "rep", "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component")
    )
    out = sets.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    # an id with several texts is one document, so its classes are linked through it
    component = F.when(F.col("n_shingles") > 0, F.col("component"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(component, "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _fold(x):
    """One bit for each group of four that is not zero."""
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    return x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(int(LOW_BITS)))
