"""Language identification by prediction by partial matching.

For each language a byte context tree of order 3 is learned from labelled texts and then
frozen. A byte is coded in its longest known context; a byte new there is coded by an
escape and in the next shorter context, without the bytes already ruled out (method C with
exclusion), at last evenly over the bytes never seen. The language whose tree codes the
whole text shortest is predicted. The code length of a byte depends on it and the three
bytes before it only, so it is a table look-up, exact for every text.

Learning takes at most ``SAMPLE_DOCS`` texts of each language, those of smallest hashed id,
so the tables that the driver builds and every task holds do not grow with the corpus.

Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing
could be learned. Texts are taken whole. Equal rows get equal results; of languages that
code a text equally short the first by name is taken. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ratingloom.llm.common import raw_bytes

ORDER = 3
SAMPLE_DOCS = 2000  # labelled texts learned for each language, at most
PIECE = 1 << 18  # bytes scored at once
TEXTS = 256  # texts whose bytes are held beside the batch
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys`` and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """Frozen counts of one language: grams of each length, and what follows each context."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        keys, count = grams[order].astype(np.int64), counts[order].astype(np.float64)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []  # by length - 1
        self.contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for length in range(ORDER + 1, 0, -1):
            short, place = np.unique(keys & ((1 << 8 * length) - 1), return_inverse=True)
            self.grams.insert(0, (short, np.bincount(place, count)))
        for k in range(ORDER + 1):
            own, n = self.grams[k]
            context, place = np.unique(own >> 8, return_inverse=True)
            total, distinct = np.bincount(place, n), np.bincount(place).astype(np.float64)
            ruled_out = np.zeros(len(context))  # what these bytes count in the next shorter context
            if k:
                lower, m = self.grams[k - 1]
                ruled_out = np.bincount(place, m[_find(lower, own & ((1 << 8 * k) - 1))[0]])
            self.contexts.append((context, total, distinct, ruled_out))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram after the other three."""
        grams = grams.astype(np.int64)
        cost, left = np.zeros(len(grams)), np.ones(len(grams), bool)
        out_n, out_d = np.zeros(len(grams)), np.zeros(len(grams))
        for k in range(ORDER, -1, -1):
            gram = grams & ((1 << 8 * (k + 1)) - 1)
            context, total, distinct, ruled_out = self.contexts[k]
            at, there = _find(context, gram >> 8)
            own, counts = self.grams[k]
            place, seen = _find(own, gram)
            there &= left
            seen &= there
            n, d = total[at] - out_n, distinct[at] - out_d
            cost[seen] += np.log2((n + d)[seen] / counts[place][seen])
            escapes = there & ~seen & (d > 0)
            cost[escapes] += np.log2((n + d)[escapes] / d[escapes])
            left &= ~seen
            out_n, out_d = np.where(there, ruled_out[at], 0.0), np.where(there, distinct[at], 0.0)
        cost[left] += np.log2(256 - out_d[left])
        return cost


@dataclass
class Model:
    """Code lengths for every gram seen in any language, and the trees for the rest."""

    langs: list[str]
    trees: list[Tree]
    slots: np.ndarray = field(init=False)
    costs: np.ndarray = field(init=False)
    used: np.ndarray = field(init=False)
    shift: int = field(init=False)

    def __post_init__(self) -> None:
        seen = [t.grams[ORDER][0] for t in self.trees]
        keys = np.unique(np.concatenate(seen)).astype(np.uint32) if seen else np.empty(0, np.uint32)
        bits = max(8, int(len(keys) * 4).bit_length())
        self.shift = 32 - bits
        self.slots, self.used = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, bool)
        self.costs = np.zeros((1 << bits, len(self.langs)), np.float32)
        each = np.stack([t.bits(keys) for t in self.trees], 1) if seen else np.empty((0, 0))
        rest, at = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = ~self.used[at]
            _, first = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.slots[at[put]], self.used[at[put]], self.costs[at[put]] = keys[rest[put]], True, each[rest[put]]
            stay = np.ones(len(rest), bool)
            stay[put] = False
            rest, at = rest[stay], (at[stay] + 1) & (len(self.slots) - 1)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint32(2654435769)) >> np.uint32(self.shift)).astype(np.int32)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """(grams, languages) code lengths."""
        at = self._slot(grams)
        cost = self.costs[at]
        rest = np.flatnonzero((self.slots[at] != grams) | ~self.used[at])
        at, new = at[rest], []
        while len(rest):  # a gram that meets an empty slot is in no table
            empty = ~self.used[at]
            new.append(rest[empty])
            rest, at = rest[~empty], (at[~empty] + 1) & (len(self.slots) - 1)
            hit = (self.slots[at] == grams[rest]) & self.used[at]
            cost[rest[hit]] = self.costs[at[hit]]
            rest, at = rest[~hit], at[~hit]
        if new and len(rest := np.concatenate(new)):
            unseen, back = np.unique(grams[rest], return_inverse=True)
            cost[rest] = np.stack([t.bits(unseen) for t in self.trees], 1)[back]
        return cost

    def total_bits(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) code lengths of whole texts."""
        out = np.zeros((len(texts), len(self.langs)))
        group: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if len(text) > PIECE:
                for a in range(0, len(text), PIECE):
                    lead = text[max(0, a - ORDER) : a] if a else b""
                    out[i] += self._sums([lead.rjust(ORDER, b"\0") + text[a : a + PIECE]])[0]
                continue
            group.append(i)
            size += len(text)
            if size >= PIECE:
                out[group] = self._sums([bytes(ORDER) + texts[j] for j in group])
                group, size = [], 0
        if group:
            out[group] = self._sums([bytes(ORDER) + texts[j] for j in group])
        return out

    def _sums(self, padded: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(p) for p in padded])
        data = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint32)
        grams = data[3:] | data[2:-1] << np.uint32(8) | data[1:-2] << np.uint32(16) | data[:-3] << np.uint32(24)
        sums = np.zeros((len(ends) + 1, len(self.langs)))
        bits = self.bits(grams)
        starts = np.concatenate([[0], ends[:-1]])
        full = np.flatnonzero(ends - starts > ORDER)
        if len(full):  # between two texts lie the grams of the padding
            edges = np.stack([starts[full], ends[full] - ORDER], 1).ravel()
            bits = np.vstack([bits, np.zeros((1, bits.shape[1]), bits.dtype)])
            sums[full] = np.add.reduceat(bits, edges, axis=0, dtype=np.float64)[::2]
        return sums[:-1]


def held_out(doc_id: Column) -> Column:
    """Never learned from: crc32 of the id as text leaves 1 on division by 3; so is a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs = b.column(0).to_pylist()
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, raw_bytes(b.column(1)), strict=True):
            by.setdefault(lang, []).append(bytes(ORDER) + text)
        for lang, texts in by.items():
            parts = []
            for t in texts:
                data = np.frombuffer(t, np.uint8).astype(np.int64)
                parts.append(data[3:] | data[2:-1] << 8 | data[1:-2] << 16 | data[:-3] << 24)
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "gram", "n"]
            )


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) with id, text and lang that are not held out."""
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # ids only are ranked, and each task hands on no more than the sample of a language
    first = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= sample_docs)
    sample = usable.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counts.toArrow()
    lang, gram, n = (rows.column(c).to_numpy() for c in ("lang", "gram", "n"))
    langs = sorted(set(lang.tolist()))
    return Model(langs, [Tree(gram[lang == x], n[lang == x]) for x in langs])


def _judge(m: Model, data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and bits per byte of each text."""
    lettered = np.array([bool(LETTER.search(t.decode())) for t in data], bool)
    names, score, rate = np.full(len(data), UNKNOWN, object), np.zeros(len(data)), np.zeros(len(data))
    rows = np.flatnonzero(lettered)
    if len(rows) and m.langs:
        bits = m.total_bits([data[i] for i in rows])
        least = bits.min(1)
        names[rows] = np.array(m.langs, object)[bits.argmin(1)]
        score[rows] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
        rate[rows] = least / np.array([len(data[i]) for i in rows])
    return names, score, rate


def language_of(text: Column, model: Model, spark: SparkSession) -> Column:
    """struct(lang, score) as a column expression, for rows whose other columns stay."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        parts = []
        for a in range(0, len(texts), TEXTS):
            names, score, _ = _judge(sent.value, [(t or "").encode() for t in texts.iloc[a : a + TEXTS]])
            parts.append(pd.DataFrame({"lang": names, "score": score}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang": [], "score": []})

    # else a filter on the result would have each text judged twice, by two workers
    return judge.asNondeterministic()(text)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) for every row of ``docs`` (doc_id, text).

    The score is the share of the predicted language if all were equally likely before.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score, rate = _judge(sent.value, list(raw_bytes(b.column(1))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(rate)],
                ["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id bigint, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on ``docs`` and predict all of them: (doc_id, held_out, lang_pred, score, bits_per_byte)."""
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")
