"""Personal data by rules and by a character-level bidirectional LSTM with a CRF on top.

The rules find e-mail addresses, IP addresses, card numbers and telephone numbers. The
network is trained in numpy, on the driver, from texts whose spans the rules have labelled:
at most ``SAMPLE_DOCS`` of them, those of smallest hashed id, one stretch around a span and
one without a span from each. It then reads all texts in windows of ``WINDOW`` characters, each
starting ``STEP`` after the last. Where windows overlap, the scores are blended, the middle of
a window counting most, and one best path is decoded over the whole stretch, so spans do
not depend on where a window was cut. What it finds beside the spans of the rules is added.

A span must hold a digit or ``@``; stretches further than ``REACH`` characters from one can only
be without a span and are not read by the network.

Null and empty texts have no spans. Texts are taken whole, equal rows get equal results; without a
labelled text there is no network and the rules alone decide. Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 400
WINDOW, STEP, REACH = 96, 48, 32
HIDDEN, EMBEDDED, BATCH, EPOCHS, RATE = 16, 12, 32, 12, 0.02

Span = tuple[str, int, int]

# An address is looked for at each @: what precedes it is the longest run of its
# characters, which is what a search from the left finds, in linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs that begin where a run of digits begins: no second look at a digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile("[0-9@]")
_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def rule_spans(text: str) -> list[Span]:
    """Spans of the rules, by start, then kind; offsets in code points, end exclusive."""
    spans: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            spans.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                spans.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


# Tags: 0 is outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
SYMBOLS = 98  # printable ASCII, line break, other letters, everything else


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.full(len(codes), 97, np.int64)
    out[(codes >= 32) & (codes < 127)] = codes[(codes >= 32) & (codes < 127)] - 32
    out[codes == 10] = 95
    out[codes >= 0xC0] = 96
    return out


def tags(spans: list[Span], start: int, end: int) -> np.ndarray:
    out = np.zeros(end - start, np.int64)
    for kind, a, e in spans:
        a, e, k = max(a, start) - start, min(e, end) - start, 1 + 2 * KINDS.index(kind)
        if a < e and not out[a:e].any():
            out[a:e] = k + 1
            out[a] = k
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _run(p: dict, side: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) of one direction over embedded input (T, B, E)."""
    h = c = np.zeros((x.shape[1], HIDDEN), x.dtype)
    given = x @ p[f"wx{side}"] + p[f"b{side}"]
    out = np.empty((*x.shape[:2], HIDDEN), x.dtype)
    for t in range(len(x)):
        z = given[t] + h @ p[f"wh{side}"]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c = (h, c), f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep is not None:
            keep.append((before, i, f, o, g, tc))
    return out


def _back(p: dict, grads: dict, side: str, x: np.ndarray, keep: list, dh_out: np.ndarray) -> np.ndarray:
    dx = np.empty_like(x)
    dh = dc = np.zeros((x.shape[1], HIDDEN), x.dtype)
    for t in range(len(x) - 1, -1, -1):
        (h0, c0), i, f, o, g, tc = keep[t]
        dh = dh + dh_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        grads[f"wx{side}"] += x[t].T @ dz
        grads[f"wh{side}"] += h0.T @ dz
        grads[f"b{side}"] += dz.sum(0)
        dx[t] = dz @ p[f"wx{side}"].T
        dh, dc = dz @ p[f"wh{side}"].T, dc * f
    return dx


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Network:
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 3) -> Network:
        r = np.random.default_rng(seed)
        make = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        p = {"e": make(SYMBOLS, EMBEDDED) * 3, "out": make(2 * HIDDEN, TAGS), "bo": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
        for side in "lr":
            p |= {f"wx{side}": make(EMBEDDED, 4 * HIDDEN), f"wh{side}": make(HIDDEN, 4 * HIDDEN), f"b{side}": np.zeros(4 * HIDDEN, np.float32)}
        return Network(p)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (T, B, tags) of symbols (T, B)."""
        e = self.p["e"][x]
        both = np.concatenate([_run(self.p, "l", e), _run(self.p, "r", e[::-1])[::-1]], 2)
        return both @ self.p["out"] + self.p["bo"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tags ``y`` (T, B) under the CRF, and its slopes."""
        p, (length, n) = self.p, x.shape
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        e, left, right = p["e"][x], [], []
        both = np.concatenate([_run(p, "l", e, left), _run(p, "r", e[::-1], right)[::-1]], 2)
        s, trans = both @ p["out"] + p["bo"], p["trans"]
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        for t in range(1, length):
            alpha[t] = s[t] + _log_sum(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(length - 2, -1, -1):
            beta[t] = _log_sum(trans + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        rows = np.arange(n)
        gold = sum(s[t, rows, y[t]] for t in range(length)) + sum(trans[y[t - 1], y[t]] for t in range(1, length))
        ds = np.exp(alpha + beta - total[:, None])
        for t in range(length):
            ds[t, rows, y[t]] -= 1
            if t:
                pair = np.exp(alpha[t - 1][:, :, None] + trans + (s[t] + beta[t])[:, None, :] - total[:, None, None])
                grads["trans"] += pair.sum(0)
                np.add.at(grads["trans"], (y[t - 1], y[t]), -1)
        flat = ds.reshape(-1, TAGS)
        grads["out"] += both.reshape(-1, 2 * HIDDEN).T @ flat
        grads["bo"] += flat.sum(0)
        dh = ds @ p["out"].T
        de = _back(p, grads, "l", e, left, dh[:, :, :HIDDEN])
        de += _back(p, grads, "r", e[::-1], right, dh[::-1, :, HIDDEN:])[::-1]
        np.add.at(grads["e"], x, de)
        return float((total - gold).mean()), {k: g / n for k, g in grads.items()}

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 4) -> None:
        """Adam over shuffled batches of windows (n, T)."""
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, EPOCHS * -(-len(x) // BATCH)
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for a in range(0, len(x), BATCH):
                step += 1
                rows = order[a : a + BATCH]
                _, grads = self.gradients(x[rows].T, y[rows].T)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                scale, rate = min(1.0, 5.0 / (norm + 1e-9)), RATE * (1 - step / (steps + 1))
                for k, g in grads.items():
                    g = g * scale
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)

    def path(self, s: np.ndarray) -> np.ndarray:
        """The best tags for scores (T, tags)."""
        trans = self.p["trans"]
        back = np.zeros(s.shape, np.int8)
        best = s[0]
        for t in range(1, len(s)):
            step = best[:, None] + trans
            back[t] = step.argmax(0)
            best = step.max(0) + s[t]
        out = np.empty(len(s), np.int64)
        out[-1] = best.argmax()
        for t in range(len(s) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


_CENTRAL = (1 - np.abs(np.arange(WINDOW) - (WINDOW - 1) / 2) / (WINDOW / 2 + 1)).astype(np.float32)
_TOGETHER = 512  # windows scored at once


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within reach of a digit or @, merged."""
    out: list[list[int]] = []
    for m in _SIGN.finditer(text):
        a, e = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([a, e])
    return [(a, e) for a, e in out]


def network_spans(network: Network, texts: list[str]) -> list[list[Span]]:
    """What the best paths mark in each text."""
    spans: list[list[Span]] = [[] for _ in texts]
    parts = [(i, a, e) for i, t in enumerate(texts) for a, e in stretches(t)]
    group: list[tuple[int, int, int]] = []
    size = 0
    for part in [*parts, None]:
        if part:
            group.append(part)
            size += 1 + max(0, part[2] - part[1] - WINDOW + STEP - 1) // STEP
        if group and (part is None or size >= _TOGETHER):
            _decode(network, texts, group, spans)
            group, size = [], 0
    return spans


def _decode(network: Network, texts: list[str], group: list[tuple[int, int, int]], spans: list[list[Span]]) -> None:
    coded = [symbols(texts[i][a:e]) for i, a, e in group]
    places = [(g, at) for g, c in enumerate(coded) for at in range(0, max(1, len(c) - WINDOW + STEP), STEP)]
    blended = [np.zeros((len(c), TAGS), np.float32) for c in coded]
    weight = [np.zeros((len(c), 1), np.float32) for c in coded]
    for k in range(0, len(places), _TOGETHER):
        some = places[k : k + _TOGETHER]
        x = np.zeros((WINDOW, len(some)), np.int64)
        for j, (g, at) in enumerate(some):
            piece = coded[g][at : at + WINDOW]
            x[: len(piece), j] = piece
        s = network.scores(x)
        for j, (g, at) in enumerate(some):
            n = min(WINDOW, len(coded[g]) - at)
            blended[g][at : at + n] += s[:n, j] * _CENTRAL[:n, None]
            weight[g][at : at + n] += _CENTRAL[:n, None]
    for (i, a, _), s, w in zip(group, blended, weight, strict=True):
        marked = network.path(s / w)
        t = 0
        while t < len(marked):
            k, e = marked[t], t + 1
            if k == 0:
                t = e
                continue
            kind = (k - 1) // 2
            while e < len(marked) and marked[e] == 2 + 2 * kind:
                e += 1
            if _SIGN.search(texts[i], a + t, a + e):
                spans[i].append((KINDS[kind], a + t, a + e))
            t = e


def examples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows (n, WINDOW) of symbols and tags from labelled texts."""
    xs, ys = [], []
    for n, text in enumerate(texts):
        spans = rule_spans(text)
        near = spans[n % len(spans)] if spans else None
        starts = [max(0, near[1] - (37 * n) % (WINDOW - 30))] if near else []
        signs = [m.start() for m in _SIGN.finditer(text)]
        if signs:
            starts.append(max(0, signs[(7 * n) % len(signs)] - (53 * n) % WINDOW))
        starts.append((n * 7919) % max(1, len(text) - WINDOW))
        for a in starts:
            e = min(len(text), a + WINDOW)
            x, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
            x[: e - a], y[: e - a] = symbols(text[a:e]), tags(spans, a, e)
            xs.append(x)
            ys.append(y)
    return np.array(xs).reshape(-1, WINDOW), np.array(ys).reshape(-1, WINDOW)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Train on a bounded sample of the texts with a digit or @; None if no span was labelled."""
    signed = id_and_text(docs).filter(F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id", "text").alias("k"), "text")
    keys = [r.k for r in signed.select("k").distinct().orderBy("k").limit(sample_docs).collect()]
    rows = signed.filter(F.col("k").isin(keys)).distinct().orderBy("k", "text").collect() if keys else []
    x, y = examples([r.text for r in rows])
    if not y.any():
        return None
    network = Network.fresh()
    network.train(x, y)
    return network


def _overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < e and a < span[2] for _, a, e in others)


def _all_spans(network: Network | None, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    """Spans of the rules, and those of the network that meet none of them."""
    base = [rule_spans(t) for t in texts]
    added = network_spans(network, texts) if network else [[] for _ in texts]
    out = []
    for own, more in zip(base, added, strict=True):
        every = [(*s, True) for s in own] + [(*s, False) for s in more if not _overlaps(s, own)]
        out.append(sorted(every, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def without_spans(text: Column, network: Network | None, spark: SparkSession) -> Column:
    """The text with its spans masked, as a column expression; null stays null."""
    sent = spark.sparkContext.broadcast(network)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        whole = [t or "" for t in texts]
        spans = _all_spans(sent.value, whole)
        out = [masked(t, [s[:3] for s in found]) for t, found in zip(whole, spans, strict=True)]
        return pd.Series([None if t is None else o for t, o in zip(texts, out, strict=True)], dtype=object)

    return mask(text)


def find(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, text, spans) for every row; spans by start, then kind; ``base`` marks those of the rules."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = _all_spans(sent.value, [t or "" for t in b.column(1).to_pylist()])
            rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans] for spans in every]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, kind)], ["doc_id", "text", "spans"])

    schema = "doc_id bigint, text string, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    return id_and_text(docs).mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """Fit on ``docs`` and list the spans of all of them; the counts are those of the rules."""
    found = find(docs, fit(docs))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    added = (F.size("spans") - F.size(base)).cast("bigint").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), added)


def _equals(kind: str):
    return lambda k: k == F.lit(kind)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, overlapping ones as one, replaced by its kind in angle brackets."""
    out, last = [], 0
    for kind, a, e in spans:
        if a >= last:
            out += [text[last:a], f"<{kind.upper()}>"]
        last = max(last, e)
    return "".join([*out, text[last:]])
