"""Spelling variants: words of a corpus one edit apart, found among sorted rotations.

A word marked with a terminator is written in all its rotations (a permuterm index). The words that
one edit at a place makes of a word are then a prefix range: the rotation that begins after the place
and ends before it is the prefix, the edited character is skipped. ``a c b`` has the rotation ``b $ a c``;
all words ``a ? b`` share the prefix ``b $ a`` and so does the word ``a b``. Rotations are range-partitioned and
sorted, the prefix first, and each partition is scanned once: a group of equal prefixes holds the
replacements at one place and at most one word that lacks the place. A group is no larger than the
alphabet, and it hands on, for each of its members, how many neighbours it has there and which of them is the most
frequent one; pairs are not written out. A replacement is met at its place only. A deletion from a run of
equal characters could be met at each of them and counts at the first. So counts add up exactly.

Null text holds no words; a null doc_id counts as an empty string in the hash. Rows are documents: repeated rows
count again. Texts of any length are taken whole, in slices cut between words. An empty table gives an empty result. Of equally
frequent neighbours the smallest in code-point order is taken. Further columns are not read. A word that holds the
terminator U+0000 has no neighbours; texts give no such word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import id_and_text, raw_bytes
from ratingloom.sources.durable import durable

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
LEAST_RATIO = 5  # how many times as frequent as the word its form must be
NOISE = 199  # a run whose hash this divides loses one code point
TERMINATOR = "\x00"
SLICE = 1 << 20  # code points of a text that are split into words at once
WORDS_KEPT = 100_000  # counts that a task holds before it hands them on


def _slices(text: str, gap: re.Pattern) -> Iterator[str]:
    """The text in parts of about ``SLICE`` code points, cut where no word is."""
    at = 0
    while len(text) - at > SLICE:
        end = gap.search(text, at + SLICE)
        if end is None:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:] if at else text


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, noise: int = NOISE) -> DataFrame:
    """(word, n): letter runs of all texts, A-Z lower-cased, some with one code point deleted.

    ``noise`` 0 deletes nothing. Occurrences are counted within a text, then within a task, then by a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, gap = re.compile(LETTERS), re.compile(LETTERS.replace("[", "[^").rstrip("+"))
        total: Counter[str] = Counter()
        for b in batches:
            for doc, raw in zip(b.column(0).to_pylist(), raw_bytes(b.column(1)), strict=True):
                own: Counter[str] = Counter()
                for part in _slices(raw.lower().decode(), gap):  # bytes.lower changes A-Z only
                    own.update(words.findall(part))
                begin = zlib.crc32(b"%d:" % doc if doc is not None else b":")
                for word, n in own.items():
                    if len(word) < least_length:
                        continue
                    if noise and not (h := zlib.crc32(word.encode(), begin)) % noise:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    total[word] += n
                if len(total) >= WORDS_KEPT:
                    yield _counted(total)
                    total = Counter()
        if total:
            yield _counted(total)

    counted = id_and_text(docs).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, whole, opens, n, word): the ranges of the permuterm index that each word lies in.

    ``whole`` rows are full rotations of the word, the others rotations without their last
    character, which is the one skipped; ``opens`` tells that this character begins a run of equal ones.
    """
    w = words.filter(~F.col("word").contains(TERMINATOR)).select("word", "n", F.length("word").alias("size"))
    at = w.select("word", "n", "size", F.explode(F.sequence(F.lit(0), F.col("size"))).alias("at"))

    def rotation(skip: int):
        return F.concat(F.expr(f"substring(word, at + {1 + skip})"), F.lit(TERMINATOR), F.expr("left(word, at)"))

    same_as_last = F.expr("at > 0 AND substring(word, at, 1) = substring(word, at + 1, 1)")
    whole = at.select(rotation(0).alias("prefix"), F.lit(True).alias("whole"), F.lit(True).alias("opens"), "n", "word")
    skipped = at.filter("at < size").select(rotation(1).alias("prefix"), F.lit(False), ~same_as_last, "n", "word")
    return whole.union(skipped)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows cut so that no group of equal first columns is divided; with them where groups begin."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([*kept, b]).combine_chunks()
            starts = _starts(t)
            if len(starts) > 1:
                yield t.slice(0, starts[-1]), starts[:-1]
            kept = t.slice(starts[-1]).to_batches()
    if kept:
        t = pa.Table.from_batches(kept).combine_chunks()
        yield t, _starts(t)


def _starts(t: pa.Table) -> np.ndarray:
    prefix = t.column(0)
    change = pc.not_equal(prefix.slice(1), prefix.slice(0, t.num_rows - 1)).to_numpy()
    return np.concatenate([[0], np.flatnonzero(change) + 1])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row how many neighbours its group has for it, and the best of them.

    Rows of a group come as: the whole rotation, then skipped ones by falling count and rising word.
    So the best neighbour of a skipped one is the first skipped one, of that the second, and of the whole one the
    first that opens a run; the whole one is a neighbour of those that open a run.
    """
    for t, starts in _whole_groups(batches):
        rows = t.num_rows
        whole, opens, n = (t.column(k).to_numpy() for k in ("whole", "opens", "n"))
        word = t.column("word").combine_chunks()
        group = np.zeros(rows, np.int64)
        group[starts[1:]] = 1
        group = np.cumsum(group)
        ends = np.append(starts[1:], rows)
        has = whole[starts]  # the whole rotation of a group comes first
        first = starts + has
        opening = opens & ~whole
        n_open = np.add.reduceat(opening.astype(np.int64), starts)
        first_open = np.full(len(starts), rows)
        at = np.flatnonzero(opening)
        np.minimum.at(first_open, group[at], at)
        skipped = ends - first
        row = np.arange(rows)
        near = np.where(whole, n_open[group], skipped[group] - 1 + (has[group] & opening))
        best = np.where(whole, first_open[group], np.where(row == first[group], first[group] + 1, first[group]))
        # among the skipped ones of its group a row may be alone
        best = np.where(~whole & (skipped[group] < 2), rows, best)
        other = np.where(opening & has[group], starts[group], rows)  # the whole word as a neighbour
        best_n, other_n = (np.append(n, -1)[k] for k in (best, other))
        names = word.take(pa.array(np.minimum(best, rows - 1))), word.take(pa.array(np.minimum(other, rows - 1)))
        smaller = pc.less(names[1], names[0]).to_numpy(zero_copy_only=False)
        take_other = (other_n > best_n) | (other_n == best_n) & (other_n >= 0) & smaller
        best = np.where(take_other, other, best)
        keep = np.flatnonzero(near > 0)
        if len(keep):
            yield pa.RecordBatch.from_arrays(
                [word.take(pa.array(keep)), pa.array(near[keep].astype(np.int64)), word.take(pa.array(best[keep])), pa.array(n[best[keep]])],
                ["word", "near", "other", "other_n"],
            )


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of words with neighbours: how many, and the most frequent one.

    ``words`` (word, n) must hold each word once.
    """
    order = [F.col("prefix"), F.col("whole").desc(), F.col("n").desc(), F.col("word")]
    found = rotations(words).repartitionByRange("prefix").sortWithinPartitions(*order)
    met = found.mapInArrow(_scan, "word string, near bigint, other string, other_n bigint")
    best = F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("form")))
    out = met.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return out.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus_n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form or null) followed to the last, by pointer doubling.

    Forms must not run in circles; here each is more frequent than its word. Each round is
    written to the shared folder; a chain of n forms takes about log2(n) rounds.
    """
    state = durable(forms.select("word", F.coalesce("form", "word").alias("root"), F.lit(True).alias("moved")))
    while state.filter("moved").limit(1).count():
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = state.join(ahead, "root", "left").select("word", "root", F.coalesce("next", "root").alias("next"))
        state = durable(step.select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
    return state.select("word", "root")


def variants(words: DataFrame, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n)."""
    words = durable(words.select("word", "n"))
    near = neighbours(words)
    strong = F.col("form_n") >= least_ratio * F.col("n")
    told = words.join(near, "word", "left").select(
        "word",
        F.when(strong, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("form_n")).alias("form_n"),
    )
    told = durable(told)
    return told.join(roots(told), "word").select("word", "form", "root", "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    """Spelling variants among the frequent words of ``docs`` (doc_id, text)."""
    return variants(word_counts(docs).filter(F.col("n") >= LEAST_COUNT))


def sql() -> str:
    """The same for DuckDB: hashes by a table made from the polynomial, neighbours by words with one code point left out."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE poly AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], range(8)), lambda c, k: {step}) AS v FROM range(256) r(i))
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)) AS b
  FROM runs WHERE length(run) >= {LEAST_LENGTH}
), hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM bytes, poly
), noisy AS (
  SELECT CASE WHEN h % {NOISE} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), cuts AS (
  SELECT word, n, i AS at, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.at = b.at AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word
), told AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= {LEAST_RATIO} * w.n THEN form END AS form,
    CASE WHEN form_n >= {LEAST_RATIO} * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at, form AS ahead FROM told
  UNION ALL SELECT k.word, t.word, t.form FROM walk k JOIN told t ON k.ahead = t.word
)
SELECT t.word, t.form, k.at AS root, t.n, t.n_near, t.form_n FROM told t JOIN walk k ON t.word = k.word AND k.ahead IS NULL
"""
