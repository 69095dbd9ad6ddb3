"""Preference formatting: a pair of conversations becomes one prompt and two masked completions.

The turns on which the chosen and the rejected conversation agree from the first one on (role and
text) are rendered once, as the prompt; what follows in each is its completion. A mask lists the
characters of a completion that are trained on: the texts of assistant turns with their end mark.

A turn is rendered as ``<|role|>``, line break, text, ``<|end|>``, line break. Turns go by number, then
role and text; equal rows count once; null role or text is empty and a null number comes first.
Rows without conv_id belong to no conversation. If one conversation begins with the other, the shorter
one's completion is empty; if they are equal, both are. Further columns are not read.

Conversations are put in pairs by ``neighbours``: in the order of their first turn (by hash), then
conv_id, each with the next, so those that begin alike meet; an odd one out at the end is alone,
with a null rejected side and no prompt. A conversation is one row, as a text is; a turn that very many
conversations share is spread by range over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ratingloom.operators.rank import positions
from ratingloom.sources.durable import durable

END = "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each turn with its role, text and where its rendering begins."""
    given = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    given = given.filter("conv_id is not null").distinct()
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    before = W.partitionBy("conv_id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    size = F.length("role") + F.length("text") + F.lit(len("<||>\n") + len(END))
    nth = F.row_number().over(W.partitionBy("conv_id").orderBy(*order))
    placed = given.select("conv_id", nth.alias("nth"), "role", "text", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("bigint").alias("at"))
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("nth", "role", "text", "at"))).alias("turns"))


def neighbours(convs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): each conversation with the one that follows in the order of first turns."""
    first = F.md5(F.concat(F.col("turns")[0]["role"], F.lit("\n"), F.col("turns")[0]["text"]))
    placed = positions(convs.select("conv_id", first.alias("first")), [F.col("first"), F.col("conv_id")])
    pair = F.floor((F.col("pos") - 1) / 2).alias("pair")
    return placed.groupBy(pair).agg(F.min_by("conv_id", "pos").alias("chosen_id"), F.max_by("conv_id", "pos").alias("last")).select(
        "chosen_id", F.when(F.col("last") != F.col("chosen_id"), F.col("last")).alias("rejected_id")
    )


def _rendered(turns: Column) -> Column:
    one = F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(END)))
    return F.array_join(one, "")


def _mask(turns: Column) -> Column:
    """Trained stretches of a completion as ``start:end``, comma-joined."""
    base = turns[0]["at"]
    said = F.filter(turns, lambda t: t["role"] == F.lit("assistant"))
    text_at = lambda t: t["at"] - base + F.lit(len("<|assistant|>\n"))
    spans = F.transform(said, lambda t: F.concat_ws(":", text_at(t), text_at(t) + F.length(t["text"]) + F.lit(len(END) - 1)))
    return F.array_join(spans, ",")


def format_pairs(pairs: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each of ``pairs`` (chosen_id, rejected_id): the common turns, prompt, completions and masks."""
    chosen, rejected = convs.toDF("chosen_id", "c"), convs.toDF("rejected_id", "r")
    both = pairs.join(chosen, "chosen_id").join(rejected, "rejected_id", "left")
    same = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_other = F.array_position(same, F.lit(False))
    n = F.when(F.col("r").isNull(), 0).when(first_other == 0, F.size("c")).otherwise(first_other - 1).cast("int")
    cut = both.withColumn("n", n)
    rest = {k: F.slice(k, F.col("n") + 1, F.greatest(F.size(k) - F.col("n"), F.lit(0))) for k in ("c", "r")}
    return cut.select(
        "chosen_id", "rejected_id", F.col("n").cast("bigint").alias("n_common"), _rendered(F.slice("c", 1, F.col("n"))).alias("prompt"),
        _rendered(rest["c"]).alias("chosen"), _rendered(rest["r"]).alias("rejected"), _mask(rest["c"]).alias("chosen_mask"), _mask(rest["r"]).alias("rejected_mask"),
    )


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    convs = durable(conversations(turns))
    return format_pairs(neighbours(convs), convs)


SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth, role, text
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
placed AS (SELECT conv_id, (row_number() OVER (ORDER BY md5(role || chr(10) || text), conv_id) - 1) AS pos FROM turns WHERE nth = 1),
pairs AS (SELECT a.conv_id AS chosen_id, b.conv_id AS rejected_id FROM placed a LEFT JOIN placed b ON b.pos = a.pos + 1 WHERE a.pos % 2 = 0),
sizes AS (SELECT conv_id, max(nth) AS n FROM turns GROUP BY conv_id),
other AS (
  SELECT chosen_id, min(a.nth) AS nth FROM pairs JOIN turns a ON a.conv_id = chosen_id
  LEFT JOIN turns b ON b.conv_id = rejected_id AND b.nth = a.nth
  WHERE b.nth IS NULL OR a.role <> b.role OR a.text <> b.text GROUP BY chosen_id),
common AS (
  SELECT p.*, CASE WHEN rejected_id IS NULL THEN 0 ELSE coalesce(o.nth - 1, s.n) END AS n_common
  FROM pairs p LEFT JOIN other o USING (chosen_id) JOIN sizes s ON s.conv_id = p.chosen_id),
sides AS (SELECT chosen_id, n_common, 'c' AS side, chosen_id AS conv_id FROM common UNION ALL SELECT chosen_id, n_common, 'r', rejected_id FROM common),
parts AS (
  SELECT chosen_id, side, t.nth, t.role, t.text, t.nth <= n_common AS shared,
    '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS shown
  FROM sides JOIN turns t USING (conv_id)),
spans AS (
  SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY chosen_id, side, shared ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + 14 AS said FROM parts),
texts AS (
  SELECT chosen_id, side, coalesce(string_agg(shown, '' ORDER BY nth) FILTER (shared), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY nth) FILTER (NOT shared), '') AS rest,
    coalesce(string_agg(said || ':' || (said + length(text) + 7), ',' ORDER BY nth) FILTER (NOT shared AND role = 'assistant'), '') AS mask
  FROM spans GROUP BY chosen_id, side)
SELECT c.chosen_id, c.rejected_id, c.n_common, x.prompt, x.rest AS chosen, y.rest AS rejected, x.mask AS chosen_mask, y.mask AS rejected_mask
FROM common c JOIN texts x ON x.chosen_id = c.chosen_id AND x.side = 'c' LEFT JOIN texts y ON y.chosen_id = c.chosen_id AND y.side = 'r'
"""
