import duckdb
import pytest
from compare import connect, difference

from ratingloom.llm import preferences as P
from ratingloom.llm.queries import QUERIES, SQL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, prompt string"


def shown(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_prompts_completions_and_masks(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "é?"), (1, 3, "assistant", "日本"),
            (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "é?"), (2, 3, "assistant", "no"), (2, 4, "user", "ok")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    pairs = spark.createDataFrame([(1, 2)], "chosen_id bigint, rejected_id bigint")
    r = P.format_pairs(pairs, P.conversations(turns)).collect()[0]
    assert r.n_common == 3 and r.prompt == shown("user", "hi") + shown("assistant", "yes") + shown("user", "é?")
    assert r.chosen == shown("assistant", "日本") and r.rejected == shown("assistant", "no") + shown("user", "ok")
    for text, mask, want in ((r.chosen, r.chosen_mask, "日本<|end|>"), (r.rejected, r.rejected_mask, "no<|end|>")):
        a, e = map(int, mask.split(":"))
        assert text[a:e] == want


@pytest.mark.parametrize("odd", [False, True])
def test_rows_of_every_kind_equal_sql(spark, odd):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"),
            (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, None, "user", "z"), (4, 0, None, None), (4, 1, "assistant", ""),
            (5, 0, "user", "q"), (5, 0, "system", "q"), (5, 7, "assistant", "long " * 9000), (None, 0, "user", "lost"), (6, 0, "user", "a")]
    rows += [(k, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if t < 3 else f"t{t}{k}") for k in range(10, 30 + odd) for t in range(5)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    con = duckdb.connect()
    con.register("conversations", turns.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    got = P.neighbour_pairs(turns).toPandas()
    alone = {"rejected_id": -1, "rejected": "-", "rejected_mask": "-"}
    assert difference(got.fillna(alone), con.execute(SQL["op6_preferences"]).df().fillna(alone)) is None
    assert (got.n_common == 3).sum() >= 9
    assert P.neighbour_pairs(turns.limit(0)).count() == 0


def test_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op6_preferences"](spark, d).toPandas()
    assert difference(got, connect(d).execute(SQL["op6_preferences"]).df()) is None
