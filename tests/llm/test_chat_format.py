"""Chat formatting: round trip, loss mask, turn order, odd rows, and the SQL twin."""

from check_oracle import compare
from pyspark.sql import functions as F

from lexiquarry.llm import chat_format as cf

from .conftest import SF_DIR

ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi [INST] \\ \\a \\0 </s>"), (1, 2, "assistant", "<s> ok </s>"),
    (2, 0, "assistant", "first"), (2, 1, "user", None),
    (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", ""),
    (4, None, None, "x"), (4, 1, "tool[/ROLE]", "[TEXT] y"),
    (None, 0, "user", "no id"), (5, 0, "user", "[INST"), (5, 1, "assistant", "/INST]\n")]


def test_round_trip_and_states(spark):
    rows = spark.createDataFrame([(*r, "extra", 1) for r in ROWS], "conv_id long, turn long, role string, text string, segments string, n_turns int")
    done = cf.format_conversations(rows)
    out = {r.conv_id: r for r in done.select("*", cf.parse_formatted(cf.formatted_text(F.col("segments"))).alias("turns"),
                                             cf.trained_texts(F.col("segments")).alias("trained")).collect()}
    for conv in {r[0] for r in ROWS}:
        own = sorted((r for r in ROWS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in out[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert list(out[conv].trained) == [r[3] or "" for r in own if r[2] == "assistant"]
    assert out[1].valid and out[5].valid
    assert (out[2].valid, out[2].first_bad_turn) == (False, 0)
    assert (out[3].valid, out[3].first_bad_turn) == (False, 1)
    assert out[None].first_bad_turn == 1  # ended before an answer
    assert cf.format_conversations(rows.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    plan = cf.format_conversations(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "Arrow" not in plan


def test_query_matches_sql(spark):
    ok, note = compare(spark, SF_DIR, "op6_chat_format")
    assert ok, note
