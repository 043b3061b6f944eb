import pytest
from pyspark.sql import functions as F

from lexiquarry.sources import screening as sg

LINES = ["cord_uid,title,publish_time", "u1,Plain,2020-01-05", 'u2,"over\ntwo lines, quoted",2020', "u3,too few", "u4,too,many,cells",
         ",no id,2020-01-01", "u5,,"]


def test_broken_rows_are_set_aside_and_the_rest_goes_on(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n")
    done = sg.screen_csv(spark, str(tmp_path / "a.csv"), "cord_uid", str(tmp_path / "out"))
    assert {(r.cord_uid, r.title, r.publish_time) for r in done.accepted.collect()} == {
        ("u1", "Plain", "2020-01-05"), ("u2", "over\ntwo lines, quoted", "2020"), ("u5", None, None)}
    assert done.accepted.columns == ["cord_uid", "title", "publish_time"]
    rejected = {(r[sg.RECORD] or r.title).strip(): r.reasons for r in done.rejected.collect()}
    assert rejected == {"u3,too few": [sg.MALFORMED], "u4,too,many,cells": [sg.MALFORMED], "no id": ["no id"]}
    assert done.counts == {"read": 6, "rejected": 3, sg.MALFORMED: 2, "no id": 1}


def test_reasons_of_any_step(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, None), (None, None), (4, "y" * 50)], "doc_id long, text string")
    reasons = {"no id": F.col("doc_id").isNull(), "no text": F.col("text").isNull(), "too long": F.length("text") > 20}
    done = sg.screen(rows, reasons, str(tmp_path / "out"))
    assert [r.doc_id for r in done.accepted.collect()] == [1]
    assert {r.doc_id: r.reasons for r in done.rejected.collect()} == {2: ["no text"], None: ["no id", "no text"], 4: ["too long"]}
    assert done.counts == {"read": 4, "rejected": 3, "no id": 1, "no text": 2, "too long": 1}
    # The written tables stay as they are, whatever happens to the input.
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


@pytest.mark.parametrize("rows", [[], [(1, "x")]])
def test_tables_without_rejects(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    done = sg.screen(frame, {"no id": F.col("doc_id").isNull()}, str(tmp_path / "out"))
    assert (done.accepted.count(), done.rejected.count(), done.counts["read"]) == (len(rows), 0, len(rows))
