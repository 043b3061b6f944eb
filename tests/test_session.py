import os
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from lexiquarry.session import settle, settle_parts, stage_dir


def fake_session(master, setting=None):
    conf = SimpleNamespace(get=lambda key, default=None: setting)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_stage_dir_follows_the_setting():
    assert stage_dir(fake_session("spark://host:1", "/shared/ckpt/")) == "/shared/ckpt"


def test_stage_dir_without_setting():
    local = fake_session("local[2]")
    assert os.path.isdir(stage_dir(local)) and stage_dir(local) == stage_dir(local)
    with pytest.raises(RuntimeError):
        stage_dir(fake_session("spark://host:1"))


def test_settle_keeps_rows_and_schema(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id long, words array<string>")
    settled = settle(rows, "unit")
    assert settled.schema == rows.schema
    assert sorted(map(tuple, settled.collect())) == sorted(map(tuple, rows.collect()))
    assert "lexiquarry/unit-" in settled.inputFiles()[0]


def stage_tables(spark):
    folder = f"{stage_dir(spark)}/lexiquarry".removeprefix("file://")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_parts_are_written_one_after_another_and_their_stage_tables_go(spark):
    before, seen = stage_tables(spark), []

    def part(i):
        inner = settle_parts([lambda: settle(spark.range(i), "inmost")], "inner")
        seen.append({t.split("-")[0] for t in stage_tables(spark) - before})
        return inner.withColumn("part", F.lit(i))

    outside = settle(spark.range(3), "outside")
    table = settle_parts((lambda i=i: part(i) for i in (2, 3)), "whole")
    assert sorted(map(tuple, table.collect())) == [(0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
    assert seen == [{"outside", "inner"}, {"outside", "whole", "inner"}]
    assert {t.split("-")[0] for t in stage_tables(spark) - before} == {"outside", "whole"} and outside.count() == 3
