"""Distinct counts that merge, chained windows on streams, and big JSON documents."""

from __future__ import annotations

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators import Metric, distinct_count, group_metrics, numbered, overall, windowed_agg
from stationflow.plans.testbed.readers import _big_documents, nested_document_split
from stationflow.plans.testbed.replay import drain, lay_down
from stationflow.session import new_work_folder
from stationflow.sources import split_json_array
from stationflow.streaming import start_query


def readings(spark, n=2000, users=500, seed=4):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(0, 7200), rng.choice(["a", "b", None]), rng.choice([None, *range(-users // 2, users // 2)]), rng.choice(["x", "y", None]), rng.randrange(0, 30))
        for _ in range(n)
    ]
    frame = spark.createDataFrame(rows, "s int, city string, user int, tag string, d int")
    return frame.select(F.timestamp_seconds("s").alias("ts"), "city", "user", "tag", F.date_add(F.lit("1969-12-20").cast("date"), F.col("d")).alias("day"))


@pytest.mark.parametrize("size, slide", [("20 minutes", "20 minutes"), ("30 minutes", "10 minutes"), ("25 minutes", "10 minutes")])
def test_bitmaps_count_exactly(spark, size, slide):
    frame = readings(spark)
    exact = [Metric("distinct", "user", "users"), Metric("distinct", "day", "days"), Metric("set", "tag", "tags"), Metric("count", None, "n")]
    maps = [Metric("bitmap_distinct", "user", "users"), Metric("bitmap_distinct", "day", "days"), Metric("set", "tag", "tags"), Metric("count", None, "n")]
    want = windowed_agg(frame, "ts", size, slide, ["city"], exact, panes=False)
    got = windowed_agg(frame, "ts", size, slide, ["city"], maps)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = windowed_agg(frame, "ts", size, slide, ["city"], [maps[0], maps[3], Metric("avg", "user", "mean")])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "collect" not in plan and "count(distinct" not in plan
    assert sorted(map(str, one.select("city", "users", "n").collect())) == sorted(map(str, want.select("city", "users", "n").collect()))


def test_bitmaps_of_groups_and_tables(spark):
    frame = readings(spark)
    got = group_metrics(frame, ["city"], [Metric("bitmap_distinct", "user", "u"), Metric("bitmap_distinct", "day", "d")])
    want = group_metrics(frame, ["city"], [Metric("distinct", "user", "u"), Metric("distinct", "day", "d")])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    for column in ("user", "day", "tag"):
        assert distinct_count(frame, column, "n").first().n == frame.agg(F.count_distinct(column)).first()[0]
        assert distinct_count(frame.limit(0), column, "n").first().n == 0
    wide = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (-1,), (63,), (64,), (None,)], "v long")
    assert distinct_count(wide, "v", "n").first().n == 6
    with pytest.raises(ValueError, match="number it first"):
        group_metrics(frame, ["city"], [Metric("bitmap_distinct", "tag", "t")]).collect()
    known = numbered(frame, "tag", "tag_no", new_work_folder(spark, "dictionary"))
    assert known.agg(F.count_distinct("tag_no")).first()[0] == 2 and known.where("tag IS NULL AND tag_no IS NOT NULL").isEmpty()
    counted = group_metrics(known, ["city"], [Metric("bitmap_distinct", "tag_no", "t")])
    assert {r.t for r in counted.collect()} == {2}


def test_reports_copy_no_rows(spark):
    plan = overall(readings(spark), {"tag": "tags", "day": "days", "user": "users"}, "user")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_sketches_merge_over_panes(spark):
    frame = spark.range(60_000).select(F.timestamp_seconds(F.col("id") % 3600).alias("ts"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user"))
    metrics = [Metric("sketch_distinct", "user", "about", error=0.01), Metric("bitmap_distinct", "user", "users")]
    got = windowed_agg(frame, "ts", "30 minutes", "5 minutes", metrics=metrics).collect()
    assert len(got) == 17 and all(r.about == pytest.approx(r.users, rel=0.04) for r in got)
    few = windowed_agg(readings(spark), "ts", "30 minutes", "5 minutes", ["city"], [Metric("sketch_distinct", "tag", "t")])
    assert {r.t for r in few.collect()} <= {0, 1, 2}
    direct = windowed_agg(readings(spark), "ts", "30 minutes", "5 minutes", ["city"], [Metric("sketch_distinct", "user", "u")], panes=False)
    merged = windowed_agg(readings(spark), "ts", "30 minutes", "5 minutes", ["city"], [Metric("sketch_distinct", "user", "u")], panes=True)
    assert sorted(map(str, direct.collect())) == sorted(map(str, merged.collect()))
    plan = windowed_agg(frame, "ts", "30 minutes", "5 minutes", metrics=metrics[:1])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("hll_sketch_agg") if "Expand" in plan else True


def test_chained_windows_on_a_stream(spark):
    frame = readings(spark, n=6000).where("city IS NOT NULL").select("ts", "city", "user", "tag")
    metrics = [Metric("count", None, "n"), Metric("avg", "user", "mean", 2), Metric("set", "tag", "tags"), Metric("max", "user", "high")]
    operators, results = {}, {}
    for panes in (False, True):
        work = new_work_folder(spark, "chained")
        lay_down(frame, "ts", f"{work}/in", 6)
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
        windows = windowed_agg(stream, "ts", "5 minutes", "1 minute", ["city"], metrics, "1 minute", chained=panes)
        query = start_query(
            windows, f"chained-{panes}", "append", "parquet", checkpoint=f"{work}/checkpoint", trigger={"availableNow": True}, options={"path": f"{work}/out"}
        )
        query.awaitTermination()
        operators[panes] = re.findall("Aggregate|Expand", windows._jdf.queryExecution().analyzed().toString())
        results[panes] = sorted(map(str, spark.read.parquet(f"{work}/out").collect()))
    table = windowed_agg(frame, "ts", "5 minutes", "1 minute", ["city"], metrics)
    last = frame.agg(F.max("ts")).first()[0]
    final = table.where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL '1 minute'"))
    assert results[True] == results[False] == sorted(map(str, final.collect()))
    assert len(results[True]) > 200
    # Panes are copied into windows, not readings.
    assert operators == {False: ["Aggregate", "Expand"], True: ["Aggregate", "Expand", "Aggregate"]}
    with pytest.raises(ValueError, match="tables"):
        windowed_agg(stream, "ts", "5 minutes", metrics=[Metric("bitmap_distinct", "user", "u")])


# -- one JSON document, many tasks ----------------------------------------------------------

def nested(name, kind):
    return T.StructType([T.StructField(name, kind)])


RECORD = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("data", T.ArrayType(nested("x", T.StringType()))),
    T.StructField("n", nested("k", nested("z", T.StringType()))),
])


def nasty(rng):
    return rng.choice(['pla"in', "br}ace {[", "es\\cape\\\\", '"data": [', "ünï\n", "", '\\"}', "]},{", "}" * 5, '"'])


@pytest.fixture()
def small_splits(spark):
    for key, value in (("spark.sql.files.maxPartitionBytes", "3000"), ("spark.sql.files.openCostInBytes", "0")):
        spark.conf.set(key, value)
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False)])
def test_split_documents_equal_whole_ones(spark, tmp_path, small_splits, indent, ascii_only):
    rng = random.Random(6)
    records = [
        {"a": i, "b": nasty(rng), "data": [{"x": nasty(rng)} for _ in range(rng.randrange(3))], "n": {"k": {"z": nasty(rng)}}} for i in range(300)
    ]
    document = {
        "meta": {"data": [{"a": -1}], "s": nasty(rng)}, "other": [{"a": -2}, [{"a": -3}]], "data": [5, *records, None, [1]], "tail": {"data": [{"a": -4}]}, "z": [{"a": -5}]
    }
    (tmp_path / "doc.json").write_text(json.dumps(document, indent=indent, ensure_ascii=ascii_only))
    (tmp_path / "array.json").write_text(json.dumps(records, indent=indent, ensure_ascii=ascii_only))
    whole = spark.read.schema(RECORD).option("multiLine", True).json(str(tmp_path / "array.json"))
    assert whole.rdd.getNumPartitions() == 1
    want = sorted(map(str, whole.select("a", "b", "data", "n").collect()))
    for name, field in (("array", None), ("doc", "data")):
        assert spark.read.option("lineSep", "}").text(str(tmp_path / f"{name}.json")).rdd.getNumPartitions() > 5
        got = split_json_array(spark, str(tmp_path / f"{name}.json"), RECORD, new_work_folder(spark, "split"), field)
        rows = got.orderBy("ordinal").collect()
        assert [r.ordinal for r in rows] == list(range(300)) == [r.a for r in rows]
        assert sorted(map(str, got.select("a", "b", "data", "n").collect())) == want


def test_split_of_several_and_of_empty_files(spark, tmp_path):
    texts = {"one": '{"data": [{"a": 1}], "data2": [{"a": 9}], "data": [ {"a": 2} , {"a": 3}]}', "two": '{"data": []}', "three": '{"x": 1}', "four": "", "five": '\n{ "data" :\n[\n{"a"\n:4}\n]}\n'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = split_json_array(spark, str(tmp_path), RECORD, new_work_folder(spark, "split"), "data").select("source_file", "ordinal", "a").collect()
    assert sorted((r.source_file.rsplit("/", 1)[1], r.ordinal, r.a) for r in got) == [("five.json", 0, 4), ("one.json", 0, 1), ("one.json", 1, 2), ("one.json", 2, 3)]
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "a.json").write_text("﻿[]")
    assert split_json_array(spark, str(tmp_path / "flat"), RECORD, new_work_folder(spark, "split")).collect() == []


@pytest.fixture()
def planned_as_large(spark):
    """Joins are planned as those of large tables are, and of the shuffles the larger ones keep more partitions."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def test_big_documents_are_one_file_each(spark, tmp_path, planned_as_large):
    rows = [(i // 2 if i < 4 else i, i % 9, "OFP"[i % 3], i / 4, datetime.datetime(2024, 1, 1 + i % 28), f"{i % 5}-LOW") for i in range(300)]
    kinds = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "orders.parquet"))
    _big_documents(spark.read.parquet(str(tmp_path / "orders.parquet")), str(tmp_path / "documents"))
    got = nested_document_split(spark, str(tmp_path)).collect()
    assert [len(list(d.glob("*.txt"))) for d in sorted((tmp_path / "documents").glob("k=*"))] == [1, 1, 1, 1]
    want = [(s, f"{t:%Y-%m-%d}", p, float(c), f'{o} "}}{{[, \\', float(k), 1) for k, c, s, p, t, o in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def final_groups(plan):
    """Rows out of the topmost aggregate that collects, of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "ObjectHashAggregateExec":
        return plan.metrics().apply("numOutputRows").value()
    inner = plan.executedPlan() if kind == "AdaptiveSparkPlanExec" else plan.plan() if kind.endswith("QueryStageExec") else None
    below = [inner] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
    return next((n for n in map(final_groups, below) if n is not None), None)


@pytest.mark.parametrize("field", [None, "data"])
def test_texts_of_no_record_are_not_collected(spark, tmp_path, small_splits, field):
    records, other = [{"a": i, "b": "x"} for i in range(50)], [[{"a": -i}] for i in range(1, 400)]
    array = json.dumps([*records, *other])
    text = array if field is None else f'{{"other": {json.dumps(other)}, "data": {array}, "more": {json.dumps(other)}}}'
    (tmp_path / "doc.json").write_text(text)
    (tmp_path / "bare.json").write_text(", ".join(map(json.dumps, records)) + "]}")
    got = split_json_array(spark, str(tmp_path / "doc.json"), RECORD, new_work_folder(spark, "split"), field)
    assert sorted((r.ordinal, r.a) for r in got.collect()) == [(i, i) for i in range(50)]
    assert final_groups(got._jdf.queryExecution().executedPlan()) == 50
    if field:  # a file without the array
        got = split_json_array(spark, str(tmp_path / "bare.json"), RECORD, new_work_folder(spark, "split"), field)
        assert got.collect() == []
        assert not final_groups(got._jdf.queryExecution().executedPlan())
