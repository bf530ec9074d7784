"""Every registered query against its SQL, and what its plan must not contain."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as driver
from stationflow.plans import testbed

QUERIES, ORACLE = testbed.queries(), testbed.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, tables, name):
    got = QUERIES[name](spark, tables)
    expected = duck.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(columns)
    rows = got.collect()
    assert table_of(got.columns, rows) == table_of(columns, expected.fetchall())
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_the_driver_lists_them(spark):
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLE.keys() <= driver.oracle_sql().keys()


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def test_queries_tell_their_tables_by_folder_only(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        QUERIES["daily_extremes"](spark, str(tmp_path / "nowhere"))


WRITING = ("stream_", "etl_load", "csv_", "json_folder", "nested_", "whole_", "array_and")
BATCH = sorted(n for n in QUERIES if not n.startswith(WRITING))


@pytest.mark.parametrize("name", BATCH)
def test_plans_stay_in_the_engine_and_off_products(spark, tables, name):
    plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "GlobalLimit"):
        assert unwanted not in plan
    if name not in ("first_distinct", "table_preview"):
        assert "TakeOrdered" not in plan


def plan_of(spark, tables, name):
    return QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_the_columns_they_need(spark, tables):
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan_of(spark, tables, "daily_extremes")).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "l_discount", "l_extendedprice", "l_linenumber", "l_quantity", "l_shipdate", "l_tax",
    ]


def test_payloads_are_parsed_once(spark, tables):
    for name in ("city_messages", "city_messages_required"):
        # One for the payload, one for the number in ``props`` it is made from.
        assert plan_of(spark, tables, name).count("from_json(") <= 2
    assert plan_of(spark, tables, "nested_explode").count("from_json(") == 1
    for name in ("station_view", "station_messages", "classify_messages", "document_shape"):
        assert plan_of(spark, tables, name).count("from_json(") <= 2


def test_payloads_are_parsed_as_far_as_they_are_used(spark, tables):
    def parsed(name):
        plan = plan_of(spark, tables, name)
        return max(re.findall(r"from_json\(StructField\(.*?\)(?=, cast|, [a-z_]+#)", plan), key=len)

    assert "coco" not in parsed("station_view") and "prcp" not in parsed("station_view")
    assert "humidity" not in parsed("classify_messages") and "temperature" in parsed("classify_messages")
    assert "rhum_source" not in parsed("document_shape") and "rhum" in parsed("document_shape")


def test_aggregates_combine_before_they_shuffle(spark, tables):
    for name in ("daily_extremes", "letter_stats_by_lang", "win_sliding_key", "report_by_group"):
        plan = plan_of(spark, tables, name)
        assert "partial_" in plan and plan.index("Exchange") < plan.index("partial_")


def test_no_local_state_in_the_sources():
    root = os.path.dirname(os.path.abspath(driver.__file__))
    for folder, _, files in os.walk(os.path.join(root, "stationflow")):
        if "llm" in folder.split(os.sep):
            continue  # has tests of its own
        for file in files:
            if file.endswith(".py"):
                with open(os.path.join(folder, file), encoding="utf-8") as source:
                    text = source.read()
                assert "localCheckpoint" not in text, file
                assert "toPandas" not in text and ".collect()" not in text, file
