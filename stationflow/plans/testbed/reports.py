from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import (
    Metric,
    count_rows,
    extremes,
    first_distinct,
    overall,
    per_group,
    preview,
    value_counts,
)
from .tables import EVENTS_SQL, cents_mean_sql, doubles, readings, table


def report_overall(spark: SparkSession, folder: str) -> DataFrame:
    rows = readings(spark, folder).withColumn("date", F.to_date("ts"))
    return doubles(
        overall(rows, {"city": "unique_cities", "date": "unique_dates"}, "temperature")
    )


REPORT_METRICS = (
    Metric("count", None, "records_count"),
    Metric("avg", "temperature", "avg_temp"),
    Metric("avg", "humidity", "avg_humidity"),
    Metric("sum", "temperature", "total_precip"),
)


def report_by_group(spark, folder):
    return doubles(per_group(readings(spark, folder), "city", REPORT_METRICS, "avg_temp"))


def report_extremes(spark, folder):
    picks = {
        "warmest": ("max", "value"), "coldest": ("min", "value"), "windiest": ("max", "user_id"),
    }
    return extremes(table(spark, folder, "events"), "event_type", picks, ["event_id"])


def value_counts_query(spark, folder):
    return value_counts(table(spark, folder, "orders"), "o_orderpriority")


def row_count(spark, folder):
    return count_rows(table(spark, folder, "lineitem"))


def first_distinct_query(spark, folder):
    """The ten users that appear first, in order of events."""
    return first_distinct(table(spark, folder, "events"), "user_id", "event_id", 10)


def table_preview(spark, folder):
    """The five most expensive orders."""
    rows = preview(table(spark, folder, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 5)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


QUERIES = {
    "report_overall": report_overall,
    "report_by_group": report_by_group,
    "report_extremes": report_extremes,
    "value_counts": value_counts_query,
    "row_count": row_count,
    "first_distinct": first_distinct_query,
    "table_preview": table_preview,
}

_C, _N = "CAST(sum(c) AS BIGINT)", "count(*)"

ORACLE = {
    "report_overall": f"""
    SELECT {_N} AS total_records, count(DISTINCT city) AS unique_cities,
           count(DISTINCT CAST(ts AS DATE)) AS unique_dates,
           min(c) / 100.0::DOUBLE AS min_temp, max(c) / 100.0::DOUBLE AS max_temp,
           {cents_mean_sql(_C, _N, 6)} AS avg_temp
    FROM ({EVENTS_SQL})""",
    "report_by_group": f"""
    SELECT city, {_N} AS records_count, {cents_mean_sql(_C, _N, 6)} AS avg_temp,
           CAST(CAST(sum(k) AS BIGINT) AS DOUBLE) / {_N} AS avg_humidity,
           {_C} / 100.0::DOUBLE AS total_precip
    FROM ({EVENTS_SQL}) GROUP BY city""",
    "report_extremes": """
    SELECT (SELECT event_type FROM events ORDER BY value DESC, event_id LIMIT 1) AS warmest_event_type,
           (SELECT max(value) FROM events) AS warmest_value,
           (SELECT event_type FROM events ORDER BY value, event_id LIMIT 1) AS coldest_event_type,
           (SELECT min(value) + 0.0 FROM events) AS coldest_value,
           (SELECT event_type FROM events ORDER BY user_id DESC, event_id LIMIT 1)
             AS windiest_event_type,
           (SELECT max(user_id) FROM events) AS windiest_value""",
    "value_counts": "SELECT o_orderpriority, count(*) AS records FROM orders GROUP BY 1",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "first_distinct": """
    SELECT user_id FROM events GROUP BY user_id ORDER BY min(event_id), user_id LIMIT 10""",
    "table_preview": """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus
    FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
}
