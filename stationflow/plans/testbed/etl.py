from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import Bands
from ...operators import (
    KeyConflict,
    dedupe_keep_first,
    derive_city_day,
    drop_incomplete,
    enrich,
    load_table,
    unseen_rows,
)
from ...session import new_work_folder
from ...streaming import KeyedTable
from .tables import comparable, table

PRICE_BANDS = Bands(((">", 300_000, "high"), (">", 150_000, "middle")), "low")
SIZE_BANDS = Bands((("<", 100, "new"), ("<", 1000, "known")), "old")
COLUMNS = (
    "record_id", "city", "date", "temperature", "precipitation", "condition",
    "temp_category", "precip_category", "year", "month", "day", "o_orderkey",
)


def _days(orders: DataFrame) -> DataFrame:
    """Orders as city-day records: key is status and date, one condition is missing."""
    rows = orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("city"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("temperature"),
        F.col("o_custkey").alias("precipitation"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
        .alias("condition"),
    )
    return derive_city_day(rows, temperature_bands=PRICE_BANDS, precipitation_bands=SIZE_BANDS)


def transform(orders: DataFrame) -> DataFrame:
    return drop_incomplete(
        dedupe_keep_first(_days(orders).select(*COLUMNS), "record_id", ["o_orderkey"])
    )


def etl_transform(spark: SparkSession, folder: str) -> DataFrame:
    return transform(table(spark, folder, "orders"))


def _halves(spark, folder):
    """Orders in two deliveries: by priority, so that many keys are in both."""
    orders = table(spark, folder, "orders")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.where(urgent), orders.where(~urgent)


def etl_unseen_rows(spark, folder):
    """Rows of the second delivery whose key the first does not have."""
    first, second = _halves(spark, folder)
    return unseen_rows(transform(second), transform(first), "record_id")


def etl_load_new(spark, folder):
    """Both deliveries loaded into a table, the second one twice; the table.

    A delivery that has its keys twice is refused, and adds nothing.
    """
    path = new_work_folder(spark, "table")
    first, second = _halves(spark, folder)
    load_table(transform(first), path)
    load_table(transform(second), path)
    load_table(transform(second), path)
    repeated = transform(first)
    try:
        load_table(repeated.unionAll(repeated), path)
    except KeyConflict:
        return spark.read.parquet(path).select(*COLUMNS)
    raise AssertionError("keys that come twice were loaded")


def etl_load_atomic(spark, folder):
    """Four deliveries, two of them loaded at the same time, into a keyed table; the table.

    The deliveries are those of ``etl_load_new``, the second one three times.
    """
    loads = KeyedTable(spark, new_work_folder(spark, "keyed"), merge=2)
    first, second = (transform(half) for half in _halves(spark, folder))
    loads.load(first)
    with ThreadPoolExecutor(2) as threads:
        both = [threads.submit(loads.load, second) for _ in range(2)]
        loaded = sorted(b.result().loaded for b in both)
    if loaded[0] or loads.load(second).loaded:
        raise AssertionError("a delivery was loaded twice")
    return loads.read().select(*COLUMNS)


def enrich_nation_region(spark, folder):
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return enrich(table(spark, folder, "nation"), regions, "n_regionkey")


def enrich_orders_customer(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return enrich(orders, customers, "o_custkey")


QUERIES = {
    "etl_transform": etl_transform,
    "etl_unseen_rows": etl_unseen_rows,
    "etl_load_new": etl_load_new,
    "etl_load_atomic": etl_load_atomic,
    "enrich_nation_region": enrich_nation_region,
    "enrich_orders_customer": enrich_orders_customer,
}


def _transform_sql(where: str = "") -> str:
    return f"""
    SELECT o_orderstatus || '_' || strftime(o_orderdate, '%Y-%m-%d') AS record_id,
           o_orderstatus AS city, strftime(o_orderdate, '%Y-%m-%d') AS date,
           o_totalprice AS temperature, o_custkey AS precipitation,
           o_orderpriority AS condition,
           CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 150000 THEN 'middle'
                ELSE 'low' END AS temp_category,
           CASE WHEN o_custkey < 100 THEN 'new' WHEN o_custkey < 1000 THEN 'known'
                ELSE 'old' END AS precip_category,
           CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(day(o_orderdate) AS INTEGER) AS day, o_orderkey
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, CAST(o_orderdate AS DATE)
                                       ORDER BY o_orderkey) AS rn
          FROM orders {where})
    WHERE rn = 1 AND o_orderpriority <> '4-NOT SPECIFIED'"""


_FIRST = _transform_sql("WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
_SECOND = _transform_sql("WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
_UNSEEN = f"""
    SELECT * FROM ({_SECOND}) WHERE record_id NOT IN (SELECT record_id FROM ({_FIRST}))"""

ORACLE = {
    "etl_transform": _transform_sql(),
    "etl_unseen_rows": _UNSEEN,
    "etl_load_new": f"{_FIRST} UNION ALL {_UNSEEN}",
    "etl_load_atomic": f"{_FIRST} UNION ALL {_UNSEEN}",
    "enrich_nation_region": """
    SELECT n_nationkey, n_name, n_regionkey, r_name
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "enrich_orders_customer": """
    SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment, c_nationkey
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
}
