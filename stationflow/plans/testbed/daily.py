from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import date_key_of
from ...operators import DailyThresholds, daily_phenomena, render_daily_text
from ...operators.daily import daily_extremes
from .tables import table

COLUMNS = {
    "temp": "l_quantity", "rhum": "l_extendedprice", "prcp": "l_discount",
    "wspd": "l_tax", "pres": "l_linenumber",
}
THRESHOLDS = DailyThresholds(
    temp_range=48, rhum=100_000, prcp=0.09, wspd=0.07, pressure_range=5
)


def _days(spark: SparkSession, folder: str, *keys: str) -> DataFrame:
    """Line items as readings of their shipping day.

    Grouped by the timestamp, from which the text key follows: a fixed-width key
    is cheaper to hash and to shuffle than text built for every row.
    """
    lines = table(spark, folder, "lineitem")
    day = F.to_date("l_shipdate").alias("day")
    tagged = daily_phenomena(lines, [day, *keys], COLUMNS, THRESHOLDS)
    return tagged.withColumn("date_key", date_key_of(F.col("day")))


def _columns(days: DataFrame, *keys: str) -> DataFrame:
    return days.select(
        "date_key", *keys,
        "min_temp", "max_temp", "max_rhum", "max_prcp", "max_wspd",
        F.col("pressure_range").cast("bigint").alias("pressure_range"),
        F.array_join("phenomena", ", ").alias("phenomena"),
        "status",
    )


def daily_extremes_query(spark: SparkSession, folder: str) -> DataFrame:
    return _columns(_days(spark, folder))


def daily_extremes_by_place(spark: SparkSession, folder: str) -> DataFrame:
    return _columns(_days(spark, folder, "l_returnflag"), "l_returnflag")


def daily_key_unpadded(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.groupBy(date_key_of(F.col("ts")).alias("date_key")).agg(
        F.count("*").alias("readings"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


def render_daily_text_query(spark: SparkSession, folder: str) -> DataFrame:
    """Text of the days, with whole-number metrics so that no rounding is involved."""
    lines = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").alias("temp"),
        F.col("l_quantity").alias("rhum"),
        F.col("l_linenumber").cast("double").alias("prcp"),
        F.col("l_linenumber").cast("double").alias("wspd"),
        F.col("l_linenumber").cast("double").alias("pres"),
    )
    days = daily_phenomena(
        lines, ["day"], thresholds=DailyThresholds(48, 49.0, 6.0, 6.0, 5)
    ).withColumn("date_key", date_key_of(F.col("day")))
    return render_daily_text(days)


QUERIES = {
    "daily_extremes": daily_extremes_query,
    "daily_extremes_by_place": daily_extremes_by_place,
    "daily_key_unpadded": daily_key_unpadded,
    "render_daily_text": render_daily_text_query,
}

_KEY = "year({0}) || '-' || month({0}) || '-' || day({0})"


def _daily_sql(*keys: str) -> str:
    extra = "".join(f"{k}, " for k in keys)
    return f"""
    WITH d AS (
      SELECT CAST(l_shipdate AS DATE) AS day, {extra}
             min(l_quantity) AS min_temp, max(l_quantity) AS max_temp,
             max(l_extendedprice) AS max_rhum, max(l_discount) AS max_prcp,
             max(l_tax) AS max_wspd,
             CAST(max(l_linenumber) - min(l_linenumber) AS BIGINT) AS pressure_range
      FROM lineitem GROUP BY ALL),
    t AS (
      SELECT *, concat_ws(', ',
        CASE WHEN max_temp - min_temp > 48 THEN 'large_daily_temp_range' END,
        CASE WHEN max_rhum > 100000 THEN 'very_high_humidity' END,
        CASE WHEN max_prcp > CAST(0.09 AS DOUBLE) THEN 'heavy_precipitation' END,
        CASE WHEN max_wspd > CAST(0.07 AS DOUBLE) THEN 'strong_wind' END,
        CASE WHEN pressure_range > 5 THEN 'rapid_pressure_change' END) AS phenomena
      FROM d)
    SELECT {_KEY.format('day')} AS date_key, {extra}
           min_temp, max_temp, max_rhum, max_prcp, max_wspd, pressure_range, phenomena,
           CASE WHEN phenomena <> '' THEN 'WEATHER_PHENOMENA' ELSE 'WEATHER_STATS' END AS status
    FROM t"""


ORACLE = {
    "daily_extremes": _daily_sql(),
    "daily_extremes_by_place": _daily_sql("l_returnflag"),
    "daily_key_unpadded": f"""
    SELECT {_KEY.format('ts')} AS date_key, count(*) AS readings,
           min(value) AS lowest, max(value) AS highest
    FROM events GROUP BY 1""",
    "render_daily_text": f"""
    WITH d AS (
      SELECT CAST(l_shipdate AS DATE) AS day, min(l_quantity) AS lo, max(l_quantity) AS hi,
             CAST(max(l_linenumber) AS DOUBLE) AS ln,
             CAST(max(l_linenumber) - min(l_linenumber) AS DOUBLE) AS pr
      FROM lineitem GROUP BY 1),
    t AS (
      SELECT *, {_KEY.format('day')} AS date_key, concat_ws(', ',
        CASE WHEN hi - lo > 48 THEN 'large_daily_temp_range' END,
        CASE WHEN hi > 49 THEN 'very_high_humidity' END,
        CASE WHEN ln > 6 THEN 'heavy_precipitation' END,
        CASE WHEN ln > 6 THEN 'strong_wind' END,
        CASE WHEN pr > 5 THEN 'rapid_pressure_change' END) AS tags
      FROM d)
    SELECT unnest([
      CASE WHEN tags <> '' THEN 'WEATHER_PHENOMENA: ' || date_key || ' - Detected: ' || tags
           ELSE 'WEATHER_STATS: ' || date_key END || chr(9),
      format('  Temperature: {{:.1f}}C - {{:.1f}}C', lo, hi) || chr(9),
      format('  Humidity: up to {{:.1f}}%', hi) || chr(9),
      format('  Precipitation: up to {{:.1f}}mm', ln) || chr(9),
      format('  Wind: up to {{:.1f}} km/h', ln) || chr(9),
      format('  Pressure range: {{:.1f}} hPa', pr) || chr(9)]) AS value
    FROM t""",
}
