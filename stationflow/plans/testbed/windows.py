from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import Metric, windowed_agg
from ..city import WINDOW_METRICS, city_broker_windows, city_line_windows, city_windows, overall_windows
from ..station import STATION_LINE_METRICS, station_windows
from .tables import EVENTS_SQL, as_station, cents_mean_sql, comparable, readings, whole_mean_sql


def win_tumbling_key(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(city_line_windows(readings(spark, folder), time="ts"))


def win_sliding_overall(spark, folder):
    return comparable(station_windows(as_station(readings(spark, folder)), time="ts"))


def win_sliding_line(spark, folder):
    rows = as_station(readings(spark, folder))
    return comparable(station_windows(rows, time="ts", metrics=STATION_LINE_METRICS))


def win_sliding_key(spark, folder):
    return comparable(city_windows(readings(spark, folder), time="ts"))


def win_sliding_key_direct(spark, folder):
    """The same windows without panes."""
    rows = windowed_agg(
        readings(spark, folder), "ts", "1 minute", "30 seconds", ["city"], WINDOW_METRICS, panes=False
    )
    return comparable(rows)


def win_sliding_5_1(spark, folder):
    return comparable(city_broker_windows(readings(spark, folder), time="ts"))


DAY_METRICS = (
    Metric("count", None, "readings"),
    Metric("sum", "temperature", "total"),
    Metric("avg", "temperature", "mean", 2),
    Metric("min", "temperature", "lowest"),
    Metric("max", "temperature", "highest"),
    Metric("set", "weather_condition", "weather_conditions"),
)


def win_day_by_hour(spark, folder):
    """A day's window every hour: each row is in 24 windows."""
    rows = windowed_agg(readings(spark, folder), "ts", "1 day", "1 hour", ["city"], DAY_METRICS)
    return comparable(rows)


def win_distinct_approx(spark, folder):
    """Distinct cities: few enough that the estimate is exact."""
    return comparable(overall_windows(readings(spark, folder), time="ts"))


def _users(spark, folder, size, slide=None):
    """Distinct users per window: the exact number by bitmaps, and the estimate of a sketch."""
    rows = readings(spark, folder).withColumnRenamed("wind_speed", "user_id")
    exact = (Metric("count", None, "readings"), Metric("bitmap_distinct", "user_id", "users"))
    guess = (Metric("sketch_distinct", "user_id", "guess", error=0.01),)
    days = windowed_agg(rows, "ts", size, slide, metrics=exact)
    both = days.join(windowed_agg(rows, "ts", size, slide, metrics=guess), ["window_start", "window_end"])
    near = F.abs(F.col("guess") - F.col("users")) * 20 <= F.col("users")
    return comparable(both.select("window_start", "readings", "users", near.cast("int").alias("within_bound")))


def win_users_approx(spark, folder):
    """Distinct users per day: the exact number, and whether the estimate is within 5 %."""
    return _users(spark, folder, "1 day")


def win_users_sliding(spark, folder):
    """The same over days that begin every hour: each row is in 24 windows."""
    return _users(spark, folder, "1 day", "1 hour")


def win_distinct_sliding(spark, folder):
    """Exact distinct users and dates per city and 6 hours, every hour; no values are held."""
    rows = readings(spark, folder).withColumnRenamed("wind_speed", "user_id").withColumn("date", F.to_date("ts"))
    metrics = (
        Metric("count", None, "readings"), Metric("bitmap_distinct", "user_id", "users"),
        Metric("bitmap_distinct", "date", "dates"), Metric("max", "temperature", "highest"),
    )
    return comparable(windowed_agg(rows, "ts", "6 hours", "1 hour", ["city"], metrics))


def win_sliding_fraction(spark, folder):
    """Windows of fractional seconds, by panes."""
    metrics = (Metric("count", None, "readings"), Metric("min", "temperature", "lowest"), Metric("max", "humidity", "highest"))
    return comparable(windowed_agg(readings(spark, folder), "ts", "1.5 seconds", "0.5 seconds", ["city"], metrics))


QUERIES = {
    "win_tumbling_key": win_tumbling_key,
    "win_sliding_overall": win_sliding_overall,
    "win_sliding_line": win_sliding_line,
    "win_sliding_key": win_sliding_key,
    "win_sliding_key_direct": win_sliding_key_direct,
    "win_sliding_5_1": win_sliding_5_1,
    "win_day_by_hour": win_day_by_hour,
    "win_distinct_approx": win_distinct_approx,
    "win_users_approx": win_users_approx,
    "win_users_sliding": win_users_sliding,
    "win_distinct_sliding": win_distinct_sliding,
    "win_sliding_fraction": win_sliding_fraction,
}


def windows_sql(
    size: float, slide: float, columns: str, key: bool = True, start: str = "window_start",
    end: str = "window_end", having: str = "",
) -> str:
    """Windows of ``size`` seconds every ``slide``, aligned to the epoch."""
    copies = int(-(-size // slide))
    size, slide = round(size * 1_000_000), round(slide * 1_000_000)
    by = "city, " if key else ""
    return f"""
    WITH e AS ({EVENTS_SQL}),
    w AS (
      SELECT e.*, epoch_us(ts) - epoch_us(ts) % {slide} - i * {slide} AS s
      FROM e, range({copies}) r(i)
      WHERE epoch_us(ts) - epoch_us(ts) % {slide} - i * {slide}
            + {size} > epoch_us(ts))
    SELECT make_timestamp(s) AS {start}, make_timestamp(s + {size}) AS {end}, {by}
           {columns}
    FROM w GROUP BY s{', city' if key else ''} {having}"""


_N = "count(*)"
_C, _K, _U = ("CAST(sum(%s) AS BIGINT)" % c for c in ("c", "k", "user_id"))
_LOW, _HIGH = "min(c) / 100.0::DOUBLE", "max(c) / 100.0::DOUBLE"
_CONDITIONS = "array_to_string(list_sort(list(DISTINCT cond)), ',') AS weather_conditions"

STATION_SQL = f"""
    {cents_mean_sql(_C, _N, 1)} AS avg_temperature,
    {cents_mean_sql('max(c)', '1', 1)} AS max_temperature,
    {cents_mean_sql('min(c)', '1', 1)} AS min_temperature,
    {whole_mean_sql(_K, _N, 1)} AS avg_humidity,
    {whole_mean_sql(_U, _N, 1)} AS avg_pressure,
    {whole_mean_sql(_K, _N, 1)} AS avg_wind_speed,
    {_C} / 100.0::DOUBLE AS total_precipitation,
    {_N} AS records_count"""
CITY_SQL = f"""
    {cents_mean_sql(_C, _N, 6)} AS avg_temperature,
    {_LOW} AS min_temperature, {_HIGH} AS max_temperature,
    CAST({_K} AS DOUBLE) / {_N} AS avg_humidity,
    CAST({_U} AS DOUBLE) / {_N} AS avg_wind_speed,
    {_N} AS measurement_count, {_CONDITIONS}"""
BROKER_SQL = f"""
    {_N} AS message_count, {cents_mean_sql(_C, _N, 1)} AS avg_temp,
    {_LOW} AS min_temperature, {_HIGH} AS max_temperature,
    {whole_mean_sql(_K, _N, 1)} AS avg_humidity, {whole_mean_sql(_U, _N, 1)} AS avg_wind_speed,
    count(DISTINCT cond) AS unique_conditions"""
OVERALL_SQL = f"""
    {_N} AS total_measurements, count(DISTINCT city) AS cities_count,
    {cents_mean_sql(_C, _N, 6)} AS overall_avg_temperature,
    {_LOW} AS overall_min_temperature, {_HIGH} AS overall_max_temperature"""
LINE_SQL = f"{cents_mean_sql(_C, _N, 6)} AS avg_temp, {_N} AS count"

ORACLE = {
    "win_tumbling_key": windows_sql(30, 30, LINE_SQL),
    "win_sliding_overall": windows_sql(
        15, 10, STATION_SQL + ", max(k) AS max_wind_speed", key=False
    ),
    "win_sliding_line": windows_sql(15, 10, STATION_SQL, key=False),
    "win_sliding_key": windows_sql(60, 30, CITY_SQL),
    "win_sliding_key_direct": windows_sql(60, 30, CITY_SQL),
    "win_sliding_5_1": windows_sql(300, 60, BROKER_SQL, start='"start"', end='"end"'),
    "win_day_by_hour": windows_sql(
        86400, 3600,
        f"""{_N} AS readings, {_C} / 100.0::DOUBLE AS total,
            {cents_mean_sql(_C, _N, 2)} AS mean, {_LOW} AS lowest, {_HIGH} AS highest,
            {_CONDITIONS}""",
    ),
    "win_distinct_approx": windows_sql(60, 30, OVERALL_SQL, key=False),
    "win_users_approx": """
    SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, count(*) AS readings,
           count(DISTINCT user_id) AS users, CAST(1 AS INTEGER) AS within_bound
    FROM events GROUP BY 1""",
    "win_users_sliding": f"""
    SELECT window_start, readings, users, CAST(1 AS INTEGER) AS within_bound
    FROM ({windows_sql(86400, 3600, f"{_N} AS readings, count(DISTINCT user_id) AS users", key=False)})""",
    "win_distinct_sliding": windows_sql(
        21600, 3600,
        f"""{_N} AS readings, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS dates,
            {_HIGH} AS highest""",
    ),
    "win_sliding_fraction": windows_sql(
        1.5, 0.5, f"{_N} AS readings, {_LOW} AS lowest, max(k) AS highest"
    ),
}
