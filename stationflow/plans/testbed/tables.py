"""Test tables and the columns several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions import TEMPERATURE_EN, band

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(column: Column | str) -> Column:
    """A two-decimal DOUBLE as exact DECIMAL: sums do not depend on row order."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(T.DecimalType(18, 2))


PROPS = T.StructType([T.StructField("k", T.LongType(), True)])


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as city readings; measurements are exact, ``ts`` has no zone."""
    return as_readings(table(spark, folder, "events"))


def as_readings(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("city"),
        money("value").alias("temperature"),
        F.from_json("props", PROPS)["k"].alias("humidity"),
        F.col("user_id").alias("wind_speed"),
        band(F.col("value"), TEMPERATURE_EN).alias("weather_condition"),
    )


def as_station(readings: DataFrame) -> DataFrame:
    """City readings under the names of station readings."""
    return readings.select(
        "ts",
        F.col("temperature").alias("temp"),
        F.col("humidity").alias("rhum"),
        F.col("wind_speed").alias("pres"),
        F.col("humidity").alias("wspd"),
        F.col("temperature").alias("prcp"),
    )


def plain_times(rows: DataFrame) -> DataFrame:
    """TIMESTAMP columns as TIMESTAMP_NTZ, for comparison."""
    return rows.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in rows.schema.fields
        )
    )


def joined_sets(rows: DataFrame) -> DataFrame:
    """Arrays as joined text, for comparison."""
    return rows.select(
        *(
            F.array_join(f.name, ",").alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in rows.schema.fields
        )
    )


def comparable(rows: DataFrame) -> DataFrame:
    return plain_times(joined_sets(doubles(rows)))


def doubles(rows: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE, for comparison."""
    return rows.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in rows.schema.fields
        )
    )


# Exact SQL: the events with integer cents ``c``, second measurement ``k`` and
# condition; and halves-up rounding of sums of cents without floating point.
EVENTS_SQL = """
    SELECT event_id, ts, event_type AS city, user_id,
           CAST(round(value * 100) AS BIGINT) AS c,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CASE WHEN value < 0 THEN 'freezing' WHEN value < 10 THEN 'cold'
                WHEN value < 20 THEN 'mild' ELSE 'warm' END AS cond
    FROM events"""


def cents_mean_sql(total: str, n: str, digits: int) -> str:
    """The mean of positive cents, as a decimal rounded half up to ``digits``."""
    if digits < 2:
        unit = 10 ** (2 - digits)
        whole = f"(2 * {total} + {unit} * {n}) // (2 * {unit} * {n})"
    else:
        unit = 10 ** (digits - 2)
        whole = f"(2 * {unit} * {total} + {n}) // (2 * {n})"
    return f"CAST({whole} AS DOUBLE) / {10**digits}"


def whole_mean_sql(total: str, n: str, digits: int) -> str:
    """The mean of non-negative integers rounded half up to ``digits``."""
    unit = 10**digits
    return f"CAST((2 * {unit} * {total} + {n}) // (2 * {n}) AS DOUBLE) / {unit}"
