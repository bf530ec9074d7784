"""Hourly station messages: parse, label, view, window, store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_time_label, processing_time
from ..operators import Metric, parse_json, windowed_agg
from ..schemas import HOURLY_STATION, HOURLY_STATION_DOCUMENT, HOURLY_STATION_LINE

STATION_METRICS = (
    Metric("avg", "temp", "avg_temperature", 1),
    Metric("max", "temp", "max_temperature", 1),
    Metric("min", "temp", "min_temperature", 1),
    Metric("avg", "rhum", "avg_humidity", 1),
    Metric("avg", "pres", "avg_pressure", 1),
    Metric("avg", "wspd", "avg_wind_speed", 1),
    Metric("max", "wspd", "max_wind_speed", 1),
    Metric("sum", "prcp", "total_precipitation", 2),
    Metric("count", None, "records_count"),
)
STATION_LINE_METRICS = tuple(m for m in STATION_METRICS if m.alias != "max_wind_speed")


DATE_FIELDS = ("year", "month", "day", "hour")
# What the view and the windows use; the others need not be parsed for them.
VIEW_FIELDS = (*DATE_FIELDS, "temp", "rhum", "pres", "wspd")
WINDOW_FIELDS = (*DATE_FIELDS, "temp", "rhum", "prcp", "wspd", "pres")


def station_readings(messages: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Topic messages as readings, with broker fields, processing time and label.

    Only ``fields`` are parsed, if given; the label needs ``DATE_FIELDS``.
    """
    parsed = parse_json(
        messages,
        HOURLY_STATION,
        fields={name: name for name in fields} if fields else None,
        keep=[
            F.col("key").cast("string").alias("key"),
            "offset",
            "partition",
            F.col("timestamp").alias("kafka_processing_time"),
        ],
    )
    return parsed.withColumns(
        {
            "processing_time": processing_time(),
            "date_time": date_time_label(*(F.col(c) for c in DATE_FIELDS)),
        }
    )


def station_line_readings(lines: DataFrame) -> DataFrame:
    """Socket lines as readings, with the processing time."""
    return parse_json(lines, HOURLY_STATION_LINE).withColumn("processing_time", processing_time())


DOCUMENT_FIELDS = (*WINDOW_FIELDS, "temp_source", "kafka_timestamp")


def station_document_rows(messages: DataFrame, fields: tuple[str, ...] | None = DOCUMENT_FIELDS) -> DataFrame:
    """Topic messages as the rows the document sink takes; only ``fields`` are parsed, if given."""
    return parse_json(
        messages, HOURLY_STATION_DOCUMENT, fields={name: name for name in fields} if fields else None
    )


def station_view(readings: DataFrame) -> DataFrame:
    """Readings under unit-bearing names, for showing."""
    return readings.select(
        F.col("date_time").alias("historical_time"),
        F.col("temp").alias("temperature_c"),
        F.col("rhum").alias("humidity_pct"),
        F.col("pres").alias("pressure_hpa"),
        F.col("wspd").alias("wind_speed_kmh"),
        "kafka_processing_time",
        "offset",
    )


def station_windows(
    readings: DataFrame,
    time: str = "processing_time",
    size: str = "15 seconds",
    slide: str = "10 seconds",
    watermark: str = "10 seconds",
    metrics: tuple[Metric, ...] = STATION_METRICS,
) -> DataFrame:
    """Sliding station aggregates.

    On the default ``processing_time`` a row counts when it arrives; pass an
    event-time column for results that do not depend on arrival.
    """
    return windowed_agg(readings, time, size, slide, (), metrics, watermark)
