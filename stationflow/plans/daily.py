"""The delimited hourly export to daily phenomena."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_key
from ..operators import DailyThresholds, daily_phenomena, positional_fields, render_daily_text
from ..schemas import HOURLY_METRICS, HOURLY_POSITIONS


def hourly_readings(lines: DataFrame) -> DataFrame:
    """Lines of the export as readings with their day key."""
    readings = positional_fields(lines, HOURLY_POSITIONS, HOURLY_METRICS)
    return readings.withColumn("date_key", date_key(F.col("year"), F.col("month"), F.col("day")))


def phenomena(lines: DataFrame, thresholds: DailyThresholds = DailyThresholds()) -> DataFrame:
    """Tagged days."""
    return daily_phenomena(hourly_readings(lines), thresholds=thresholds)


def phenomena_text(
    lines: DataFrame, thresholds: DailyThresholds = DailyThresholds(), line_end: str = "\t"
) -> DataFrame:
    """Tagged days as text lines, in key order."""
    return render_daily_text(phenomena(lines, thresholds), line_end=line_end)
