"""Daily extremes and the phenomena they amount to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tag names in the order they are listed, labels and line formats.
LARGE_RANGE = "large_daily_temp_range"
HIGH_HUMIDITY = "very_high_humidity"
HEAVY_PRECIPITATION = "heavy_precipitation"
STRONG_WIND = "strong_wind"
PRESSURE_CHANGE = "rapid_pressure_change"
WITH_PHENOMENA = "WEATHER_PHENOMENA"
WITHOUT_PHENOMENA = "WEATHER_STATS"


@dataclass(frozen=True)
class DailyThresholds:
    """A day is tagged when its extreme is strictly above the threshold."""

    temp_range: float = 15
    rhum: float = 95
    prcp: float = 5.0
    wspd: float = 50.0
    pressure_range: float = 15


def daily_extremes(
    readings: DataFrame,
    keys: Sequence[Column | str] = ("date_key",),
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Extremes of each day (``keys``): one shuffle, of one row per task and day.

    ``columns`` renames the inputs, e.g. ``{"temp": "l_quantity", ...}``.
    """
    source = {name: name for name in ("temp", "rhum", "prcp", "wspd", "pres")}
    source.update(columns or {})
    return readings.groupBy(*keys).agg(
        F.min(source["temp"]).alias("min_temp"),
        F.max(source["temp"]).alias("max_temp"),
        F.max(source["rhum"]).alias("max_rhum"),
        F.max(source["prcp"]).alias("max_prcp"),
        F.max(source["wspd"]).alias("max_wspd"),
        (F.max(source["pres"]) - F.min(source["pres"])).alias("pressure_range"),
    )


def tag_phenomena(
    daily: DataFrame, thresholds: DailyThresholds = DailyThresholds()
) -> DataFrame:
    """Adds ``phenomena`` (tags in a fixed order) and ``status``."""
    rules = (
        (F.col("max_temp") - F.col("min_temp"), thresholds.temp_range, LARGE_RANGE),
        (F.col("max_rhum"), thresholds.rhum, HIGH_HUMIDITY),
        (F.col("max_prcp"), thresholds.prcp, HEAVY_PRECIPITATION),
        (F.col("max_wspd"), thresholds.wspd, STRONG_WIND),
        (F.col("pressure_range"), thresholds.pressure_range, PRESSURE_CHANGE),
    )
    tags = F.array_compact(
        F.array(*(F.when(extreme > bound, F.lit(tag)) for extreme, bound, tag in rules))
    )
    tagged = daily.withColumn("phenomena", tags)
    return tagged.withColumn(
        "status",
        F.when(F.size("phenomena") > 0, WITH_PHENOMENA).otherwise(WITHOUT_PHENOMENA),
    )


def daily_phenomena(
    readings: DataFrame,
    keys: Sequence[Column | str] = ("date_key",),
    columns: Mapping[str, str] | None = None,
    thresholds: DailyThresholds = DailyThresholds(),
) -> DataFrame:
    """``daily_extremes`` with tags."""
    return tag_phenomena(daily_extremes(readings, keys, columns), thresholds)


def daily_text_lines(date: Column | str = "date_key") -> list[Column]:
    """The six text lines of a tagged day."""
    # The wording of the lines.
    day = F.col(date) if isinstance(date, str) else date
    tags = F.array_join("phenomena", ", ")
    return [
        F.when(
            F.col("status") == WITH_PHENOMENA,
            F.concat(F.lit(f"{WITH_PHENOMENA}: "), day, F.lit(" - Detected: "), tags),
        ).otherwise(F.concat(F.lit(f"{WITHOUT_PHENOMENA}: "), day)),
        F.format_string("  Temperature: %.1fC - %.1fC", "min_temp", "max_temp"),
        F.concat(F.lit("  Humidity: up to "), F.col("max_rhum").cast("string"), F.lit("%")),
        F.concat(F.lit("  Precipitation: up to "), F.col("max_prcp").cast("string"), F.lit("mm")),
        F.concat(F.lit("  Wind: up to "), F.col("max_wspd").cast("string"), F.lit(" km/h")),
        F.format_string("  Pressure range: %.1f hPa", "pressure_range"),
    ]


def render_daily_text(
    daily: DataFrame, date: str = "date_key", line_end: str = "\t", ordered: bool = True
) -> DataFrame:
    """Tagged days as text: six rows of ``value`` per day.

    Days come in the byte order of ``<date>;`` (``2024-1-19`` before
    ``2024-1-1``). The days are sorted before they become lines, so the sort
    moves one narrow row per day. ``line_end`` closes every line: a tab, as in
    a key/value text file whose value is empty.
    """
    rows = daily.orderBy(F.concat(F.col(date), F.lit(";"))) if ordered else daily
    lines = [F.concat(line, F.lit(line_end)) for line in daily_text_lines(date)]
    return rows.select(F.explode(F.array(*lines)).alias("value"))
