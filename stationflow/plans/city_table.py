"""Nested city-day documents into a keyed table, and the report on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import (
    LoadResult,
    Metric,
    dedupe_keep_first,
    derive_city_day,
    drop_incomplete,
    explode_records,
    extremes,
    load_table,
    overall,
    per_group,
    value_counts,
)
from ..schemas import CITY_DAY_DOCUMENT
from ..sources import nested_json

TABLE_COLUMNS = (
    "record_id", "city", "date", "temperature", "humidity", "pressure", "wind_speed",
    "condition", "precipitation", "temp_category", "precip_category", "year", "month", "day",
    "created_at",
)
# Where a document stands: in which file, split, and place there.
POSITION = ("source_file", "block", "document")
# What the table wants set.
NOT_NULL = ("city", "date")
CITY_METRICS = (
    Metric("count", None, "records_count"),
    Metric("avg", "temperature", "avg_temp"),
    Metric("avg", "humidity", "avg_humidity"),
    Metric("sum", "precipitation", "total_precip"),
)


def extract(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """The records of the documents at ``path``, with file and position."""
    documents = nested_json(spark, path, CITY_DAY_DOCUMENT, whole_file)
    return explode_records(documents, "weather_data", keep=POSITION)


def transform(
    records: DataFrame,
    order: tuple[str, ...] = (*POSITION, "ordinal"),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Bands, date parts and key; first row of each key; complete rows only.

    ``keep`` names columns to carry besides those of the table.
    """
    firsts = dedupe_keep_first(derive_city_day(records), "record_id", order)
    return drop_incomplete(firsts.select(*TABLE_COLUMNS, *keep))


def run(spark: SparkSession, source: str, table: str, on_conflict: str = "skip") -> LoadResult:
    """Extract, transform and load; a second run adds nothing (or raises)."""
    return load_table(transform(extract(spark, source)), table, on_conflict=on_conflict, not_null=NOT_NULL)


def report(table: DataFrame) -> dict[str, DataFrame]:
    """Overall and per-city statistics of the table."""
    return {
        "overall": overall(
            table, {"city": "unique_cities", "date": "unique_dates"}, "temperature"
        ),
        "per_city": per_group(table, "city", CITY_METRICS, "avg_temp"),
    }


def analysis(
    rows: DataFrame, order: tuple[str, ...] = ("date", "record_id")
) -> dict[str, DataFrame]:
    """Extremes and band counts of transformed rows.

    A tie goes to the first row in ``order``: pass file and position (kept by
    ``transform``) for the order of the source; a stored table has none.
    """
    picks = {
        "warmest": ("max", "temperature"),
        "coldest": ("min", "temperature"),
        "wettest": ("max", "precipitation"),
    }
    return {
        "extremes": extremes(rows, "city", picks, order),
        "temperature_bands": value_counts(rows, "temp_category"),
        "precipitation_bands": value_counts(rows, "precip_category"),
    }
