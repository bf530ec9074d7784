"""City readings from files, lines or topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import TEMPERATURE_EN, band, event_time, iso_text
from ..operators import Metric, group_metrics, parse_json, windowed_agg
from ..schemas import CITY_READING, CITY_READING_LINE

RUNNING_METRICS = (
    Metric("avg", "temperature", "avg_temperature"),
    Metric("min", "temperature", "min_temperature"),
    Metric("max", "temperature", "max_temperature"),
    Metric("avg", "humidity", "avg_humidity"),
    Metric("count", None, "measurement_count"),
    Metric("set", "weather_condition", "weather_conditions"),
)
WINDOW_METRICS = (
    *RUNNING_METRICS[:4],
    Metric("avg", "wind_speed", "avg_wind_speed"),
    *RUNNING_METRICS[4:],
)
OVERALL_METRICS = (
    Metric("count", None, "total_measurements"),
    Metric("approx_distinct", "city", "cities_count"),
    Metric("avg", "temperature", "overall_avg_temperature"),
    Metric("min", "temperature", "overall_min_temperature"),
    Metric("max", "temperature", "overall_max_temperature"),
)
LINE_METRICS = (Metric("avg", "temperature", "avg_temp"), Metric("count", None, "count"))
BROKER_METRICS = (
    Metric("count", None, "message_count"),
    Metric("avg", "temperature", "avg_temp", 1),
    Metric("min", "temperature", "min_temperature"),
    Metric("max", "temperature", "max_temperature"),
    Metric("avg", "humidity", "avg_humidity", 1),
    Metric("avg", "wind_speed", "avg_wind_speed", 1),
    Metric("approx_distinct", "weather_condition", "unique_conditions"),
)


def city_messages(
    messages: DataFrame, require: tuple[str, ...] = (), fields: tuple[str, ...] | None = None
) -> DataFrame:
    """Topic messages as readings; messages without payload are dropped.

    Text that is no JSON gives a row of nulls; ``require=("city",)`` drops it.
    Only ``fields`` are parsed, if given.
    """
    return parse_json(
        messages,
        CITY_READING,
        keep=["topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp")],
        fields={
            name: "weather_timestamp" if name == "timestamp" else name
            for name in fields or CITY_READING.fieldNames()
        },
        drop_null=True,
        require=require,
    )


def city_lines(lines: DataFrame) -> DataFrame:
    """Socket lines as readings with their event time."""
    return parse_json(lines, CITY_READING_LINE).withColumn(
        "event_time", event_time(F.col("timestamp"))
    )


def city_running(readings: DataFrame) -> DataFrame:
    """Running aggregates per city."""
    return group_metrics(readings, ["city"], RUNNING_METRICS)


def city_windows(
    readings: DataFrame, time: str = "processing_time", watermark: str = "2 minutes"
) -> DataFrame:
    """One-minute windows every 30 seconds, per city."""
    return windowed_agg(
        readings, time, "1 minute", "30 seconds", ["city"], WINDOW_METRICS, watermark
    )


def overall_windows(
    readings: DataFrame, time: str = "processing_time", watermark: str = "2 minutes"
) -> DataFrame:
    """One-minute windows every 30 seconds, over all cities."""
    return windowed_agg(
        readings, time, "1 minute", "30 seconds", (), OVERALL_METRICS, watermark, panes=True
    )


def city_line_windows(
    readings: DataFrame, time: str = "event_time", watermark: str = "30 seconds"
) -> DataFrame:
    """Tumbling 30-second windows on event time, per city."""
    return windowed_agg(readings, time, "30 seconds", None, ["city"], LINE_METRICS, watermark)


def city_broker_windows(
    readings: DataFrame, time: str = "kafka_timestamp", watermark: str = "5 minutes"
) -> DataFrame:
    """Five-minute windows every minute on the broker's time, per city."""
    return windowed_agg(
        readings, time, "5 minutes", "1 minute", ["city"], BROKER_METRICS, watermark,
        panes=True, start="start", end="end",
    )


def classify(readings: DataFrame, temperature: str = "temperature") -> DataFrame:
    """Readings with a temperature band and the time of processing as ISO text."""
    return readings.withColumns(
        {
            "temp_category": band(F.col(temperature), TEMPERATURE_EN),
            "processed_at": iso_text(F.current_timestamp()),
        }
    )


def classified_document(batch: DataFrame, batch_id: int) -> DataFrame:
    """Shape of ``document_writer`` for classified readings."""
    return classify(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
