from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import TEMPERATURE_EN, band
from ...operators import parse_json, to_json_value
from ...operators.once import computed_once
from ...schemas import HOURLY_STATION
from ...streaming import document_shape
from ..city import city_messages, classify
from ..station import VIEW_FIELDS, station_document_rows, station_readings, station_view
from .tables import PROPS, comparable, table


def hour_parts(time: str = "ts") -> list[Column]:
    t = F.col(time)
    return [
        F.year(t).alias("year"), F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"),
    ]


def envelope(rows: DataFrame, value: Column) -> DataFrame:
    """Events as topic messages: the fields Spark's topic source delivers."""
    messages = computed_once(
        rows,
        [
            F.col("user_id").cast("string").cast("binary").alias("key"),
            F.lit("readings").alias("topic"),
            F.col("user_id").cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        ],
        "value",
        value.cast("binary"),
    )
    return messages.select(
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType"
    )


def _with_k(events: DataFrame) -> DataFrame:
    """Events with the number in ``props``, parsed once."""
    return computed_once(events, [c for c in events.columns if c != "props"], "k", F.from_json("props", PROPS)["k"])


def station_messages_of(events: DataFrame) -> DataFrame:
    """Events as station messages."""
    events = _with_k(events)
    k = F.col("k")
    fields = F.struct(
        *hour_parts(),
        F.col("value").alias("temp"),
        F.col("event_type").alias("temp_source"),
        k.cast("double").alias("rhum"),
        F.col("value").alias("prcp"),
        k.cast("double").alias("wspd"),
        F.col("user_id").cast("double").alias("pres"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("kafka_timestamp"),
        F.lit("unknown to the schema").alias("extra"),
    )
    return envelope(events, F.to_json(fields))


def city_messages_of(events: DataFrame) -> DataFrame:
    """Events as city messages; some are no JSON, some have no payload at all."""
    events = _with_k(events)
    k = F.col("k")
    fields = F.struct(
        F.col("event_type").alias("city"),
        k.alias("temperature"),
        F.col("user_id").alias("humidity"),
        F.lit(1013).alias("pressure"),
        band(F.col("value"), TEMPERATURE_EN).alias("weather_condition"),
        F.col("user_id").alias("wind_speed"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    value = F.when(F.col("event_type") == "error", F.lit("not json")).when(
        F.col("event_type") != "signup", F.to_json(fields)
    )
    return envelope(events, value)


def station_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = station_readings(station_messages_of(table(spark, folder, "events")))
    # The code is missing everywhere: compared as DOUBLE, like other nullable numbers.
    return comparable(rows.drop("processing_time").withColumn("coco", F.col("coco").cast("double")))


def station_view_query(spark, folder):
    return comparable(
        station_view(station_readings(station_messages_of(table(spark, folder, "events")), VIEW_FIELDS))
    )


def _nullable_as_double(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: F.col(c).cast("double") for c in ("temperature", "humidity", "pressure", "wind_speed")}
    )


def city_messages_query(spark, folder):
    """Missing payloads are dropped, unreadable ones leave a row of nulls."""
    rows = city_messages(city_messages_of(table(spark, folder, "events")))
    return comparable(_nullable_as_double(rows))


def city_messages_required(spark, folder):
    """The same with a required field."""
    messages = city_messages_of(table(spark, folder, "events"))
    return comparable(_nullable_as_double(city_messages(messages, require=("city",))))


def classify_messages(spark, folder):
    messages = city_messages_of(table(spark, folder, "events"))
    return comparable(
        classify(city_messages(messages, ("city",), ("city", "temperature")))
        .where(F.col("processed_at").isNotNull())
        .select("offset", "city", "temperature", "temp_category")
    )


def message_round_trip(spark, folder):
    """Rows to JSON messages (as published) and back."""
    rows = table(spark, folder, "events").select(
        "event_id",
        *hour_parts(),
        F.col("value").alias("temp"),
        F.col("event_type").alias("temp_source"),
        F.from_json("props", PROPS)["k"].alias("rhum"),
    )
    sent = to_json_value(rows, key="event_id")
    back = parse_json(sent, HOURLY_STATION, keep=["key"])
    return back.select(
        "key", "year", "month", "day", "hour", "temp", "temp_source", "rhum",
        F.col("kafka_timestamp").isNotNull().cast("int").alias("stamped"),
    )


def document_shape_query(spark, folder):
    """Documents, unnested again."""
    messages = station_messages_of(table(spark, folder, "events"))
    documents = document_shape(station_document_rows(messages), batch_id=7)
    return comparable(
        documents.select(
            "year", "month", "day", "hour", "temperature", "humidity", "pressure", "wind_speed",
            "precipitation", "batch_id", F.col("metadata.temp_source").alias("temp_source"),
            F.col("metadata.kafka_timestamp").alias("kafka_timestamp"),
        )
    )


QUERIES = {
    "station_messages": station_messages,
    "station_view": station_view_query,
    "city_messages": city_messages_query,
    "city_messages_required": city_messages_required,
    "classify_messages": classify_messages,
    "message_round_trip": message_round_trip,
    "document_shape": document_shape_query,
}

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_PARTS = (
    "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
    "CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour"
)
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
_LABEL = "strftime(ts, '%Y-%m-%d %H:00')"
_CITY_COLUMNS = f"""
    'readings' AS topic, CAST(user_id AS INTEGER) AS partition, event_id AS "offset",
    ts AS kafka_timestamp,
    CASE WHEN event_type <> 'error' THEN event_type END AS city,
    CASE WHEN event_type <> 'error' THEN CAST({_K} AS DOUBLE) END AS temperature,
    CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS humidity,
    CASE WHEN event_type <> 'error' THEN CAST(1013 AS DOUBLE) END AS pressure,
    CASE WHEN event_type = 'error' THEN NULL WHEN value < 0 THEN 'freezing'
         WHEN value < 10 THEN 'cold' WHEN value < 20 THEN 'mild' ELSE 'warm'
    END AS weather_condition,
    CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS wind_speed,
    CASE WHEN event_type <> 'error' THEN {_ISO} END AS weather_timestamp"""
DOCUMENT_SQL = f"""
    {_PARTS}, value AS temperature, CAST({_K} AS DOUBLE) AS humidity,
    CAST(user_id AS DOUBLE) AS pressure, CAST({_K} AS DOUBLE) AS wind_speed,
    value AS precipitation, event_type AS temp_source, {_ISO} AS kafka_timestamp"""
VIEW_SQL = f"""
    SELECT {_LABEL} AS historical_time, value AS temperature_c,
           CAST({_K} AS DOUBLE) AS humidity_pct, CAST(user_id AS DOUBLE) AS pressure_hpa,
           CAST({_K} AS DOUBLE) AS wind_speed_kmh, ts AS kafka_processing_time,
           event_id AS "offset"
    FROM events"""

CLASSIFIED_SQL = f"""
    SELECT event_id AS "offset", event_type AS city, {_K} AS temperature,
           CASE WHEN {_K} < 0 THEN 'freezing' WHEN {_K} < 10 THEN 'cold'
                WHEN {_K} < 20 THEN 'mild' ELSE 'warm' END AS temp_category
    FROM events WHERE event_type NOT IN ('signup', 'error')"""

ORACLE = {
    "station_messages": f"""
    SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
           CAST(user_id AS INTEGER) AS partition, ts AS kafka_processing_time, {_PARTS},
           value AS temp, event_type AS temp_source, CAST({_K} AS DOUBLE) AS rhum,
           CAST(NULL AS VARCHAR) AS rhum_source, value AS prcp,
           CAST(NULL AS VARCHAR) AS prcp_source, CAST({_K} AS DOUBLE) AS wspd,
           CAST(NULL AS VARCHAR) AS wspd_source, CAST(user_id AS DOUBLE) AS pres,
           CAST(NULL AS VARCHAR) AS pres_source, CAST(NULL AS DOUBLE) AS coco,
           CAST(NULL AS VARCHAR) AS coco_source, {_ISO} AS kafka_timestamp,
           {_LABEL} AS date_time
    FROM events""",
    "station_view": VIEW_SQL,
    "city_messages": f"SELECT {_CITY_COLUMNS} FROM events WHERE event_type <> 'signup'",
    "city_messages_required": f"""
    SELECT {_CITY_COLUMNS} FROM events WHERE event_type NOT IN ('signup', 'error')""",
    "classify_messages": CLASSIFIED_SQL,
    "message_round_trip": f"""
    SELECT CAST(event_id AS VARCHAR) AS key, {_PARTS}, value AS temp, event_type AS temp_source,
           CAST({_K} AS DOUBLE) AS rhum, CAST(1 AS INTEGER) AS stamped
    FROM events""",
    "document_shape": f"SELECT {DOCUMENT_SQL}, CAST(7 AS BIGINT) AS batch_id FROM events",
}
