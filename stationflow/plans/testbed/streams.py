"""Streams: each takes the whole event table through a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import Metric, group_metrics, keep_first_seen, windowed_agg
from ...session import new_work_folder
from ...streaming import (
    LateSplit,
    ManifestTable,
    RunningTable,
    batch_folder_writer,
    document_shape,
    document_writer,
    fan_out,
    read_batches,
)
from ..city import (
    LINE_METRICS,
    RUNNING_METRICS,
    city_broker_windows,
    city_line_windows,
    city_lines,
    city_messages,
    city_windows,
    classified_document,
    overall_windows,
)
from ..station import DOCUMENT_FIELDS, VIEW_FIELDS, WINDOW_FIELDS, station_readings, station_view, station_windows
from .messages import (
    CLASSIFIED_SQL,
    DOCUMENT_SQL,
    VIEW_SQL,
    city_messages_of,
    station_messages_of,
)
from .replay import collect_updates, drain, last_batch, latest_per_key, replay, table_stream
from .tables import EVENTS_SQL, as_readings, cents_mean_sql, comparable, money, table, whole_mean_sql
from .windows import (
    BROKER_SQL,
    CITY_SQL,
    LINE_SQL,
    OVERALL_SQL,
    STATION_SQL,
    windows_sql,
)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a zoned time: watermarks need TIMESTAMP."""
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _live(spark: SparkSession, folder: str) -> DataFrame:
    """The event table's own files as a stream, where order does not matter."""
    return table_stream(spark, f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _folded(spark, folder, plan, keys, name) -> DataFrame:
    """Update mode, folded to the latest row per window."""
    updates = collect_updates(_events(spark, folder), "ts", plan, "update", name=name)
    return comparable(latest_per_key(updates, keys))


def stream_running_key(spark, folder):
    """Complete mode: the last batch is the whole result."""
    out = new_work_folder(spark, "running-out")
    running = group_metrics(as_readings(_live(spark, folder)), ["city"], RUNNING_METRICS)
    drain(running, "complete", batch_folder_writer(out), name="running")
    return comparable(last_batch(read_batches(spark, out).drop("query")))


def stream_win_update(spark, folder):
    return _folded(
        spark, folder,
        lambda events: city_windows(as_readings(events), time="ts"),
        ["window_start", "window_end", "city"], "win-update",
    )


def stream_win_overall(spark, folder):
    return _folded(
        spark, folder,
        lambda events: overall_windows(as_readings(events), time="ts"),
        ["window_start", "window_end"], "win-overall",
    )


def stream_win_broker(spark, folder):
    return _folded(
        spark, folder,
        lambda events: city_broker_windows(as_readings(events), time="ts"),
        ["start", "end", "city"], "win-broker",
    )


def stream_win_append(spark, folder):
    """Append mode into files: a window is written once, when the watermark has passed it."""

    def hourly(events):
        return windowed_agg(
            as_readings(events), "ts", "1 hour", None, ["city"], LINE_METRICS, "10 minutes"
        )

    out = new_work_folder(spark, "win-append-out")
    replay(_events(spark, folder), "ts", hourly, "append", "parquet", options={"path": out}, name="win-append")
    return comparable(spark.read.parquet(out))


BROKER_PANES = (
    Metric("count", None, "message_count"),
    Metric("min", "temperature", "min_temperature"),
    Metric("max", "temperature", "max_temperature"),
    Metric("avg", "humidity", "avg_humidity", 1),
    Metric("sketch_distinct", "weather_condition", "unique_conditions"),
)


def stream_win_panes(spark, folder):
    """Five minutes every minute in append mode, by two chained aggregates: panes, then windows."""

    def chained(events):
        return windowed_agg(
            as_readings(events), "ts", "5 minutes", "1 minute", ["city"], BROKER_PANES, "10 minutes", chained=True
        )

    out = new_work_folder(spark, "win-panes-out")
    replay(_events(spark, folder), "ts", chained, "append", "parquet", options={"path": out}, name="win-panes")
    return comparable(spark.read.parquet(out))


def stream_lines_tumbling(spark, folder):
    """Readings as JSON lines with ISO event times, parsed and windowed in the stream."""
    readings = as_readings(_events(spark, folder)).select(
        "ts",
        F.to_json(
            F.struct(
                "city",
                F.col("humidity").alias("temperature"),
                F.col("wind_speed").alias("humidity"),
                "weather_condition",
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            )
        ).alias("value"),
    )
    updates = collect_updates(
        readings, "ts", lambda lines: city_line_windows(city_lines(lines)), "update", name="lines"
    )
    return comparable(latest_per_key(updates, ["window_start", "window_end", "city"]))


def stream_station_windows(spark, folder):
    """Topic envelopes, parsed and windowed by broker time in the stream."""

    def windows(messages):
        rows = station_readings(messages, WINDOW_FIELDS).withColumns(
            {"temp": money("temp"), "prcp": money("prcp")}
        )
        return station_windows(rows, time="kafka_processing_time")

    messages = station_messages_of(_events(spark, folder))
    updates = collect_updates(messages, "timestamp", windows, "update", name="station")
    return comparable(latest_per_key(updates, ["window_start", "window_end"]))


def stream_raw(spark, folder):
    """Append mode, no state: the view of parsed messages."""
    out = new_work_folder(spark, "raw-out")
    view = station_view(station_readings(station_messages_of(_live(spark, folder)), VIEW_FIELDS))
    drain(view, "append", "parquet", {"path": out}, "raw")
    return comparable(spark.read.parquet(out))


def stream_fan_out(spark, folder):
    """One reading of the source into two sinks: all rows, and counts per batch."""
    out = new_work_folder(spark, "fan-out")
    raw, counts = batch_folder_writer(f"{out}/raw"), batch_folder_writer(f"{out}/counts")

    def per_city(batch, batch_id):
        counts(batch.groupBy("city").agg(F.count("*").alias("n")), batch_id)

    drain(as_readings(_live(spark, folder)), "append", fan_out(raw, per_city), name="fan")
    rows = read_batches(spark, f"{out}/raw").groupBy("city").agg(
        F.count("*").alias("raw_rows"), F.sum("temperature").alias("total")
    )
    counted = read_batches(spark, f"{out}/counts").groupBy("city").agg(
        F.sum("n").alias("counted_rows")
    )
    return comparable(rows.join(counted, "city"))


def stream_documents(spark, folder):
    """Per-batch document sink, read back."""
    out = new_work_folder(spark, "documents")
    rows = station_readings(station_messages_of(_live(spark, folder)), DOCUMENT_FIELDS)
    drain(rows, "append", document_writer(out, "parquet", document_shape), name="docs")
    stored = read_batches(spark, out)
    return comparable(
        stored.select(
            "year", "month", "day", "hour", "temperature", "humidity", "pressure", "wind_speed",
            "precipitation", F.col("metadata.temp_source").alias("temp_source"),
            F.col("metadata.kafka_timestamp").alias("kafka_timestamp"),
            (F.col("batch_id") == F.col("batch")).cast("int").alias("batch_matches"),
            (F.col("processed_at").isNotNull() & F.col("timestamp").isNotNull())
            .cast("int").alias("stamped"),
        )
    )


def stream_classified(spark, folder):
    """City messages, classified and stored as documents per batch."""
    out = new_work_folder(spark, "classified")
    rows = city_messages(city_messages_of(_live(spark, folder)), ("city",), ("city", "temperature"))
    drain(rows, "append", document_writer(out, "parquet", classified_document), name="classified")
    stored = read_batches(spark, out).where("batch = batch_id AND processed_at IS NOT NULL")
    return comparable(stored.select("offset", "city", "temperature", "temp_category"))


def stream_keep_first(spark, folder):
    """Every message is delivered twice, 90 seconds apart; each is stored once."""
    events = as_readings(_events(spark, folder)).withColumn("delivered", F.explode(F.array("ts", F.col("ts") + F.expr("INTERVAL '90 seconds'"))))
    out = new_work_folder(spark, "keep-first-out")

    def first(messages):
        return keep_first_seen(messages, "event_id", "ts", "10 minutes")

    replay(events, "delivered", first, "append", "parquet", options={"path": out}, name="keep-first")
    return comparable(spark.read.parquet(out).select("event_id", "city", "ts", "temperature"))


def _halves(spark, folder):
    """The readings up to and after the middle event, as two tables."""
    rows = as_readings(_events(spark, folder))
    middle = rows.agg(F.max("event_id").alias("most")).first().most // 2
    return rows.where(F.col("event_id") <= middle), rows.where(F.col("event_id") > middle)


def stream_running_table(spark, folder):
    """Running aggregates in a stored table: a second query, with a new checkpoint, goes on with it."""
    running = RunningTable(spark, new_work_folder(spark, "running-table"), ["city"], RUNNING_METRICS, buckets=8)
    for half in _halves(spark, folder):
        replay(half, "ts", lambda rows: rows, "append", running.writer(), batches=3, name="running-table")
    return comparable(running.read())


def stream_manifest(spark, folder):
    """City messages as documents, through a sink of commits: 20 micro-batches, merged by fours."""
    table = ManifestTable(spark, new_work_folder(spark, "manifest-table"), merge=4)
    messages = city_messages_of(_events(spark, folder))

    def classified(rows):
        return city_messages(rows, ("city",), ("city", "temperature"))

    replay(messages, "timestamp", classified, "append", table.writer(classified_document), batches=20, name="manifest")
    few = len(table.latest().folders) < 8
    rows = table.read().where("processed_at IS NOT NULL")
    return comparable(rows.select("offset", "city", "temperature", "temp_category", F.lit(int(few)).alias("few_folders")))


def stream_late_rows(spark, folder):
    """Readings that arrive up to five days late: hours of those on time, and the late ones kept."""
    late_by = F.expr("make_dt_interval(0, 0, 0, cast(pmod(xxhash64(event_id), 432000) as decimal(18, 6)))")
    rows = as_readings(_events(spark, folder)).withColumn("arrived", F.col("ts") + late_by)
    hourly = RunningTable(spark, new_work_folder(spark, "late-hours"), ["city", "hour"], LINE_METRICS, buckets=8)
    late = ManifestTable(spark, new_work_folder(spark, "late-rows"))

    def on_time(batch, batch_id):
        hourly.writer()(batch.withColumn("hour", F.date_trunc("hour", "ts")), batch_id)

    split = LateSplit(spark, new_work_folder(spark, "late-split"), "ts", "1 hour", on_time, late.writer())
    replay(rows, "arrived", lambda stream: stream, "append", split.write, batches=12, name="late")
    counted = hourly.read().groupBy("city").agg(F.sum("count").alias("on_time"))
    kept = late.read().groupBy("city").agg(F.count(F.lit(1)).alias("late"))
    both = counted.join(kept, "city")
    return comparable(both.select("city", (F.col("on_time") + F.col("late")).alias("readings"), (F.col("late") > 0).cast("int").alias("some_late")))


QUERIES = {
    "stream_running_key": stream_running_key,
    "stream_win_update": stream_win_update,
    "stream_win_overall": stream_win_overall,
    "stream_win_broker": stream_win_broker,
    "stream_win_append": stream_win_append,
    "stream_win_panes": stream_win_panes,
    "stream_lines_tumbling": stream_lines_tumbling,
    "stream_station_windows": stream_station_windows,
    "stream_raw": stream_raw,
    "stream_fan_out": stream_fan_out,
    "stream_documents": stream_documents,
    "stream_classified": stream_classified,
    "stream_keep_first": stream_keep_first,
    "stream_running_table": stream_running_table,
    "stream_manifest": stream_manifest,
    "stream_late_rows": stream_late_rows,
}

RUNNING_SQL = f"""
    WITH e AS ({EVENTS_SQL})
    SELECT city, {cents_mean_sql('CAST(sum(c) AS BIGINT)', 'count(*)', 6)} AS avg_temperature,
           min(c) / 100.0::DOUBLE AS min_temperature, max(c) / 100.0::DOUBLE AS max_temperature,
           CAST(CAST(sum(k) AS BIGINT) AS DOUBLE) / count(*) AS avg_humidity,
           count(*) AS measurement_count,
           array_to_string(list_sort(list(DISTINCT cond)), ',') AS weather_conditions
    FROM e GROUP BY city"""

ORACLE = {
    "stream_running_key": RUNNING_SQL,
    "stream_win_update": windows_sql(60, 30, CITY_SQL),
    "stream_win_overall": windows_sql(60, 30, OVERALL_SQL, key=False),
    "stream_win_broker": windows_sql(300, 60, BROKER_SQL, start='"start"', end='"end"'),
    # A window is final once it ends at or before the watermark.
    "stream_win_append": windows_sql(
        3600, 3600, LINE_SQL,
        having="HAVING s + 3600000000 <= (SELECT epoch_us(max(ts)) FROM events) - 600000000",
    ),
    "stream_win_panes": windows_sql(
        300, 60,
        f"""count(*) AS message_count, min(c) / 100.0::DOUBLE AS min_temperature, max(c) / 100.0::DOUBLE AS max_temperature,
            {whole_mean_sql('CAST(sum(k) AS BIGINT)', 'count(*)', 1)} AS avg_humidity,
            count(DISTINCT cond) AS unique_conditions""",
        having="HAVING s + 300000000 <= (SELECT epoch_us(max(ts)) FROM events) - 600000000",
    ),
    "stream_lines_tumbling": windows_sql(
        30, 30,
        "CAST(CAST(sum(k) AS BIGINT) AS DOUBLE) / count(*) AS avg_temp, count(*) AS count",
    ),
    "stream_station_windows": windows_sql(
        15, 10, STATION_SQL + ", CAST(max(k) AS DOUBLE) AS max_wind_speed", key=False
    ),
    "stream_raw": VIEW_SQL,
    "stream_fan_out": f"""
    SELECT city, count(*) AS raw_rows, CAST(sum(c) AS BIGINT) / 100.0::DOUBLE AS total,
           count(*) AS counted_rows
    FROM ({EVENTS_SQL}) GROUP BY city""",
    "stream_classified": CLASSIFIED_SQL,
    "stream_keep_first": f"SELECT event_id, city, ts, c / 100.0::DOUBLE AS temperature FROM ({EVENTS_SQL})",
    "stream_running_table": RUNNING_SQL,
    "stream_manifest": f"SELECT *, CAST(1 AS INTEGER) AS few_folders FROM ({CLASSIFIED_SQL})",
    "stream_late_rows": "SELECT event_type AS city, count(*) AS readings, CAST(1 AS INTEGER) AS some_late FROM events GROUP BY 1",
    "stream_documents": f"""
    SELECT {DOCUMENT_SQL}, CAST(1 AS INTEGER) AS batch_matches, CAST(1 AS INTEGER) AS stamped
    FROM events""",
}
