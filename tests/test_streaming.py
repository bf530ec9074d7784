from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from stationflow.operators import Metric, group_metrics, windowed_agg
from stationflow.plans.city import city_running, city_windows
from stationflow.plans.testbed.replay import collect_updates, latest_per_key, replay
from stationflow.schemas import CITY_READING_FILE
from stationflow.session import new_work_folder, shared_folder
from stationflow.sources import json_dir_stream, kafka_options, kafka_stream
from stationflow.streaming import (
    batch_folder_writer,
    LateRows,
    checkpoint_for,
    console_options,
    document_shape,
    document_writer,
    fan_out,
    read_batches,
    run_for,
    start_query,
    stop_all,
    to_topic,
    topic_options,
)

DAY = dt.datetime(2024, 5, 1)
NOW = {"availableNow": True}
COUNT = (Metric("count", None, "n"),)


def reading(i, city="A", temperature=1, condition="Sunny"):
    return {
        "file_id": i, "city": city, "temperature": temperature, "humidity": 50 + i, "pressure": 1000,
        "weather_condition": condition, "wind_speed": i,
        "timestamp": (DAY + dt.timedelta(seconds=20 * i)).isoformat(),
    }


def drop_file(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    time.sleep(0.02)  # files are taken in the order of their modification times


@pytest.fixture()
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    for i in range(4):
        drop_file(folder, f"{i}.json", reading(i, "AB"[i % 2], i - 1, ["Sunny", "Rainy"][i // 2]))
    return folder


def run_now(stream, name, tmp_path, **how):
    query = start_query(
        stream, name, checkpoint=str(tmp_path / f"checkpoint-{name}"), trigger=NOW, **how
    )
    query.awaitTermination()
    return query


def test_one_file_per_trigger_running_aggregate_in_complete_mode(spark, tmp_path, inbox):
    batches = []
    run_now(
        city_running(json_dir_stream(spark, str(inbox), CITY_READING_FILE)), "running", tmp_path,
        mode="complete", sink=lambda batch, i: batches.append(batch.collect()),
    )
    assert len(batches) == 4
    last = {r.city: r.asDict() for r in batches[-1]}
    assert last["A"] == {
        "city": "A", "avg_temperature": 0.0, "min_temperature": -1, "max_temperature": 1,
        "avg_humidity": 51.0, "measurement_count": 2, "weather_conditions": ["Rainy", "Sunny"],
    }
    static = city_running(spark.read.schema(CITY_READING_FILE).json(str(inbox)))
    assert {r.city: r.asDict() for r in static.collect()} == last


def test_a_restarted_query_goes_on_from_its_checkpoint(spark, tmp_path, inbox):
    def run():
        stream = json_dir_stream(spark, str(inbox), CITY_READING_FILE, None)
        run_now(stream, "restart", tmp_path, sink=batch_folder_writer(str(tmp_path / "out")))
        return read_batches(spark, str(tmp_path / "out"))

    assert run().count() == 4
    drop_file(inbox, "late.json", reading(9), reading(10))
    again = run()
    assert again.groupBy("batch").count().orderBy("batch").collect()[-1]["count"] == 2
    assert again.count() == 6


def test_update_mode_equals_the_table(spark):
    rows = spark.range(300).select(
        (F.lit(DAY).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 7)).alias("ts"),
        F.when(F.col("id") % 3 == 0, "B").otherwise("A").alias("city"),
        F.col("id").alias("temperature"), F.col("id").alias("humidity"), F.col("id").alias("wind_speed"),
        F.concat(F.lit("c"), F.col("id") % 2).alias("weather_condition"),
    )

    def plan(frame):
        return city_windows(frame, time="ts")

    updates = collect_updates(rows, "ts", plan, "update", batches=3, name="t-update")
    keys = ["window_start", "window_end", "city"]
    # Windows that span two slices are reported twice; the later report stands.
    assert updates.count() > updates.select(*keys).distinct().count()
    folded = latest_per_key(updates, keys)
    table = plan(rows)
    assert sorted(map(str, folded.select(*table.columns).collect())) == sorted(map(str, table.collect()))


def late_source(spark, tmp_path, batches):
    """One parquet file per batch, read one per trigger."""
    folder = tmp_path / "late"
    for i, seconds in enumerate(batches):
        rows = [(DAY + dt.timedelta(seconds=s), "A") for s in seconds]
        spark.createDataFrame(rows, "ts timestamp, city string").coalesce(1).write.mode("append").parquet(
            str(folder)
        )
        time.sleep(0.05)
    return (
        spark.readStream.schema("ts timestamp, city string").option("maxFilesPerTrigger", 1)
        .parquet(str(folder))
    )


def test_late_rows_are_dropped_once_the_watermark_has_passed(spark, tmp_path):
    # Batch 1 still runs with the watermark of batch 0; from batch 2 on old rows are late.
    late = LateRows.watch(spark)
    stream = late_source(spark, tmp_path, [[0, 600], [5], [6, 7], [605]])
    seen = []
    query = run_now(
        windowed_agg(stream, "ts", "1 minute", None, ["city"], COUNT, "1 minute"), "late", tmp_path,
        mode="update", sink=lambda batch, i: seen.extend(batch.collect()),
    )
    latest = {r.window_start: r.n for r in seen}
    assert latest == {DAY: 2, DAY + dt.timedelta(minutes=10): 2}
    # Rows of one window and key in one task count once.
    assert late.of(query) >= 1
    spark.streams.removeListener(late)


def test_append_mode_emits_closed_windows_once(spark, tmp_path):
    stream = late_source(spark, tmp_path, [[0, 30], [70], [400]])
    out = str(tmp_path / "closed")
    run_now(
        windowed_agg(stream, "ts", "1 minute", None, ["city"], COUNT, "1 minute"), "closed", tmp_path,
        sink="parquet", options={"path": out},
    )
    got = {r.window_start: r.n for r in spark.read.parquet(out).collect()}
    assert got == {DAY: 2, DAY + dt.timedelta(minutes=1): 1}


def test_console_with_an_interval_runs_for_a_while(spark, tmp_path, inbox):
    stream = json_dir_stream(spark, str(inbox), CITY_READING_FILE).withColumn(
        "processing_time", F.current_timestamp()
    )
    shown = start_query(
        city_windows(stream), "shown", "update", "console", str(tmp_path / "c1"),
        {"processingTime": "200 milliseconds"}, console_options(5),
    )
    raw = start_query(stream, "raw", "append", "console", str(tmp_path / "c2"), NOW, console_options(5))
    run_for([raw, shown], 8)
    assert not raw.isActive and not shown.isActive
    assert not [q for q in spark.streams.active if q.name in ("shown", "raw")]
    assert shown.recentProgress[0]["numInputRows"] == 1
    assert sum(p["numInputRows"] for p in raw.recentProgress) == 4


@pytest.mark.parametrize("first", ["failing", "idle"])
@pytest.mark.parametrize("seconds", [60, float("inf")])
def test_run_for_raises_the_error_of_any_query_and_stops_the_others(spark, tmp_path, inbox, first, seconds):
    def broken(batch, batch_id):
        raise RuntimeError("store is down")

    stream = json_dir_stream(spark, str(inbox), CITY_READING_FILE)
    idle = start_query(
        stream, "idle", sink=lambda b, i: None, checkpoint=str(tmp_path / "i"),
        trigger={"processingTime": "1 second"},
    )
    failing = start_query(stream, "failing", sink=broken, checkpoint=str(tmp_path / "f"))
    began = time.monotonic()
    with pytest.raises(StreamingQueryException, match="store is down"):
        run_for([failing, idle] if first == "failing" else [idle, failing], seconds)
    assert time.monotonic() - began < 40
    assert not idle.isActive
    stop_all([idle, failing])


def test_a_failed_batch_is_tried_again_and_stored_once(spark, tmp_path, inbox):
    out = str(tmp_path / "docs")
    store = batch_folder_writer(out, "json")
    attempts = []

    def flaky(batch, batch_id):
        store(batch, batch_id)
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost after writing")

    def start():
        run_now(
            json_dir_stream(spark, str(inbox), CITY_READING_FILE), "flaky", tmp_path,
            sink=document_writer(out, save=flaky, shape=lambda batch, i: batch),
        )

    with pytest.raises(StreamingQueryException):
        start()
    start()
    assert attempts == [0, 0, 1, 2, 3]
    assert read_batches(spark, out, "json", CITY_READING_FILE).count() == 4
    with pytest.raises(ValueError):
        read_batches(spark, out, "json")


def test_a_new_checkpoint_adds_to_what_is_stored(spark, tmp_path, inbox):
    out = str(tmp_path / "kept")
    for name in ("first", "second"):
        run_now(
            json_dir_stream(spark, str(inbox), CITY_READING_FILE, None), name, tmp_path,
            sink=document_writer(out, "parquet", shape=lambda batch, i: batch),
        )
    assert read_batches(spark, out).count() == 8
    assert read_batches(spark, out).select("query").distinct().count() == 2


def test_rows_without_a_time_are_replayed_as_well(spark, tmp_path):
    rows = spark.createDataFrame([(DAY, 1), (None, 2), (DAY, 3)], "ts timestamp, v int")
    out = str(tmp_path / "all")
    replay(rows, "ts", lambda r: r, "append", batch_folder_writer(out), batches=2)
    assert sorted(r.v for r in read_batches(spark, out).collect()) == [1, 2, 3]


def test_work_folders_of_a_replay_are_removed(spark, tmp_path):
    rows = spark.createDataFrame([(DAY, 1)], "ts timestamp, v int")
    replay(rows, "ts", lambda r: r, "append", batch_folder_writer(str(tmp_path / "o")), name="gone")
    left = os.listdir(os.path.join(shared_folder(spark), "stationflow"))
    assert not [name for name in left if name.startswith("gone")]


def test_documents(spark):
    rows = spark.createDataFrame(
        [(2024, 1, 2, 3, 1.5, "m", 80.0, 0.0, 4.0, 1000.0, "2024-01-02T03:00:00")],
        "year int, month int, day int, hour int, temp double, temp_source string, rhum double, "
        "prcp double, wspd double, pres double, kafka_timestamp string",
    )
    document = document_shape(rows, 7).first().asDict(recursive=True)
    assert document.pop("timestamp") is not None
    assert dt.datetime.fromisoformat(document.pop("processed_at"))
    assert document == {
        "year": 2024, "month": 1, "day": 2, "hour": 3, "temperature": 1.5, "humidity": 80.0,
        "pressure": 1000.0, "wind_speed": 4.0, "precipitation": 0.0, "batch_id": 7,
        "metadata": {"temp_source": "m", "kafka_timestamp": "2024-01-02T03:00:00"},
    }


def test_empty_batches_leave_no_documents(spark, tmp_path):
    saved = []
    write = document_writer("unused", save=lambda b, i: saved.append(i), shape=lambda b, i: b)
    write(spark.range(0), 1)
    write(spark.range(1), 2)
    assert saved == [2]


def test_fan_out_releases_the_batch(spark):
    calls = []
    batch = spark.range(3)

    def failing(b, i):
        raise RuntimeError("second sink")

    write = fan_out(lambda b, i: calls.append((b.count(), b.storageLevel.useMemory)), failing)
    with pytest.raises(RuntimeError):
        write(batch, 0)
    assert calls == [(3, True)]
    assert not batch.storageLevel.useMemory


def test_topic_settings():
    assert kafka_options("kafka:9092", "readings", fail_on_loss=False) == {
        "kafka.bootstrap.servers": "kafka:9092", "subscribe": "readings",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    assert kafka_options(
        "a,b", "t", "earliest", max_offsets_per_trigger=1000, min_partitions=64
    ) == {
        "kafka.bootstrap.servers": "a,b", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "1000", "minPartitions": "64",
    }
    assert topic_options("a", "t") == {
        "kafka.bootstrap.servers": "a", "topic": "t", "kafka.acks": "all", "kafka.retries": "3",
    }


def test_topics_need_the_connector(spark):
    # The connector package is not installed here: the adapters reach Spark and no further.
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:1", "t")
    with pytest.raises(Exception, match="(?i)kafka"):
        to_topic(spark.range(1), "localhost:1", "t")


def test_publishing_a_stream_needs_a_checkpoint(spark):
    with pytest.raises(ValueError):
        to_topic(spark.readStream.format("rate").load(), "localhost:1", "t")


def test_work_folders_are_below_the_shared_one(spark):
    shared = shared_folder(spark)
    assert shared == spark.conf.get("spark.checkpoint.dir")
    first, second = new_work_folder(spark, "x"), new_work_folder(spark, "x")
    assert first != second and first.startswith(shared)
    assert checkpoint_for(spark, "q").startswith(shared)


def test_without_watermark_a_running_count_is_kept(spark, tmp_path):
    stream = late_source(spark, tmp_path, [[0], [600], [1], [2]])
    seen = []
    run_now(
        group_metrics(stream, ["city"], COUNT), "kept", tmp_path,
        mode="update", sink=lambda batch, i: seen.extend(batch.collect()),
    )
    assert [r.n for r in seen] == [1, 2, 3, 4]
