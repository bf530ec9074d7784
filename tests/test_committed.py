"""Committed tables: appended, merged, running, split by lateness and keyed; and keep-first on streams."""

from __future__ import annotations

import math
import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from stationflow.operators import KeyConflict, Metric, NullValue, group_metrics, keep_first_seen
from stationflow.plans.testbed.replay import replay
from stationflow.streaming import CommittedTable, KeyedTable, LateSplit, ManifestTable, RunningTable
from stationflow.streaming.commits import KEPT, Commit, Folders


def numbers(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("n"), (F.col("id") % 7).alias("k"))


def values(frame, column="n"):
    return sorted(r[column] for r in frame.select(column).collect())


def test_a_name_is_given_once(spark, tmp_path):
    files = Folders(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as threads:
        won = list(threads.map(lambda i: files.create("x/one.json", f"{i}"), range(16)))
    assert sum(won) == 1
    assert files.names("x") == ["one.json"] and files.text("x/one.json") == str(won.index(True))
    assert files.names("nowhere") == []


def test_commits_of_many_writers_are_all_there(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))

    def add(i):
        return table.commit(lambda last: Commit(0, last.folders | {f"f{i}": {}}, last.batches, last.dropped, last.notes))

    with ThreadPoolExecutor(4) as threads:
        assert all(threads.map(add, range(30)))
    last = table.latest()
    assert last.number == 30 and set(last.folders) == {f"f{i}" for i in range(30)}
    assert len(table.files.names("_commits")) <= KEPT + 1
    assert table.commit(lambda last: None) is False and table.latest().number == 30


def test_manifest_merges_and_stays_small(spark, tmp_path):
    table, batches = ManifestTable(spark, str(tmp_path / "t"), merge=3), 40
    for i in range(batches):
        assert table.append(numbers(spark, 10 * i, 10 * i + 10).coalesce(1), "q", i)
        # At most two folders of each level are left.
        assert len(table.latest().folders) <= 2 * (1 + math.ceil(math.log(i + 2, 3)))
    assert values(table.read()) == list(range(10 * batches))
    assert len(table.files.names("data")) <= len(table.latest().folders) + len(table.latest().dropped)
    assert len(table.latest().dropped) <= 3 * KEPT
    assert not table.append(numbers(spark, 0, 10), "q", batches - 1)  # tried again
    assert table.append(numbers(spark, 0, 10), "another", 0)  # a query of its own
    assert table.read().count() == 10 * batches + 10
    with pytest.raises(ValueError, match="schema"):
        table.append(spark.range(3), "q", batches)


def test_a_killed_batch_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    table = ManifestTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing was committed"):
        table.read()
    table.append(numbers(spark, 0, 5), "q", 0)

    def killed(self, change):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(ManifestTable, "commit", killed)
        with pytest.raises(RuntimeError):
            table.append(numbers(spark, 5, 9), "q", 1)
    assert values(table.read()) == list(range(5))
    assert table.append(numbers(spark, 5, 9), "q", 1)
    assert values(table.read()) == list(range(9))
    assert table.sweep(3600) == [] and len(table.sweep(0)) == 1
    assert values(table.read()) == list(range(9))


METRICS = (
    Metric("count", None, "n"), Metric("count", "v", "seen"), Metric("sum", "v", "total"), Metric("avg", "v", "mean", 3), Metric("min", "v", "low"),
    Metric("max", "v", "high"), Metric("set", "tag", "tags"), Metric("sketch_distinct", "v", "about"),
)


def test_running_table_equals_one_aggregate(spark, tmp_path):
    rng = random.Random(2)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice([None, *range(-20, 20)]), rng.choice(["x", "y", None]), rng.randrange(9)) for _ in range(600)
    ]
    frame = spark.createDataFrame(rows, "city string, v int, tag string, part int").withColumn("v", F.col("v").cast("decimal(10,2)"))
    table = RunningTable(spark, str(tmp_path / "t"), ["city"], METRICS, buckets=3)
    for part in range(9):
        assert table.add(frame.where(f"part = {part}"), "first" if part < 5 else "second", part % 5)
        assert not table.add(frame.where(f"part = {part}"), "first" if part < 5 else "second", part % 5)
    want = group_metrics(frame, ["city"], METRICS)
    got = table.read()
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError, match="sketch_distinct"):
        RunningTable(spark, str(tmp_path / "u"), ["city"], [Metric("distinct", "v", "d")]).add(frame)


def test_running_table_rewrites_touched_buckets_only(spark, tmp_path):
    table = RunningTable(spark, str(tmp_path / "t"), ["k"], [Metric("sum", "n", "s")], buckets=16)
    table.add(numbers(spark, 0, 70))
    before = table.latest().notes["buckets"]
    table.add(numbers(spark, 0, 70).where("k = 3"))
    after = table.latest().notes["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()
    assert {r.k: r.s for r in table.read().collect()} == {k: sum(n for n in range(70) if n % 7 == k) * (2 if k == 3 else 1) for k in range(7)}


def test_two_writers_of_a_running_table_lose_nothing(spark, tmp_path):
    table = RunningTable(spark, str(tmp_path / "t"), ["k"], [Metric("sum", "n", "s")], buckets=2)
    with ThreadPoolExecutor(2) as threads:
        list(threads.map(lambda i: RunningTable(spark, str(tmp_path / "t"), ["k"], [Metric("sum", "n", "s")], buckets=2).add(numbers(spark, 0, 14), f"q{i}", 0), range(2)))
    assert {r.k: r.s for r in table.read().collect()} == {k: 2 * (2 * k + 7) for k in range(7)}


def test_on_time_and_late_are_all_rows(spark, tmp_path):
    kept, late = ManifestTable(spark, str(tmp_path / "kept")), ManifestTable(spark, str(tmp_path / "late"))
    split = LateSplit(spark, str(tmp_path / "split"), "ts", "1 hour", kept.writer(), late.writer())
    batches = [[10, 20, None], [70, 15, 5], [200, 9, 11], [150, 139, 300, None]]  # minutes; watermarks -, -40, 10, 140
    frames = [
        spark.createDataFrame([(i, m) for m in batch], "batch int, m int").withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
        for i, batch in enumerate(batches)
    ]
    for i, frame in enumerate(frames):
        split.write(frame, i)
        split.write(frame, i)  # tried again: nothing twice, and the same cut
    assert sorted((r.batch, r.m) for r in late.read().collect()) == [(2, 9), (3, 139)]
    assert kept.read().count() + late.read().count() == sum(map(len, batches))
    assert split.watermark() == (300 - 60) * 60_000_000


def test_late_rows_are_kept_by_a_stream_and_by_a_second_query(spark, tmp_path):
    kept, late = ManifestTable(spark, str(tmp_path / "kept")), ManifestTable(spark, str(tmp_path / "late"))
    split = LateSplit(spark, str(tmp_path / "split"), "ts", "10 seconds", kept.writer(), late.writer())
    rows = spark.range(400).select(F.col("id").alias("n"), F.timestamp_seconds("id").alias("arrived"), F.timestamp_seconds(F.when(F.col("id") % 10 == 3, 0).otherwise(F.col("id"))).alias("ts"))
    for half in (rows.where("n < 200"), rows.where("n >= 200")):
        replay(half, "arrived", lambda stream: stream, "append", split.write, batches=4)
    stored, aside = values(kept.read()), values(late.read())
    assert sorted(stored + aside) == list(range(400))
    assert set(n for n in range(200, 400) if n % 10 == 3) <= set(aside) <= set(range(3, 400, 10))


def test_keys_stay_unique_under_loads_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "t")
    ranges = [(0, 60), (30, 90), (50, 120), (0, 130)]
    with ThreadPoolExecutor(4) as threads:
        done = list(threads.map(lambda r: KeyedTable(spark, path, "n", merge=3).load(numbers(spark, *r)), ranges))
    table = KeyedTable(spark, path, "n", merge=3)
    assert values(table.read()) == list(range(130))
    assert sum(r.loaded for r in done) == 130 and [r.offered for r in done] == [60, 60, 70, 130]
    assert table.load(numbers(spark, 0, 130)).loaded == 0
    assert table.load(numbers(spark, 100, 140), "skip").loaded == 10
    before = table.latest().number
    for bad, error in (
        (numbers(spark, 139, 150), KeyConflict), (numbers(spark, 200, 205).union(numbers(spark, 200, 201)), KeyConflict),
        (numbers(spark, 200, 203).withColumn("k", F.lit(None).cast("long")), NullValue),
    ):
        with pytest.raises(error):
            table.load(bad, "error", not_null=["k"])
    assert table.latest().number == before and values(table.read()) == list(range(140))
    known = {name.split("/")[0] for name in table.latest().folders} | set(table.latest().dropped)
    assert set(table.files.names("data")) <= known  # refused loads left nothing


def test_folders_that_cannot_have_a_key_are_not_read(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "n", merge=10)
    for low in range(0, 4000, 1000):
        table.load(numbers(spark, low, low + 1000))
    last = table.latest()
    asked = table.candidates(numbers(spark, 1500, 1600), list(last.folders), last.folders)
    by_folder = Counter(r.folder for r in asked.collect())
    of = {name: table.read_folders([f"{name}/rows"], numbers(spark, 0, 1).schema).agg(F.min("n")).first()[0] for name in last.folders}
    assert by_folder[next(n for n, low in of.items() if low == 1000)] == 100
    assert sum(by_folder.values()) <= 100 + 5  # one key in 400 may be looked for in vain
    # What is read of the table: none of the folders without a candidate.
    known = table.known(numbers(spark, 1500, 1600), list(last.folders), numbers(spark, 0, 1).schema, last.folders)
    names = {f.split("/data/")[1].split("/")[0] for f in known.inputFiles() if f.endswith(".parquet") and "/rows/" in f}
    assert names == set(by_folder) and known.count() == 100
    none = table.known(numbers(spark, 9000, 9001), list(last.folders), numbers(spark, 0, 1).schema, last.folders)
    assert none is None or none.isEmpty()


def test_redelivered_messages_are_stored_once(spark, tmp_path):
    rows = spark.range(300).select(
        F.col("id").alias("n"), F.timestamp_seconds(F.col("id") + 10**9).alias("ts"), F.explode(F.array(F.lit(0), F.lit(40))).alias("late_by")
    ).withColumn("arrived", F.timestamp_seconds(F.col("n") + F.col("late_by") + 10**9))
    out = str(tmp_path / "out")
    replay(rows, "arrived", lambda s: keep_first_seen(s, "n", "ts", "2 minutes"), "append", "parquet", batches=5, options={"path": out})
    assert values(spark.read.parquet(out)) == list(range(300))
    first = keep_first_seen(rows.drop("ts"), ["n"], "arrived", "2 minutes")
    assert first.count() == 300 and first.agg(F.max("late_by")).first()[0] == 0
