from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stationflow.operators import Metric, windowed_agg

DAY = dt.datetime(2024, 5, 1)
SCHEMA = "ts timestamp, city string, v int, tag string"
METRICS = (
    Metric("count", None, "n"),
    Metric("count", "v", "n_v"),
    Metric("sum", "v", "total"),
    Metric("avg", "v", "mean", 2),
    Metric("min", "v", "low"),
    Metric("max", "v", "high"),
    Metric("set", "tag", "tags"),
)


def at(second: float) -> dt.datetime:
    return DAY + dt.timedelta(seconds=second)


def seconds(moment: dt.datetime) -> float:
    return (moment - DAY).total_seconds()


def windows_of(frame):
    return {(seconds(r.window_start), seconds(r.window_end)) for r in frame.collect()}


@pytest.mark.parametrize(
    "second, windows",
    [
        (4, {(-10, 5), (0, 15)}),
        (12, {(0, 15), (10, 25)}),
        (7, {(0, 15)}),
        (5, {(0, 15)}),
        (0, {(-10, 5), (0, 15)}),
        (4.999999, {(-10, 5), (0, 15)}),
    ],
)
@pytest.mark.parametrize("panes", [False, True])
def test_sliding_windows_of_one_row(spark, second, windows, panes):
    frame = spark.createDataFrame([(at(second), "A", 1, "x")], SCHEMA)
    got = windowed_agg(frame, "ts", "15 seconds", "10 seconds", metrics=METRICS[:1], panes=panes)
    assert windows_of(got) == windows


def brute_force(rows, size, slide):
    groups = defaultdict(list)
    for ts, city, v, tag in rows:
        u = seconds(ts)
        start = u // slide * slide
        while start + size > u:
            groups[start, city].append((v, tag))
            start -= slide
    result = {}
    for key, members in groups.items():
        vs = [v for v, _ in members if v is not None]
        result[key] = (
            len(members), len(vs), sum(vs) if vs else None,
            int(sum(vs) / len(vs) * 100 + 0.5) / 100 if vs else None,
            min(vs, default=None), max(vs, default=None),
            sorted({t for _, t in members if t is not None}),
        )
    return result


def sample(n=400, seed=3):
    rng = random.Random(seed)
    # One city holds a third of all rows and more.
    return [
        (
            at(round(rng.uniform(0, 300), 3)), rng.choice("AAABC"),
            rng.choice([None, *range(20)]), rng.choice([None, "x", "y", "z"]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("size, slide", [(30, 30), (15, 10), (60, 30), (300, 60)])
@pytest.mark.parametrize("panes", [False, True])
def test_windows_against_brute_force(spark, size, slide, panes):
    rows = sample()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = windowed_agg(
        frame, "ts", f"{size} seconds", f"{slide} seconds", ["city"], METRICS, panes=panes
    )
    result = {
        (seconds(r.window_start), r.city):
            (r.n, r.n_v, r.total, r["mean"], r.low, r.high, r.tags)
        for r in got.collect()
    }
    assert result == brute_force(rows, size, slide)


def test_times_without_zone_and_missing_times(spark):
    frame = spark.createDataFrame(sample(50) + [(None, "A", 1, "x")], SCHEMA)
    zoned = windowed_agg(frame, "ts", "1 minute", keys=["city"], metrics=METRICS)
    plain = windowed_agg(
        frame.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", "1 minute",
        keys=["city"], metrics=METRICS, watermark="1 minute",
    )
    as_plain = zoned.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    )
    assert sorted(map(str, plain.collect())) == sorted(map(str, as_plain.collect()))
    assert zoned.agg(F.sum("n")).first()[0] == 50


def test_names_and_rounding(spark):
    frame = spark.createDataFrame([(at(1), "A", 1, "x"), (at(2), "A", 2, "x"), (at(3), "A", 2, "x")], SCHEMA)
    got = windowed_agg(
        frame, "ts", "1 hour", metrics=[Metric("avg", "v", "m", 1), Metric("approx_distinct", "v", "d")],
        start="from", end="to",
    )
    assert got.columns == ["from", "to", "m", "d"]
    assert tuple(got.first())[2:] == (1.7, 2)


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_panes_are_aggregated_before_rows_are_copied(spark):
    frame = spark.createDataFrame(sample(50), SCHEMA)

    def plan(metrics, *durations, **how):
        return plan_of(windowed_agg(frame, "ts", *durations, keys=["city"], metrics=metrics, **how))

    sliding = plan(METRICS, "5 minutes", "1 minute")
    assert sliding.index("Expand") < sliding.rindex("Aggregate")
    direct = plan(METRICS, "5 minutes", "1 minute", panes=False)
    assert direct.index("Expand") > direct.rindex("Aggregate")
    # Nothing to gain: one aggregation.
    assert plan(METRICS[:6], "1 minute").count("Aggregate") == 1
    assert plan([Metric("approx_distinct", "v", "d")], "5 minutes", "1 minute").count("Aggregate") == 1


def test_estimates_are_the_same_by_panes(spark):
    frame = spark.createDataFrame(sample(2000), SCHEMA)
    metrics = [Metric("approx_distinct", "v", "d"), Metric("set", "tag", "t"), Metric("count", None, "n")]
    direct, by_panes = (
        windowed_agg(frame, "ts", "1 minute", "10 seconds", ["city"], metrics, panes=panes)
        for panes in (False, True)
    )
    assert sorted(map(str, direct.collect())) == sorted(map(str, by_panes.collect()))


@pytest.mark.parametrize("kind", ["decimal(18,2)", "int", "bigint", "double", "decimal(38,10)"])
def test_types_are_the_same_by_panes(spark, kind):
    frame = spark.createDataFrame(sample(50), SCHEMA).withColumn("v", F.col("v").cast(kind))
    direct, by_panes = (
        windowed_agg(frame, "ts", "1 minute", "10 seconds", ["city"], METRICS, panes=panes)
        for panes in (False, True)
    )
    assert [f.dataType for f in direct.schema] == [f.dataType for f in by_panes.schema]
    assert sorted(map(str, direct.collect())) == sorted(map(str, by_panes.collect()))


def test_means_of_large_integers(spark):
    big = 2**62
    frame = spark.createDataFrame([(at(i), "A", big, "x") for i in range(4)], SCHEMA.replace("v int", "v long"))
    got = windowed_agg(frame, "ts", "1 minute", metrics=[Metric("avg", "v", "m")], panes=True)
    assert got.first().m == float(big)


def test_panes_need_whole_durations(spark):
    with pytest.raises(ValueError):
        windowed_agg(spark.createDataFrame([], SCHEMA), "ts", "hourly", metrics=METRICS, panes=True)


def test_estimate_of_many_distinct_values(spark):
    frame = spark.range(50_000).select(
        F.lit(DAY).alias("ts"), (F.col("id") % 20_000).alias("user")
    )
    got = windowed_agg(frame, "ts", "1 day", metrics=[Metric("approx_distinct", "user", "users")])
    assert got.first().users == pytest.approx(20_000, rel=0.1)


@pytest.mark.parametrize(
    "size, slide",
    [
        ("1.5 seconds", "0.5 seconds"), ("90 seconds", "1 minute 30 seconds"), ("1 minute 30 seconds", "45 seconds"),
        ("interval 2 minutes", "500 milliseconds"), ("1 HOUR", "20 Minutes"), ("250 milliseconds", None),
    ],
)
def test_panes_equal_direct_windows_in_any_spelling(spark, size, slide):
    frame = spark.createDataFrame(sample(60), SCHEMA)
    got = [
        sorted(map(str, windowed_agg(frame, "ts", size, slide, ["city"], METRICS, panes=panes).collect()))
        for panes in (True, False)
    ]
    assert got[0] == got[1] and got[0]


@pytest.mark.parametrize("text", ["soon", "5", "1 month", "5 parsecs", "2 seconds ago", "-1 second", "0 seconds"])
def test_unknown_durations_are_refused(spark, text):
    frame = spark.createDataFrame(sample(3), SCHEMA)
    with pytest.raises(ValueError, match="not a duration"):
        windowed_agg(frame, "ts", text, "1 second", panes=True)


def test_exact_and_estimated_distinct_values(spark):
    frame = spark.createDataFrame(sample(200), SCHEMA)
    metrics = (Metric("distinct", "tag", "exact"), Metric("approx_distinct", "tag", "guess", error=0.01))
    for panes in (True, False):
        rows = windowed_agg(frame, "ts", "1 minute", metrics=metrics, panes=panes).collect()
        assert rows and all(r.exact == r.guess for r in rows)
