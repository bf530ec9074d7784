from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators import (
    DailyThresholds,
    KeyConflict,
    Metric,
    NullValue,
    count_rows,
    daily_phenomena,
    dedupe_keep_first,
    derive_city_day,
    drop_incomplete,
    enrich,
    explode_records,
    extremes,
    first_distinct,
    group_metrics,
    letter_word_stats,
    load_table,
    non_blank,
    normalize,
    overall,
    parse_json,
    per_group,
    positional_fields,
    preview,
    render_daily_text,
    repair_columns,
    to_json_value,
    to_metric_rows,
    unseen_rows,
    value_counts,
)
from stationflow.schemas import HOURLY_METRICS, HOURLY_POSITIONS, HOURLY_STATION
from stationflow.session import shared_folder


def rows_of(frame, *order):
    return [tuple(r) for r in (frame.orderBy(*order) if order else frame).collect()]


# --- lines -------------------------------------------------------------------


def line(year=2024, month=1, day=2, hour=3, temp="1.5", rhum="80", prcp="0", wspd="4", pres="1000"):
    fields = [""] * 20
    for name, value in dict(
        year=year, month=month, day=day, hour=hour, temp=temp, rhum=rhum, prcp=prcp, wspd=wspd, pres=pres
    ).items():
        fields[HOURLY_POSITIONS[name]] = str(value)
    return ";".join(fields)


def test_positional_lines_drop_whole_bad_rows(spark):
    lines = [
        line(), "  " + line(hour=4) + "  ", line().rsplit(";", 1)[0], "year;" + line(), "", "   ",
        line(temp=""), line(rhum="n/a"), line(pres="nan"), line(wspd=" 7.5 ") + ";more",
    ]
    frame = spark.createDataFrame([(v,) for v in lines], "value string")
    got = positional_fields(frame, HOURLY_POSITIONS, HOURLY_METRICS)
    assert got.columns == list(HOURLY_POSITIONS)[:4] + list(HOURLY_METRICS)
    assert rows_of(got, "hour", "wspd") == [
        ("2024", "1", "2", "3", 1.5, 80.0, 0.0, 4.0, 1000.0),
        ("2024", "1", "2", "3", 1.5, 80.0, 0.0, 7.5, 1000.0),
        ("2024", "1", "2", "4", 1.5, 80.0, 0.0, 4.0, 1000.0),
    ]


def test_positional_lines_with_other_separators_and_last_field(spark):
    frame = spark.createDataFrame([("a|1|z  ", 5), ("b|x|z", 6)], "value string, line_no int")
    got = positional_fields(
        frame, {"name": 0, "n": 1, "tail": 2}, ["n"], min_fields=3, sep="|", header="#", keep=["line_no"]
    )
    assert rows_of(got) == [(5, "a", "z", 1.0)]


def test_lines_of_one_field(spark):
    frame = spark.createDataFrame([("a",), ("  ",), ("",), ("1;2",)], "value string")
    got = positional_fields(frame, {"name": 0}, [], min_fields=1)
    assert rows_of(got, "name") == [("1",), ("a",)]


def test_non_blank(spark):
    frame = spark.createDataFrame([(" a ",), ("\t",), ("",), (None,)], "value string")
    assert rows_of(non_blank(frame)) == [("a",)]


# --- messages ----------------------------------------------------------------


def test_payloads(spark):
    values = [
        json.dumps({"year": 2024, "temp": 1.5, "rhum": 75.0, "unknown": 1}),
        "not json", "", "  ", None, json.dumps({"rhum": 75}), "[1]",
    ]
    frame = spark.createDataFrame(
        [(i, None if v is None else bytearray(v.encode())) for i, v in enumerate(values)],
        "offset int, value binary",
    )
    fields = {"year": "year", "temp": "t", "rhum": "rhum"}

    def parsed(**how):
        return rows_of(parse_json(frame, HOURLY_STATION, ["offset"], fields, **how), "offset")

    nothing = (None, None, None)
    assert parsed() == [
        (0, 2024, 1.5, 75.0), *((i, *nothing) for i in (1, 2, 3, 4)), (5, None, None, 75.0), (6, *nothing),
    ]
    # Unreadable text is a row of nulls; only missing text is no payload.
    assert [r[0] for r in parsed(drop_null=True)] == [0, 1, 5, 6]
    assert [r[0] for r in parsed(require=["rhum"])] == [0, 5]
    assert [r[0] for r in parsed(require=["year", "rhum"])] == [0]


def test_kept_columns_may_share_a_payload_name(spark):
    frame = spark.createDataFrame([('{"city": "A"}', "k")], "value string, city string")
    schema = T.StructType.fromDDL("city string")
    got = parse_json(frame, schema, [F.col("city").alias("envelope_city")])
    assert rows_of(got) == [("k", "A")]


def test_json_messages_round_trip(spark):
    frame = spark.createDataFrame([(1, "A", None), (2, "B", 2.5)], "id int, city string, t double")
    sent = to_json_value(frame, key="id")
    assert sent.columns == ["key", "value"]
    back = parse_json(sent, T.StructType.fromDDL("id int, city string, t double, kafka_timestamp string"))
    assert [r[:3] for r in rows_of(back, "id")] == [(1, "A", None), (2, "B", 2.5)]
    assert back.where("kafka_timestamp RLIKE '^....-..-..T'").count() == 2
    assert to_json_value(frame, sent_at=None).first().value == '{"id":1,"city":"A"}'


# --- records -----------------------------------------------------------------


def test_normalize_and_repair(spark):
    frame = spark.createDataFrame(
        [(" 1 ", "2.5", "x"), ("nan", "05.03.2025 0:00", " ")], "n string, t string, other string"
    )
    schema = T.StructType.fromDDL("n int, t double")
    assert rows_of(normalize(frame, schema)) == [(1, 2.5, "x"), (None, None, " ")]
    assert rows_of(repair_columns(frame, ["t"]).select("t")) == [(2.5,), (5.0,)]


def test_explode_records(spark):
    frame = spark.createDataFrame(
        [(1, [("a", 1), ("b", 2)]), (2, []), (3, None)],
        "doc int, items array<struct<name: string, n: int>>",
    )
    assert rows_of(explode_records(frame, "items", ["doc"])) == [(1, 0, "a", 1), (1, 1, "b", 2)]
    texts = spark.createDataFrame([(["x", "y"],)], "value array<string>")
    assert rows_of(explode_records(texts, "value")) == [(0, "x"), (1, "y")]


# --- daily -------------------------------------------------------------------

# day, temperatures, humidity, precipitation, wind, pressures -> tags
DAYS = [
    ("2024-1-10", -6.4, -0.6, 75.0, 0.0, 13.0, 1000.0, 1001.7, []),
    ("2024-1-17", -6.3, 0.5, 97.0, 2.0, 11.0, 1000.0, 1019.5,
     ["very_high_humidity", "rapid_pressure_change"]),
    ("2024-1-19", -8.7, -0.3, 95.0, 0.0, 13.0, 1000.0, 1015.3, ["rapid_pressure_change"]),
    ("2024-1-1", 0.0, 15.0, 95.0, 5.0, 50.0, 1000.0, 1015.0, []),
    ("2024-4-11", 0.7, 18.0, 95.0, 0.0, 15.0, 1000.0, 1002.3, ["large_daily_temp_range"]),
    ("2024-4-16", 4.0, 11.0, 85.0, 1.0, 52.6, 1000.0, 1005.7, ["strong_wind"]),
    ("2024-5-21", 13.0, 20.0, 96.0, 12.0, 15.0, 1000.0, 1003.3,
     ["very_high_humidity", "heavy_precipitation"]),
]


@pytest.fixture(scope="module")
def readings(spark):
    rows = []
    for day, low, high, rhum, prcp, wspd, p0, p1, _ in DAYS:
        rows.append((day, low, rhum, 0.0, wspd, p0))
        rows.append((day, high, 10.0, prcp, 0.0, p1))
        rows.append((day, low, 10.0, 0.0, 0.0, p0))
    return spark.createDataFrame(
        rows, "date_key string, temp double, rhum double, prcp double, wspd double, pres double"
    )


def test_phenomena_are_strictly_above_their_thresholds(readings):
    got = {r.date_key: r for r in daily_phenomena(readings).collect()}
    assert {d: r.phenomena for d, r in got.items()} == {d[0]: d[-1] for d in DAYS}
    assert got["2024-1-10"].status == "WEATHER_STATS"
    assert got["2024-4-16"].status == "WEATHER_PHENOMENA"
    assert (got["2024-1-10"].min_temp, got["2024-1-10"].max_temp) == (-6.4, -0.6)


def test_all_tags_in_order(spark):
    frame = spark.createDataFrame(
        [("d", 0.0, 99.0, 9.0, 60.0, 0.0), ("d", 30.0, 0.0, 0.0, 0.0, 30.0)],
        "day string, t double, rhum double, prcp double, wspd double, pres double",
    )
    got = daily_phenomena(frame, ["day"], {"temp": "t"}).first().phenomena
    assert got == [
        "large_daily_temp_range", "very_high_humidity", "heavy_precipitation", "strong_wind",
        "rapid_pressure_change",
    ]
    none = DailyThresholds(100, 100, 100, 100, 100)
    assert daily_phenomena(frame, ["day"], {"temp": "t"}, none).first().phenomena == []


def test_daily_text(readings):
    lines = [r.value for r in render_daily_text(daily_phenomena(readings)).collect()]
    assert lines[:6] == [
        "WEATHER_STATS: 2024-1-10\t",
        "  Temperature: -6.4C - -0.6C\t",
        "  Humidity: up to 75.0%\t",
        "  Precipitation: up to 0.0mm\t",
        "  Wind: up to 13.0 km/h\t",
        "  Pressure range: 1.7 hPa\t",
    ]
    heads = lines[::6]
    # Byte order of "<date>;": 1-19 before 1-1.
    assert [h.split(": ")[1].split("\t")[0].split(" - ")[0] for h in heads] == [
        "2024-1-10", "2024-1-17", "2024-1-19", "2024-1-1", "2024-4-11", "2024-4-16", "2024-5-21",
    ]
    assert heads[1] == (
        "WEATHER_PHENOMENA: 2024-1-17 - Detected: very_high_humidity, rapid_pressure_change\t"
    )
    plain = render_daily_text(daily_phenomena(readings), line_end="", ordered=False)
    assert plain.where("value LIKE '%\t'").count() == 0


# --- text --------------------------------------------------------------------


def test_letter_word_stats(spark):
    texts = [("ru", "кот и дом"), ("ru", ""), ("en", "cat, 1st"), ("--", "123"), ("ru", None)]
    frame = spark.createDataFrame(texts, "lang string, value string")
    got = {r.lang: r.asDict() for r in letter_word_stats(frame, keys=["lang"]).collect()}
    assert got["ru"] == {
        "lang": "ru", "average_word_length": 7 / 3, "vowel": 3, "consonant": 4, "total_letters": 7,
        "word_count": 3, "total_chars": 7,
    }
    assert (got["en"]["word_count"], got["en"]["total_chars"], got["en"]["consonant"]) == (1, 3, 4)
    assert got["--"]["average_word_length"] is None and got["--"]["vowel"] == 0

    total = to_metric_rows(letter_word_stats(frame))
    assert dict(rows_of(total)) == {
        "average_word_length": "2.50", "vowel": "4", "consonant": "8", "total_letters": "12",
        "word_count": "4",
    }
    no_words = to_metric_rows(letter_word_stats(frame.where("lang = '--'")))
    assert "average_word_length" not in dict(rows_of(no_words))
    assert rows_of(letter_word_stats(frame.limit(0)))[0] == (None, 0, 0, 0, 0, 0)


# --- etl ---------------------------------------------------------------------

CITY_DAYS = [
    (1, "A", "2024-01-15", 6.0, 0.0, "sun"),
    (2, "A", "2024-01-15", 1.0, 0.5, "fog"),
    (3, "B", "2024-01-15", -3.0, 2.0, None),
    (4, "B", "2024-01-15", -3.0, 2.0, "snow"),
    (5, "B", "2024-02-01", -11.0, 3.0, "snow"),
]
CITY_SCHEMA = "n int, city string, date string, temperature double, precipitation double, condition string"


@pytest.fixture()
def city_days(spark):
    return spark.createDataFrame(CITY_DAYS, CITY_SCHEMA)


def transformed(frame):
    return drop_incomplete(dedupe_keep_first(derive_city_day(frame), "record_id", ["n"]))


def test_first_row_of_a_key_counts_even_when_incomplete(city_days):
    got = transformed(city_days)
    assert rows_of(
        got.select("record_id", "n", "temp_category", "precip_category", "year", "month", "day"), "n"
    ) == [
        ("A_2024-01-15", 1, "тепло", "без осадков", 2024, 1, 15),
        ("B_2024-02-01", 5, "очень холодно", "сильные осадки", 2024, 2, 1),
    ]
    assert got.select("created_at").distinct().count() == 1


def test_dedupe_limits_each_task_to_one_row_per_key(spark):
    hot = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    first = dedupe_keep_first(hot, "k", [F.desc("id")])
    assert rows_of(first, "k") == [(0, 999), (1, 997), (2, 998)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_load_skips_known_keys_and_reports(spark, tmp_path, city_days):
    path = str(tmp_path / "table")
    rows = transformed(city_days)
    assert load_table(rows, path) == load_table(rows.limit(0), str(tmp_path / "other")).__class__(2, 2)
    assert load_table(rows, path).loaded == 0
    more = transformed(
        spark.createDataFrame([*CITY_DAYS[:1], (9, "C", "2024-03-01", 0.0, 0.1, "fog")], CITY_SCHEMA)
    )
    result = load_table(more, path)
    assert (result.offered, result.loaded) == (2, 1)
    table = spark.read.parquet(path)
    assert rows_of(table.select("record_id"), "record_id") == [
        ("A_2024-01-15",), ("B_2024-02-01",), ("C_2024-03-01",),
    ]
    assert {"year", "month"} <= set(table.columns)


def test_load_error_mode_loads_nothing(spark, tmp_path, city_days):
    path = str(tmp_path / "table")
    rows = transformed(city_days)
    load_table(rows, path, on_conflict="error")
    with pytest.raises(KeyConflict):
        load_table(rows, path, on_conflict="error")
    doubled = rows.union(rows).withColumn("record_id", F.concat("record_id", F.lit("x")))
    with pytest.raises(KeyConflict):
        load_table(doubled, path, on_conflict="error")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        load_table(rows, path, on_conflict="replace")


def test_load_keeps_its_key_unique_and_set(spark, tmp_path, city_days):
    path = str(tmp_path / "unique")
    rows = transformed(city_days)
    for mode in ("skip", "error"):
        with pytest.raises(KeyConflict):
            load_table(rows.union(rows), path, on_conflict=mode)
        for column in ("record_id", "year"):
            bad = rows.withColumn(column, F.lit(None).cast(rows.schema[column].dataType))
            with pytest.raises(NullValue, match=column):
                load_table(bad, path, on_conflict=mode)
    with pytest.raises(NullValue, match="city"):
        load_table(rows.withColumn("city", F.lit(None).cast("string")), path, not_null=("city", "date"))
    assert not os.path.exists(path)
    assert load_table(rows, path).loaded == 2
    left = os.listdir(os.path.join(shared_folder(spark), "stationflow"))
    assert not [name for name in left if name.startswith("increment")]


def test_load_without_partitions(spark, tmp_path):
    path = str(tmp_path / "flat")
    rows = spark.range(5).withColumnRenamed("id", "record_id")
    assert load_table(rows, path, partition_by=()).loaded == 5
    assert load_table(spark.range(8).withColumnRenamed("id", "record_id"), path, partition_by=()).loaded == 3


def test_unseen_rows(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    old = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert rows_of(unseen_rows(new, old, "k")) == [(1, "a")]


def test_enrich_keeps_unmatched_rows(spark):
    rows = spark.createDataFrame([(1, 4), (2, 4), (3, 9)], "product_id long, category_id long")
    lookup = spark.createDataFrame([(4, "Tablets"), (5, "Cameras")], "category_id long, category_name string")
    assert rows_of(enrich(rows, lookup, "category_id").select("product_id", "category_name"), "product_id") == [
        (1, "Tablets"), (2, "Tablets"), (3, None),
    ]
    assert enrich(rows, lookup, ["category_id"], "inner").count() == 2


# --- reports -----------------------------------------------------------------


def test_reports(spark):
    frame = spark.createDataFrame(
        [
            (0, "A", "d1", 5.0, 0.0), (1, "B", "d1", 9.0, 2.5), (2, "A", "d2", 9.0, 2.5),
            (3, "B", "d2", -1.0, None), (4, "C", "d2", None, float("nan")),
        ],
        "n int, city string, date string, t double, p double",
    )
    assert rows_of(overall(frame, {"city": "cities", "date": "dates"}, "t")) == [(5, 3, 2, -1.0, 9.0, 5.5)]
    top = extremes(
        frame, "city", {"warm": ("max", "t"), "cold": ("min", "t"), "wet": ("max", "p")}, ["n"]
    ).first()
    # The first of two equal values wins; null and NaN never do.
    assert tuple(top) == ("B", 9.0, "B", -1.0, "B", 2.5)
    metrics = [Metric("count", None, "n"), Metric("avg", "t", "avg_t"), Metric("sum", "t", "s")]
    assert rows_of(per_group(frame, "city", metrics, "avg_t")) == [
        ("A", 2, 7.0, 14.0), ("B", 2, 4.0, 8.0), ("C", 1, None, None),
    ]
    assert rows_of(value_counts(frame, "date")) == [("d2", 3), ("d1", 2)]
    assert rows_of(first_distinct(frame, "date", "n", 1)) == [("d1",)]
    assert rows_of(preview(frame.select("n"), [F.desc("n")], 2)) == [(4,), (3,)]
    assert count_rows(frame).first().row_count == 5


def test_extremes_of_ties_and_of_nothing(spark):
    frame = spark.range(3000).select(
        F.concat(F.lit("c"), (2999 - F.col("id")).cast("string")).alias("city"), "id",
        F.when(F.col("id") % 3 == 1, 7).otherwise(0).alias("v"),
        F.lit(None).cast("double").alias("none"), F.lit(-0.0).alias("zero"),
    )
    picks = {"a": ("max", "v"), "b": ("min", "v"), "c": ("max", "none"), "d": ("min", "zero")}
    # A third of all rows shares the highest value; the first of them is wanted.
    assert tuple(extremes(frame, "city", picks, ["id"]).first()) == (
        "c2998", 7, "c2999", 0, None, None, "c2999", 0.0,
    )
    only_null = extremes(frame, "city", {"c": ("max", "none")}, ["id"])
    assert tuple(only_null.first()) == (None, None)


def test_group_metrics(spark):
    frame = spark.createDataFrame([("A", 1, "x"), ("A", 2, "w"), ("A", 2, None)], "c string, v int, t string")
    metrics = [Metric("set", "t", "ts"), Metric("count", "t", "n"), Metric("max", "v", "hi")]
    assert rows_of(group_metrics(frame, ["c"], metrics)) == [("A", ["w", "x"], 2, 2)]
    assert rows_of(group_metrics(frame, [], metrics[:1])) == [(["w", "x"],)]


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_load_probes_only_the_partitions_it_touches(spark, tmp_path):
    from stationflow.operators.etl import _bounded, seen_keys

    table, increment = str(tmp_path / "table"), str(tmp_path / "increment")
    rows = spark.range(1200).select(
        (F.col("id") % 3 + 2020).alias("year"), (F.col("id") % 12 + 1).alias("month"),
        F.col("id").alias("record_id"),
    )
    rows.repartition("year").write.partitionBy("year", "month").parquet(table)
    rows.where("year = 2021 AND month IN (2, 5)").limit(20).write.parquet(increment)
    staged = spark.read.parquet(increment)
    existing = spark.read.schema(staged.schema).parquet(table)
    known = seen_keys(_bounded(staged, ("year", "month")), existing, "record_id", ("year", "month"))
    plan = final_plan(known)
    assert known.count() == 20
    assert "dynamicpruning" in plan and "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # The table is scanned where it is; only the increment moves.
    assert "hashpartitioning" not in plan


def test_a_crowded_key_is_split_in_a_join_by_shuffle(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"), F.rand(1).alias("x")
        )
        lookup = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
        joined = enrich(rows, lookup, "k")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 200_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
