"""The jobs end to end, on files written here."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators import KeyConflict, enrich
from stationflow.plans import city, city_table, daily, repair, station, text
from stationflow.schemas import CATEGORY, CITY_READING_FILE, PRODUCT
from stationflow.sources import delimited, json_array, text_lines


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


# city, date, temperature, humidity, pressure, wind, condition, precipitation
RECORDS = [
    ("Тверь", "2024-03-01", -5.0, 84, 1010, 3.0, "снег", 2.5),
    ("Тула", "2024-03-01", 8.0, 60, 1015, 2.0, "ясно", 0.0),
    ("Пермь", "2024-03-01", -12.0, 77, 1008, 1.0, "ясно", 0.0),
    ("Тверь", "2024-03-02", -8.0, 84, 1011, 4.0, "снег", 0.3),
    ("Тула", "2024-03-02", 9.5, 67, 1014, 2.5, "дождь", 3.5),
    ("Пермь", "2024-03-02", -14.5, 77, 1009, 1.5, "ясно", 0.0),
    ("Тверь", "2024-03-02", 30.0, 1, 1, 1.0, "repeated", 9.0),
    ("Тула", "2024-03-03", 1.0, None, 1014, 2.5, "incomplete", 0.0),
]
FIELDS = ("city", "date", "temperature", "humidity", "pressure", "wind_speed", "condition", "precipitation")


@pytest.fixture()
def document(tmp_path):
    body = {
        "weather_data": [dict(zip(FIELDS, r)) for r in RECORDS],
        "metadata": {"source": "test", "version": "1.0", "cities_count": 3, "days_count": 3},
    }
    return write(tmp_path / "days.json", json.dumps(body, ensure_ascii=False, indent=2))


def test_nested_document_to_table_to_report(spark, tmp_path, document):
    table = str(tmp_path / "weather_records")
    result = city_table.run(spark, document, table)
    assert (result.offered, result.loaded) == (6, 6)
    assert city_table.run(spark, document, table).loaded == 0
    with pytest.raises(KeyConflict):
        city_table.run(spark, document, table, on_conflict="error")

    rows = spark.read.parquet(table)
    assert set(rows.columns) == set(city_table.TABLE_COLUMNS)
    reports = city_table.report(rows)
    assert tuple(reports["overall"].first()) == (6, 3, 2, -14.5, 9.5, pytest.approx(-22 / 6))
    assert [tuple(r) for r in reports["per_city"].collect()] == [
        ("Тула", 2, 8.75, 63.5, 3.5), ("Тверь", 2, -6.5, 84.0, 2.8), ("Пермь", 2, -13.25, 77.0, 0.0),
    ]
    kept = city_table.transform(city_table.extract(spark, document), keep=("source_file", "ordinal"))
    more = city_table.analysis(kept, ("source_file", "ordinal"))
    assert tuple(more["extremes"].first()) == ("Тула", 9.5, "Пермь", -14.5, "Тула", 3.5)
    assert [tuple(r) for r in more["temperature_bands"].collect()] == [
        ("очень холодно", 2), ("тепло", 2), ("холодно", 2),
    ]
    assert dict(map(tuple, more["precipitation_bands"].collect())) == {
        "без осадков": 3, "слабые осадки": 1, "умеренные осадки": 1, "сильные осадки": 1,
    }


def test_json_lines_documents_split(spark, tmp_path):
    lines = "\n".join(json.dumps({"weather_data": [dict(zip(FIELDS, r))]}) for r in RECORDS[:3])
    path = write(tmp_path / "days.jsonl", lines)
    assert city_table.extract(spark, path, whole_file=False).count() == 3


def hourly_line(day, hour, temp, rhum, prcp, wspd, pres):
    fields = ["2024", "5", str(day), str(hour), *[""] * 16]
    for position, value in zip((4, 6, 8, 14, 18), (temp, rhum, prcp, wspd, pres)):
        fields[position] = str(value)
    return ";".join(fields)


def test_delimited_export_to_phenomena_text(spark, tmp_path):
    lines = [
        "year;month;day;hour;temp;" + ";" * 16,
        hourly_line(21, 0, 13.0, 96, 12, 15, 1003.3), hourly_line(21, 12, 20.0, 50, 0, 3, 1000),
        hourly_line(3, 0, 1.0, 50, 0, 5, 1000), hourly_line(3, 1, "", 99, 50, 99, 900), "",
    ]
    export = text_lines(spark, write(tmp_path / "hours.csv", "\r\n".join(lines)))
    assert {r.date_key: r.phenomena for r in daily.phenomena(export).collect()} == {
        "2024-5-21": ["very_high_humidity", "heavy_precipitation"], "2024-5-3": [],
    }
    out = str(tmp_path / "text")
    daily.phenomena_text(export).coalesce(1).write.text(out)
    assert [r.value for r in spark.read.text(out).collect()] == [
        "WEATHER_PHENOMENA: 2024-5-21 - Detected: very_high_humidity, heavy_precipitation\t",
        "  Temperature: 13.0C - 20.0C\t", "  Humidity: up to 96.0%\t",
        "  Precipitation: up to 12.0mm\t", "  Wind: up to 15.0 km/h\t",
        "  Pressure range: 3.3 hPa\t",
        "WEATHER_STATS: 2024-5-3\t", "  Temperature: 1.0C - 1.0C\t", "  Humidity: up to 50.0%\t",
        "  Precipitation: up to 0.0mm\t", "  Wind: up to 5.0 km/h\t", "  Pressure range: 0.0 hPa\t",
    ]


def test_text_statistics_of_a_file(spark, tmp_path):
    path = write(tmp_path / "book.txt", "Кот и пёс.\n\n   \nA cat, 2nd dog\n")
    assert {r.metric: r.value for r in text.statistics_rows(spark, path).collect()} == {
        # кот, и, A, cat, dog
        "average_word_length": "2.20", "vowel": "6", "consonant": "10", "total_letters": "16",
        "word_count": "5",
    }
    out = str(tmp_path / "stats")
    text.write_statistics(spark, path, out)
    assert "word_count\t5" in [r.value for r in spark.read.text(out).collect()]


def test_repaired_export(spark, tmp_path):
    source = write(
        tmp_path / "in.csv",
        "hour;temp;wspd;prcp;wpgt;note\n0;22.03.2025 0:00;2025-09-06 00:00:00;1.5;;a\n1;-3;x;;7;b\n",
    )
    schema = T.StructType.fromDDL(
        "hour string, temp string, wspd string, prcp string, wpgt string, note string"
    )
    target = str(tmp_path / "out")
    repair.repair(spark, source, target, schema)
    back = delimited(spark, target, schema).orderBy("hour").collect()
    assert [tuple(r) for r in back] == [
        ("0", "22.0", "6.0", "1.5", None, "a"), ("1", "-3.0", None, None, "7.0", "b"),
    ]
    typed = T.StructType.fromDDL("hour int, temp double, wspd double, prcp double, wpgt double")
    records = repair.export_records(spark, target, schema, typed)
    assert tuple(records.orderBy("hour").first()) == (0, 22.0, 6.0, 1.5, None, "a")


def station_message(i, **fields):
    body = {"year": 2024, "month": 1, "day": 2, "hour": i, "temp": 1.0 + i, "rhum": 75.0,
            "prcp": 0.25, "wspd": 4.0, "pres": 1000.0, "temp_source": "m", **fields}
    return (str(i).encode(), json.dumps(body).encode(), "t", 0, i, f"2024-01-02 00:00:{i:02d}")


@pytest.fixture()
def messages(spark):
    rows = [station_message(i) for i in range(3)] + [station_message(12, temp=None)]
    return spark.createDataFrame(
        [(bytearray(k), bytearray(v), t, p, o, ts) for k, v, t, p, o, ts in rows],
        "key binary, value binary, topic string, partition int, offset long, timestamp string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_station_messages(messages):
    readings = station.station_readings(messages)
    first = readings.orderBy("offset").first()
    assert (first.key, first.offset, first.temp, first.rhum, first.date_time) == (
        "0", 0, 1.0, 75.0, "2024-01-02 00:00",
    )
    assert first.coco is None and first.processing_time is not None
    assert station.station_view(readings).columns == [
        "historical_time", "temperature_c", "humidity_pct", "pressure_hpa", "wind_speed_kmh",
        "kafka_processing_time", "offset",
    ]
    windows = station.station_windows(readings, time="kafka_processing_time")
    assert windows.columns[2:] == [m.alias for m in station.STATION_METRICS]
    assert [tuple(r)[2:] for r in windows.orderBy("window_start").collect()] == [
        (2.0, 3.0, 1.0, 75.0, 1000.0, 4.0, 4.0, 0.75, 3),
        (2.0, 3.0, 1.0, 75.0, 1000.0, 4.0, 4.0, 1.0, 4),
        (None, None, None, 75.0, 1000.0, 4.0, 4.0, 0.25, 1),
    ]
    # On processing time all rows of one query share their windows.
    assert {r.records_count for r in station.station_windows(readings).collect()} == {4}
    assert "coco" not in station.station_document_rows(messages).columns


def test_station_lines(spark):
    lines = spark.createDataFrame([('{"temp": 2.5, "rhum": 70}',), ("junk",)], "value string")
    readings = station.station_line_readings(lines)
    assert readings.where("temp = 2.5 AND rhum = 70").count() == 1
    windows = station.station_windows(readings, metrics=station.STATION_LINE_METRICS)
    assert "max_wind_speed" not in windows.columns


CITY_ROWS = [
    ("A", 10, 50, "Sunny", 1, "2024-05-01T00:00:05"), ("A", 20, 70, "Rainy", 2, "2024-05-01T00:00:20"),
    ("B", -1, 60, "Sunny", 3, "2024-05-01T00:00:40"), ("A", 25, 60, "Sunny", 4, "2024-05-01T00:03:00"),
]


@pytest.fixture()
def city_readings(spark):
    values = [
        json.dumps(dict(zip(("city", "temperature", "humidity", "weather_condition", "wind_speed", "timestamp"), r)))
        for r in CITY_ROWS
    ]
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_city_lines(city_readings):
    rows = city.city_line_windows(city.city_lines(city_readings)).orderBy("window_start", "city").collect()
    assert [(r.city, r.avg_temp, r["count"]) for r in rows] == [("A", 15.0, 2), ("B", -1.0, 1), ("A", 25.0, 1)]


def test_city_messages_and_windows(city_readings):
    envelopes = city_readings.select(
        "value", F.lit("weather").alias("topic"), F.lit(0).alias("partition"), F.lit(0).alias("offset"),
        F.lit("2024-05-01 00:00:30").cast("timestamp").alias("timestamp"),
    )
    readings = city.city_messages(envelopes, require=("city",))
    assert readings.columns == [
        "topic", "partition", "offset", "kafka_timestamp", "city", "temperature", "humidity",
        "pressure", "weather_condition", "wind_speed", "weather_timestamp",
    ]
    broker = city.city_broker_windows(readings)
    assert broker.columns == [
        "start", "end", "city", "message_count", "avg_temp", "min_temperature", "max_temperature",
        "avg_humidity", "avg_wind_speed", "unique_conditions",
    ]
    per_city = {(r.city, r.message_count, r.avg_temp, r.unique_conditions) for r in broker.collect()}
    assert per_city == {("A", 3, 18.3, 2), ("B", 1, -1.0, 1)}
    assert broker.count() == 10
    overall = city.overall_windows(readings, time="kafka_timestamp").collect()
    assert {(r.total_measurements, r.cities_count, r.overall_max_temperature) for r in overall} == {(4, 2, 25)}
    bands = {r.temperature: r.temp_category for r in city.classify(readings).collect()}
    assert bands == {10: "mild", 20: "warm", -1: "freezing", 25: "warm"}


def test_products_and_categories(spark, tmp_path):
    products = json_array(
        spark,
        write(
            tmp_path / "p.json",
            '[\n {"product_id": 1, "product_name": "X", "category_id": 4, "manufacturer_id": 1, "price": 9.99},\n'
            ' {"product_id": 2, "product_name": "Y", "category_id": 4, "manufacturer_id": 2, "price": 1}\n]',
        ),
        PRODUCT,
    )
    categories = delimited(
        spark, write(tmp_path / "c.csv", "category_id;category_name;description\n4;Tablets;All tablets\n"), CATEGORY
    )
    joined = enrich(products, categories, "category_id")
    assert [(r.product_name, r.category_name, r.price) for r in joined.orderBy("product_id").collect()] == [
        ("X", "Tablets", 9.99), ("Y", "Tablets", 1.0),
    ]


def test_declared_fields_may_be_missing(spark, tmp_path):
    path = write(tmp_path / "r.json", '{"city": "A", "more": 1}\n')
    row = spark.read.schema(CITY_READING_FILE).json(path).first()
    assert row.city == "A" and row.file_id is None
