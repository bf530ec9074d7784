from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...functions import PRECIPITATION_RU, TEMPERATURE_EN, TEMPERATURE_RU, band, date_time_label, strip
from ...operators import explode_records, normalize, repair_columns
from ...session import new_work_folder
from ...sources import delimited
from ..daily import hourly_readings
from ..repair import write_delimited
from .messages import hour_parts
from .tables import PROPS, table


def _export_lines(events: DataFrame) -> DataFrame:
    """Events as lines of a 20-field export, some of them damaged by event type."""
    t, k = F.col("ts"), F.from_json("props", PROPS)["k"].cast("string")
    kind, value = F.col("event_type"), F.col("value").cast("string")
    temp = (
        F.when((kind == "error") & (F.col("value") < 10), "").when(kind == "error", "n/a")
        .otherwise(F.concat(F.lit(" "), value))
    )
    fields = [
        *(part.cast("string") for part in (F.year(t), F.month(t), F.dayofmonth(t), F.hour(t))),
        temp, F.lit("src"), k, F.lit("src"), value,
        *[F.lit("")] * 5, k, *[F.lit("")] * 3, F.col("user_id").cast("string"),
    ]
    line = F.concat_ws(";", *fields)
    complete = F.concat(line, F.lit(";end"))
    # A short line, a repeated header and a blank line.
    damaged = (
        F.when((kind == "signup") & (F.col("value") < 20), line)
        .when((kind == "signup") & (F.col("value") < 40), F.concat(F.lit("year;"), complete))
        .when((kind == "signup") & (F.col("value") < 60), "  \t ")
        .otherwise(F.concat(complete, F.lit("\r")))
    )
    return events.select(damaged.alias("value"))


def positional_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the export, read back by position."""
    return hourly_readings(_export_lines(table(spark, folder, "events")))


def _mangled() -> Column:
    """Values as a spreadsheet leaves them, by event type."""
    day, month = F.dayofmonth("ts"), F.month("ts")

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.concat(two(day), F.lit("."), two(month), F.lit(".2025 0:00")))
        .when(kind == "view", F.concat(F.lit("2025-"), two(month), F.lit("-"), two(day), F.lit(" 00:00:00")))
        .when((kind == "error") & (F.col("value") < 10), F.lit("abc"))
        .when((kind == "error") & (F.col("value") < 20), F.lit("2025-09"))
        .when((kind == "error") & (F.col("value") < 30), F.lit(None).cast("string"))
        .otherwise((-F.col("value")).cast("string"))
    )


def repair_numbers(spark, folder):
    rows = table(spark, folder, "events").select("event_id", _mangled().alias("temp"))
    return repair_columns(rows, ["temp"])


RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "temp", "k", "note")])
TYPED = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("note", T.StringType()),
    ]
)


def _raw_records(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "error", " NaN ").when(kind == "signup", "  ")
        .when(kind == "view", "calm").otherwise(F.col("value").cast("string")).alias("temp"),
        F.concat(F.lit(" "), F.from_json("props", PROPS)["k"].cast("string"), F.lit(".0"))
        .alias("k"),
        F.concat(F.lit(" \t"), kind, F.lit(" ")).alias("note"),
    )


def normalize_record(spark, folder):
    return normalize(_raw_records(table(spark, folder, "events")), TYPED)


def csv_round_trip(spark, folder):
    """Mangled records written delimited, read back, repaired and written again."""
    work = new_work_folder(spark, "csv")
    rows = table(spark, folder, "events").select(
        "event_id", _mangled().alias("temp"), F.col("event_type").alias("note")
    )
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("temp", T.StringType()),
         T.StructField("note", T.StringType())]
    )
    write_delimited(rows, f"{work}/mangled")
    write_delimited(
        repair_columns(delimited(spark, f"{work}/mangled", schema), ["temp"]), f"{work}/fixed"
    )
    fixed = delimited(spark, f"{work}/fixed", schema)
    return fixed.select("event_id", F.col("temp").try_cast("double").alias("temp"), "note")


def date_time_label_query(spark, folder):
    parts = table(spark, folder, "events").select("event_id", *hour_parts())
    return parts.select(
        "event_id",
        date_time_label(*(F.col(c) for c in ("year", "month", "day", "hour"))).alias("date_time"),
    )


def _band_query(bands, shift):
    def query(spark, folder):
        value = F.col("value") - shift
        return table(spark, folder, "events").select(
            "event_id", band(value, bands).alias("category")
        )

    return query


def nested_explode(spark, folder):
    """Each text as a JSON document of line records, parsed and exploded."""
    documents = table(spark, folder, "documents")
    nested = documents.select(
        "doc_id",
        F.to_json(
            F.struct(
                F.transform(
                    F.split("text", "\n"),
                    lambda line: F.struct(line.alias("line"), F.length(line).alias("chars")),
                ).alias("records"),
                F.struct("lang", "source").alias("metadata"),
            )
        ).alias("json"),
    )
    schema = T.StructType.fromDDL(
        "records ARRAY<STRUCT<line: STRING, chars: INT>>, metadata STRUCT<lang: STRING, source: STRING>"
    )
    parsed = nested.select("doc_id", F.from_json("json", schema).alias("d")).select(
        "doc_id", F.col("d.metadata.lang").alias("lang"), "d.records"
    )
    rows = explode_records(parsed, "records", keep=["doc_id", "lang"])
    return rows.select("doc_id", "lang", F.col("ordinal").cast("bigint").alias("ordinal"), "line", "chars")


QUERIES = {
    "positional_parse": positional_parse,
    "repair_numbers": repair_numbers,
    "normalize_record": normalize_record,
    "csv_round_trip": csv_round_trip,
    "date_time_label": date_time_label_query,
    "band_temperature_en": _band_query(TEMPERATURE_EN, 10),
    "band_temperature_ru": _band_query(TEMPERATURE_RU, 20),
    "band_precip": _band_query(PRECIPITATION_RU, 0),
    "nested_explode": nested_explode,
}

_K = "json_extract_string(props, '$.k')"
_REPAIRED = """
    CASE event_type WHEN 'click' THEN CAST(day(ts) AS DOUBLE)
         WHEN 'view' THEN CAST(day(ts) AS DOUBLE)
         WHEN 'error' THEN CASE WHEN value >= 30 THEN -value END
         ELSE -value END AS temp"""

ORACLE = {
    "positional_parse": f"""
    SELECT CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month,
           CAST(day(ts) AS VARCHAR) AS day, CAST(hour(ts) AS VARCHAR) AS hour,
           value AS temp, CAST({_K} AS DOUBLE) AS rhum, value AS prcp,
           CAST({_K} AS DOUBLE) AS wspd, CAST(user_id AS DOUBLE) AS pres,
           year(ts) || '-' || month(ts) || '-' || day(ts) AS date_key
    FROM events
    WHERE event_type <> 'error' AND NOT (event_type = 'signup' AND value < 60)""",
    "repair_numbers": f"SELECT event_id, {_REPAIRED} FROM events",
    "normalize_record": f"""
    SELECT event_id,
           CASE WHEN event_type NOT IN ('error', 'signup', 'view') THEN value END AS temp,
           CAST({_K} AS INTEGER) AS k, event_type AS note
    FROM events""",
    "csv_round_trip": f"SELECT event_id, {_REPAIRED}, event_type AS note FROM events",
    "date_time_label": """
    SELECT event_id,
           year(ts) || '-' || lpad(CAST(month(ts) AS VARCHAR), 2, '0') || '-'
           || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || ' '
           || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS date_time
    FROM events""",
    "band_temperature_en": """
    SELECT event_id,
           CASE WHEN value - 10 < 0 THEN 'freezing' WHEN value - 10 < 10 THEN 'cold'
                WHEN value - 10 < 20 THEN 'mild' ELSE 'warm' END AS category
    FROM events""",
    "band_temperature_ru": """
    SELECT event_id,
           CASE WHEN value - 20 > 5 THEN 'тепло' WHEN value - 20 > 0 THEN 'прохладно'
                WHEN value - 20 > -10 THEN 'холодно' ELSE 'очень холодно' END AS category
    FROM events""",
    "band_precip": """
    SELECT event_id,
           CASE WHEN value = 0 THEN 'без осадков' WHEN value < 1 THEN 'слабые осадки'
                WHEN value < 3 THEN 'умеренные осадки' ELSE 'сильные осадки' END AS category
    FROM events""",
    "nested_explode": """
    SELECT doc_id, lang, CAST(i - 1 AS BIGINT) AS ordinal, lines[i] AS line,
           CAST(length(lines[i]) AS INTEGER) AS chars
    FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents) d,
         LATERAL (SELECT unnest(range(1, len(d.lines) + 1)) AS i)""",
}
