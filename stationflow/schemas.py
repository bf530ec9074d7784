"""Declared schemas of the inputs. Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_INT, _LONG, _DOUBLE, _TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# Hourly station message. Humidity is DOUBLE: publishers send 75.0 as readily as
# 75, and an INT field would silently turn the former into null.
HOURLY_STATION = _struct(
    year=_INT, month=_INT, day=_INT, hour=_INT,
    temp=_DOUBLE, temp_source=_TEXT,
    rhum=_DOUBLE, rhum_source=_TEXT,
    prcp=_DOUBLE, prcp_source=_TEXT,
    wspd=_DOUBLE, wspd_source=_TEXT,
    pres=_DOUBLE, pres_source=_TEXT,
    coco=_INT, coco_source=_TEXT,
    kafka_timestamp=_TEXT,
)

# The document job reads the message without the condition code.
HOURLY_STATION_DOCUMENT = T.StructType(
    [f for f in HOURLY_STATION.fields if not f.name.startswith("coco")]
)

# The line-socket job carries the bare metrics.
HOURLY_STATION_LINE = _struct(
    year=_INT, month=_INT, day=_INT, hour=_INT,
    temp=_DOUBLE, rhum=_DOUBLE, prcp=_DOUBLE, wspd=_DOUBLE, pres=_DOUBLE,
    current_timestamp=_TEXT,
)

CITY_READING = _struct(
    city=_TEXT, temperature=_LONG, humidity=_LONG, pressure=_LONG,
    weather_condition=_TEXT, wind_speed=_LONG, timestamp=_TEXT,
)

# One-record JSON files also carry a file number.
CITY_READING_FILE = T.StructType([T.StructField("file_id", _LONG, True), *CITY_READING.fields])

CITY_READING_LINE = _struct(
    city=_TEXT, temperature=_LONG, humidity=_LONG, weather_condition=_TEXT, timestamp=_TEXT,
)

CITY_DAY = _struct(
    city=_TEXT, date=_TEXT, temperature=_DOUBLE, humidity=_LONG, pressure=_LONG,
    wind_speed=_DOUBLE, condition=_TEXT, precipitation=_DOUBLE,
)

CITY_DAY_DOCUMENT = _struct(
    weather_data=T.ArrayType(CITY_DAY),
    metadata=_struct(
        source=_TEXT, last_updated=_TEXT, version=_TEXT, cities_count=_LONG, days_count=_LONG,
    ),
)

# Position of each used column in the delimited hourly export.
HOURLY_POSITIONS = {
    "year": 0, "month": 1, "day": 2, "hour": 3,
    "temp": 4, "rhum": 6, "prcp": 8, "wspd": 14, "pres": 18,
}
HOURLY_METRICS = ("temp", "rhum", "prcp", "wspd", "pres")

PRODUCT = _struct(
    product_id=_LONG, product_name=_TEXT, category_id=_LONG, manufacturer_id=_LONG, price=_DOUBLE,
)
CATEGORY = _struct(category_id=_LONG, category_name=_TEXT, description=_TEXT)
