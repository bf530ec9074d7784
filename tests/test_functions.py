from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.functions import (
    PRECIPITATION_RU,
    TEMPERATURE_EN,
    TEMPERATURE_RU,
    band,
    consonant_count,
    date_key,
    date_key_of,
    date_time_label,
    event_time,
    iso_text,
    repair_spreadsheet_number,
    strip,
    to_number,
    typed_value,
    vowel_count,
    word_chars,
    word_count,
    words,
)
from stationflow.functions.text import CONSONANTS, VOWELS

slow = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def python_number(text):
    """The float a decimal literal stands for; None for nan, inf and non-numbers."""
    if text is None or not any(c.isdigit() for c in text):
        return None
    try:
        return float(text)
    except ValueError:
        return None


NUMBERS = [
    "12.5", "-3", "+4", ".5", "5.", "1e3", "1E-2", " 7.25 ", "\t8\n", "1_000", "1__0", "_1", "1_",
    "1_0.5_0", " 9 ", "", " ", "abc", "1d", "2f", "0x10", "nan", "NaN", "inf",
    "-Infinity", "1,5", "--1", "+-1", "1 2", ".", "e5", "1e", "-0", None,
]


def test_to_number_is_a_decimal_literal(column):
    assert column(NUMBERS, to_number) == [python_number(t) for t in NUMBERS]


@slow
@given(st.lists(st.text(alphabet="0123456789.-+eE_ dfnax", max_size=8), min_size=40, max_size=80))
def test_to_number_on_any_text(column, texts):
    assert column(texts, to_number) == [python_number(t) for t in texts]


def test_strip_takes_all_white_space(column):
    texts = ["  a b ", "\t\r\nx\x0b\x0c", " 　y ", "", " ", None]
    assert column(texts, strip) == [t.strip() if t is not None else None for t in texts]


@pytest.mark.parametrize(
    "text, value",
    [
        ("22.03.2025 0:00", 22.0), ("06.09.2025 0:00", 6.0), ("2025-09-06 00:00:00", 6.0),
        ("2025-09-06 00:00:00.5", None), ("1.2025", 1.0), ("12.5", 12.5), ("-3", -3.0),
        (None, None), ("", None), ("abc", None), ("2025-09", None), ("2025", 2025.0),
        ("2025-1-2-3", 2.0), ("x.2025", None),
    ],
)
def test_repair_keeps_the_day(column, text, value):
    assert column([text], repair_spreadsheet_number) == [value]


def test_repair_of_another_year(column):
    texts = ["22.03.2024 0:00", "22.03.2025 0:00"]
    assert column(texts, lambda c: repair_spreadsheet_number(c, 2024)) == [22.0, None]


def test_repair_of_numbers(column):
    values = [12.5, -3.0, None]
    assert column(values, repair_spreadsheet_number, "double") == values


def test_typed_values_of_other_kinds(column):
    import datetime as dt
    from decimal import Decimal

    assert column([" 5.25 ", "x", ""], lambda c: typed_value(c, "decimal(9,2)")) == [
        Decimal("5.25"), None, None,
    ]
    assert column([" 2024-01-02 ", "nan", "soon"], lambda c: typed_value(c, "date")) == [
        dt.date(2024, 1, 2), None, None,
    ]


def test_typed_values(column):
    texts = [" 5 ", "5.0", "5.7", "nan", "", "calm", None, "9007199254740993"]
    assert column(texts, lambda c: typed_value(c, "bigint")) == [
        5, 5, None, None, None, None, None, 9007199254740993,
    ]
    assert column(texts[:6], lambda c: typed_value(c, "double")) == [5.0, 5.0, 5.7, None, None, None]
    assert column(texts[:7], lambda c: typed_value(c, "string")) == [
        "5", "5.0", "5.7", None, None, "calm", None,
    ]


@pytest.mark.parametrize(
    "bands, values, labels",
    [
        (TEMPERATURE_EN, [-0.1, 0, 9.9, 10, 20], ["freezing", "cold", "cold", "mild", "warm"]),
        (
            TEMPERATURE_RU, [5.1, 5, 0.1, 0, -10],
            ["тепло", "прохладно", "прохладно", "холодно", "очень холодно"],
        ),
        (
            PRECIPITATION_RU, [0, 0.9, 1, 2.9, 3],
            ["без осадков", "слабые осадки", "умеренные осадки", "умеренные осадки", "сильные осадки"],
        ),
    ],
)
def test_band_boundaries(column, bands, values, labels):
    assert column([float(v) for v in values], lambda c: band(c, bands), "double") == labels
    assert column([None, float("nan")], lambda c: band(c, bands), "double") == [None, None]


def test_band_of_integers_and_decimals(column):
    assert column([-1, 25], lambda c: band(c, TEMPERATURE_EN), "long") == ["freezing", "warm"]
    from decimal import Decimal

    assert column([Decimal("9.99")], lambda c: band(c, TEMPERATURE_EN), "decimal(9,2)") == ["cold"]


def test_date_keys_and_labels(spark):
    rows = spark.createDataFrame(
        [(2024, 1, 5, 7), (2024, 12, 31, 23), (2024, None, 1, 0)], "y int, m int, d int, h int"
    )
    y, m, d, h = (F.col(c) for c in "ymdh")
    got = rows.select(date_key(y, m, d).alias("k"), date_time_label(y, m, d, h).alias("l")).collect()
    assert [tuple(r) for r in got] == [
        ("2024-1-5", "2024-01-05 07:00"), ("2024-12-31", "2024-12-31 23:00"), (None, None),
    ]


def test_event_time_and_iso(column):
    texts = ["2025-01-02T03:04:05.678901", "2025-01-02 03:04:05", "yesterday", None]
    assert column(texts, event_time) == [
        dt.datetime(2025, 1, 2, 3, 4, 5, 678901), dt.datetime(2025, 1, 2, 3, 4, 5), None, None,
    ]
    assert column(texts[:1], lambda c: iso_text(event_time(c))) == texts[:1]
    assert column(texts[:1], lambda c: date_key_of(event_time(c))) == ["2025-1-2"]


SAMPLE = "всё ещё ёлка кот foo_bar abc1 дом-музей Привет, hello"


def test_words_of_the_sample(column):
    assert column([SAMPLE], words) == [["кот", "дом", "музей", "Привет", "hello"]]
    assert column([SAMPLE], word_count) == [5]
    assert column([SAMPLE], word_chars) == [3 + 3 + 5 + 6 + 5]


def test_letter_sets(column):
    letters = "abcyёЁъьщZя5 _é"
    assert column([letters], vowel_count) == [sum(c in VOWELS for c in letters)]
    assert column([letters], consonant_count) == [sum(c in CONSONANTS for c in letters)]
    assert not set(VOWELS) & set(CONSONANTS)


@slow
@given(
    st.lists(
        st.text(alphabet="abzёяЯъé_1 .,-\ń½٣日", max_size=30), min_size=20, max_size=60
    )
)
def test_text_counts_on_any_text(column, texts):
    expected = [re.findall(r"\b[а-яА-Яa-zA-Z]+\b", t) for t in texts]
    assert column(texts, words) == expected
    assert column(texts, word_chars) == [sum(map(len, ws)) for ws in expected]
    assert column(texts, vowel_count) == [sum(c in VOWELS for c in t) for t in texts]
    assert column(texts, consonant_count) == [sum(c in CONSONANTS for c in t) for t in texts]
