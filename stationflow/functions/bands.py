"""Threshold bands."""

from __future__ import annotations

import operator
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TESTS = {
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq,
}


@dataclass(frozen=True)
class Bands:
    """Labelled tests, tried in order; ``default`` is for values none of them takes."""

    tests: tuple[tuple[str, float, str], ...]
    default: str


# Fixed values.
TEMPERATURE_EN = Bands((("<", 0, "freezing"), ("<", 10, "cold"), ("<", 20, "mild")), "warm")
TEMPERATURE_RU = Bands(
    ((">", 5, "тепло"), (">", 0, "прохладно"), (">", -10, "холодно")), "очень холодно"
)
PRECIPITATION_RU = Bands(
    (("=", 0, "без осадков"), ("<", 1, "слабые осадки"), ("<", 3, "умеренные осадки")),
    "сильные осадки",
)


def band(value: Column, bands: Bands) -> Column:
    """The label of the band ``value`` falls into; null for null and NaN."""
    label = F.when(value.isNull() | F.isnan(value), F.lit(None).cast("string"))
    for test, bound, name in bands.tests:
        label = label.when(_TESTS[test](value, F.lit(bound)), F.lit(name))
    return label.otherwise(F.lit(bands.default))
