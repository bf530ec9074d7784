"""Lines to fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strip, to_number
from ..functions.numbers import WHITESPACE
from .once import computed_once


def non_blank(lines: DataFrame, value: str = "value") -> DataFrame:
    """Stripped lines, without the blank ones."""
    return lines.withColumn(value, strip(F.col(value))).where(F.col(value) != "")


def positional_fields(
    lines: DataFrame,
    positions: Mapping[str, int],
    metrics: Sequence[str],
    min_fields: int = 20,
    sep: str = ";",
    header: str = "year",
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Delimited lines to columns: text parts as they are, ``metrics`` as DOUBLE.

    Blank lines, lines whose first field starts with ``header`` and lines of
    fewer than ``min_fields`` fields are dropped; so is the whole line when any one metric
    is not a number, because a half-read reading would shift the extremes of its
    day. ``keep`` names further columns of ``lines`` to carry along.
    """
    # A separator that means nothing in a regex is split on without one.
    pattern = f"\\Q{sep}\\E" if len(sep) > 1 or sep in ".$|()[{^?*+\\" else sep
    split = computed_once(lines, keep, "_fields", F.split(F.col(value), pattern, -1))

    def field(position: int) -> Column:
        # Stripping the ends of a line is stripping its outer fields.
        text = F.get(F.col("_fields"), F.lit(position))
        if position == 0:
            text = F.ltrim(text, F.lit(WHITESPACE))
        if position >= min_fields - 1:
            ended = F.rtrim(text, F.lit(WHITESPACE))
            text = F.when(F.size("_fields") == position + 1, ended).otherwise(text)
        return text

    accepted = split.where((F.size("_fields") >= min_fields) & ~field(0).startswith(header))
    if min_fields < 2:
        accepted = accepted.where((F.size("_fields") > 1) | (field(0) != ""))
    texts = [name for name in positions if name not in metrics]
    numbers = F.struct(*(to_number(field(positions[name])).alias(name) for name in metrics))
    carried = [*keep, *(field(positions[name]).alias(name) for name in texts)]
    parsed = computed_once(accepted, carried, "_metrics", numbers)
    return parsed.select(
        *keep, *texts, *(F.col("_metrics")[name].alias(name) for name in metrics)
    ).na.drop(subset=list(metrics))
