"""Compute a costly column once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(
    rows: DataFrame, keep: Sequence[Column | str], name: str, value: Column
) -> DataFrame:
    """``keep`` and ``value`` as ``name``, whatever is filtered on later.

    A filter above a projection is moved below it with the projected expression
    copied in, so a parsed column that is filtered on is parsed once for the
    filter and again for the output. Filters on what a generator yields stay
    above it; a one-element array yields each row unchanged.
    """
    return rows.select(*keep, F.explode_outer(F.array(value)).alias(name))
