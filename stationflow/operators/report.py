"""Summary reports over a table."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import Metric, distinct_count, group_metrics


def count_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def overall(
    rows: DataFrame, distinct: Mapping[str, str], value: str, prefix: str = "temp"
) -> DataFrame:
    """One row: count, exact distinct counts (column -> name), min, max and mean.

    Each distinct column has a pass of its own over nothing but that column, as
    several in one pass would copy every row once per column. Whole numbers and
    dates are counted by bitmaps, other values are made distinct in each task
    before the shuffle. ``rows`` is read again for each: pass a stored table.
    """
    whole = rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(value).alias(f"min_{prefix}"),
        F.max(value).alias(f"max_{prefix}"),
        F.avg(value).alias(f"avg_{prefix}"),
    )
    counts = (distinct_count(rows, column, name).scalar().alias(name) for column, name in distinct.items())
    return whole.select("total_records", *counts, f"min_{prefix}", f"max_{prefix}", f"avg_{prefix}")


def per_group(
    rows: DataFrame, key: str, metrics: Sequence[Metric], order_by: str
) -> DataFrame:
    """``metrics`` per group, highest ``order_by`` first, ties by key."""
    return group_metrics(rows, [key], metrics).orderBy(F.desc(order_by), key)


def extremes(
    rows: DataFrame,
    label: str,
    picks: Mapping[str, tuple[str, str]],
    order: Sequence[str],
) -> DataFrame:
    """Where a value is highest or lowest: one row.

    ``picks`` maps a name to ``("max" | "min", column)``; each yields
    ``<name>_<label>`` and ``<name>_value``. The first row in ``order`` wins a
    tie; nulls and NaN never win.

    The extreme values come first, from a plain aggregate over their columns
    (Spark merges the subqueries into one scan); labels and order are looked at
    only in the rows that have one of them. ``rows`` is read twice: pass a stored
    table rather than a long computation.
    """
    bests, columns = [], []
    for name, (which, column) in picks.items():
        value = F.when(~F.isnan(column), F.col(column))
        sign, best = (-value, F.max) if which == "max" else (value, F.min)
        bests.append(F.col(column) == rows.agg(best(value)).scalar())
        rank = F.when(value.isNotNull(), F.struct(sign, *order))
        columns.append(F.min_by(F.col(label), rank).alias(f"{name}_{label}"))
        columns.append(best(value).alias(f"{name}_value"))
    return rows.where(reduce(operator.or_, bests)).agg(*columns)


def value_counts(rows: DataFrame, column: str, name: str = "records") -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), column)


def first_distinct(rows: DataFrame, column: str, ordinal: str, n: int = 10) -> DataFrame:
    """The first ``n`` distinct values of a column in order of appearance."""
    firsts = rows.groupBy(column).agg(F.min(ordinal).alias("_first"))
    return firsts.orderBy("_first", column).limit(n).select(column)


def preview(rows: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return rows.orderBy(*order).limit(n)
