"""Aggregates over tumbling and sliding time windows, and over plain groups."""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_MICROSECONDS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


@dataclass(frozen=True)
class Metric:
    """One aggregate: ``fn`` of ``column`` under the name ``alias``.

    ``fn`` is ``count``, ``sum``, ``avg``, ``min``, ``max``, ``set`` (distinct
    values as a sorted array), ``distinct`` (how many, on tables only) or
    ``approx_distinct`` with its relative standard ``error``; ``digits`` rounds half
    up. A ``set`` ends up in one row: it is for columns of few values.

    Two kinds of distinct counts can be merged, and so go by panes whatever the
    number of values: ``sketch_distinct`` is an estimate from HyperLogLog sketches
    with its relative standard ``error`` (0.016 unless given); ``bitmap_distinct``
    is the exact number of values of an integer or date column, on tables, from
    bitmaps of 64 neighbouring values each. ``numbered`` makes such a column of any other.
    """

    fn: str
    column: str | None
    alias: str
    digits: int | None = None
    error: float | None = None

    def expression(self) -> Column:
        return self._named(self._of(self.column))

    def _of(self, column: str | None) -> Column:
        if self.fn == "approx_distinct" and self.error is not None:
            return F.approx_count_distinct(column, self.error)
        if self.fn == "sketch_distinct":
            return F.hll_sketch_estimate(F.hll_sketch_agg(_sketched(F.col(column)), self._precision()))
        return _AGGREGATES[self.fn](column)

    def _precision(self) -> int:
        """The base-2 logarithm of a sketch's registers; its error is 1.04 / sqrt of these."""
        return min(21, max(4, math.ceil(2 * math.log2(1.04 / (self.error or 0.01625)))))

    def _named(self, value: Column) -> Column:
        if self.digits is not None:
            value = F.round(value, self.digits)
        return value.alias(self.alias)


_AGGREGATES = {
    "count": lambda c: F.count(F.lit(1) if c is None else F.col(c)),
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "set": lambda c: F.sort_array(F.collect_set(c)),
    "distinct": F.count_distinct,
    "approx_distinct": F.approx_count_distinct,
    "bitmap_distinct": F.count_distinct,
}


# Aggregates that are found again from the distinct values of partial groups.
_HELD = ("set", "distinct", "approx_distinct")


def _sketched(column: Column) -> Column:
    """Values of any type go into a sketch by their text; null stays out."""
    return column.cast("string")


def _number(column: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    raise ValueError(f"bitmap_distinct: {column} is {kind.simpleString()}, not a whole number or a date; number it first")


def numbered(rows: DataFrame, column: str, number: str, path: str) -> DataFrame:
    """``rows`` with ``number``: a whole number for each distinct value of ``column``.

    The dictionary is written to ``path`` (which must not exist): numbers are given out
    by tasks, so they are fixed only once they are stored. Values that one task numbers
    are neighbours, as bitmaps want them. Null stays null.
    """
    values = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("_value")).distinct()
    values.withColumn(number, F.monotonically_increasing_id()).write.parquet(path)
    known = rows.sparkSession.read.schema(T.StructType([T.StructField("_value", rows.schema[column].dataType), T.StructField(number, T.LongType())])).parquet(path)
    return rows.join(known, F.col(column) == F.col("_value"), "left").drop("_value")


def distinct_count(rows: DataFrame, column: str, name: str) -> DataFrame:
    """One row: how many values ``column`` has, by bitmaps where it has whole numbers or dates."""
    kind = rows.schema[column].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType)):
        return rows.select(column).distinct().agg(F.count(column).alias(name))
    number = _number(column, kind)
    words = rows.groupBy(F.shiftright(number, 6).alias("_word")).agg(F.bit_or(_bit(number)).alias("_bits"))
    return words.agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("long").alias(name))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def group_metrics(rows: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """``metrics`` per group.

    On a stream this is a running aggregate, whose state holds every key ever
    seen: use it on keys that are bounded in number. On a table, values of ``set``
    metrics are made distinct by a hash aggregation first.
    """
    columns = [F.col(key) for key in keys]
    if not rows.isStreaming and any(m.fn in ("set", "bitmap_distinct") for m in metrics):
        passes = _apart(metrics)
        if len(passes) > 1:
            return _joined([group_metrics(rows, keys, own) for own in passes], keys, metrics)
        return _in_steps(rows, columns, columns, metrics)
    return rows.groupBy(*columns).agg(*(m.expression() for m in metrics))


def windowed_agg(
    rows: DataFrame,
    time: str,
    size: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    metrics: Sequence[Metric] = (),
    watermark: str | None = None,
    panes: bool | None = None,
    start: str = "window_start",
    end: str = "window_end",
    chained: bool = False,
) -> DataFrame:
    """``metrics`` per time window (and ``keys``), with the window as two columns.

    The same call serves a table and a stream. ``watermark`` is how late rows of
    a stream may come; a table has no late rows and ignores it. The time column
    of a stream must be TIMESTAMP, a table's may be TIMESTAMP_NTZ as well.

    A sliding window copies each row into every window it is in before
    aggregating. On a table, ``panes`` aggregates rows into the panes windows are
    made of first -- the greatest common divisor of size and slide -- and copies
    pane rows only; columns of distinct-value metrics group the panes as well. By
    default that is done for sliding windows and for ``set`` metrics, but not
    with ``approx_distinct``, whose column may have about as many values as there
    are rows: pass True where it has few.

    On a stream, ``chained`` does the same by two aggregates one after the other, in
    append mode: panes are copied into windows, instead of every row into all its
    windows. A row is then late when its pane is over, though later windows it is in
    may not be. A table is not affected.
    """
    slide = slide or size
    kinds = {m.fn for m in metrics}
    if rows.isStreaming:
        if "bitmap_distinct" in kinds:
            raise ValueError("windowed_agg: bitmap_distinct is for tables")
        panes = chained
        if watermark:
            rows = rows.withWatermark(time, watermark)
    elif panes is None:
        panes = "approx_distinct" not in kinds and ("set" in kinds or slide != size)
        panes = panes or "bitmap_distinct" in kinds
    passes = [metrics] if rows.isStreaming else _apart(metrics)
    if len(passes) > 1:
        parts = [windowed_agg(rows, time, size, slide, keys, own, None, panes, start, end) for own in passes]
        return _joined(parts, [start, end, *keys], metrics)
    key_columns = [F.col(key) for key in keys]

    def window(column: str, *durations: str) -> Column:
        return F.window(F.col(column), *durations)

    if panes:
        length = f"{math.gcd(_microseconds(size), _microseconds(slide))} microseconds"
        # A stream's panes keep their watermark as a window, a table's are plain times.
        pane = "_pane" if rows.isStreaming else "_pane.start"
        grouped = _in_steps(
            rows,
            [window(time, length).alias("_pane"), *key_columns],
            [window(pane, size, slide).alias("window"), *key_columns],
            metrics,
        )
    else:
        grouped = rows.groupBy(window(time, size, slide).alias("window"), *key_columns).agg(
            *(m.expression() for m in metrics)
        )
    return grouped.select(
        F.col("window.start").alias(start),
        F.col("window.end").alias(end),
        *keys,
        *(m.alias for m in metrics),
    )


def _in_steps(
    rows: DataFrame, first: list[Column], second: list[Column], metrics: Sequence[Metric]
) -> DataFrame:
    """Aggregate by ``first``, then merge the partial results by ``second``.

    The columns of distinct-value metrics join the first grouping. Their values
    arrive at the second step few and distinct, and the first step is a plain
    hash aggregation: arrays are only built from what is left. Of a bitmap column
    only the number of its word joins it, one for 64 values; words are merged by
    ``second`` in a step of their own, and then their bits are counted.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    held = {m.column: F.col(m.column) for m in metrics if m.fn in _HELD}
    names = {column: f"_held_{i}" for i, column in enumerate(held)}
    numbers = {m.column: _number(m.column, kinds[m.column]) for m in metrics if m.fn == "bitmap_distinct"}
    words = {column: f"_word_{i}" for i, column in enumerate(numbers)}
    partial, again = {"_rows": F.count(F.lit(1))}, {"_rows": F.sum("_rows")}
    for column, name in words.items():
        partial[f"{name}_bits"] = F.bit_or(_bit(numbers[column]))
        again[f"{name}_bits"] = F.bit_or(f"{name}_bits")
    for m in metrics:
        for name, (value, merge) in _partials(m, kinds).items():
            partial[name], again[name] = value, merge(name)
    inner = [held[column].alias(name) for column, name in names.items()]
    inner += [F.shiftright(numbers[column], 6).alias(name) for column, name in words.items()]
    parts = rows.groupBy(*first, *inner).agg(*(value.alias(name) for name, value in partial.items()))
    if words and second is not first:
        keys = [F.col(name) for name in words.values()]
        parts = parts.groupBy(*second, *keys).agg(*(value.alias(name) for name, value in again.items()))
        second = [F.col(name) for name in parts.columns[: len(second)]]
    return parts.groupBy(*second).agg(*(m._named(_merged(m, names, words, kinds)) for m in metrics))


def _apart(metrics: Sequence[Metric]) -> list[list[Metric]]:
    """Metrics that can share a pass: a bitmap column stands beside no other distinct values."""
    bitmaps = list(dict.fromkeys(m.column for m in metrics if m.fn == "bitmap_distinct"))
    if len(bitmaps) + any(m.fn in _HELD for m in metrics) < 2:
        return [list(metrics)]
    rest = [m for m in metrics if m.fn != "bitmap_distinct"]
    own = [[m for m in metrics if m.fn == "bitmap_distinct" and m.column == c] for c in bitmaps]
    return [rest, *own] if rest else own


def _joined(parts: Sequence[DataFrame], keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """Passes over the same groups, side by side; null keys are equal."""
    whole = parts[0]
    if len(parts) > 1 and not keys:
        raise ValueError("group_metrics: distinct_count counts several columns of a whole table")
    for i, part in enumerate(parts[1:]):
        named = part.withColumnsRenamed({key: f"_key_{i}_{n}" for n, key in enumerate(keys)})
        same = reduce(operator.and_, (F.col(key).eqNullSafe(F.col(f"_key_{i}_{n}")) for n, key in enumerate(keys)))
        whole = whole.join(named, same)
    return whole.select(*keys, *(m.alias for m in metrics))


def _partials(m: Metric, kinds: dict[str, T.DataType]) -> dict[str, tuple[Column, Callable[[str], Column]]]:
    """Names of partial results: how they are made, and how several become one."""
    c = m.column
    if m.fn in (*_HELD, "bitmap_distinct") or (m.fn == "count" and c is None):
        return {}
    if m.fn == "avg":
        # Integers are averaged as DOUBLE, as ``avg`` does it: their sum may not fit.
        exact = isinstance(kinds.get(c), T.DecimalType)
        addend = F.col(c) if exact else F.col(c).cast("double")
        return {f"_part_{c}": (F.sum(addend), F.sum), f"_count_{c}": (F.count(c), F.sum)}
    if m.fn == "sketch_distinct":
        lg = m._precision()
        return {f"_sketch_{lg}_{c}": (F.hll_sketch_agg(_sketched(F.col(c)), lg), F.hll_union_agg)}
    return {f"_{m.fn}_{c}": (_AGGREGATES[m.fn](c), F.sum if m.fn == "count" else _AGGREGATES[m.fn])}


def _merged(m: Metric, held: dict[str, str], words: dict[str, str], kinds: dict[str, T.DataType]) -> Column:
    c, kind = m.column, kinds.get(m.column)
    if m.fn in _HELD:
        return m._of(held[c])
    if m.fn == "bitmap_distinct":
        return F.coalesce(F.sum(F.bit_count(f"{words[c]}_bits")), F.lit(0)).cast("long")
    if m.fn == "sketch_distinct":
        return F.hll_sketch_estimate(F.hll_union_agg(f"_sketch_{m._precision()}_{c}"))
    if m.fn == "count":
        return F.sum("_rows" if c is None else f"_count_{c}")
    if m.fn == "avg":
        mean = F.try_divide(F.sum(f"_part_{c}"), F.sum(f"_count_{c}"))
        return _like(mean, kind, 4, 4)
    value = _AGGREGATES[m.fn](f"_{m.fn}_{c}")
    return _like(value, kind, 10 if m.fn == "sum" else 0, 0)


def part_metrics(rows: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """Partial results of ``metrics`` per group, to be stored and merged with others later."""
    made = rows.groupBy(*keys).agg(*(value.alias(name) for name, (value, _) in _stored(metrics, rows.schema).items()))
    return _wide(made, keys)


def merge_parts(parts: DataFrame, keys: Sequence[str], metrics: Sequence[Metric], schema: T.StructType) -> DataFrame:
    """One partial result per group from many; ``schema`` is that of the rows they are of."""
    merged = parts.groupBy(*keys).agg(*(merge(name).alias(name) for name, (_, merge) in _stored(metrics, schema).items()))
    return _wide(merged, keys)


def _wide(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DECIMAL results with all the digits there are, so that merging does not change their type."""
    wide = {
        f.name: F.col(f.name).cast(T.DecimalType(38, f.dataType.scale))
        for f in parts.schema.fields
        if isinstance(f.dataType, T.DecimalType) and f.name not in keys
    }
    return parts.withColumns(wide) if wide else parts


def finish_parts(parts: DataFrame, keys: Sequence[str], metrics: Sequence[Metric], schema: T.StructType) -> DataFrame:
    """``metrics`` per group from partial results."""
    kinds = {f.name: f.dataType for f in schema.fields}
    sets = {m.alias: F.sort_array(_union_of(f"_set_{m.column}")) for m in metrics if m.fn == "set"}
    return parts.groupBy(*keys).agg(*(m._named(sets[m.alias] if m.alias in sets else _merged(m, {}, {}, kinds)) for m in metrics))


def _stored(metrics: Sequence[Metric], schema: T.StructType) -> dict[str, tuple[Column, Callable[[str], Column]]]:
    kinds = {f.name: f.dataType for f in schema.fields}
    found = {"_rows": (F.count(F.lit(1)), F.sum)}
    for m in metrics:
        if m.fn in ("distinct", "approx_distinct", "bitmap_distinct"):
            raise ValueError(f"{m.fn} has no partial result to store; sketch_distinct has")
        found |= _partials(m, kinds) if m.fn != "set" else {f"_set_{m.column}": (F.collect_set(m.column), _union_of)}
    return found


def _union_of(name: str) -> Column:
    return F.array_distinct(F.flatten(F.collect_list(name)))


def _like(value: Column, kind: T.DataType | None, digits: int, scale: int) -> Column:
    """DECIMAL results in the type a single aggregation would have given them."""
    if not isinstance(kind, T.DecimalType):
        return value
    return value.cast(
        T.DecimalType(min(kind.precision + digits, 38), min(kind.scale + scale, 38))
    )


def _microseconds(duration: str) -> int:
    """A duration in Spark's own spelling, e.g. ``1 minute 30 seconds`` or ``1.5 seconds``.

    Days and weeks are whole multiples of 24 hours; months have no fixed length.
    """
    text = " ".join(duration.lower().split()).removeprefix("interval ")
    total = Decimal(0)
    for part in re.split(r"(?<=[a-z]) (?=[-+.\d])", text):
        found = re.fullmatch(r"(\d+(?:\.\d*)?|\.\d+) ([a-z]+?)s?", part)
        if not found or found[2] not in _UNIT_MICROSECONDS or ("." in found[1] and found[2] != "second"):
            raise ValueError(f"not a duration: {duration!r}")
        total += Decimal(found[1]) * _UNIT_MICROSECONDS[found[2]]
    if total <= 0 or total != int(total):
        raise ValueError(f"not a duration: {duration!r}")
    return int(total)
