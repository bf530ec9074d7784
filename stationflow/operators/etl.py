"""Derive, de-duplicate and load keyed records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import PRECIPITATION_RU, TEMPERATURE_RU, Bands, band
from ..session import drop_folder, new_work_folder


class KeyConflict(Exception):
    """Keys of an increment are in the table already, or twice in the increment."""


class NullValue(Exception):
    """A column of an increment that must be set is null."""


@dataclass(frozen=True)
class LoadResult:
    """Rows of the increment, and how many of them were new and appended."""

    offered: int
    loaded: int


def derive_city_day(
    days: DataFrame,
    city: str = "city",
    date: str = "date",
    temperature: str = "temperature",
    precipitation: str = "precipitation",
    temperature_bands: Bands = TEMPERATURE_RU,
    precipitation_bands: Bands = PRECIPITATION_RU,
) -> DataFrame:
    """Adds the bands, ``created_at``, date parts and the business key ``record_id``."""
    day = F.to_date(F.col(date))
    return days.withColumns(
        {
            "temp_category": band(F.col(temperature), temperature_bands),
            "precip_category": band(F.col(precipitation), precipitation_bands),
            "created_at": F.current_timestamp(),
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "record_id": F.concat(F.col(city), F.lit("_"), F.col(date).cast("string")),
        }
    )


def dedupe_keep_first(
    rows: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in ``order`` (which must be total within a key).

    ``row_number() = 1`` is planned with a group limit before the shuffle: every
    task sends at most one row per key, so a key with a great many copies is no
    hot partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def keep_first_seen(rows: DataFrame, key: str | Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key: on a stream the one that arrives first.

    A stream remembers a key until ``delay`` has passed since its event time, so a
    message that is delivered again within that is dropped, and state stays bounded.
    Rows whose event time is more than ``delay`` behind the latest are late and are
    dropped as well. On a table the earliest row by ``time`` stays, whatever the
    distance; a null time comes first. The time of a stream must be TIMESTAMP.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if rows.isStreaming:
        return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    return dedupe_keep_first(rows, keys, [F.col(time).asc_nulls_first(), F.xxhash64(*rows.columns)])


def drop_incomplete(rows: DataFrame) -> DataFrame:
    """Rows without any null. Comes after de-duplication: a first copy with a
    null takes its whole key away."""
    return rows.na.drop("any")


def seen_keys(
    incoming: DataFrame, existing: DataFrame, key: str, within: Sequence[str] = ()
) -> DataFrame:
    """The keys of ``incoming`` the table has already.

    The table is the probing side of a semi join on a narrow projection: when the
    increment is small Spark broadcasts its keys and the table is scanned without
    being shuffled, and partition columns in ``within`` prune the scan.
    """
    on = [*within, key]
    return existing.select(*on).join(incoming.select(*on), on, "left_semi").select(key)


def unseen_rows(
    incoming: DataFrame, existing: DataFrame, key: str, within: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``."""
    return incoming.join(seen_keys(incoming, existing, key, within), key, "left_anti")


def load_table(
    incoming: DataFrame,
    path: str,
    key: str = "record_id",
    partition_by: Sequence[str] = ("year", "month"),
    on_conflict: str = "skip",
    not_null: Sequence[str] = (),
) -> LoadResult:
    """Append the rows whose key the table at ``path`` does not have.

    The key stays unique: an increment that has a key twice raises ``KeyConflict``
    (``dedupe_keep_first`` goes before), and ``on_conflict="error"`` raises it as
    well if any key is known already; with ``skip`` those rows are left out. A null
    key, a null partition column or a null in one of ``not_null`` raises
    ``NullValue``. Nothing is loaded then. Partition columns must follow from the
    key.

    The increment is written to the shared folder first: it is computed once, its
    size is known when the joins are planned, and a lost executor costs a re-read.
    It is removed when the load has ended.
    """
    if on_conflict not in ("skip", "error"):
        raise ValueError(f"on_conflict: {on_conflict!r}")
    spark = incoming.sparkSession
    stage = new_work_folder(spark, "increment")
    needed = list(dict.fromkeys([key, *partition_by, *not_null]))
    offered = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(needed)]
    try:
        incoming.observe(offered, *counts).write.parquet(stage)
        missing = [c for i, c in enumerate(needed) if offered.get[f"null_{i}"]]
        if missing:
            raise NullValue(f"null in {', '.join(missing)}; nothing loaded")
        staged = spark.read.schema(incoming.schema).parquet(stage)
        if not staged.groupBy(key).count().where("count > 1").isEmpty():
            raise KeyConflict(f"{key} twice in the increment; nothing loaded")

        # An empty table if there is none yet; left alone otherwise.
        staged.limit(0).write.mode("ignore").partitionBy(*partition_by).parquet(path)
        existing = spark.read.schema(staged.schema).parquet(path)
        known = seen_keys(_bounded(staged, partition_by), existing, key, partition_by)
        if on_conflict == "error" and not known.isEmpty():
            raise KeyConflict(f"{key} of the increment already present; nothing loaded")
        fresh = staged.join(known, key, "left_anti")

        loaded = Observation()
        # Rows of one partition together, but AQE may split a crowded one.
        rebalanced = fresh.hint("rebalance", *partition_by)
        counted = rebalanced.observe(loaded, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("append").partitionBy(*partition_by).parquet(path)
        return LoadResult(offered.get["rows"], loaded.get["rows"])
    finally:
        drop_folder(spark, stage)


def _bounded(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with the range of each column as a filter.

    It holds for every row, but lets Spark prune the partitions of what the rows
    are joined with: by the range at once, by the exact values at run time.
    """
    if not columns:
        return rows
    bounds = rows.agg(
        *(F.min(c).alias(f"low_{c}") for c in columns), *(F.max(c).alias(f"high_{c}") for c in columns)
    ).first()
    for c in columns:
        if bounds[f"low_{c}"] is not None:
            rows = rows.where(F.col(c).between(bounds[f"low_{c}"], bounds[f"high_{c}"]))
    return rows
