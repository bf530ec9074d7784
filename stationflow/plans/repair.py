"""Repair a delimited export that went through a spreadsheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import normalize, repair_columns
from ..sources import delimited

REPAIRED = ("temp", "wspd", "prcp", "wpgt")


def repair(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    columns: tuple[str, ...] = REPAIRED,
    year: int = 2025,
) -> None:
    """Read ``source`` as text columns, repair ``columns``, write to ``target``."""
    write_delimited(repair_columns(delimited(spark, source, schema), columns, year), target)


def write_delimited(rows: DataFrame, target: str, sep: str = ";") -> None:
    """Delimited text with a header, replacing what is at ``target``."""
    rows.write.option("sep", sep).option("header", True).mode("overwrite").csv(target)


def export_records(spark: SparkSession, source: str, raw: T.StructType, schema: T.StructType) -> DataFrame:
    """Lines of an export as typed records, ready to publish."""
    return normalize(delimited(spark, source, raw), schema)
