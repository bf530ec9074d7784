"""Letter and word statistics of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import letter_word_stats, to_metric_rows
from ..sources import text_lines


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row of sums over all lines. Blank lines count nothing anyway."""
    return letter_word_stats(text_lines(spark, path))


def statistics_rows(spark: SparkSession, path: str) -> DataFrame:
    """The same as ``metric``/``value`` rows."""
    return to_metric_rows(statistics(spark, path))


def write_statistics(spark: SparkSession, path: str, out: str) -> None:
    """The same as tab-separated text."""
    statistics_rows(spark, path).write.option("sep", "\t").mode("overwrite").csv(out)
