"""Steps of a long operator: written to the shared folder and read again."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files and broadcasts of steps that are written.

    It does so once the driver has collected the plans that made them; asked for after
    each step, neither the executors' disks nor the driver's heap fill up with them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(rows: DataFrame, path: str) -> DataFrame:
    """``rows``, written to ``path``: later steps read them, and so does a retry."""
    spark, schema = rows.sparkSession, rows.schema
    rows.write.parquet(path)
    del rows
    release(spark)
    return spark.read.schema(schema).parquet(path)
