"""Drive a table through a streaming query, for the stream queries and tests.

Where order does not matter, the stream reads the table's own files. Where it does
(watermarks), the rows are laid down once, in files by time, and read file by file,
so that nothing is late that would not be late live. Work folders are removed; what a
query stored stays, as it is read later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ...session import drop_folder, new_work_folder
from ...streaming import batch_folder_writer, read_batches, start_query
from ...streaming.sinks import BatchFunction

Plan = Callable[[DataFrame], DataFrame]

# Rows of a micro-batch that is laid down.
BATCH_ROWS = 5_000_000
# Files of a table per micro-batch.
BATCH_FILES = 64


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stored table as a stream of its own files.

    A file source takes folders or patterns; as a pattern, a table may be one file.
    """
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(pattern)


def drain(
    stream: DataFrame, mode: str, sink: str | BatchFunction, options: dict[str, str] | None = None, name: str = "replay"
) -> None:
    """Run all there is through one query."""
    folder = new_work_folder(stream.sparkSession, name)
    try:
        query = start_query(
            stream, name=f"{name}-{folder[-8:]}", mode=mode, sink=sink, checkpoint=f"{folder}/checkpoint",
            trigger={"availableNow": True}, options=options,
        )
        query.awaitTermination()
    finally:
        drop_folder(stream.sparkSession, folder)


def lay_down(rows: DataFrame, time: str, folder: str, batches: int | None = None) -> None:
    """Write ``rows`` once, in files by time; null times come first.

    The number of files follows from the number of rows unless given. A stream takes
    files by their modification times, so these are set in the order of the files.
    """
    spark = rows.sparkSession
    batches = batches or max(2, -(-rows.count() // BATCH_ROWS))
    rows.repartitionByRange(batches, F.col(time)).write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((s for s in files.listStatus(path) if s.getPath().getName().startswith("part-")), key=lambda s: s.getPath().getName())
    first = min((s.getModificationTime() for s in found), default=0)
    for i, status in enumerate(found):
        files.setTimes(status.getPath(), first + 1000 * i, -1)


def replay(
    rows: DataFrame, time: str, plan: Plan, mode: str, sink: str | BatchFunction,
    batches: int | None = None, options: dict[str, str] | None = None, name: str = "replay",
) -> None:
    """Feed ``rows`` to ``plan`` in the order of ``time``, one file per micro-batch."""
    spark = rows.sparkSession
    folder = new_work_folder(spark, f"{name}-source")
    try:
        lay_down(rows, time, folder, batches)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        drain(plan(stream), mode, sink, options, name)
    finally:
        drop_folder(spark, folder)


def collect_updates(
    rows: DataFrame, time: str, plan: Plan, mode: str, batches: int | None = None, name: str = "replay"
) -> DataFrame:
    """Replay and return all output, with its micro-batch in ``batch``."""
    out = new_work_folder(rows.sparkSession, f"{name}-out")
    replay(rows, time, plan, mode, batch_folder_writer(out), batches, name=name)
    return read_batches(rows.sparkSession, out).drop("query")


def latest_per_key(updates: DataFrame, keys: Sequence[str], batch: str = "batch") -> DataFrame:
    """Fold the output of update mode: the last row of each key stands.

    ``row_number() = 1`` has a group limit before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(batch).desc()))
    return updates.withColumn("_rank", rank).where("_rank = 1").drop("_rank", batch)


def last_batch(updates: DataFrame, batch: str = "batch") -> DataFrame:
    """The output of complete mode: the last batch is the whole result."""
    newest = updates.agg(F.max(batch).alias("_newest"))
    return updates.join(F.broadcast(newest), F.col(batch) == F.col("_newest")).drop("_newest", batch)
