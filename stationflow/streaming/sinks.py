"""Sinks of streaming queries: batch folders, documents, topics, fan-out."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import iso_text
from ..operators.messages import to_json_value

BatchFunction = Callable[[DataFrame, int], None]

# Document field -> message field.
DOCUMENT_FIELDS = {
    "year": "year", "month": "month", "day": "day", "hour": "hour",
    "temperature": "temp", "humidity": "rhum", "pressure": "pres",
    "wind_speed": "wspd", "precipitation": "prcp",
}
DOCUMENT_METADATA = ("temp_source", "kafka_timestamp")


def document_shape(
    rows: DataFrame,
    batch_id: int,
    fields: Mapping[str, str] | None = None,
    metadata: tuple[str, ...] = DOCUMENT_METADATA,
) -> DataFrame:
    """Readings as documents: renamed, stamped, with nested ``metadata``."""
    now = F.current_timestamp()
    return rows.select(
        now.alias("timestamp"),
        *(F.col(old).alias(new) for new, old in (fields or DOCUMENT_FIELDS).items()),
        F.lit(batch_id).cast("long").alias("batch_id"),
        iso_text(now).alias("processed_at"),
        F.struct(*metadata).alias("metadata"),
    )


def batch_folder_writer(path: str, fmt: str = "parquet") -> BatchFunction:
    """Write each micro-batch into a folder of its own below ``path``.

    The folder is named by the query's lasting id and the batch. A batch that is
    tried again after a failure overwrites its folder, so every batch is there
    exactly once; a query with a new checkpoint has a new id and adds to what
    others have stored. Executors write their partitions; nothing passes through
    the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        batch.write.format(fmt).mode("overwrite").save(f"{path}/query={query}/batch={batch_id}")

    return write


def read_batches(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None
) -> DataFrame:
    """What ``batch_folder_writer`` wrote, with its ``query`` and the number in ``batch``.

    Formats that do not carry their schema need ``schema``: nothing is inferred.
    """
    if schema is None and fmt not in ("parquet", "orc", "avro"):
        raise ValueError(f"reading {fmt} needs a schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        given = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        reader = reader.schema(T.StructType([*given.fields]).add("query", T.StringType()).add("batch", T.IntegerType()))
    return reader.load(path)


def document_writer(
    path: str,
    fmt: str = "json",
    shape: Callable[[DataFrame, int], DataFrame] = document_shape,
    save: BatchFunction | None = None,
) -> BatchFunction:
    """Per-batch document sink. Empty batches leave nothing behind.

    ``save`` replaces the folder writer, e.g. by a document store's Spark
    connector writing by ``batch_id`` so that a retried batch replaces itself.
    Errors are not swallowed: the query fails and the batch is tried again.
    """
    store = save or batch_folder_writer(path, fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            store(shape(batch, batch_id), batch_id)

    return write


def fan_out(*writers: BatchFunction) -> BatchFunction:
    """Several per-batch sinks behind one reading of the source."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def topic_options(servers: str, topic: str, acks: str = "all", retries: int = 3) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
    }


def to_topic(
    rows: DataFrame,
    servers: str,
    topic: str,
    key: str | None = None,
    checkpoint: str | None = None,
    **settings,
) -> StreamingQuery | None:
    """Publish rows as JSON messages; a stream needs a ``checkpoint``.

    Needs the ``spark-sql-kafka-0-10`` package of the running Spark version.
    """
    messages = to_json_value(rows, key)
    options = topic_options(servers, topic, **settings)
    if rows.isStreaming:
        if not checkpoint:
            raise ValueError("publishing a stream needs a checkpoint location")
        return (
            messages.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start()
        )
    messages.write.format("kafka").options(**options).save()
    return None
