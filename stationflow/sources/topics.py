"""Message and line streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """The options of a topic subscription.

    ``min_partitions`` splits the offset ranges of busy topic partitions between
    several tasks, ``max_offsets_per_trigger`` bounds a batch after a backlog.
    Offsets live in the checkpoint of the query; there is no consumer group.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true" if fail_on_loss else "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """A topic as a stream of envelopes; ``settings`` as in ``kafka_options``.

    Needs the ``spark-sql-kafka-0-10`` package of the running Spark version.
    """
    options = kafka_options(servers, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load()


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket, in ``value``. For trying things out: it cannot replay."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
