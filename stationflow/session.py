"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stream state lives off-heap and is checkpointed as increments.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` overrides any of them.

    The number of shuffle partitions is left to the deployment: set
    ``spark.sql.shuffle.partitions`` to a few times the cores (AQE coalesces the
    excess of a batch job; a stream keeps the number of its first start).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset it is one below the warehouse, which is always set and
    which all machines of a cluster share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return folder.rstrip("/")


def new_work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder (not yet created)."""
    path = f"{shared_folder(spark)}/stationflow/{purpose}-{uuid.uuid4().hex}"
    for made in _collecting:
        made.append(path)
    return path


# Lists that ``work_folders`` is keeping at the moment.
_collecting: list[list[str]] = []


@contextmanager
def work_folders(spark: SparkSession) -> Iterator[list[str]]:
    """Work folders made inside are removed at the end.

    For steps whose result is written inside: until then, what they return reads
    these folders.
    """
    made: list[str] = []
    _collecting.append(made)
    try:
        yield made
    finally:
        _collecting.remove(made)
        for path in made:
            drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``new_work_folder``, on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
