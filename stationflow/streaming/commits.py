"""Tables of folders that never change, named by numbered commits.

Data is written to folders of its own first; a commit is one small JSON file that
lists the folders which make up the table from then on, and what else the writer has
to remember. A commit takes the next number and fails if another has it, so each
writer sees all that was committed before, and readers see whole commits only: a
writer that is killed leaves a folder that no commit lists.

The file system must not replace a file by a rename (HDFS) or must know links (local
disks and mounts); plain object stores do not do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import Metric, finish_parts, merge_parts, part_metrics
from .sinks import BatchFunction

# Commits that stay readable; what only older ones list is removed.
KEPT = 20


class Folders:
    """Files below ``path``, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        where = self._path(name)
        return [s.getPath().getName() for s in self._files.listStatus(where)] if self._files.exists(where) else []

    def ages(self, name: str) -> dict[str, float]:
        """Seconds since each entry of a folder was changed."""
        where, now = self._path(name), time.time()
        found = self._files.listStatus(where) if self._files.exists(where) else []
        return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in found}

    def text(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file unless there is one of that name; False if there is."""
        final, draft = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self._files.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self._files.getScheme() != "file":
                return not self._files.exists(final) and self._files.rename(draft, final)
            local = lambda p: self._jvm.java.io.File(p.toUri().getPath()).toPath()
            try:
                self._jvm.java.nio.file.Files.createLink(local(final), local(draft))
                return True
            except Exception as error:
                if "FileAlreadyExistsException" not in str(error):
                    raise
                return False
        finally:
            self._files.delete(draft, False)

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)


@dataclass
class Commit:
    """``number`` and what the table consists of; 0 is the empty table.

    ``folders`` maps the name of a data folder to what the writer knows of it,
    ``batches`` a streaming query to its last batch, ``dropped`` a folder that is no
    longer listed to the commit that dropped it.
    """

    number: int = 0
    folders: dict[str, dict] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    dropped: dict[str, int] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)


class CommittedTable:
    """Data folders below ``path`` and the commits that list them."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.files = Folders(spark, path)

    def latest(self) -> Commit:
        while True:
            numbers = sorted(n for n in self.files.names("_commits") if n.endswith(".json"))
            if not numbers:
                return Commit()
            try:
                return Commit(**json.loads(self.files.text(f"_commits/{numbers[-1]}")))
            except Exception as error:  # removed by a later commit's tidying since it was listed
                if "FileNotFound" not in str(error):
                    raise

    def commit(self, change: Callable[[Commit], Commit | None]) -> bool:
        """Commit what ``change`` makes of the latest commit; again if another came first.

        Nothing is committed where ``change`` returns None.
        """
        while True:
            last = self.latest()
            number = last.number + 1
            new = change(last)
            if new is None:
                return False
            new.number = number
            for name in set(last.folders) - set(new.folders):
                new.dropped[name] = number
            old = [name for name, since in new.dropped.items() if since <= number - KEPT]
            for name in old:
                del new.dropped[name]
            if self.files.create(f"_commits/{number:012d}.json", json.dumps(new.__dict__)):
                for name in old:
                    self.files.remove(f"data/{name}")
                if number > KEPT:
                    self.files.remove(f"_commits/{number - KEPT:012d}.json")
                return True

    def new_folder(self) -> str:
        return uuid.uuid4().hex

    def where(self, folder: str) -> str:
        return f"{self.path}/data/{folder}"

    def read_folders(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).schema(schema).load([self.where(name) for name in folders])

    def sweep(self, older_than: float) -> list[str]:
        """Remove data folders that no commit lists and that are ``older_than`` seconds old.

        What a killed writer left behind; the age must exceed the longest write.
        """
        last = self.latest()
        known = {name.split("/")[0] for name in (*last.folders, *last.dropped)}
        gone = [name for name, age in self.files.ages("data").items() if name not in known and age >= older_than]
        for name in gone:
            self.files.remove(f"data/{name}")
        return gone


def _query_of(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


class ManifestTable(CommittedTable):
    """A table that micro-batches are appended to, with few files however many they are.

    Every batch is there exactly once: one that is tried again after its commit is
    left out. As soon as ``merge`` folders of one level are there, they are merged
    into one of the next; a row is written again once per level, and the number of
    folders grows with the logarithm of the number of batches.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", merge: int = 8) -> None:
        super().__init__(spark, path, fmt)
        self.merge = merge

    def writer(self, shape: Callable[[DataFrame, int], DataFrame] | None = None) -> BatchFunction:
        """A per-batch sink; empty batches leave nothing behind."""

        def write(batch: DataFrame, batch_id: int) -> None:
            if not batch.isEmpty():
                self.append(shape(batch, batch_id) if shape else batch, _query_of(batch), batch_id)

        return write

    def append(self, rows: DataFrame, query: str | None = None, batch_id: int = 0) -> bool:
        """Add ``rows``; False if this batch of ``query`` is there already."""
        if query is not None and self.latest().batches.get(query, -1) >= batch_id:
            return False
        name, schema = self.new_folder(), rows.schema.json()
        rows.write.format(self.fmt).save(self.where(name))

        def add(last: Commit) -> Commit | None:
            if query is not None and last.batches.get(query, -1) >= batch_id:
                return None
            if last.notes.get("schema", schema) != schema:
                raise ValueError(f"{self.path}: the schema of the batch is not that of the table")
            batches = last.batches | ({query: batch_id} if query is not None else {})
            return Commit(0, last.folders | {name: {"level": 0}}, batches, last.dropped, last.notes | {"schema": schema})

        done = self.commit(add)
        self._merge()
        return done

    def _merge(self) -> None:
        while True:
            last = self.latest()
            levels: dict[int, list[str]] = {}
            for name, facts in last.folders.items():
                levels.setdefault(facts["level"], []).append(name)
            full = next((level for level, names in sorted(levels.items()) if len(names) >= self.merge), None)
            if full is None:
                return
            parts, name = levels[full], self.new_folder()
            whole = self.read_folders(parts, self._schema(last))
            whole.hint("rebalance").write.format(self.fmt).save(self.where(name))

            def swap(now: Commit) -> Commit | None:
                if not set(parts) <= set(now.folders):
                    return None  # another writer merged them
                rest = {k: v for k, v in now.folders.items() if k not in parts}
                return Commit(0, rest | {name: {"level": full + 1}}, now.batches, now.dropped, now.notes)

            if not self.commit(swap):
                self.files.remove(f"data/{name}")

    def _schema(self, commit: Commit) -> T.StructType:
        return T.StructType.fromJson(json.loads(commit.notes["schema"]))

    def read(self) -> DataFrame:
        """The rows of the latest commit."""
        last = self.latest()
        if "schema" not in last.notes:
            raise ValueError(f"{self.path}: nothing was committed yet")
        return self.read_folders(list(last.folders), self._schema(last))


class RunningTable(CommittedTable):
    """Running aggregates per key, stored: a stream without state that only grows.

    Each batch is aggregated by itself and merged with what is stored for its keys.
    Keys are dealt to ``buckets``; a batch rewrites the buckets its keys are in and no
    others, and its commit names the new folders of these. The table outlives the
    query: one with a new checkpoint goes on where the last one stopped. ``distinct``
    and ``approx_distinct`` cannot be merged; ``sketch_distinct`` can.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], metrics: Sequence[Metric], buckets: int = 64) -> None:
        super().__init__(spark, path)
        self.keys, self.metrics, self.buckets = list(keys), list(metrics), buckets

    def writer(self) -> BatchFunction:
        def write(batch: DataFrame, batch_id: int) -> None:
            if not batch.isEmpty():
                self.add(batch, _query_of(batch), batch_id)

        return write

    def add(self, rows: DataFrame, query: str | None = None, batch_id: int = 0) -> bool:
        """Merge ``rows`` in; False if this batch of ``query`` is in already."""
        bucket = F.pmod(F.xxhash64(*(F.col(key).cast("string") for key in self.keys)), F.lit(self.buckets)).cast("int")
        kinds = {f.name: f.dataType.json() for f in rows.schema.fields}
        parts = part_metrics(rows, self.keys, self.metrics).withColumn("_bucket", bucket)
        while True:
            last = self.latest()
            if query is not None and last.batches.get(query, -1) >= batch_id:
                return False
            held: dict[str, str] = last.notes.get("buckets", {})
            # At most ``buckets`` numbers.
            touched = [str(b) for b in parts.agg(F.collect_set("_bucket")).first()[0]]
            before = self.read_folders([held[b] for b in touched if b in held], T.StructType(parts.schema.fields))
            whole = merge_parts(parts.unionByName(before), [*self.keys, "_bucket"], self.metrics, rows.schema)
            name = self.new_folder()
            whole.withColumn("_in", F.col("_bucket")).repartition("_in").write.partitionBy("_in").parquet(self.where(name))

            def swap(now: Commit) -> Commit | None:
                same: dict[str, str] = now.notes.get("buckets", {})
                if any(same.get(b) != held.get(b) for b in touched) or now.batches != last.batches:
                    return None  # another writer was here: merge with what it wrote
                new = same | {b: f"{name}/_in={b}" for b in touched}
                batches = now.batches | ({query: batch_id} if query is not None else {})
                notes = now.notes | {"buckets": new, "schema": parts.schema.json(), "kinds": kinds}
                return Commit(0, {folder: {} for folder in {f.split("/")[0] for f in new.values()}}, batches, now.dropped, notes)

            if self.commit(swap):
                return True
            self.files.remove(f"data/{name}")

    def read(self) -> DataFrame:
        """``keys`` and ``metrics`` over all rows so far."""
        last = self.latest()
        if "buckets" not in last.notes:
            raise ValueError(f"{self.path}: nothing was committed yet")
        stored = self.read_folders(list(last.notes["buckets"].values()), T.StructType.fromJson(json.loads(last.notes["schema"])))
        kinds = T.StructType([T.StructField(k, T._parse_datatype_json_string(v)) for k, v in last.notes["kinds"].items()])
        return finish_parts(stored, self.keys, self.metrics, kinds)


class LateSplit(CommittedTable):
    """Keep late rows: each batch is cut at the watermark it runs with.

    The watermark of a batch is the greatest event time of all earlier batches less
    ``delay``. Rows at or above it, and rows without a time, go to ``on_time``, the
    others to ``late``; both are per-batch sinks that store a batch once, such as
    those of ``ManifestTable`` and ``RunningTable``. The greatest time is committed
    after both, so a batch that is tried again is cut in the same place, and a query
    with a new checkpoint goes on with it.
    """

    def __init__(self, spark: SparkSession, path: str, time: str, delay: str, on_time: BatchFunction, late: BatchFunction) -> None:
        super().__init__(spark, path)
        self.time, self.delay, self.sinks = time, delay, (on_time, late)

    def watermark(self) -> int | None:
        """The cut of the next batch in microseconds since 1970."""
        seen = self.latest().notes.get("seen")
        return None if seen is None else seen - int(self.spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL '{self.delay}')").first()[0])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        query, last = _query_of(batch), self.latest()
        if last.batches.get(query, -1) >= batch_id:
            return
        cut, at = self.watermark(), F.unix_micros(F.col(self.time).cast("timestamp"))
        is_late = F.lit(False) if cut is None else F.coalesce(at < cut, F.lit(False))
        batch.persist()
        try:
            for sink, part in zip(self.sinks, (batch.where(~is_late), batch.where(is_late))):
                sink(part, batch_id)
            newest = batch.agg(F.max(at)).first()[0]
        finally:
            batch.unpersist()

        def seen(now: Commit) -> Commit:
            most = max((x for x in (now.notes.get("seen"), newest) if x is not None), default=None)
            return Commit(0, {}, now.batches | {query: batch_id}, now.dropped, now.notes | {"seen": most})

        self.commit(seen)
