"""A keyed table that several loads may add to at once, with a key filter beside its data.

Data folders are named by commits (``commits``), so a load is seen whole or
not at all. A load reads the commit it starts from, leaves out the keys the table has,
writes what is left and commits; if another load came first, only the folders that one
added are looked at again.

Beside each data folder lies a Bloom filter of its keys as a table: the words that have
bits, in pieces per partition of the data. A key of an increment that lacks one of its
bits in a folder's filter is not in that folder, so the folder is not read for it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_folder, new_work_folder
from .commits import Commit, CommittedTable
from ..operators.etl import KeyConflict, LoadResult, NullValue

# Bits per key and bits set by each key: one key in 400 is looked for in vain.
BITS_PER_KEY, HASHES = 16, 4
_WORD = 64


def _places(key: str, size: Column) -> Column:
    """The places of a key's bits in a filter of ``size`` bits."""
    return F.array_distinct(F.array(*(F.pmod(F.xxhash64(F.lit(i), F.col(key)), size) for i in range(HASHES))))


def _bit(place: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(place).bitwiseAND(F.lit(_WORD - 1).cast("long")).cast("int"))


class KeyedTable(CommittedTable):
    """Rows with a unique key at ``path``, loaded by any number of writers."""

    def __init__(self, spark: SparkSession, path: str, key: str = "record_id", merge: int = 8) -> None:
        super().__init__(spark, path)
        self.key, self.merge = key, merge

    def load(self, incoming: DataFrame, on_conflict: str = "skip", not_null: Sequence[str] = ()) -> LoadResult:
        """Add the rows whose key the table does not have, all at once or not at all.

        A key twice in the increment raises ``KeyConflict``, and with
        ``on_conflict="error"`` so does a key that is there already; a null key, or a
        null in one of ``not_null``, raises ``NullValue``. Nothing is loaded then.
        """
        if on_conflict not in ("skip", "error"):
            raise ValueError(f"on_conflict: {on_conflict!r}")
        stage = new_work_folder(self.spark, "increment")
        name = self.new_folder()
        try:
            incoming.write.parquet(stage)
            staged = self.spark.read.schema(incoming.schema).parquet(stage)
            needed = list(dict.fromkeys([self.key, *not_null]))
            facts = staged.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(needed))).first()
            missing = [c for i, c in enumerate(needed) if facts[f"n{i}"]]
            if missing:
                raise NullValue(f"null in {', '.join(missing)}; nothing loaded")
            if not staged.groupBy(self.key).count().where("count > 1").isEmpty():
                raise KeyConflict(f"{self.key} twice in the increment; nothing loaded")
            schema = incoming.schema.json()
            looked: set[str] = set()
            fresh, loaded = staged, None
            while True:
                last = self.latest()
                if last.notes.get("schema", schema) != schema:
                    raise ValueError(f"{self.path}: the schema of the increment is not that of the table")
                unseen = [f for f in last.folders if f not in looked]
                known = self.known(fresh, unseen, staged.schema, last.folders)
                if known is not None and not known.isEmpty():
                    if on_conflict == "error":
                        raise KeyConflict(f"{self.key} of the increment already present; nothing loaded")
                    fresh, loaded = fresh.join(known, self.key, "left_anti"), None
                looked.update(unseen)
                if loaded is None:
                    self.files.remove(f"data/{name}")
                    loaded = self._store(fresh, name)
                if not loaded:
                    self.files.remove(f"data/{name}")
                    return LoadResult(facts.rows, 0)

                def add(now: Commit, looked=frozenset(looked), rows=loaded) -> Commit | None:
                    if set(now.folders) - looked:
                        return None  # another load came first: look at what it added
                    entry = {name: self._facts(rows, 0)}
                    return Commit(0, now.folders | entry, now.batches, now.dropped, now.notes | {"schema": schema})

                if self.commit(add):
                    self._merge()
                    return LoadResult(facts.rows, loaded)
        except BaseException:
            if name not in self.latest().folders:
                self.files.remove(f"data/{name}")
            raise
        finally:
            drop_folder(self.spark, stage)

    @staticmethod
    def _facts(rows: int, level: int) -> dict:
        """Filters have a power of two of bits, so that there are few sizes to look a key up in."""
        return {"rows": rows, "level": level, "bits": max(_WORD, 1 << (rows * BITS_PER_KEY - 1).bit_length())}

    def _store(self, rows: DataFrame, name: str) -> int:
        """Write rows and their filter; how many there are."""
        rows.write.parquet(self.where(f"{name}/rows"))
        stored = self.spark.read.schema(rows.schema).parquet(self.where(f"{name}/rows"))
        count = stored.count()
        size = self._facts(count, 0)["bits"] if count else _WORD
        places = stored.select(F.explode(_places(self.key, F.lit(size).cast("long"))).alias("place"))
        words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(_bit("place")).alias("bits"))
        words.select(F.lit(name).alias("folder"), F.lit(size).cast("long").alias("size"), "word", "bits").write.parquet(self.where(f"{name}/filter"))
        return count

    def _merge(self) -> None:
        """Folders of one level into one of the next, as soon as there are ``merge`` of them."""
        while True:
            last = self.latest()
            levels: dict[int, list[str]] = {}
            for folder, facts in last.folders.items():
                levels.setdefault(facts["level"], []).append(folder)
            full = next((level for level, folders in sorted(levels.items()) if len(folders) >= self.merge), None)
            if full is None:
                return
            parts, name = levels[full], self.new_folder()
            schema = T.StructType.fromJson(json.loads(last.notes["schema"]))
            rows = self._store(self.read_folders([f"{part}/rows" for part in parts], schema).hint("rebalance"), name)

            def swap(now: Commit) -> Commit | None:
                if not set(parts) <= set(now.folders):
                    return None  # another load merged them
                rest = {folder: facts for folder, facts in now.folders.items() if folder not in parts}
                return Commit(0, rest | {name: self._facts(rows, full + 1)}, now.batches, now.dropped, now.notes)

            if not self.commit(swap):
                self.files.remove(f"data/{name}")

    def candidates(self, incoming: DataFrame, folders: Sequence[str], facts: dict[str, dict]) -> DataFrame:
        """``folder, key``: all pairs that the filters do not rule out."""
        filters = self.spark.read.schema("folder string, size long, word long, bits long").parquet(*(self.where(f"{f}/filter") for f in folders))
        sizes = sorted({facts[folder]["bits"] for folder in folders})
        keys = incoming.select(F.col(self.key).alias("key"))
        sized = keys.select("key", F.explode(F.array(*(F.lit(size).cast("long") for size in sizes))).alias("size"))
        placed = sized.withColumn("places", _places("key", F.col("size"))).withColumn("wanted", F.size("places"))
        asked = placed.select("key", "size", "wanted", F.explode("places").alias("place")).withColumn("word", F.shiftright("place", 6))
        hits = asked.join(filters, ["size", "word"]).where(F.col("bits").bitwiseAND(_bit("place")) != 0)
        whole = hits.groupBy("folder", "key").agg(F.count(F.lit(1)).alias("found"), F.first("wanted").alias("wanted"))
        return whole.where("found = wanted").select("folder", "key")

    def known(self, incoming: DataFrame, folders: Sequence[str], schema: T.StructType, facts: dict[str, dict]) -> DataFrame | None:
        """Keys of ``incoming`` in these folders; None where no folder can have one."""
        if not folders:
            return None
        asked = self.candidates(incoming, folders, facts)
        # Which folders have to be read: a set no larger than the commit that lists them.
        read = asked.agg(F.collect_set("folder")).first()[0]
        if not read:
            return None
        held = self.read_folders([f"{folder}/rows" for folder in read], schema).select(self.key)
        likely = asked.select(F.col("key").alias(self.key)).distinct()
        return held.join(likely, self.key, "left_semi").select(self.key)

    def read(self) -> DataFrame:
        last = self.latest()
        if "schema" not in last.notes:
            raise ValueError(f"{self.path}: nothing was loaded yet")
        return self.read_folders([f"{folder}/rows" for folder in last.folders], T.StructType.fromJson(json.loads(last.notes["schema"])))
