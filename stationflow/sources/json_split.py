"""One big JSON document, read by many tasks.

The file is cut at every ``}``, which Spark's text source does in splits of any size.
A piece cannot know whether it begins inside a string or how deep it is, so each is
measured for both cases: its quotes, its net depth and its least depth. Running sums
over the pieces in order -- within a split by a window, over the splits by one row
each -- then tell every piece where it stands, and the pieces of one record are put
together and parsed. Only the measures are sorted; texts move once, to their records.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = ["source_file", "block"]


def _outside(text: Column, inside: bool) -> Column:
    """What stands outside strings, if the text begins ``inside`` one or not."""
    kept = F.filter(F.split(text, '"'), lambda _, i: i % 2 == (1 if inside else 0))
    return F.regexp_replace(F.array_join(kept, ""), r"[^\[\]{}]", "")


def _plain(text: Column) -> Column:
    """Without escaped characters, so that every quote left begins or ends a string."""
    return F.regexp_replace(text, r"(?s)\\.", "")


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"')))


def _net(brackets: Column) -> Column:
    closing = F.length(F.regexp_replace(brackets, r"[\[{]", ""))
    return F.length(brackets) - 2 * closing


def _least(brackets: Column) -> Column:
    """The least depth reached, from 0 at the beginning on."""
    step = lambda s, c: F.struct(
        (s["d"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("d"),
        F.least(s["m"], s["d"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("m"),
    )
    chars = F.filter(F.split(brackets, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit(0).alias("d"), F.lit(0).alias("m")), step, lambda s: s["m"])


def _measured(text: Column, inside: bool) -> Column:
    """Quotes, net and least depth of a piece and the ``}`` after it."""
    plain = _plain(text)
    ends_outside = (_quotes(plain) + (1 if inside else 0)) % 2 == 0
    brackets = F.concat(_outside(plain, inside), F.when(ends_outside, F.lit("}")).otherwise(F.lit("")))
    return F.struct(_net(brackets).alias("net"), _least(brackets).alias("least"), ends_outside.alias("closes"))


def _before(block_sums: DataFrame, value: Column, name: str) -> DataFrame:
    """``name``: the sum over the earlier splits of a file."""
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return block_sums.select(*_KEY, F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(name))


def split_json_array(
    spark: SparkSession, path: str, schema: T.StructType, work: str, field: str | None = None
) -> DataFrame:
    """The records of big JSON files, each file read by as many tasks as it has splits.

    A file is an array of objects, or with ``field`` an object that has the array under
    that name (again and again, if it comes more than once). Returns the columns of
    ``schema`` with ``source_file`` and ``ordinal``, which counts a file's records from
    0. Elements that are no objects are left out; a record that does not parse is a row
    of nulls, as in ``from_json``. ``work`` is a folder in shared storage, not there
    yet, for the pieces and their measures.
    """
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("text"),
    )
    plain = _plain(F.col("text"))
    opener = None if field is None else rf'"{re.escape(field)}"\s*:\s*\['
    measured = raw.select(
        *_KEY, "seq", "text", _quotes(plain).alias("quotes"), _measured(F.col("text"), False).alias("m0"), _measured(F.col("text"), True).alias("m1"),
        (F.col("text").rlike(opener) if opener else F.lit(False)).alias("named"),
    )
    measured.write.parquet(f"{work}/pieces")
    pieces = spark.read.schema(measured.schema).parquet(f"{work}/pieces")

    # Does a piece begin inside a string? The parity of all quotes before it.
    here = Window.partitionBy(*_KEY).orderBy("seq")
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    quoted = _before(pieces.groupBy(*_KEY).agg(F.sum("quotes").alias("q")), F.col("q"), "quotes_before")
    sums = pieces.drop("text").join(quoted, _KEY)
    begins = (F.col("quotes_before") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2
    sums = sums.withColumn("inside", begins == 1)
    sums = sums.withColumn("m", F.when(F.col("inside"), F.col("m1")).otherwise(F.col("m0"))).drop("m0", "m1", "quotes", "quotes_before")
    sums.write.parquet(f"{work}/strings")
    sums = spark.read.schema(sums.schema).parquet(f"{work}/strings")

    # How deep does it begin?
    deep = _before(sums.groupBy(*_KEY).agg(F.sum("m.net").alias("d")), F.col("d"), "depth_before")
    placed = sums.join(deep, _KEY)
    placed = placed.withColumn("depth", F.col("depth_before") + F.coalesce(F.sum("m.net").over(earlier), F.lit(0)))
    level = 1 if field is None else 2
    ends_at = F.col("depth") + F.col("m.net")
    if field is None:
        placed = placed.withColumns({"opened": F.lit(None).cast("int"), "open": F.lit(True)})
    else:
        texts = pieces.where("named").select(*_KEY, "seq", "text")
        found = placed.where("named").select(*_KEY, "seq", "inside", "depth").join(texts, [*_KEY, "seq"])
        found = found.select(*_KEY, "seq", _opened(opener, field).alias("opened")).where("opened IS NOT NULL")
        placed = placed.join(found, [*_KEY, "seq"], "left")
        # Pieces that come up to the document's own level close what was open, unless they open the array.
        touches = (F.col("depth") <= 1) | (F.col("depth") + F.col("m.least") <= 1)
        told = F.when(F.col("opened").isNotNull(), True).when(touches, False)
        placed = placed.withColumn("told", told)
        last = F.max_by("told", F.when(F.col("told").isNotNull(), F.col("seq")))
        over = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sofar = placed.groupBy(*_KEY).agg(last.alias("told_last")).select(*_KEY, F.last("told_last", True).over(over).alias("told_before"))
        placed = placed.join(sofar, _KEY)
        placed = placed.withColumn("open", F.coalesce(F.last("told", True).over(here), F.col("told_before"), F.lit(False)))
    ends = F.col("m.closes") & F.col("open") & (ends_at == level)
    placed = placed.select(*_KEY, "seq", "opened", "open", ends.alias("ends"))
    placed.write.parquet(f"{work}/places")
    placed = spark.read.schema(placed.schema).parquet(f"{work}/places")

    # Which record is it of? A record goes on until it ends; an array that opens begins a new one.
    steps = placed.groupBy(*_KEY).agg(F.count_if("ends").alias("e"), F.count("opened").alias("o"))
    in_file = steps.groupBy("source_file").agg(F.sum("e").alias("ends_in_file"))
    steps = _before(steps, F.col("e"), "ends_before").join(_before(steps, F.col("o"), "opens_before"), _KEY).join(in_file, "source_file")
    numbered = placed.join(steps, _KEY).select(
        *_KEY, "seq", "opened", "open", "ends", "ends_in_file",
        (F.col("ends_before") + F.coalesce(F.count_if("ends").over(earlier), F.lit(0))).alias("ordinal"),
        (F.col("opens_before") + F.count("opened").over(here)).alias("array"),
    )
    # What stands outside the array, or after the last record's end, is of no record, and would be one group however long it is.
    numbered = numbered.where(F.col("open") & (F.col("ordinal") < F.col("ends_in_file"))).drop("open", "ends_in_file")
    text = F.col("text")
    if field is not None:
        parts = F.split("text", opener)
        rest = F.array_join(F.slice(parts, F.col("opened") + 1, F.size(parts)), f'"{field}":[')
        text = F.when(F.col("opened").isNotNull(), rest).otherwise(text)
    whole = numbered.join(pieces.select(*_KEY, "seq", "text"), [*_KEY, "seq"]).groupBy("source_file", "array", "ordinal").agg(
        F.max("ends").alias("ends"), F.array_sort(F.collect_list(F.struct("block", "seq", F.concat(text, F.lit("}")).alias("text")))).alias("texts")
    )
    record = F.regexp_replace(F.array_join("texts.text", ""), r"^[\s,\[\x{FEFF}]+", "")
    found = whole.where("ends").select("source_file", "ordinal", record.alias("text"))
    # Elements that are no objects stand before the record they come with.
    alone = F.element_at(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>"), -1)
    text = F.when(F.col("text").startswith("{"), F.col("text")).otherwise(alone)
    parsed = found.select("source_file", "ordinal", F.from_json(text, schema).alias("r"))
    return parsed.select("source_file", "ordinal", "r.*")


def _opened(opener: str, field: str) -> Column:
    """Which of the places where the name stands opens the array that is open at the end; else null."""
    parts, name = F.split("text", opener), f'"{field}":['
    begins = F.when(F.col("inside"), 1).otherwise(0)

    def opens(k: Column) -> Column:
        front = _plain(F.array_join(F.slice(parts, 1, k), name))
        rest = _plain(F.array_join(F.slice(parts, k + 1, F.size(parts)), name))
        outside = F.when(F.col("inside"), _outside(front, True)).otherwise(_outside(front, False))
        after = F.concat(_outside(rest, False), F.when(_quotes(rest) % 2 == 0, F.lit("}")).otherwise(F.lit("")))
        at_name = (begins + _quotes(front)) % 2 == 0
        return at_name & (F.col("depth") + _net(outside) == 1) & (_least(after) >= 0)

    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: (k < F.size(parts)) & opens(k))
    return F.try_element_at(places, F.lit(-1))
