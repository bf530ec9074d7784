"""Near-duplicates by a multi-index join of MinHash signatures.

A signature is 64 min-hashes of a document's word shingles, cut to 8 bits each. Two
documents of similarity J differ in about (1 - J) of the places. The places are split
into 13 chunks. If two signatures differ in at most 25 places, some chunk differs in
at most one (pigeonhole): so each chunk is indexed with every single place left out
in turn, and every such pair meets under some key. At similarity 0.85, the chance of
more than 25 differing places is below one in a million. ``signature_for`` makes the
numbers of places and chunks that hold the same chance at a lower similarity.

A key never yields all its pairs. Documents of one set of shingles are one class.
Each class is checked, on full sets, against the hub of its key: the class that meets
most others. Where all classes of a key have come together by that, it is done.
Classes whose keys are still divided are compared through their rarest shingles: two
sets that are alike enough share one of so many of them as follows from their sizes.
Pairs of different components that meet so, and are within the signature distance,
are checked on full sets, and no link is lost. Joins are merge joins, so that neither
links nor signatures pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_work_folder
from . import arrays as A
from .components import components
from .shipping import ship
from .steps import stored

SHINGLE = 5
PLACES = 64
# Chance that a pair at the similarity a signature is made for stays unseen.
MISSED = 1e-6
_MOST = 256


@dataclass(frozen=True)
class Signature:
    """``places`` in ``chunks``; pairs at ``percent`` or more differ in at most ``distance``.

    2 * ``chunks`` must exceed ``distance``, or no chunk is sure to differ in one place at most.
    """

    percent: int
    places: int
    chunks: int
    distance: int

    @property
    def bounds(self) -> np.ndarray:
        return np.linspace(0, self.places, self.chunks + 1).round().astype(int)


@cache
def signature_for(percent: int) -> Signature:
    """The fewest places whose chunks are as long as those for 85 percent, or longer.

    Shorter chunks would make keys that unlike documents share by chance.
    """
    apart = 1 - percent / 100
    for places in range(PLACES, _MOST + 1, 8):
        beyond, distance = 0.0, places
        while distance > 0:
            more = math.comb(places, distance) * apart**distance * (1 - apart) ** (places - distance)
            if beyond + more > MISSED:
                break
            beyond, distance = beyond + more, distance - 1
        chunks = distance // 2 + 1
        if 13 * places >= PLACES * chunks:
            return Signature(percent, places, chunks, distance)
    raise ValueError(f"signature_for: {_MOST} places do not do for {percent} percent")


SIGNATURE = signature_for(85)

_RANDOM = np.random.default_rng(85)
_FLIP = _RANDOM.integers(0, 2**64, PLACES, dtype=np.uint64)
_FACTOR = _RANDOM.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = np.concatenate([_FLIP, _RANDOM.integers(0, 2**64, _MOST - PLACES, dtype=np.uint64)])
_FACTOR = np.concatenate([_FACTOR, _RANDOM.integers(0, 2**63, _MOST - PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])

_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, signature array<long>"


def block_shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within a text, and the text each is of."""
    data, offsets = A.text_bytes(column)
    data = A.lowered(data)
    starts, ends = A.runs(A.SPACED_WORD[data], offsets)
    of = A.owner(offsets, starts)
    term = A.word_hash(data, starts, ends)
    n = len(offsets) - 1
    words = np.bincount(of, minlength=n)
    first = np.cumsum(words) - words
    sizes = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    at = A.ragged(first, sizes)
    text = np.repeat(np.arange(n), sizes)
    left = np.repeat(first + words, sizes) - at
    value = np.zeros(len(at), np.uint64)
    for k in range(size):  # a text of fewer words is one shorter shingle
        more = left > k
        step = A.mix(value + term[np.minimum(at + k, max(len(term) - 1, 0))]) if len(at) else value
        value = np.where(more, step, value)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    once = A.first_of_run(text, value)
    return value[once], text[once]


def _signatures(value: np.ndarray, sizes: np.ndarray, places: int) -> np.ndarray:
    """One row of longs per text that has shingles: 8 places of 8 bits each."""
    heads = (np.cumsum(sizes) - sizes)[sizes > 0]
    low = np.empty((len(heads), places), np.uint64)
    for i in range(places):
        low[:, i] = np.minimum.reduceat((value ^ _FLIP[i]) * _FACTOR[i], heads)
    return (A.mix(low) >> np.uint64(56)).astype(np.uint8).view(np.int64)


def signed(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = SHINGLE, places: int = PLACES,
) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, signature`` per row of ``docs``.

    ``set_a, set_b`` are 128 bits that stand for the whole set; a text without
    words has no shingles and no signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in A.blocks(batches):
            value, of = block_shingles(block.column("text"), size)
            n = block.num_rows
            sizes = np.bincount(of, minlength=n)
            some = sizes > 0
            heads = (np.cumsum(sizes) - sizes)[some]
            sets = np.zeros((2, n), np.uint64)
            if len(heads):
                sets[0, some] = np.add.reduceat(A.mix(value), heads)
                sets[1, some] = np.add.reduceat(A.mix(value ^ _FLIP[0]), heads)
            marks = _signatures(value, sizes, places) if len(heads) else np.zeros((0, places // 8), np.int64)
            ends = np.concatenate(([0], np.cumsum(np.where(some, places // 8, 0))))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), pa.array(sizes.astype(np.int64)),
                    pa.array(sets[0].view(np.int64)), pa.array(sets[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(marks.ravel())),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )

    picked = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(sign, _SIGNED)


def _places(marks: pa.Array, places: int) -> np.ndarray:
    """Signatures as rows of one byte per place."""
    return marks.flatten().to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, places)


def keyed(classes: DataFrame, signature: Signature) -> DataFrame:
    """``key, id`` per key of ``id, signature``: each chunk with each of its places left out."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = _places(batch.column("signature"), signature.places).astype(np.uint64)
            keys = []
            for chunk in range(signature.chunks):
                places = range(*signature.bounds[chunk : chunk + 2].tolist())
                for out in places:
                    # Chunk and place left out, then five bytes at most: one long, no hashing.
                    key = np.full(len(marks), chunk * signature.places + out, np.uint64)
                    for p in places:
                        if p != out:
                            key = key << np.uint64(8) | marks[:, p]
                    keys.append(key)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(ids, len(keys)))], ["key", "id"]
            )

    return classes.select("id", "signature").mapInArrow(spread, "key long, id long")


def places_apart(a: str, b: str, places: int = PLACES) -> Column:
    """In how many of the places two signatures differ."""
    ones = F.lit(0x0101010101010101)
    total = F.lit(0)
    for i in range(places // 8):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(_SPREAD[shift])))
        total = total + F.bit_count(x.bitwiseAND(ones))
    return total


# Bits that may come from the same byte when it is shifted right.
_SPREAD = {4: 0x0F0F0F0F0F0F0F0F, 2: 0x3F3F3F3F3F3F3F3F, 1: 0x7F7F7F7F7F7F7F7F}


def _sets(docs: DataFrame, ids: DataFrame, doc: str, text: str, size: int, places: int) -> DataFrame:
    """``set, id, shingles, signature`` of the documents named in ``ids``; ``set`` numbers the rows."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in A.blocks(batches):
            value, of = block_shingles(block.column("text"), size)
            ends = np.searchsorted(of, np.arange(block.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value.view(np.int64)))
            marks = _signatures(value, np.diff(ends), places)
            each = pa.array(np.concatenate(([0], np.cumsum(np.where(np.diff(ends) > 0, places // 8, 0)))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), lists, pa.ListArray.from_arrays(each, pa.array(marks.ravel()))], ["id", "shingles", "signature"]
            )

    texts = docs.select(F.col(doc).cast("long").alias("id"), F.col(text).alias("text"))
    made = texts.join(ids, "id", "left_semi").mapInArrow(make, "id long, shingles array<long>, signature array<long>")
    return made.withColumn("set", F.monotonically_increasing_id())


def _rare_pairs(sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of different parts whose sets may be alike enough.

    Shingles are ranked by how many of the sets have them, the rarest first. Of two
    sets that are alike enough, the smaller (of one size: that with the rarer ones)
    has a common shingle among its first ``short`` ranks, and the other among its
    first ``long`` ranks; what is left behind both ranks must suffice as well.
    """
    whole = 100 + percent
    each = sets.select("set", "id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    many = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("many"))
    counted = each.join(many, "shingle")
    alone = counted.groupBy("set").agg(F.count_if(F.col("many") == 1).alias("alone"))
    met = counted.where("many > 1").join(alone, "set")
    order = Window.partitionBy("set").orderBy("many", "shingle")
    ranked = met.withColumn("rank", F.col("alone") + F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    short = F.col("rank") <= F.col("n") - F.ceil(2 * percent * F.col("n") / whole) + 1
    rarity = F.max(F.when(short, F.col("many"))).over(Window.partitionBy("set"))
    ranked = ranked.withColumns({"short": short, "rarity": F.coalesce(rarity, F.lit(0))})
    ranked = ranked.join(parts.toDF("id", "part"), "id", "left").withColumn("part", F.coalesce("part", "id"))
    names = ("set", "id", "n", "shingle", "rank", "rarity", "part")
    x = ranked.where("short").select(*(F.col(c).alias(f"x_{c}") for c in names))
    y = ranked.select(*(F.col(c).alias(f"y_{c}") for c in names))
    first = F.struct("x_n", "x_rarity", "x_set") < F.struct("y_n", "y_rarity", "y_set")
    left = 1 + F.least(F.col("x_n") - F.col("x_rank"), F.col("y_n") - F.col("y_rank"))
    enough = (whole * left >= percent * (F.col("x_n") + F.col("y_n"))) & (100 * F.col("x_n") >= percent * F.col("y_n"))
    pairs = x.join(y, (F.col("x_shingle") == F.col("y_shingle")) & (F.col("x_part") != F.col("y_part")) & enough & first)
    return pairs.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, signature: Signature) -> DataFrame:
    """The pairs within the signature distance whose full sets are alike enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = (_places(batch.column("mark_a"), signature.places) != _places(batch.column("mark_b"), signature.places)).sum(axis=1)
            batch = batch.filter(pa.array(apart <= signature.distance))
            # A shingle of both sets of a pair stands next to itself.
            sizes = [np.diff(batch.column(c).offsets.to_numpy()) for c in ("of_a", "of_b")]
            row = np.concatenate([np.repeat(np.arange(batch.num_rows), n) for n in sizes])
            value = np.concatenate([batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("of_a", "of_b")])
            order = np.lexsort((value, row))
            twice = ~A.first_of_run(row[order], value[order])
            both = np.bincount(row[order][twice], minlength=batch.num_rows)
            keep = pa.array(100 * both >= percent * (sizes[0] + sizes[1] - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"), F.col("signature").alias("mark_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"), F.col("signature").alias("mark_b"))
    held = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return held.select("a", "b", "of_a", "of_b", "mark_a", "mark_b").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = 85,
    signature: Signature | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, kept`` per row of ``docs``.

    Documents are linked where 100 * intersection >= ``percent`` * union of their
    distinct shingles. ``component_id`` is the least id reached, ``n_links`` how many
    links of the row's class were looked at and confirmed. A text without words, or
    null, has no shingles and is its own component. Rows that share an id are one
    document: what links one links all. Rows with a null id make no links: they have
    the component of rows with the same set, or null, and are kept. Very long texts
    are taken whole; other columns are not read; no rows give no rows. ``signature``
    is made for ``percent`` unless given, and must not be made for more.
    """
    signature = signature or signature_for(min(percent, SIGNATURE.percent))
    if percent < signature.percent:
        raise ValueError(f"near_duplicates: the signature is made for {signature.percent} percent or more")
    spark = ship(docs.sparkSession)
    folder = new_work_folder(spark, "near-dedup")
    every = stored(signed(docs, doc, text, size, signature.places), f"{folder}/signed")

    # One class per set of shingles, under the least id that has it.
    on_set = ["n_shingles", "set_a", "set_b"]
    worded = every.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = worded.groupBy(*on_set).agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"))
    classes = stored(classes, f"{folder}/classes")

    # Keys that classes meet under. The count is combined before it is shuffled.
    keys = keyed(classes, signature)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    meeting = stored(keys.join(shared, "key").select("key", "id", "n"), f"{folder}/meeting")
    sets = stored(_sets(docs, meeting.select("id").distinct(), doc, text, size, signature.places), f"{folder}/sets")

    # Every class against the hub of its keys.
    met = meeting.groupBy("id").agg(F.sum("n").alias("met"))
    hubs = meeting.select("key", "id").join(met.hint("merge"), "id").groupBy("key").agg(F.max_by("id", "met").alias("a"))
    stars = meeting.join(hubs.hint("merge"), "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    links = stored(_linked(stars, sets, percent, signature), f"{folder}/links")
    joined = stored(components(links, f"{folder}/first").toDF("id", "part"), f"{folder}/joined")

    # Classes whose keys are still divided, through their rarest shingles.
    placed = meeting.join(joined.hint("merge"), "id", "left").select("key", "id", F.coalesce("part", "id").alias("part"))
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    divided = stored(placed.join(mixed.select("key").hint("merge"), "key").select("id").distinct(), f"{folder}/divided")
    parts = joined.toDF("id", "component_id")
    if not divided.isEmpty():
        rest = stored(_rare_pairs(sets.join(divided.hint("merge"), "id", "left_semi"), joined, percent), f"{folder}/rest")
        more = stored(_linked(rest, sets, percent, signature), f"{folder}/more")
        if not more.isEmpty():
            # What these links add is between parts, of which there are few left.
            ends = {side: joined.toDF(side, f"part_{side}") for side in ("a", "b")}
            across = more.join(ends["a"].hint("merge"), "a", "left").join(ends["b"].hint("merge"), "b", "left")
            across = across.select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
            whole = stored(components(across, f"{folder}/last").toDF("part", "component_id"), f"{folder}/whole")
            lone = more.select(F.explode(F.array("a", "b")).alias("id")).select("id", F.col("id").alias("part"))
            named = joined.union(lone).groupBy("id").agg(F.min("part").alias("part")).join(whole.hint("merge"), "part", "left")
            parts = named.select("id", F.coalesce("component_id", "part").alias("component_id"))
            links = links.union(more).distinct()

    degree = links.select(F.explode(F.array("a", "b")).alias("id"))
    told = parts.withColumn("one", F.lit(0)).unionByName(degree.select("id", F.lit(None).cast("long").alias("component_id"), F.lit(1).alias("one")))
    told = told.groupBy("id").agg(F.min("component_id").alias("component_id"), F.sum("one").alias("n_links"))
    named = classes.drop("signature").join(told.hint("merge"), "id", "left")
    named = named.select(*on_set, F.coalesce("component_id", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    found = every.drop("signature").join(named.hint("merge"), on_set, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay when each group keeps its document of least id.

    Rows that share an id are one document and stay or go together; rows with a null
    id stay.
    """
    gone = near_duplicates(docs, doc, text, **settings).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[doc] == gone["_gone"], "left_anti")


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
