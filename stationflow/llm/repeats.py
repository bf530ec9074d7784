"""Removal of repeated passages by anchors, in two steps of buckets.

This is not the refinement of bucket pointers, which sorts every position again on
the bucket identifiers of later offsets: that shuffles some twenty bytes or more per
byte of text in each round, beyond a budget of four times the input. One position in
30 is enough here, and two steps instead of rounds.

A byte goes if some 100-byte string covering it also starts earlier. Every such
string holds an anchor: the 32-byte string of least hash among the 69 inside it, so
equal strings have equal anchors at equal places, and about one position in 30 is an
anchor. The first buckets are the anchors' 32-byte strings. A bucket of one anchor is
done. The others are refined by what stands at later (and earlier) offsets: first by
the whole surroundings of the anchor, all that its 100-byte strings can reach; an
anchor whose surroundings are found earlier is settled as a whole. Buckets that then
still hold different surroundings are refined down to single 100-byte strings.

Texts are packed into segments, which are stored once. A segment settles what it can
by itself and sends one row per key, so the most frequent passage comes once per
segment, not once per document. Buckets with very many surroundings are dealt out by
the hash of the 100-byte string instead of by anchor; both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_work_folder
from . import arrays as A
from .shipping import ship
from .steps import stored

LENGTH = 100
GRAM = 32
# Surroundings of one anchor that a segment sends; of more, the bucket is dealt out.
SENT = 4
# Surroundings in a bucket that one task refines; more are dealt out.
TOGETHER = 64
# Bytes of text per segment, and per bucket of the shuffles.
SEGMENT_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20

_LAST = np.iinfo(np.int64).max
_SETTLED, _TOGETHER, _DEALT = 1, 2, 3
_SEGMENTS = "segment long, doc_ids array<long>, ends array<int>, size int, packed binary"
_ROWS = "bucket long, kind int, segment long, n int, m int, packed binary"
_FLAGS = "segment long, n int, packed binary"


def _pack(*columns: np.ndarray) -> bytes:
    """Columns by bytes of equal weight, which compress better than rows."""
    parts = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() if len(c) else b"" for c in columns]
    return pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _unpack(packed: bytes, *shapes: tuple[int, type]) -> list[np.ndarray]:
    sizes = [n * np.dtype(kind).itemsize for n, kind in shapes]
    data = np.frombuffer(pa.decompress(packed, sum(sizes), codec="zstd", asbytes=True), np.uint8) if sum(sizes) else np.zeros(0, np.uint8)
    out, at = [], 0
    for (n, kind), size in zip(shapes, sizes):
        wide = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + size].reshape(wide, n).T).view(kind).reshape(n) if n else np.zeros(0, kind))
        at += size
    return out


def pack_segments(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents packed into segments of about two megabytes, one row each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for block in A.blocks(batches, size=SEGMENT_BYTES):
            data, offsets = A.text_bytes(block.column("text"))
            n = block.num_rows
            one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(values, kind))
            ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), block.column("doc_id"))
            packed = pa.compress(data.tobytes(), codec="zstd", asbytes=True) if len(data) else b""
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment]), ids, one(offsets[1:], pa.int32()), pa.array([len(data)], pa.int32()), pa.array([packed], pa.binary())],
                ["segment", "doc_ids", "ends", "size", "packed"],
            )
            segment += 1

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(pack, _SEGMENTS)


class Segment:
    """The bytes of a segment, and its anchors, where asked for."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        get = lambda name: batch.column(name)[i]
        self.number, size = get("segment").as_py(), get("size").as_py()
        self.data = np.frombuffer(pa.decompress(get("packed").as_py(), size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
        self.offsets = np.concatenate(([0], get("ends").values.to_numpy().astype(np.int64)))
        ids = get("doc_ids").values
        self.has_id = ids.is_valid().to_numpy(zero_copy_only=False)
        # A null id comes after all others.
        self.ids = ids.fill_null(_LAST).to_numpy()

    def find_anchors(self) -> bool:
        """Sets, per anchor, ``at``, ``gram``, ``around``, ``left``, ``right``, ``doc_id`` and
        ``low`` to ``high``, the starts of the 100-byte strings it stands for."""
        n = len(self.data)
        if n < LENGTH:
            return False
        self.sums = A.prefix_hash(self.data)
        gram = A.span_hash(self.sums, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
        # Least hash first, then the leftmost.
        rank = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
        width, span = LENGTH - GRAM + 1, 1
        while 2 * span <= width:
            rank = np.minimum(rank[:-span], rank[span:])
            span *= 2
        rank = np.minimum(rank[: len(rank) - (width - span)], rank[width - span :])
        sizes = np.maximum(np.diff(self.offsets) - LENGTH + 1, 0)
        starts = A.ragged(self.offsets[:-1], sizes)
        if not len(starts):
            return False
        of = (rank[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        head = A.first_of_run(of, np.repeat(np.arange(len(sizes)), sizes))
        heads = np.flatnonzero(head)
        self.at, self.gram = of[heads], gram[of[heads]]
        self.low, self.high = starts[heads], starts[np.append(heads[1:], len(starts)) - 1]
        doc = A.owner(self.offsets, self.at)
        self.doc_id = self.ids[doc]
        self.left = np.maximum(self.at - (LENGTH - GRAM), self.offsets[doc])
        self.right = np.minimum(self.at + LENGTH, self.offsets[doc + 1])
        self.around = A.mix(A.span_hash(self.sums, self.left, self.right) + (self.at - self.left).astype(np.uint64))
        # Within the segment: the first anchor of each surroundings, and how many of these a bucket has.
        order = np.lexsort((self.at, self.doc_id, self.around, self.gram))
        first = A.first_of_run(self.gram[order], self.around[order])
        self.repeat = np.zeros(len(self.at), bool)
        self.repeat[order[~first]] = True
        kept = order[first]
        bucket_head = A.first_of_run(self.gram[kept])
        heads = np.flatnonzero(bucket_head)
        sizes = np.diff(heads, append=len(kept))
        nth = np.arange(len(kept)) - np.repeat(heads, sizes)
        self.sent = kept[nth < SENT]
        self.unsent = kept[nth >= SENT]
        self.crowded = (np.repeat(sizes, sizes) > SENT)[nth < SENT]
        return True


def _rows(bucket_of: np.ndarray, buckets: int, kind: int, segment: int, columns: list[np.ndarray], bodies=None) -> Iterator[tuple]:
    """Rows for the shuffle: the entries of each bucket packed together."""
    order = np.argsort(bucket_of, kind="stable")
    cuts = np.searchsorted(bucket_of[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        pick = order[cuts[b] : cuts[b + 1]]
        body = np.concatenate([bodies[i] for i in pick]) if bodies else np.zeros(0, np.uint8)
        yield int(b), kind, segment, len(pick), len(body), _pack(*(c[pick] for c in columns), body)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "kind": pa.int32(), "segment": pa.int64(), "n": pa.int32(), "m": pa.int32(), "packed": pa.binary()}
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, k in zip(columns, names)], names)


_ROW_NAMES = ["bucket", "kind", "segment", "n", "m", "packed"]
_ANCHOR = (np.uint64, np.uint64, np.int64, np.uint32, np.bool_)
_STRING = (np.uint64, np.int64, np.uint32)
_AROUND = (np.int64, np.uint32, np.uint8, np.uint8, np.uint8)


def anchor_rows(segments: DataFrame, buckets: int) -> DataFrame:
    """The anchors of all segments, dealt out by their 32-byte strings."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = Segment(batch, i)
                if s.find_anchors():
                    pick = s.sent[np.argsort(s.gram[s.sent])]
                    crowded = s.crowded[np.argsort(s.gram[s.sent])]
                    columns = [s.gram[pick], s.around[pick], s.doc_id[pick], s.at[pick].astype(np.uint32), crowded]
                    bucket = (A.mix(s.gram[pick]) % np.uint64(buckets)).astype(np.int64)
                    yield _batch(list(_rows(bucket, buckets, 0, s.number, columns)), _ROW_NAMES)

    return segments.mapInArrow(send, _ROWS)


def _gathered(table: pa.Table, shapes: tuple) -> tuple[list[np.ndarray], np.ndarray]:
    """The entries of all rows, and the segment of each."""
    parts = [_unpack(p.as_py(), *((n, k) for k in shapes)) for n, p in zip(table["n"].to_pylist(), table["packed"])]
    columns = [np.concatenate(c) for c in zip(*parts)]
    return columns, np.repeat(table["segment"].to_numpy(), table["n"].to_numpy())


def _flag_rows(segment: np.ndarray, at: np.ndarray, flag: np.ndarray) -> pa.Table:
    order = np.lexsort((at, segment))
    segment, at, flag = segment[order], at[order], flag[order]
    heads = np.flatnonzero(A.first_of_run(segment))
    ends = np.append(heads[1:], len(segment))
    rows = [(int(segment[a]), int(b - a), _pack(at[a:b].astype(np.uint32), flag[a:b].astype(np.uint8))) for a, b in zip(heads, ends)]
    return pa.Table.from_batches([_batch(rows, ["segment", "n", "packed"])])


def flag_anchors(rows: DataFrame) -> DataFrame:
    """Per segment: anchors that are settled, and those whose buckets go on."""

    def refine(table: pa.Table) -> pa.Table:
        (gram, around, doc_id, at, crowded), segment = _gathered(table, _ANCHOR)
        order = np.lexsort((at, segment, doc_id, around, gram))
        gram, around, at, segment, crowded = gram[order], around[order], at[order], segment[order], crowded[order]
        head = A.first_of_run(gram)
        bucket = np.cumsum(head) - 1
        first = A.first_of_run(gram, around)
        different = np.bincount(bucket, first)[bucket]
        full = (np.bincount(bucket, crowded)[bucket] > 0) | (different > TOGETHER)
        flag = np.where(~first, _SETTLED, np.where(full, _DEALT, np.where(different > 1, _TOGETHER, 0)))
        some = flag > 0
        return _flag_rows(segment[some], at[some], flag[some])

    return rows.groupBy("bucket").applyInArrow(refine, _FLAGS)


def _by_segment(flags: DataFrame, name: str) -> DataFrame:
    """At most as many entries as the segment has bytes."""
    return flags.groupBy("segment").agg(F.collect_list(F.struct("n", "packed")).alias(name))


def _flags_of(lists: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    if not lists[i].is_valid:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    parts = [_unpack(x["packed"], (x["n"], np.uint32), (x["n"], np.uint8)) for x in lists[i].as_py()]
    at, flag = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(at)
    return at[order].astype(np.int64), flag[order]


def string_rows(segments: DataFrame, flags: DataFrame, buckets: int) -> DataFrame:
    """What goes on to single strings (kinds 1 and 2), and the spans settled so far (kind 0)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = Segment(batch, i)
                if not s.find_anchors():
                    continue
                at, flag = _flags_of(batch.column("flags"), i)
                status = np.where(s.repeat, _SETTLED, 0).astype(np.uint8)
                status[s.unsent] = _DEALT
                place = np.searchsorted(at, s.at[s.sent])
                known = place < len(at)
                known[known] = at[place[known]] == s.at[s.sent][known]
                status[s.sent[known]] = flag[place[known]]
                out = []
                done = status == _SETTLED
                starts, ends = s.left[done], s.right[done]

                dealt = np.flatnonzero(status == _DEALT)
                sizes = s.high[dealt] - s.low[dealt] + 1
                string = A.ragged(s.low[dealt], sizes)
                doc_id = np.repeat(s.doc_id[dealt], sizes)
                key = A.span_hash(s.sums, string, string + LENGTH)
                order = np.lexsort((string, doc_id, key))
                first = A.first_of_run(key[order])
                again = string[order[~first]]
                starts, ends = np.append(starts, again), np.append(ends, again + LENGTH)
                pick = order[first]
                out += _rows((key[pick] % np.uint64(buckets)).astype(np.int64), buckets, 1, s.number, [key[pick], doc_id[pick], string[pick].astype(np.uint32)])

                near = np.flatnonzero(status == _TOGETHER)
                columns = [
                    s.doc_id[near], s.left[near].astype(np.uint32), (s.right - s.left)[near].astype(np.uint8),
                    (s.low - s.left)[near].astype(np.uint8), (s.high - s.left)[near].astype(np.uint8),
                ]
                bodies = [s.data[a:b] for a, b in zip(s.left[near], s.right[near])]
                out += _rows((A.mix(s.gram[near]) % np.uint64(buckets)).astype(np.int64), buckets, 2, s.number, columns, bodies)
                order = np.argsort(starts)
                if len(order):
                    out.append((0, 0, s.number, len(order), 0, _pack(starts[order].astype(np.uint32), (ends - starts)[order].astype(np.uint8))))
                yield _batch(out, _ROW_NAMES)

    return segments.join(_by_segment(flags, "flags"), "segment", "left").mapInArrow(send, _ROWS)


def flag_strings(rows: DataFrame) -> DataFrame:
    """Per segment: the starts of 100-byte strings that also start earlier."""

    def refine(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        keys, ids, places, segments = [], [], [], []
        for i in np.flatnonzero(kind == 1):
            n, number = table["n"][i].as_py(), table["segment"][i].as_py()
            key, doc_id, at = _unpack(table["packed"][i].as_py(), *((n, k) for k in _STRING))
            keys.append(key), ids.append(doc_id), places.append(at.astype(np.int64)), segments.append(np.full(n, number))
        for i in np.flatnonzero(kind == 2):
            n, m, number = table["n"][i].as_py(), table["m"][i].as_py(), table["segment"][i].as_py()
            doc_id, left, width, low, high, body = _unpack(table["packed"][i].as_py(), *((n, k) for k in _AROUND), (m, np.uint8))
            begin = np.cumsum(width, dtype=np.int64) - width
            sizes = high.astype(np.int64) - low + 1
            offset = A.ragged(low.astype(np.int64), sizes)
            start = np.repeat(begin, sizes) + offset
            keys.append(A.span_hash(A.prefix_hash(body), start, start + LENGTH))
            ids.append(np.repeat(doc_id, sizes))
            places.append(np.repeat(left.astype(np.int64), sizes) + offset)
            segments.append(np.full(len(start), number))
        key, doc_id, at, segment = (np.concatenate(c) for c in (keys, ids, places, segments))
        order = np.lexsort((at, segment, doc_id, key))
        again = order[~A.first_of_run(key[order])]
        return _flag_rows(segment[again], at[again], np.full(len(again), LENGTH, np.uint8))

    return rows.where("kind > 0").groupBy("bucket").applyInArrow(refine, _FLAGS)


def cut(segments: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` of every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = Segment(batch, i)
                at, width = _flags_of(batch.column("spans"), i)
                change = np.zeros(len(s.data) + 1, np.int32)
                np.add.at(change, at, 1)
                np.add.at(change, at + width, -1)
                gone = np.cumsum(change[:-1]) > 0
                starts, ends = A.runs(gone, s.offsets)
                of = A.owner(s.offsets, starts)
                n = len(s.offsets) - 1
                left = np.concatenate(([0], np.cumsum(~gone)))[s.offsets]
                kept = s.data[~gone].tobytes()
                base = s.offsets[of]
                pairs = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.ids, mask=~s.has_id),
                        pa.array(np.diff(s.offsets)),
                        pa.array([kept[a:b] for a, b in zip(left[:-1], left[1:])], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), pairs),
                    ],
                    ["doc_id", "n_bytes", "kept", "spans"],
                )

    schema = "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"
    return segments.join(_by_segment(spans, "spans"), "segment", "left").mapInArrow(apply, schema)


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, kept, spans``: each text in UTF-8 without bytes that repeat.

    A byte goes if a 100-byte string of one text that covers it also starts earlier:
    in a document of smaller id, or before it in the same. A null id comes after all
    ids; rows that share an id come in the order they are stored in. Null is an
    empty text. Texts under 100 bytes stay as they are. ``spans`` are the maximal
    removed runs, in bytes. Other columns are left out.
    """
    spark = ship(docs.sparkSession)
    folder = new_work_folder(spark, "repeats")

    segments = stored(pack_segments(docs, doc, text), f"{folder}/segments")
    size = segments.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    buckets = int(max(12, size // BUCKET_BYTES))
    flags = stored(flag_anchors(anchor_rows(segments, buckets)), f"{folder}/anchors")
    strings = stored(string_rows(segments, flags, buckets), f"{folder}/strings")
    more = stored(flag_strings(strings), f"{folder}/spans")
    settled = strings.where("kind = 0").select("segment", "n", "packed")
    return cut(segments, settled.union(more))


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
