"""Byte-level BPE, encoding and decoding.

A piece of text is merged by a segment tree over the ranks of its adjacent pairs.
The root is the lowest rank, and of equal ranks the leftmost; a merge changes three
leaves and the nodes above them, until the root has no mergeable pair. All distinct
pieces of a block are merged together, one tree each, in arrays; what a piece becomes
is remembered, within a bound, by the worker.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .shipping import ship

# Pieces a worker remembers; beyond, it starts anew.
REMEMBERED = 150_000
# Leaves of the trees that are worked on together.
LEAVES = 1 << 18

_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)
_TEXT_END, _SPECIAL = 0x110000, 0x110001
# White space in the sense of Unicode.
_WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005,
    0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Letters and numbers new in Unicode 16, which Python's tables may lack.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
_NONE = np.uint64(2**64 - 1)


def default_vocabulary() -> str:
    """Where the installed public vocabulary is."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 bytes stand for themselves; the rest, in order, for the
    characters from U+0100 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point, and of the two marks."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for ranges, kind in ((_NEW_LETTERS, _LETTER), (_NEW_NUMBERS, _NUMBER)):
        for low, high in ranges:
            table[low : high + 1] = kind
    table[list(_WHITE_SPACE)] = _SPACE
    return np.append(table, np.array([_END, _END], np.uint8))


def piece_starts(points: np.ndarray) -> np.ndarray:
    """True where a piece starts, in code points with marks after each text.

    Pieces are runs of letters, of numbers and of other signs, each with one space
    before it if there is one; the short English endings after an apostrophe; and
    white space, whose last character is left to what follows.
    """
    kind = _classes()[points]
    before = np.concatenate(([_END], kind[:-1])).astype(np.uint8)
    after = np.concatenate((kind[1:], [_END])).astype(np.uint8)
    spaced = np.concatenate(([False], points[:-1] == 0x20))
    solid = kind < _SPACE
    start = (solid & (before != kind) & ~spaced) | ((kind == _SPACE) & ((before != _SPACE) | (after < _SPACE))) | (kind == _END)
    at = np.flatnonzero(start & (points == 0x27))
    if len(at):
        next1 = points[np.minimum(at + 1, len(points) - 1)]
        next2 = points[np.minimum(at + 2, len(points) - 1)]
        one = np.isin(next1, [ord(c) for c in "stmd"])
        two = np.zeros(len(at), bool)
        for pair in ("re", "ve", "ll"):
            two |= (next1 == ord(pair[0])) & (next2 == ord(pair[1]))
        ends = np.where(one, at + 2, at + 3)[one | two]
        at = at[one | two]
        start[at + 1] = False
        more = ends[kind[ends] == _LETTER]
        start[more] = True
    return start


class Encoder:
    """One vocabulary, with what its pieces have become so far."""

    def __init__(self, described: str):
        model = json.loads(described)
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocabulary.values(), *self.specials.values()]) + 1
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.of_byte = np.array([vocabulary[c] for c in byte_characters()], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left, right, made = (np.array([vocabulary[x] for x in column], np.int64) for column in zip(*((a, b, a + b) for a, b in pairs)))
        self.size, self.made = size, made
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.pair, self.rank = key[order], order.astype(np.uint64)
        texts = [b""] * size
        for token, i in [*vocabulary.items(), *self.specials.items()]:
            texts[i] = b"".join(bytes([byte_of[c]]) if c in byte_of else c.encode() for c in token)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.widths = np.array([len(t) for t in texts], np.int64)
        self.heads = np.cumsum(self.widths) - self.widths
        self.known: dict[bytes, bytes] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[place] == key) & (a >= 0) & (b >= 0), self.rank[place] << np.uint64(32), _NONE)

    def _merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of at most ``width`` bytes; ids one after the other, and how many of each."""
        n = len(starts)
        places = np.arange(width)
        inside = places < sizes[:, None]
        ids = np.full((n, width), -1, np.int64)
        ids[inside] = self.of_byte[data[A.ragged(starts, sizes)]]
        ids = ids.ravel()
        row = np.arange(n) * width
        after = np.broadcast_to(places + 1, (n, width)).copy().ravel()
        before = np.broadcast_to(places - 1, (n, width)).copy().ravel()
        follower = np.full(n * width, -1, np.int64)
        follower[:-1] = ids[1:]
        follower[width - 1 :: width] = -1
        tree = np.full((n, 2 * width), _NONE, np.uint64)
        leaf = self._ranks(ids, follower)
        tree[:, width:] = (leaf | np.tile(places.astype(np.uint64), n) * (leaf != _NONE)).reshape(n, width)
        node = width
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node //= 2
        tree = tree.ravel()
        live = np.arange(n)
        while True:
            root = tree[live * 2 * width + 1]
            live = live[root != _NONE]
            if not len(live):
                break
            root = root[root != _NONE]
            base = row[live]
            left = (root & np.uint64(0xFFFFFFFF)).astype(np.int64)
            right = after[base + left]
            beyond = after[base + right]
            ids[base + left] = self.made[(root >> np.uint64(32)).astype(np.int64)]
            ids[base + right] = -1
            after[base + left] = beyond
            has = beyond < width
            before[base[has] + beyond[has]] = left[has]
            prior = before[base + left]
            id_left = ids[base + left]
            id_next = np.where(has, ids[base + np.minimum(beyond, width - 1)], -1)
            id_prior = np.where(prior >= 0, ids[base + np.maximum(prior, 0)], -1)
            rank = self._ranks(np.concatenate((id_left, id_prior)), np.concatenate((id_next, id_left)))
            at = np.concatenate((left, np.maximum(prior, 0), right))
            value = np.concatenate((rank, np.full(len(live), _NONE)))
            value = np.where(value == _NONE, value, value | at.astype(np.uint64))
            keep = np.concatenate((np.ones(len(live), bool), prior >= 0, np.ones(len(live), bool)))
            of = np.tile(live * 2 * width, 3)[keep]
            node = at[keep] + width
            tree[of + node] = value[keep]
            while node[0] > 1:
                node >>= 1
                tree[of + node] = np.minimum(tree[of + 2 * node], tree[of + 2 * node + 1])
        ids = ids.reshape(n, width)
        return ids[ids >= 0], (ids >= 0).sum(axis=1)

    def merge_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit numbers."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(sizes) - sizes
        widths = np.maximum(2, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        out: list[bytes] = [b""] * len(pieces)
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            step = max(1, LEAVES // int(width))
            for i in range(0, len(rows), step):
                some = rows[i : i + step]
                ids, counts = self._merge(data, starts[some], sizes[some], int(width))
                packed, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(counts)
                for piece, a, b in zip(some.tolist(), (ends - 4 * counts).tolist(), ends.tolist()):
                    out[piece] = packed[a:b]
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        mark, special = (np.array([x], "<u4").tobytes() for x in (_TEXT_END, _SPECIAL))
        parts = []
        order: list[int] = []
        for text in texts:
            text = text or ""
            found = [(text.find(s), s) for s in self.specials if s in text]
            while found:
                at, content = min(found)
                parts += [text[:at].encode("utf-32-le"), special]
                order.append(self.specials[content])
                text = text[at + len(content) :]
                found = [(text.find(s), s) for s in self.specials if s in text]
            parts += [text.encode("utf-32-le"), mark]
        points = np.frombuffer(b"".join(parts), "<u4")
        starts = np.flatnonzero(piece_starts(points))
        ends = np.append(starts[1:], len(points))
        first = points[starts]
        text_of = np.cumsum(first == _TEXT_END) - (first == _TEXT_END)
        piece = first != _TEXT_END
        starts, ends, first, text_of = starts[piece], ends[piece], first[piece], text_of[piece]
        key = A.word_hash(points.view(np.uint8), 4 * starts, 4 * ends)
        _, where, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        raw = points.tobytes()
        pieces = [raw[a:b] for a, b in zip((4 * starts[where]).tolist(), (4 * ends[where]).tolist())]
        is_special = first[where] == _SPECIAL
        new = [piece for piece, special in zip(pieces, is_special.tolist()) if piece not in self.known and not special]
        if new:
            self.known.update(zip(new, self.merge_pieces([piece.decode("utf-32-le").encode() for piece in new])))
        found = [b"\0\0\0\0" if s else self.known[piece] for piece, s in zip(pieces, is_special.tolist())]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        heads = np.cumsum(sizes) - sizes
        counts = sizes[back]
        ids = flat[A.ragged(heads[back], counts)]
        if order:
            slots = np.cumsum(counts) - counts
            ids[slots[first == _SPECIAL]] = order
        return ids, np.bincount(text_of, counts, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes the ids stand for; special ones stand for their names."""
        return self.bytes[A.ragged(self.heads[ids], self.widths[ids])].tobytes()


@functools.lru_cache(maxsize=2)
def _encoder(described: str) -> Encoder:
    return Encoder(described)


def _shared(spark: SparkSession, path: str | None) -> Broadcast:
    """The vocabulary file, which has the size of a vocabulary, for all executors."""
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        return ship(spark).sparkContext.broadcast(file.read())


def encode(docs: DataFrame, doc: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text. Null is an empty text and has none.

    The names of special tokens in a text become their ids, as the library does it.
    """
    shared = _shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for block in A.blocks(batches):
            ids, counts = encoder.encode(block.column("text").to_pylist())
            ends = np.concatenate(([0], np.cumsum(counts)))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, doc: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, text``: what the ids stand for. Bytes that are no UTF-8 become U+FFFD; null ids are none."""
    shared = _shared(rows.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            lists = batch.column("ids")
            texts = [encoder.decode(x.values.to_numpy() if x.is_valid else np.zeros(0, int)).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col(doc).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")


def encoded_documents(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", vocabulary: str | None = None, with_ids: bool = True
) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256, same``: encode and decode in one pass.

    The digests are of the ids as little-endian 32-bit numbers and of the decoded
    text in UTF-8; ``same`` tells whether decoding gave the text back. Without
    ``with_ids`` there is no column of ids.
    """
    shared = _shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for block in A.blocks(batches):
            texts = block.column("text").to_pylist()
            ids, counts = encoder.encode(texts)
            ends = np.concatenate(([0], np.cumsum(counts)))
            packed = ids.astype("<u4").tobytes()
            decoded = encoder.decode(ids)
            cuts = np.concatenate(([0], np.cumsum(encoder.widths[ids])))[ends].tolist()
            first, second, same = [], [], []
            for text, a, b, c, d in zip(texts, ends[:-1].tolist(), ends[1:].tolist(), cuts[:-1], cuts[1:]):
                back = decoded[c:d].decode("utf-8", "replace")
                first.append(hashlib.sha256(packed[4 * a : 4 * b]).hexdigest())
                second.append(hashlib.sha256(back.encode()).hexdigest())
                same.append(back == (text or ""))
            columns = [block.column("doc_id"), pa.array(counts), pa.array(first), pa.array(second), pa.array(same)]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same", *(["ids"] if with_ids else [])]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = encoded_documents(spark.read.parquet(f"{folder}/documents.parquet"), with_ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
