"""Arrow text columns as numpy arrays: words and hashes of a whole block at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text worked on at a time; a longer text is a block of its own.
BLOCK_BYTES = 512 << 10

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

# Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in text whose A-Z are lower-cased.
PLAIN_WORD = np.zeros(256, bool)
PLAIN_WORD[0x30:0x3A] = PLAIN_WORD[0x61:0x7B] = PLAIN_WORD[0x80:] = True
# Bytes of `[^\x20\x09-\x0D]+`.
SPACED_WORD = np.ones(256, bool)
SPACED_WORD[[0x20, *range(0x09, 0x0E)]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``size`` bytes of ``text`` at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(text)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; null is 0."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes one after the other, and where each text starts (one more than texts)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else left."""
    return _LOWER[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, none of which crosses a text's start."""
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all (the finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            made = np.full(size, base, np.uint64)
            made[0] = 1
            _powers[i] = np.cumprod(made, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


# Spans of more bytes than this are hashed one by one.
_LONG = 256


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, of any length: eight bytes after the other are mixed in.

    No sum of the bytes' own values: sequences that are alike in number and order of
    their bytes, however they are made, have hashes that have nothing in common.
    """
    padded = np.concatenate((np.ascontiguousarray(data), np.zeros(8, np.uint8)))
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    sizes = ends - starts
    found = mix(sizes.astype(np.uint64) + _U(0xD6E8FEB86659FD93))
    at, passed = np.flatnonzero((sizes <= _LONG) & (sizes > 0)), 0
    while len(at):
        block, left = eight[starts[at] + passed], sizes[at] - passed
        unused = (8 * np.maximum(8 - left, 0)).astype(np.uint64)
        block = (block << unused) >> unused
        found[at] = mix((found[at] ^ block) * _U(_BASE) + _U(passed + 1))
        passed += 8
        at = at[left > 8]
    for i in np.flatnonzero(sizes > _LONG).tolist():
        digest = hashlib.blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        found[i] = _U(int.from_bytes(digest, "little"))
    return found


def prefix_hash(data: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """Sums that ``span_hash`` takes differences of; one more than bytes.

    For short spans that overlap, as passages do: of spans of 1,024 bytes and more,
    some that are made for it have the same hash. Words and lines go by ``word_hash``.
    """
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _power(len(data))[0], out=out[1:], dtype=np.uint64)
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, wherever it stands."""
    found = sums[ends] - sums[starts]
    found *= _power(len(sums))[1][starts]
    return mix(found + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The text each position is in; both ascend."""
    return np.searchsorted(offsets, positions, "right") - 1


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of many ranges, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(total)


def first_of_run(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
    return new
