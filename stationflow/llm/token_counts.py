"""Token counts by a linear longest-match automaton.

The vocabulary is a trie of its word-initial pieces and, below a root of its own, of
its continuing pieces. Where a word leaves the trie, the failure link of the node
leads to what is left of the text read so far after its longest pieces are taken off,
and the node knows how many pieces those are. Every byte is read once, and the number
of pieces comes out without any piece being made.
"""

from __future__ import annotations

import functools
import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .bpe import byte_characters, default_vocabulary
from .shipping import ship

# Words a worker remembers; beyond, it starts anew.
REMEMBERED = 300_000


class Automaton:
    """Greedy longest match over bytes: first an initial piece, then continuing ones."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes]):
        # Node 0 starts words, node 1 continues them.
        self.step: dict[int, int] = {}
        nodes = [(-1, -1), (-1, -1)]
        token = {}
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                at = root
                for byte in piece:
                    key = at << 8 | byte
                    if key not in self.step:
                        self.step[key] = len(nodes)
                        nodes.append((at, byte))
                    at = self.step[key]
                if at > 1:
                    token[at] = True
        self.fail = [-1] * len(nodes)
        self.popped = [0] * len(nodes)
        below: dict[int, list[int]] = {}
        for node, (parent, _) in enumerate(nodes):
            if parent >= 0:
                below.setdefault(parent, []).append(node)
        queue = deque([0, 1])
        while queue:
            at = queue.popleft()
            queue.extend(below.get(at, ()))
            parent, byte = nodes[at]
            if parent < 0:
                continue
            if at in token:
                self.fail[at], self.popped[at] = 1, 1
                continue
            back, count = self.fail[parent], self.popped[parent]
            while back >= 0 and (back << 8 | byte) not in self.step:
                count += self.popped[back]
                back = self.fail[back]
            if back >= 0:
                self.fail[at], self.popped[at] = self.step[back << 8 | byte], count

    def count(self, word: bytes) -> int:
        """How many pieces a word has; -1 if it can't be taken apart."""
        at = pieces = 0
        for byte in word:
            while (key := at << 8 | byte) not in self.step:
                if self.fail[at] < 0:
                    return -1
                pieces += self.popped[at]
                at = self.fail[at]
            at = self.step[key]
        while at != 1:
            if self.fail[at] < 0:
                return -1
            pieces += self.popped[at]
            at = self.fail[at]
        return pieces


def word_pieces(described: str) -> tuple[list[bytes], list[bytes]]:
    """Initial and continuing pieces of a byte-level vocabulary.

    Tokens that open with a space are initial, tokens without one continue; single
    bytes are both.
    """
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    space = byte_characters()[0x20]
    initial, continuing = [], []
    for token in json.loads(described)["model"]["vocab"]:
        plain = bytes(byte_of[c] for c in token.removeprefix(space))
        if token.startswith(space):
            initial.append(plain)
        else:
            continuing.append(plain)
            if len(plain) == 1:
                initial.append(plain)
    return initial, continuing


@functools.lru_cache(maxsize=2)
def _automaton(described: str) -> tuple[Automaton, dict[bytes, int]]:
    return Automaton(*word_pieces(described)), {}


def count_tokens(docs: DataFrame, doc: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. A word that can't be taken
    apart is one token and counted in ``n_unknown``. A null text has no words.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        shared = ship(docs.sparkSession).sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _automaton(shared.value)
        for block in A.blocks(batches):
            data, offsets = A.text_bytes(block.column("text"))
            starts, ends = A.runs(A.SPACED_WORD[data], offsets)
            of = A.owner(offsets, starts)
            key, first, back = np.unique(A.word_hash(data, starts, ends), return_index=True, return_inverse=True)
            if len(known) > REMEMBERED:
                known.clear()
            counts = np.empty(len(key), np.int64)
            raw = data.tobytes()
            for i, (a, b) in enumerate(zip(starts[first].tolist(), ends[first].tolist())):
                word = raw[a:b]
                if word not in known:
                    known[word] = automaton.count(word)
                counts[i] = known[word]
            each = counts[back]
            n = block.num_rows
            total = np.bincount(of, np.abs(each), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), pa.array(np.bincount(of, minlength=n).astype(np.int64)), pa.array(total),
                    pa.array(np.bincount(of[each < 0], minlength=n).astype(np.int64)),
                ],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{folder}/documents.parquet"))
