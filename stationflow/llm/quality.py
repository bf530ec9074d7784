"""Quality rules: gradient-boosted trees over document statistics.

Statistics are taken for a block of documents at once. The trees are grown here, on
a bounded sample of labelled rows, by histograms; the score may only fall as shares
of symbols, repeated lines and repeated words rise, and only rise with the number of
words. For scoring, all trees are one set of node arrays, and all rows of a block
walk all trees together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .shipping import ship

# Labelled rows the trees are grown on, at most: those of the least id hashes.
SAMPLE = 10_000
# Share of good held-out rows that may score under the threshold.
LOST_GOOD = 0.002

STATISTICS = (
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct", "n_upper", "n_digits", "n_stops", "n_bare_lines", "n_long_words",
)
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits", "stops",
    "bare_lines", "long_words", "line_words",
)
# Feature -> sign of the score's slope.
MONOTONIC = {"log_words": 1, "symbols": -1, "dup_lines": -1, "repeats": -1}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;")] = True


def _per_text(offsets: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """How many flags of each text are set."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def block_statistics(column: pa.Array) -> np.ndarray:
    """One row per text, one column per name in ``STATISTICS``."""
    data, offsets = A.text_bytes(column)
    n = len(offsets) - 1
    lead = (data & 0xC0) != 0x80
    inside = A.SPACED_WORD[data]
    starts, ends = A.runs(inside, offsets)
    of = A.owner(offsets, starts)
    words = np.bincount(of, minlength=n)
    term = A.word_hash(data, starts, ends)

    # Words in windows of three that are found twice or more in their text.
    repeated = np.zeros(len(starts), bool)
    if len(starts) > 2:
        whole = np.flatnonzero(of[2:] == of[:-2])
        gram = A.mix(A.mix(A.mix(term[whole]) + term[whole + 1]) + term[whole + 2])
        order = np.lexsort((gram, of[whole]))
        head = A.first_of_run(of[whole][order], gram[order])
        group = np.cumsum(head) - 1
        twice = whole[order[np.bincount(group)[group] > 1]] if len(whole) else whole
        for k in range(3):
            repeated[twice + k] = True
    distinct = np.zeros(n, np.int64)
    if len(starts):
        order = np.lexsort((term, of))
        distinct = np.bincount(of[order][A.first_of_run(of[order], term[order])], minlength=n)

    # Lines, without their line feed; those that have a word.
    feeds = np.flatnonzero(data == 0x0A)
    line_starts = np.union1d(feeds + 1, offsets[:-1])
    line_starts = line_starts[line_starts < len(data)]
    stops = np.union1d(offsets[1:], line_starts)
    line_ends = stops[np.searchsorted(stops, line_starts, "right")] if len(line_starts) else line_starts
    line_ends = line_ends - (data[line_ends - 1] == 0x0A) if len(line_starts) else line_ends
    seen = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    worded = seen[line_ends] > seen[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_of = A.owner(offsets, line_starts)
    lines = np.bincount(line_of, minlength=n)
    dup = np.zeros(n, np.int64)
    bare = np.zeros(n, np.int64)
    if len(line_starts):
        line = A.word_hash(data, line_starts, line_ends)
        order = np.lexsort((line, line_of))
        dup = lines - np.bincount(line_of[order][A.first_of_run(line_of[order], line[order])], minlength=n)
        bare = np.bincount(line_of[~_STOP[data[line_ends - 1]]], minlength=n)
    return np.column_stack(
        [
            _per_text(offsets, lead),
            words,
            _per_text(offsets, lead & inside),
            _per_text(offsets, _SYMBOL[data]),
            lines,
            dup,
            np.bincount(of[repeated], minlength=n),
            distinct,
            _per_text(offsets, (data >= 0x41) & (data <= 0x5A)),
            _per_text(offsets, (data >= 0x30) & (data <= 0x39)),
            _per_text(offsets, _STOP[data]),
            bare,
            np.bincount(of[(ends - starts) > 20], minlength=n),
        ]
    ).astype(np.int64)


def features(stats: np.ndarray) -> np.ndarray:
    s = dict(zip(STATISTICS, stats.T.astype(float)))
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.column_stack(
        [
            np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / lines,
            s["n_repeat_words"] / words, s["n_distinct"] / words, s["n_upper"] / chars, s["n_digits"] / chars,
            s["n_stops"] / words, s["n_bare_lines"] / lines, s["n_long_words"] / words, s["n_words"] / lines,
        ]
    )


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees; a leaf's children are the leaf itself."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float
    cut: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of being good, per row of ``x``."""
        node = np.broadcast_to(self.root, (len(x), len(self.root)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            down = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(down, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)


def grow(
    x: np.ndarray, good: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64,
    smooth: float = 1.0, least: int = 10, signs: tuple[int, ...] | None = None,
) -> Trees:
    """Boost ``rounds`` trees on log loss. ``signs`` holds each feature's slope: 1, -1 or 0 for free.

    A split on a bound feature must have its leaves in order, and the middle
    between them bounds everything below, so that whole trees keep the slope.
    """
    if signs is None:
        signs = tuple(MONOTONIC.get(name, 0) for name in FEATURES)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    rate_good = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_good / (1 - rate_good)))
    score = np.full(len(x), base)
    nodes = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    root = []

    def leaf_value(g, h, low, high):
        return float(np.clip(g / (h + smooth), low, high))

    def build(rows, grad, hess, level, low, high):
        at = len(nodes["value"])
        g, h = grad[rows].sum(), hess[rows].sum()
        value = leaf_value(g, h, low, high)
        for k, v in (("feature", 0), ("threshold", 0.0), ("left", at), ("right", at), ("value", value * rate)):
            nodes[k].append(v)
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, grad[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], len(e) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                vl = np.clip(gl / (hl + smooth), low, high)
                vr = np.clip((g - gl) / (h - hl + smooth), low, high)
                gain = gl * vl - 0.5 * (hl + smooth) * vl**2 + (g - gl) * vr - 0.5 * (h - hl + smooth) * vr**2
                gain -= g * value - 0.5 * (h + smooth) * value**2
                ok = (nl >= least) & (len(rows) - nl >= least) & (signs[f] * (vr - vl) >= 0)
                gain = np.where(ok, gain, -1.0)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], (f, i, vl[i], vr[i]))
        if best[1] is None:
            score[rows] += value * rate
            return at
        f, i, vl, vr = best[1]
        middle = (vl + vr) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[signs[f]]
        down = binned[rows, f] <= i
        left = build(rows[down], grad, hess, level + 1, *bounds[0])
        right = build(rows[~down], grad, hess, level + 1, *bounds[1])
        nodes["feature"][at], nodes["threshold"][at] = f, float(edges[f][i])
        nodes["left"][at], nodes["right"][at] = left, right
        return at

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        root.append(build(np.arange(len(x)), good - p, p * (1 - p), 0, -np.inf, np.inf))
    arrays = {k: np.array(v, np.int32 if k in ("feature", "left", "right") else float) for k, v in nodes.items()}
    return Trees(np.array(root, np.int32), **arrays, depth=depth, base=base)


def document_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and the columns in ``STATISTICS``; a null text counts as empty."""
    ship(docs.sparkSession)
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in A.blocks(batches, text):
            stats = block_statistics(block.column(text))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(k) for k in keep), *(pa.array(c) for c in stats.T)], [*keep, *STATISTICS]
            )

    counts = ", ".join(f"{s} long" for s in STATISTICS)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(count, f"{fields}, {counts}")


def train(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Trees | None:
    """Trees grown on at most ``sample`` labelled documents, or None where all are of one class.

    The sample is the labelled ids of the least hashes; an id labelled twice counts
    as the worse, and of rows that share an id the least text stands for it. A fifth
    of it, again by hash, is held out to set the threshold. Where no label is of the
    other class nothing can be learned, and the base rules decide alone. Null ids and
    labels are no labels.
    """
    known = labels.select(F.col(doc).alias("id"), F.col("quality").alias("good")).dropna()
    known = known.groupBy("id").agg(F.min("good").alias("good"))
    picked = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(doc).alias("id"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("good").alias("good"))
    rows = document_statistics(joined, ("id", "good")).collect()  # one row per id, ``sample`` at most
    rows = sorted(tuple(r) for r in rows)
    good = np.array([r[1] > 0 for r in rows], float)
    if not len(rows) or good.min() == good.max():
        return None
    x = features(np.array([r[2:] for r in rows], np.int64))
    ids = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    held = A.mix(ids) % np.uint64(5) == 0
    if not (held & (good > 0)).any() or good[~held].min() == good[~held].max():
        held[:] = False
    trees = grow(x[~held], good[~held])
    judged = trees.score(x[held if held.any() else ~held])
    judged = judged[good[held if held.any() else ~held] > 0]
    return Trees(**{**trees.__dict__, "cut": float(min(0.0, np.quantile(judged, LOST_GOOD)))})


def judge(docs: DataFrame, trees: Trees | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``STATISTICS``, ``score``, ``base_failed`` and ``kept`` for every row.

    The base rules fail a text of under 50 words, or with more than half of its
    words in repeated windows: so a null, empty or blank text is not kept.
    """
    ship(docs.sparkSession)
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    counts = ", ".join(f"{s} long" for s in STATISTICS)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in A.blocks(batches, text):
            stats = block_statistics(block.column(text))
            score = trees.score(features(stats)) if trees else np.zeros(len(stats))
            words, again = stats[:, STATISTICS.index("n_words")], stats[:, STATISTICS.index("n_repeat_words")]
            failed = (words < 50) | (100 * again > 50 * words)
            kept = ~failed & (score >= (trees.cut if trees else 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(k) for k in keep), *(pa.array(c) for c in stats.T), pa.array(score), pa.array(failed), pa.array(kept)],
                [*keep, *STATISTICS, "score", "base_failed", "kept"],
            )

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(
        rate, f"{fields}, {counts}, score double, base_failed boolean, kept boolean"
    )


def keep_good(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    trees = train(docs, labels, doc, text)
    plain = {f.name: f"c{i}" for i, f in enumerate(docs.schema)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in plain.items()))
    judged = judge(renamed, trees, tuple(plain.values()), plain[text])
    return judged.where("kept").select(*(F.col(n).alias(c) for c, n in plain.items()))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return judge(docs, train(docs, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
