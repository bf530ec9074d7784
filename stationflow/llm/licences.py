"""Licence scans: a trained classifier of paragraphs.

A paragraph is what stands between lines without a word, so a notice that is wrapped, or
marked as a comment line by line, is one. It is judged by its pieces: windows of words,
half over each other, and sentences, so that neither a notice over many lines nor one
line among prose is lost. A sentence within a window that names another family counts
for the window's, if its words are in that family's texts too. Features are words and word pairs, hashed; a softmax regression
over them tells the licence families from each other, from other licences and from plain
text. It is trained here: on names, identifiers and whole texts of licences
(``licence_texts``), varied; on licences of no known family and invented ones; and on
pieces of a bounded sample of documents.

Probabilities are calibrated on pieces that the regression was not trained on: it is
fitted three times, each time without a third of the variants of known texts, a third of
the other licences and a third of the plain pieces. A predicted family stands if the
piece shares enough word triples with a text of it, and more with its texts than with
any other family's; if not, the piece is unknown, or plain text if it may well be that.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .licence_texts import FRAMES, IDENTIFIED, LICENCES, NAMED, NO_NAMES, ORDINARY, OTHERS, Licence
from .shipping import ship

# Hashed features.
FEATURES = 1 << 13
# Words of a window; the next one begins half as many later.
WINDOW = 48
# Documents whose pieces stand for plain text, and pieces of them, at most.
SAMPLE_DOCUMENTS = 300
SAMPLE_PIECES = 1_500
# Share of the smaller set of word triples that must be common to confirm a family.
CONFIRM = 0.6
FOLDS = 3
# Words whose piece scores are held at a time.
_SLICE = 1 << 16


@dataclass(frozen=True)
class Pieces:
    """Words of a block, and the pieces that they are judged by."""

    term: np.ndarray  # a hash per word
    starts: np.ndarray  # where each word starts and ends, in bytes
    ends: np.ndarray
    first: np.ndarray  # first word of each piece, and the word after its last
    last: np.ndarray
    paragraph: np.ndarray  # number of each piece's paragraph
    window: np.ndarray  # whether each piece is a window, not a sentence
    text_of: np.ndarray  # text of each paragraph

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The feature of each word, and of it and the next word."""
        pair = A.mix(A.mix(self.term[:-1]) + self.term[1:]) if len(self.term) else self.term
        cut = lambda x: (x % np.uint64(FEATURES)).astype(np.int64)
        return cut(self.term), np.append(cut(pair), 0)

    def triples(self, i: int) -> np.ndarray:
        """The distinct word triples of a piece; of fewer words, one for all of them."""
        term = self.term[self.first[i] : self.last[i]]
        if len(term) >= 3:
            return np.unique(A.mix(A.mix(A.mix(term[:-2]) + term[1:-1]) + term[2:]))
        whole = np.zeros(1, np.uint64)
        for word in term:
            whole = A.mix(whole * np.uint64(3) + word)
        return whole


def pieces(column: pa.Array) -> Pieces:
    data, offsets = A.text_bytes(column)
    low = A.lowered(data)
    starts, ends = A.runs(A.PLAIN_WORD[low], offsets)
    term = A.word_hash(low, starts, ends)
    n, none = len(starts), np.zeros(0, np.int64)
    if not n:
        return Pieces(term, starts, ends, none, none, none, none.astype(bool), none)
    text = A.owner(offsets, starts)
    feeds = np.flatnonzero(data == 0x0A)
    line = np.searchsorted(feeds, starts)
    new = np.ones(n, bool)
    new[1:] = (text[1:] != text[:-1]) | (line[1:] > line[:-1] + 1)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    paragraph = np.cumsum(new) - 1
    # Windows: the last one reaches the end of its paragraph.
    half = WINDOW // 2
    many = np.maximum(-(-(sizes - half) // half), 1)
    of = np.repeat(np.arange(len(heads)), many)
    window = heads[of] + half * A.ragged(np.zeros(len(many), np.int64), many)
    stop = np.minimum(window + WINDOW, (heads + sizes)[of])
    # Sentences end at a feed, or at a mark before a space; those longer than a window are in windows.
    follows = np.zeros(len(data) + 1, bool)
    follows[1 : len(data)] = np.isin(data[:-1], np.frombuffer(b".!?;", np.uint8)) & np.isin(data[1:], np.frombuffer(b" \t\r\n", np.uint8))
    marks = np.flatnonzero(follows)
    cut = new.copy()
    cut[1:] |= (line[1:] != line[:-1]) | (np.searchsorted(marks, starts[1:]) != np.searchsorted(marks, starts[:-1]))
    sentence = np.flatnonzero(cut)
    sentence_stop = np.append(sentence[1:], n)
    own = paragraph[sentence]
    short = (sentence_stop - sentence <= WINDOW) & ((sentence_stop - sentence < sizes[own]) | (sizes[own] > WINDOW))
    first = np.concatenate((window, sentence[short]))
    last = np.concatenate((stop, sentence_stop[short]))
    order = np.argsort(first, kind="stable")
    return Pieces(term, starts, ends, first[order], last[order], paragraph[first[order]], order < len(window), text[heads])


@dataclass(frozen=True)
class Classifier:
    families: tuple[str, ...]
    weights: np.ndarray  # feature x class; the last two are plain text and unknown licences
    bias: np.ndarray
    cut_plain: float  # least probability of not being plain text, where no template confirms it
    cut_known: float  # least probability of the family among all families and unknown
    triples: tuple[tuple[np.ndarray, ...], ...]  # of each text of each family

    def probabilities(self, p: Pieces) -> np.ndarray:
        """A row per piece. Pieces are differences of running sums over words, a slice of them at a time."""
        one, two = p.grams()
        out = np.zeros((len(p.first), len(self.bias)))
        at = 0
        while at < len(p.first):
            base = p.first[at]
            to = max(at + 1, int(np.searchsorted(p.first, base + _SLICE)))
            stop = int(p.last[at:to].max())
            singles = np.zeros((stop - base + 1, len(self.bias)))
            doubles = singles.copy()
            np.cumsum(self.weights[one[base:stop]], axis=0, out=singles[1:])
            np.cumsum(self.weights[two[base:stop]], axis=0, out=doubles[1:])
            a, b = p.first[at:to] - base, p.last[at:to] - base
            total = singles[b] - singles[a] + doubles[b - 1] - doubles[a]
            out[at:to] = total / np.sqrt(2 * (b - a) - 1)[:, None] + self.bias
            at = to
        return _softmax(out)

    def classes(self, p: Pieces) -> np.ndarray:
        """Per piece a family's number, or one (plain text) or two (unknown licence) beyond them."""
        n = len(self.families)
        if not len(p.first):
            return np.zeros(0, np.int64)
        share = self.probabilities(p)
        best = share[:, :n].argmax(axis=1)
        other = 1 - share[:, n]
        known = (share[np.arange(len(best)), best] >= self.cut_known * other) & (other >= 0.5)
        unnamed = np.where(other < self.cut_plain, n, n + 1)
        out = np.where(known, best, unnamed)
        for i in np.flatnonzero(known):
            own = p.triples(i)
            if not (self._confirmed(own, out[i]) and self._foremost(own, out[i])):
                out[i] = unnamed[i]
        # The last window before each piece that names a family, if the piece lies in it.
        window = np.where(p.window & (out < n), np.arange(len(out)), -1)
        window = np.maximum.accumulate(window)
        inside = (window >= 0) & ~p.window & (p.last <= p.last[window])
        for i in np.flatnonzero((out < n) & inside & (out != out[window])):
            if self._confirmed(p.triples(i), out[window[i]]):
                out[i] = out[window[i]]
        # Fewer than three words, or words that mostly come again and again, name a family or nothing.
        for i in np.flatnonzero(out > n):
            size = p.last[i] - p.first[i]
            if size < 3 or 2 * len(p.triples(i)) < size - 2:
                out[i] = n
        return out

    def _foremost(self, own: np.ndarray, family: int) -> bool:
        """Whether the family's texts have more of these triples than any other family's."""
        common = [len(np.unique(np.concatenate([np.intersect1d(own, t, True) for t in texts]))) for texts in self.triples]
        return common[family] > max((c for i, c in enumerate(common) if i != family), default=0)

    def _confirmed(self, own: np.ndarray, family: int) -> bool:
        """Whether a piece with these triples shares enough of them with a text of the family."""
        return any(len(np.intersect1d(own, t, True)) >= CONFIRM * min(len(own), len(t)) for t in self.triples[family])


@dataclass(frozen=True)
class _Rows:
    """Sparse rows of features, one per text: entries by row."""

    feature: np.ndarray
    row: np.ndarray
    value: np.ndarray
    n: int

    def take(self, mask: np.ndarray) -> _Rows:
        held = mask[self.row]
        return _Rows(self.feature[held], (np.cumsum(mask) - 1)[self.row[held]], self.value[held], int(mask.sum()))

    def score(self, weights: np.ndarray) -> np.ndarray:
        heads = np.flatnonzero(A.first_of_run(self.row))
        return np.add.reduceat(weights[self.feature] * self.value, heads, axis=0)


def _rows(texts: list[str]) -> _Rows:
    """A row per text; each must have a word."""
    p = pieces(pa.array([" ".join(t.split()) for t in texts], pa.string()))
    one, two = p.grams()
    of = p.text_of[p.paragraph]
    size = np.zeros(len(texts), np.int64)
    np.maximum.at(size, of, p.last)
    first = np.append(0, size[:-1])
    size = size - first
    row = np.arange(len(size))
    feature = np.concatenate((one[A.ragged(first, size)], two[A.ragged(first, size - 1)]))
    row = np.concatenate((np.repeat(row, size), np.repeat(row, size - 1)))
    order = np.argsort(row, kind="stable")
    value = (1 / np.sqrt(2 * size - 1))[row[order]].astype(np.float32)[:, None]
    return _Rows(feature[order], row[order], value, len(size))


def _softmax(score: np.ndarray) -> np.ndarray:
    score = np.exp(score - score.max(axis=1, keepdims=True))
    return score / score.sum(axis=1, keepdims=True)


def _fit(rows: _Rows, label: np.ndarray, classes: int, rounds=160, rate=40.0, decay=1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by gradient steps with momentum, each class weighing the same."""
    weights, bias = np.zeros((FEATURES, classes), np.float32), np.zeros(classes, np.float32)
    step, step_bias = np.zeros_like(weights), np.zeros_like(bias)
    target = np.eye(classes, dtype=np.float32)[label]
    weight = (1 / np.maximum(np.bincount(label, minlength=classes), 1))[label][:, None].astype(np.float32) / np.float32(classes)
    order = np.argsort(rows.feature, kind="stable")
    row, value, feature = rows.row[order], rows.value[order], rows.feature[order]
    heads = np.flatnonzero(A.first_of_run(feature))
    used = feature[heads]
    for _ in range(rounds):
        error = (_softmax(rows.score(weights) + bias) - target) * weight
        slope = np.float32(decay) * weights
        slope[used] += np.add.reduceat(error[row] * value, heads, axis=0)
        step = np.float32(0.9) * step - np.float32(rate) * slope
        step_bias = np.float32(0.9) * step_bias - np.float32(rate / 10) * error.sum(axis=0)
        weights, bias = weights + step, bias + step_bias
    return weights, bias


def _split(column: pa.Array) -> list[str]:
    """The distinct texts of all pieces."""
    data, _ = A.text_bytes(column)
    p, raw = pieces(column), data.tobytes()
    return sorted({raw[p.starts[a] : p.ends[b - 1]].decode() for a, b in zip(p.first, p.last)})


def _sentences(licence: Licence) -> list[str]:
    return [f.format(x) for x in licence.names for f in NAMED] + [f.format(x) for x in licence.ids for f in IDENTIFIED]


def _paragraphs(licence: Licence) -> list[str]:
    return [" ".join(x.split()) for text in licence.texts for x in text.split("\n\n")]


def sample_pieces(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> list[str]:
    """Up to ``SAMPLE_PIECES`` distinct pieces of the documents of the ``SAMPLE_DOCUMENTS`` least id hashes.

    Ids alone are sorted; texts are read for those that were picked. Pieces are those of
    the least hashes, in the order of their words. Where ids repeat, all their texts count.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    picked = source.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    ids = [r.doc_id for r in picked.collect()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in A.blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_split(block.column("text")), pa.string())], ["piece"])

    texts = source.where(F.col("doc_id").isin(ids)).select("text").mapInArrow(cut, "piece string").distinct()
    rows = texts.orderBy(F.xxhash64("piece"), "piece").limit(SAMPLE_PIECES).collect() if ids else []
    return sorted(r.piece for r in rows)


def train(docs: DataFrame, doc: str = "doc_id", text: str = "text", licences: Mapping[str, Licence] = LICENCES) -> Classifier:
    """A classifier of the families in ``licences``; other ones may be given, with whole texts.

    Plain text are pieces of a bounded sample of ``docs`` (``sample_pieces``), less those
    that share enough word triples with a text of a known family or with another licence.
    Null and empty texts, and an empty table, give no plain pieces: then the sentences of
    ``licence_texts.ORDINARY`` alone stand for plain text.
    """
    families = tuple(licences)
    plain, unknown = len(families), len(families) + 1
    texts_of = [_sentences(licences[f]) + _paragraphs(licences[f]) for f in families]

    def sets(texts: list[str]) -> tuple[np.ndarray, ...]:
        whole = [" ".join(t.split()) for t in texts]
        p = pieces(pa.array(whole, pa.string()))
        ends = np.append(np.flatnonzero(np.diff(p.paragraph)) + 1, len(p.first)) if len(p.first) else []
        out, head = [], 0
        for end in ends:
            out.append(Pieces(p.term, p.starts, p.ends, p.first[head : head + 1], p.last[head:end].max(keepdims=True), p.paragraph, p.window, p.text_of).triples(0))
            head = end
        return tuple(out)

    triples = tuple(sets(texts) for texts in texts_of)
    texts = [t for group in triples for t in group] + list(sets([s for licence in OTHERS for s in _sentences(licence)]))
    listed = np.unique(np.concatenate(texts))

    def notice(piece: str) -> bool:
        """Whether it shares enough triples with a licence; no word, and it is as little plain text."""
        own = sets([piece])
        if not own or not np.isin(own[0], listed, assume_unique=True).any():
            return not own
        return any(len(np.intersect1d(own[0], t, True)) >= CONFIRM * min(len(own[0]), len(t)) for t in texts)

    random = np.random.default_rng(6)
    sample = [s for s in sample_pieces(docs, doc, text) if not notice(s)]
    names = [w for s in sample for w in s.split()] or ["gadget", "sample", "any"]
    pick = lambda: names[random.integers(len(names))]

    def varied(line: str) -> str:
        """With about one word in twelve left out, and a word of the documents at times before it."""
        words = line.split()
        kept = [w for w in words if len(words) < 8 or random.random() > 1 / 12]
        return " ".join(([pick()] if random.random() < 0.2 else []) + kept)

    # Text, class and fold of each example; variants of one text are in different folds.
    rows: list[tuple[str, int, int]] = []
    for i, family in enumerate(families):
        for line in _sentences(licences[family]):
            shift = random.integers(FOLDS)
            rows += [(f.format(varied(line) if j else line), i, (j + shift) % FOLDS) for j, f in enumerate(FRAMES)]
        for line in _split(pa.array(_paragraphs(licences[family]), pa.string())):
            rows += [(varied(line) if j else line, i, j) for j in range(FOLDS)]
    rows += [(f.format(line), unknown, k % FOLDS) for k, licence in enumerate(OTHERS) for line in _sentences(licence) for f in FRAMES[:3]]
    rows += [(NO_NAMES[i % len(NO_NAMES)].format(pick(), pick()), unknown, i // len(NO_NAMES) % FOLDS) for i in range(320)]
    rows += [(line, plain, i % FOLDS) for i, line in enumerate([*ORDINARY, *sample])]
    features, label, fold = _rows([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    share = np.zeros((len(label), len(families) + 2))
    for k in range(FOLDS):
        weights, bias = _fit(features.take(fold != k), label[fold != k], len(families) + 2)
        share[fold == k] = _softmax(features.take(fold == k).score(weights) + bias)
    other = 1 - share[:, plain]
    best = share[:, : len(families)].max(axis=1) / np.maximum(other, 1e-12)
    at = lambda values, q: float(np.quantile(values, q)) if len(values) else 0.5
    # As few plain pieces and unknown licences as can be had without losing known ones.
    cut_plain = max(0.5, min(at(other[label == plain], 0.999), at(other[label != plain], 0.02)))
    # At 0.6 no second family is near: words that licences share, as the GNU ones do, name none of them.
    cut_known = max(0.6, min(at(best[label == unknown], 0.99), at(best[label < plain], 0.02)))
    weights, bias = _fit(features, label, len(families) + 2)
    return Classifier(families, weights, bias, cut_plain, cut_known, triples)


def scan_licences(docs: DataFrame, classifier: Classifier, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_paragraphs, n_licence, n_unknown, families`` per row of ``docs``.

    A paragraph with a confirmed piece names that piece's family; without one, and with a
    piece of an unknown licence, it counts as unknown. ``families`` are those named, sorted.

    A null or empty text, or one without words, has no paragraphs. Rows with a null id or
    a repeated one are judged each for itself; an empty table gives no rows; other columns
    of ``docs``, whatever their names, are not read. Long texts are scored a slice of
    words at a time; memory beside that is some 100 bytes a word of the longest text.
    """
    shared = ship(docs.sparkSession).sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        known = len(judge.families)
        for block in A.blocks(batches):
            rows = block.num_rows
            p = pieces(block.column("text"))
            found = judge.classes(p)
            named, odd = np.zeros(len(p.text_of), bool), np.zeros(len(p.text_of), bool)
            named[p.paragraph[found < known]] = True
            odd[p.paragraph[found > known]] = True
            sets: list[set[str]] = [set() for _ in range(rows)]
            for i in np.flatnonzero(found < known):
                sets[p.text_of[p.paragraph[i]]].add(judge.families[found[i]])
            count = lambda mask: pa.array(np.bincount(p.text_of[mask], minlength=rows).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), count(np.ones(len(named), bool)), count(named), count(odd & ~named),
                    pa.array([sorted(x) for x in sets], pa.list_(pa.string())),
                ],
                ["doc_id", "n_paragraphs", "n_licence", "n_unknown", "families"],
            )

    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_paragraphs long, n_licence long, n_unknown long, families array<string>")


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = scan_licences(docs, train(docs))
    return found.select("doc_id", "n_paragraphs", "n_licence", "n_unknown", F.array_join("families", ",").alias("families"))
