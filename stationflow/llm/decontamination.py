"""Benchmark decontamination by a distributed positional inverted index.

The training texts become index segments: a segment covers about a megabyte of
text and holds, per term, the ascending word positions. Segments are stored as a
table, so the index is built once and may be asked many times. A test phrase is
looked up by its rarest term (by counts over the whole index); every occurrence
proposes a start, and the lists of the next rarest terms, moved by their offsets,
are intersected with the starts that are left. What survives all terms is an exact
match; with a slop, terms may each stand that many words off their place, and every
start that the rarest term allows is tried, so the result does not depend on which
term is the rarest.

Segments are cut by text, not by term, so no list of a frequent term ever meets in
one task, and the postings are never shuffled.
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

WINDOW = 10
# Words that a term may stand off its place, in the query.
SLOP = 2
# Bytes of text per index segment.
SEGMENT_BYTES = 1 << 20
# Phrases asked in one pass over the index; more are asked in more passes.
PASS_PHRASES = 50_000
# Terms the index is narrowed to; a test set with more gets an index of all terms.
NARROW_TERMS = 200_000

_INDEX = (
    "segment long, doc_ids array<long>, doc_words array<long>, terms array<long>, "
    "sizes array<int>, positions array<int>"
)
_HITS = "segment long, ordinal int, hits array<long>, items array<long>, near array<long>"


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the text it is in."""
    data, offsets = A.text_bytes(column)
    data = A.lowered(data)
    starts, ends = A.runs(A.PLAIN_WORD[data], offsets)
    return A.word_hash(data, starts, ends).view(np.int64), A.owner(offsets, starts)


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def word_terms(texts: DataFrame, id_column: str, text: str = "text") -> DataFrame:
    """``id, terms``: the terms of each text in order. Null has none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in A.blocks(batches):
            terms, of = _terms(block.column("text"))
            ends = np.searchsorted(of, np.arange(block.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms))
            yield pa.RecordBatch.from_arrays([block.column("id"), lists], ["id", "terms"])

    source = texts.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(read, "id long, terms array<long>")


def phrases(tests: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``phrase, items``: distinct runs of ``window`` words and the tests they are of.

    A test of fewer words is one phrase; one without words, or null, has none.
    """
    of = word_terms(tests, item, text).where(F.size("terms") > 0)
    last = F.greatest(F.size("terms") - window, F.lit(0))
    each = of.select("id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("terms", i + 1, window))).alias("phrase"))
    return each.groupBy("phrase").agg(F.sort_array(F.collect_set("id")).alias("items"))


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per segment: its documents with their word counts, and its postings.

    Word positions run through a segment, with one left out between documents so
    that no phrase can cross. ``vocabulary``, sorted, keeps only the lists of those
    terms; words of other terms still count in positions.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for block in A.blocks(batches, size=SEGMENT_BYTES):
            terms, of = _terms(block.column("text"))
            counts = np.bincount(of, minlength=block.num_rows).astype(np.int64)
            at = np.arange(len(terms)) + of
            if vocabulary is not None and len(terms):
                place = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                known = vocabulary[place] == terms if len(vocabulary) else np.zeros(len(terms), bool)
                terms, at = terms[known], at[known]
            order = np.argsort(terms, kind="stable")
            terms, at = terms[order], at[order]
            heads = np.flatnonzero(A.first_of_run(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([segment]),
                    _list_of(block.column("doc_id")),
                    _list(counts, pa.int64()),
                    _list(terms[heads], pa.int64()),
                    _list(np.diff(heads, append=len(terms)), pa.int32()),
                    _list(at, pa.int32()),
                ],
                ["segment", "doc_ids", "doc_words", "terms", "sizes", "positions"],
            )
            segment += 1

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(build, _INDEX)


def _list_of(column: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def term_counts(index: DataFrame) -> DataFrame:
    """How often each indexed term occurs, over all segments."""
    each = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t"))
    return each.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.sizes").alias("n"))


def _passes(asked: DataFrame, counts: DataFrame, folder: str, size: int) -> Iterator[tuple]:
    """The phrases in bounded sets: terms, offsets from the rarest term on, and items."""
    spark = asked.sparkSession
    rarity = asked.select("phrase", "items", F.posexplode("phrase").alias("off", "term")).join(counts, "term", "left")
    ranked = rarity.groupBy("phrase", "items").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off"))).alias("rank")
    )
    # A phrase with a term that occurs nowhere occurs nowhere.
    found = ranked.where(F.col("rank")[0]["n"] > 0).select("phrase", "items", F.col("rank.off").alias("offs"))
    found.write.parquet(folder)
    stored = spark.read.parquet(folder)
    parts = -(-stored.count() // size)
    for part in range(parts):
        rows = stored.where(F.pmod(F.hash("phrase"), F.lit(parts)) == part).collect()  # at most about ``size``
        yield _packed(rows)


def _packed(rows) -> tuple:
    width = max((len(r.phrase) for r in rows), default=0)
    terms, offs = np.zeros((len(rows), width), np.int64), np.full((len(rows), width), -1, np.int64)
    for i, r in enumerate(rows):
        offs[i, : len(r.offs)] = r.offs
        terms[i, : len(r.offs)] = np.array(r.phrase, np.int64)[r.offs]
    sizes = np.array([len(r.items) for r in rows], np.int64)
    return terms, offs, sizes, np.array([x for r in rows for x in r.items], np.int64)


def _starts(keys, terms, sizes, ask, offs, slop: int, begins, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase, start and document of every match in one segment.

    ``keys`` are the postings as (place of the term, position), ascending; ``begins``
    and ``words`` say which positions each document has. All terms of a match are in
    one document; with a slop its start may be outside.
    """
    none = np.zeros(0, np.int64)
    heads = np.cumsum(sizes) - sizes
    place = np.searchsorted(terms, ask)
    place[place == len(terms)] = 0
    there = (terms[place] == ask) | (offs < 0)
    phrase = np.flatnonzero(there.all(axis=1))
    if not len(phrase):
        return none, none, none
    first = place[phrase, 0]
    count = sizes[first].astype(np.int64)
    at = keys[A.ragged(heads[first].astype(np.int64), count)] & 0xFFFFFFFF
    shift = np.repeat(offs[phrase, 0], count)
    phrase = np.repeat(phrase, count)
    doc = np.searchsorted(begins, at, "right") - 1
    start = (at - shift)[:, None] + np.arange(-slop, slop + 1)
    phrase, doc, start = np.repeat(phrase, 2 * slop + 1), np.repeat(doc, 2 * slop + 1), start.ravel()
    for k in range(1, ask.shape[1]):
        if not len(phrase):
            break
        off = offs[phrase, k]
        base = place[phrase, k].astype(np.int64) << 32
        low = np.maximum(start + off - slop, begins[doc])
        high = np.minimum(start + off + slop, begins[doc] + words[doc] - 1)
        found = np.minimum(np.searchsorted(keys, base + low), len(keys) - 1)
        ok = (keys[found] >= base + low) & (keys[found] <= base + high)
        ok |= off < 0
        phrase, start, doc = phrase[ok], start[ok], doc[ok]
    return phrase, start, doc


def _items_by_doc(phrase, doc, item_heads, item_sizes, items) -> tuple[np.ndarray, np.ndarray]:
    """Document and item of each pair that has a match, once, ascending."""
    item = items[A.ragged(item_heads[phrase], item_sizes[phrase])]
    of = np.repeat(doc, item_sizes[phrase])
    order = np.lexsort((item, of))
    item, of = item[order], of[order]
    once = A.first_of_run(of, item)
    return of[once], item[once]


def match_phrases(index: DataFrame, asked: tuple, slop: int = 0) -> DataFrame:
    """``segment, ordinal, hits, items, near`` of each document with a match.

    ``hits`` are word numbers inside any exact occurrence, ``items`` the tests these
    are of, ``near`` the tests of which a window matches with ``slop``.
    """
    ask, offs, item_sizes, items = asked
    lengths = (offs >= 0).sum(axis=1)
    item_heads = np.cumsum(item_sizes) - item_sizes
    shared = index.sparkSession.sparkContext.broadcast((ask, offs, lengths, item_sizes, item_heads, items))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, offs, lengths, item_sizes, item_heads, items = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
                terms, sizes, at = get("terms"), get("sizes"), get("positions").astype(np.int64)
                if not len(terms) or not len(ask):
                    continue
                words = get("doc_words")
                begins = np.cumsum(words) - words + np.arange(len(words))
                keys = (np.repeat(np.arange(len(terms)), sizes) << 32) | at
                phrase, start, doc = _starts(keys, terms, sizes, ask, offs, 0, begins, words)
                near_doc, near = item_doc, item = _items_by_doc(phrase, doc, item_heads, item_sizes, items)
                if slop:
                    loose, _, loose_doc = _starts(keys, terms, sizes, ask, offs, slop, begins, words)
                    near_doc, near = _items_by_doc(loose, loose_doc, item_heads, item_sizes, items)
                hit = np.unique(A.ragged(start, lengths[phrase]))
                hit_doc = np.searchsorted(begins, hit, "right") - 1
                some = np.union1d(item_doc, near_doc)
                cut = lambda of, values: pa.ListArray.from_arrays(
                    pa.array(np.append(np.searchsorted(of, some), len(of)), pa.int32()), pa.array(values, pa.int64())
                )
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), batch.column("segment")[i].as_py())),
                            pa.array(some, pa.int32()),
                            cut(hit_doc, hit - begins[hit_doc]),
                            cut(item_doc, item),
                            cut(near_doc, near),
                        ],
                        ["segment", "ordinal", "hits", "items", "near"],
                    )

    return index.mapInArrow(match, _HITS)


def find_contamination(
    docs: DataFrame, tests: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text",
    window: int = WINDOW, slop: int = 0, pass_phrases: int = PASS_PHRASES,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items, near_items, n_near``.

    ``items`` are the tests that share a window with the document, ascending.
    ``near_items`` are other tests that share one within ``slop``, ascending, and ``n_near``
    their number: there is a start, inside the document or before or after it, so that
    every word of the window stands in the document at most ``slop`` words off its place
    from there (one word of the document may stand for several equal ones). Null texts
    have no words; a null id is kept; rows that share an id are told apart; with no
    documents or no tests nothing is hit. Other columns are left out.
    """
    spark = ship(docs.sparkSession)
    folder = new_work_folder(spark, "decontamination")
    phrases(tests, item, text, window).write.parquet(f"{folder}/phrases")
    asked = spark.read.parquet(f"{folder}/phrases")
    terms = asked.select(F.explode("phrase").alias("term")).distinct()
    # A bounded look: one row beyond the bound means that all terms are indexed.
    narrow = np.array([r.term for r in terms.limit(NARROW_TERMS + 1).collect()], np.int64)
    vocabulary = np.sort(narrow) if len(narrow) <= NARROW_TERMS else None
    build_index(docs, vocabulary, doc, text).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    # A pass is written before the next one begins, so one set of phrases is held at a time.
    done = []
    for pack in _passes(asked, term_counts(index), f"{folder}/ranked", pass_phrases):
        done.append(f"{folder}/hits-{len(done)}")
        stored(match_phrases(index, pack, slop), done[-1])
    found = spark.read.schema(_HITS).parquet(*done) if done else spark.createDataFrame([], _HITS)
    by_doc = found.groupBy("segment", "ordinal").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    by_doc = by_doc.withColumn("near", F.array_except("near", "items"))
    every = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("ordinal", "d"))
    every = every.select("segment", "ordinal", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").alias("n_words"))
    return every.join(by_doc, ["segment", "ordinal"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("near", F.array().cast("array<long>")).alias("near_items"),
        F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"),
    )


def decontaminate(docs: DataFrame, tests: DataFrame, **names) -> DataFrame:
    """``docs`` without the documents that hold a window of a test.

    Rows that share the id of one that does go as well.
    """
    doc = names.get("doc", "doc_id")
    bad = find_contamination(docs, tests, **names).where("n_hit > 0").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[doc].eqNullSafe(bad["_bad"]), "left_anti")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tests = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = find_contamination(docs, tests, slop=SLOP)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dg AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dg.n, item_id FROM dg JOIN win USING (n, g)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
gk AS (SELECT g, n, unnest(g) AS word, unnest(range(1, n + 1)) AS k FROM (SELECT DISTINCT g, n FROM win)),
rare AS (
  SELECT g, n, word, k FROM gk LEFT JOIN (SELECT word, count(*) AS c FROM p GROUP BY word) USING (word)
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY coalesce(c, 0), k) = 1),
cand AS (SELECT DISTINCT g, n, doc_id, i - k + o AS s FROM rare JOIN p USING (word), (SELECT unnest(range(-2, 3)) AS o)),
near AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT cand.doc_id, cand.g, s FROM cand JOIN gk ON gk.g = cand.g
    JOIN p ON p.doc_id = cand.doc_id AND p.word = gk.word AND p.i BETWEEN s + gk.k - 2 AND s + gk.k + 2
    GROUP BY cand.doc_id, cand.g, s, cand.n HAVING count(DISTINCT gk.k) = cand.n)),
nr AS (
  SELECT doc_id, count(*) AS n_near FROM (
    SELECT DISTINCT doc_id, item_id FROM near JOIN win USING (g) EXCEPT SELECT DISTINCT doc_id, item_id FROM m)
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN nr USING (doc_id)
"""
