"""Approximate nearest neighbours by largest inner product, from balanced posting lists.

Vectors are put on a sphere by one more component, so that the largest inner product
is the least distance. A sample is halved again and again into clusters of one size;
their means are the centroids, and a list of vectors belongs to each. A vector near
a boundary stands in the lists of all centroids that are almost as near as its
nearest. A query takes the lists of the centroids within a ratio of the distance of
its nearest one. Both look centroids up in a graph of near centroids, held in memory.

Lists are stored as rows of bounded pieces, and queries meet them in blocks: a list
or a set of queries of any size is dealt to many tasks. Copies of one vector are
searched once; of the ids of copies only the least can be among the nearest of a
query, as ties go to the least id, so each piece has those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_work_folder
from .shipping import ship
from .steps import stored

# Vectors the centroids are fitted on, at most, and vectors per list aimed at.
SAMPLE = 32_768
LIST = 512
# A centroid is the mean of at least so many vectors of the sample.
_LEAST = 8
# Vectors or queries in one piece.
_PIECE = 512
# A vector is in all lists within this ratio of its nearest, a query takes those within that.
BOUNDARY, PROBE = 1.01, 1.16
_DEGREE, _BEAM = 16, 32


@dataclass
class Centroids:
    """Centroids on the sphere, and the graph of the nearest of each."""

    points: np.ndarray
    graph: np.ndarray
    dim: int
    norm: float

    def placed(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Vectors on the unit sphere: queries by direction, others by norm."""
        size = np.sqrt((vectors * vectors).sum(1))
        if query:
            return np.concatenate([vectors / size[:, None], np.zeros((len(vectors), 1))], 1).astype(np.float32)
        unit = vectors / self.norm
        rest = np.sqrt(np.maximum(1 - (size / self.norm) ** 2, 0))
        return np.concatenate([unit, rest[:, None]], 1).astype(np.float32)

    def near(self, points: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Row and centroid of all found within ``ratio`` of each row's least distance."""
        rows, found = [], []
        left, width = np.arange(len(points)), min(_BEAM, len(self.points))
        while len(left):
            more = []
            for part in np.array_split(left, -(-len(left) // 1024)):
                ids, far = self._walk(points[part], ratio, width)
                within = far <= ratio * far[:, :1]
                # A full beam may hide centroids that are as near: those rows go on with a wider one.
                full = within[:, -1] & (width < len(self.points))
                row, at = np.nonzero(within & ~full[:, None])
                rows.append(part[row])
                found.append(ids[row, at])
                more.append(part[full])
            left, width = np.concatenate(more), min(2 * width, len(self.points))
        return np.concatenate(rows or [left]), np.concatenate(found or [left])

    def _walk(self, points: np.ndarray, ratio: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``width`` centroids that a best-first walk finds, and their distances."""
        n, total = len(points), len(self.points)
        entry = np.unique(np.linspace(0, total - 1, min(8, width)).astype(int))
        seen = np.zeros((n, total), bool)
        seen[:, entry] = True
        ids = np.tile(entry, (n, 1))
        far = np.sqrt(np.maximum(2 - 2 * points @ self.points[entry].T + self._excess[entry], 0))
        done = np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(far, 1, kind="stable")[:, :width]
            ids, far, done = (np.take_along_axis(x, order, 1) for x in (ids, far, done))
            wanted = ~done & (far <= np.maximum(ratio * far[:, :1], far[:, min(_BEAM, far.shape[1]) - 1 : min(_BEAM, far.shape[1])]))
            wanted &= np.isfinite(far) & (np.cumsum(wanted, 1) <= 4)
            row, at = np.nonzero(wanted)
            if not len(row):
                return ids, far
            done |= wanted
            next_row = np.repeat(row, self.graph.shape[1])
            next_id = self.graph[ids[row, at]].ravel()
            fresh = ~seen[next_row, next_id]
            pair = np.unique(next_row[fresh] * total + next_id[fresh])
            next_row, next_id = pair // total, pair % total
            seen[next_row, next_id] = True
            place = np.arange(len(pair)) - np.searchsorted(next_row, next_row)
            most = int(place.max()) + 1 if len(pair) else 0
            new_id, new_far = np.zeros((n, most), int), np.full((n, most), np.inf)
            dots = np.einsum("ij,ij->i", points[next_row], self.points[next_id])
            new_id[next_row, place] = next_id
            new_far[next_row, place] = np.sqrt(np.maximum(2 - 2 * dots + self._excess[next_id], 0))
            ids, far = np.concatenate([ids, new_id], 1), np.concatenate([far, new_far], 1)
            done = np.concatenate([done, np.zeros((n, most), bool)], 1)

    @property
    def _excess(self) -> np.ndarray:
        """Squared lengths of the centroids less one: means of points on a sphere are within it."""
        return (self.points * self.points).sum(1) - 1


def fit(sample: np.ndarray, dim: int, norm: float, lists: int) -> Centroids:
    """``lists`` centroids (a power of two) by halving the sample, and their graph."""
    rng = np.random.default_rng(20)
    model = Centroids(np.zeros((1, dim + 1), np.float32), np.zeros((1, 1), int), dim, norm)
    points = model.placed(sample, False)
    groups = [np.arange(len(points))]
    while len(groups) < lists:
        halves = []
        for group in groups:
            own = points[group]
            pair = own[rng.choice(len(own), 2, replace=False)]
            for _ in range(6):
                order = np.argsort(own @ (pair[0] - pair[1]), kind="stable")
                low, high = order[: len(own) // 2], order[len(own) // 2 :]
                pair = np.stack([own[high].mean(0), own[low].mean(0)])
            halves += [group[low], group[high]]
        groups = halves
    centres = np.stack([points[group].mean(0) for group in groups])
    near = np.empty((lists, min(_DEGREE, lists)), int)
    for at in range(0, lists, 1024):
        far = (centres * centres).sum(1) - 2 * centres[at : at + 1024] @ centres.T
        near[at : at + 1024] = np.argsort(far, 1)[:, : near.shape[1]]
    # A ring through all of them, so that every centroid can be reached, and a few far ones.
    ring = rng.permutation(lists)
    after = np.empty(lists, int)
    after[ring] = np.roll(ring, -1)
    model.points, model.graph = centres, np.column_stack([near, after, rng.integers(0, lists, (lists, 3))])
    return model


def _usable(vector: Column) -> Column:
    """No null, all components finite, not zero throughout."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of doubles, short ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    at = np.repeat(np.cumsum(sizes) - sizes, sizes)
    row, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - at
    keep = place < dim
    out[row[keep], place[keep]] = flat[keep]
    return out


def _vectors(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32()), pa.array(matrix.ravel()))


@dataclass
class Index:
    """Stored lists, the centroids they belong to, and how many ids of copies they hold."""

    spark: SparkSession
    folder: str
    centroids: Centroids | None
    lists: DataFrame | None
    kept: int


def _pieced(rows: DataFrame, item: Column, name: str) -> DataFrame:
    """``list`` and arrays of about ``_PIECE`` items of ``rows`` (``list, id, ...``)."""
    # One row per list, and these are bounded by the sample.
    counts = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / _PIECE).alias("pieces"))
    dealt = rows.join(F.broadcast(counts), "list").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")))
    return dealt.groupBy("list", "piece").agg(F.collect_list(item).alias(name))


def build(vectors: DataFrame, doc: str, vector: str, kept: int = 21, sample: int = SAMPLE, size: int = LIST) -> Index:
    """An index of all rows; its centroids are fitted on ``sample`` vectors at most.

    Null vectors, those of zeros only, and those with null or non-finite components
    take no part, and neither do null ids; short vectors are as if filled up with
    zeros. Of rows that share an id, the one whose vector is greatest in Spark's order
    of arrays counts. Of equal vectors the ``kept`` least ids are listed: a search can ask for
    ``kept - 1`` neighbours besides the query's own id. Other columns are not read.
    An empty table makes an index without lists.
    """
    spark = ship(vectors.sparkSession)
    folder = new_work_folder(spark, "neighbours")
    rows = vectors.select(F.col(doc).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector"))).groupBy("id").agg(F.max("vector").alias("vector"))
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    # Spark takes the least ids of a vector in each task before they are shuffled.
    place = F.row_number().over(Window.partitionBy("hash", "vector").orderBy("id"))
    least = rows.withColumn("place", place).where(F.col("place") <= kept)
    classes = least.groupBy("hash", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = stored(classes.select("vector", "ids", F.col("ids")[0].alias("id"), "hash"), f"{folder}/classes")

    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim"), F.max(squares).alias("square")).first()
    if not facts.n:
        return Index(spark, folder, None, None, kept)
    share = min(1.0, 1.1 * sample / facts.n)
    drawn = classes.where(F.pmod("hash", F.lit(1 << 20)) < share * (1 << 20)) if share < 1 else classes
    drawn = drawn.select("hash", "vector").toArrow().sort_by("hash").slice(0, sample)
    lists = 1
    while lists * size < facts.n and 2 * lists * _LEAST <= drawn.num_rows:
        lists *= 2
    dim = facts.dim
    model = fit(_matrix(drawn.column("vector").combine_chunks(), dim), dim, float(np.sqrt(facts.square)), lists)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = _matrix(batch.column("vector"), dim)
            row, at = model.near(model.placed(full, False), BOUNDARY)
            picked = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), batch.column("id").take(picked), batch.column("ids").take(picked), _vectors(full[row])],
                ["list", "id", "ids", "vector"],
            )

    listed = classes.select("id", "ids", "vector").mapInArrow(assign, "list int, id long, ids array<long>, vector array<double>")
    listed = stored(listed, f"{folder}/assigned")
    pieces = stored(_pieced(listed, F.struct("ids", "vector"), "items"), f"{folder}/lists")
    return Index(spark, folder, model, pieces.select("list", "items"), kept)


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest scores first, ties by id, each id once, as a vector may stand in several lists."""
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:most]
    return scores[first], ids[first]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, component after component."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def search(index: Index, queries: DataFrame, doc: str, vector: str, k: int = 20) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` nearest found of each query, itself aside.

    ``score`` is the inner product in double precision; ties go to the lesser id, and
    a row with the query's own id is no candidate. A query with fewer candidates gets
    all that were found; one that takes no part, as in ``build``, gets none.
    """
    if k >= index.kept:
        raise ValueError(f"search: the index is made for {index.kept - 1} neighbours at most")
    spark, model, most = ship(queries.sparkSession), index.centroids, k + 1
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    folder = new_work_folder(spark, "search")
    rows = queries.select(F.col(doc).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("query_id").isNotNull() & _usable(F.col("vector"))).groupBy("query_id").agg(F.max("vector").alias("vector"))
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    # Equal queries are searched once, under the least of their ids.
    asked = rows.groupBy("hash", "vector").agg(F.min("query_id").alias("id"))
    asked = stored(asked, f"{folder}/asked")
    dim = model.dim

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = _matrix(batch.column("vector"), dim)
            some = np.flatnonzero((full != 0).any(1))
            row, at = model.near(model.placed(full[some], True), PROBE)
            row = some[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), batch.column("id").take(pa.array(row)), _vectors(full[row])], ["list", "id", "vector"]
            )

    probes = asked.select("id", "vector").mapInArrow(probe, "list int, id long, vector array<double>")
    probes = stored(probes, f"{folder}/probes")
    blocks = _pieced(probes, F.struct("id", "vector"), "queries").select("list", "queries")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asking, items = batch.column("queries")[i].values, batch.column("items")[i].values
                q, x = _matrix(asking.field("vector"), dim), _matrix(items.field("vector"), dim)
                near = q @ x.T
                # All that may be among the nearest by exact products, rounding aside.
                cut = np.partition(near, -min(most, len(x)), 1)[:, -min(most, len(x))]
                slack = 1e-9 * (1 + np.abs(near).max(1))
                row, at = np.nonzero(near >= (cut - slack)[:, None])
                score = _products(q[row], x[at])
                ids = items.field("ids")
                start = ids.offsets.to_numpy() - ids.offsets[0].as_py()
                size = np.diff(start)[at]
                flat = ids.flatten().to_numpy()
                pick = np.repeat(start[:-1][at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                row, score, found = np.repeat(row, size), np.repeat(score, size), flat[pick]
                bounds = np.searchsorted(row, np.arange(len(q) + 1))
                best = [_best(score[a:b], found[a:b], most) for a, b in zip(bounds[:-1], bounds[1:])]
                ends = pa.array(np.concatenate(([0], np.cumsum([len(s) for s, _ in best]))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        asking.field("id"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([s for s, _ in best]))),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate([f for _, f in best]))),
                    ],
                    ["id", "scores", "found"],
                )

    partial = index.lists.join(blocks, "list").select("queries", "items").mapInArrow(compare, "id long, scores array<double>, found array<long>")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                scores = batch.column("scores")[i].values.flatten().to_numpy()
                found = batch.column("found")[i].values.flatten().to_numpy()
                s, f = _best(scores, found, most)
                made.append({"id": batch.column("id")[i].as_py(), "best": [{"score": a, "id": b} for a, b in zip(s.tolist(), f.tolist())]})
            item = pa.struct([("score", pa.float64()), ("id", pa.int64())])
            yield pa.RecordBatch.from_pylist(made, schema=pa.schema([("id", pa.int64()), ("best", pa.list_(item))]))

    gathered = partial.groupBy("id").agg(F.collect_list(F.struct("scores", "found")).alias("lists"))
    gathered = gathered.select("id", F.col("lists.scores").alias("scores"), F.col("lists.found").alias("found"))
    answers = gathered.mapInArrow(merge, "id long, best array<struct<score:double,id:bigint>>")
    named = rows.join(asked, ["hash", "vector"]).select("query_id", "id").join(answers, "id")
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)
    ranked = named.select("query_id", F.posexplode(others).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit")["id"].alias("id"), F.col("hit")["score"].alias("score"))


def op11_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    found = search(build(table, "vec_id", "embedding"), table.where("vec_id % 20 = 0"), "vec_id", "embedding")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
