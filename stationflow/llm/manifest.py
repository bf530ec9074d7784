"""A Merkle manifest of a table: a content-addressed store of records, and proofs from it.

Every row is a leaf: the digest of its columns. Within a group the leaves stand in
order; every three consecutive nodes become the digest of their digests, level by
level, until one is left; the same is done with the groups' roots. A record has a
digest and the digests it was made of; records are kept in packs, each of which is
the part of the tree below one node down to 729 nodes six levels deeper.

Proofs descend from the root: a request for a leaf has the digits of the leaf's rank
in base three. At each pack it looks its digest up, takes the child that the digit
names, and collects the others; the path of the next pack goes on from the child it
came to. At the leaf the segments are put in reverse, and the path reads from the
leaf to the root. Requests below one node share the path down to it, so no record
is asked for by more requests than it has packs below it, and no group meets in one
task however many rows it has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_work_folder
from .scan import running
from .shipping import ship
from .steps import stored

FANOUT = 3
# Levels of a pack, and the nodes below it.
LEVELS = 6
PACK = FANOUT**LEVELS

_PACKED = "group string, pos long, digest string, n int, levels int, records array<struct<digest:string,children:array<string>>>"
_SIDES = "array<struct<left:string,right:string>>"


def digest_of(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def leaf_digest(*columns: str) -> Column:
    """SHA-256 over the columns: ``-`` for null, else byte count, ``:`` and the value."""
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def levels_over(n: int, alone: bool) -> int:
    """Levels from ``n`` nodes to their pack's one; a group's only pack has as many as it needs."""
    if not alone:
        return LEVELS
    levels = 0
    while FANOUT**levels < n:
        levels += 1
    return levels


def records_of(nodes: list[str], levels: int) -> tuple[str, dict[str, list[str]]]:
    """The digest over ``nodes``, and digest -> children of all nodes above them."""
    found: dict[str, list[str]] = {}
    for _ in range(levels):
        runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
        nodes = [digest_of(run) for run in runs]
        found.update(zip(nodes, runs))
    return nodes[0], found


def descend(records: dict[str, list[str]], digest: str, rank: int, levels: int) -> tuple[str, list[tuple[str, str]]]:
    """The node of ``rank`` below ``digest``, and its siblings on the way down, left and right."""
    passed = []
    for level in range(levels - 1, -1, -1):
        digit = rank // FANOUT**level % FANOUT
        children = records[digest]
        passed.append(("".join(children[:digit]), "".join(children[digit + 1 :])))
        digest = children[digit]
    return digest, passed


def _packs(nodes: DataFrame) -> DataFrame:
    """Packs over ``group, pos, digest``: one row per 729 consecutive nodes of a group."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                below = [node["digest"] for node in row["nodes"]]
                # The first pack of a group is its only one unless it is full; then it has all levels anyhow.
                levels = levels_over(len(below), row["pos"] == 0 and len(below) < PACK)
                digest, found = records_of(below, levels)
                records = [{"digest": k, "children": v} for k, v in found.items()]
                made = {"group": row["group"], "pos": row["pos"], "digest": digest, "n": len(below), "levels": levels, "records": records}
                yield pa.RecordBatch.from_pylist([made], schema=_ARROW)

    dealt = nodes.groupBy("group", F.floor(F.col("pos") / PACK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("nodes"))
    return dealt.select("group", F.col("block").alias("pos"), "nodes").mapInArrow(pack, _PACKED)


_RECORD = pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])
_ARROW = pa.schema(
    [("group", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("n", pa.int32()), ("levels", pa.int32()), ("records", pa.list_(_RECORD))]
)
_SIDE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


@dataclass
class Manifest:
    """The stored tree of a table: ``members`` are its leaves, packs hold its records."""

    spark: SparkSession
    folder: str
    members: DataFrame
    carried: list[str]
    lower: list[DataFrame]
    groups: DataFrame
    upper: list[DataFrame]

    def records(self) -> DataFrame:
        """``digest, children``: every record of the tree, once."""
        all_packs = [packs.select(F.explode("records").alias("r")).select("r.*") for packs in (*self.lower, *self.upper)]
        found = all_packs[0]
        for more in all_packs[1:]:
            found = found.union(more)
        return found.groupBy("digest").agg(F.first("children").alias("children"))

    def root(self) -> DataFrame:
        """``root``: one row, or none for an empty table."""
        return self.upper[-1].select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """Every leaf with its path; see ``prove``."""
        return prove(self)


def _tree(nodes: DataFrame, folder: str) -> list[DataFrame]:
    """Packs level by level, from the nodes up to one pack per group."""
    steps = []
    while True:
        packs = stored(_packs(nodes), f"{folder}/packs-{len(steps)}")
        steps.append(packs)
        if not packs.agg(F.max("pos")).first()[0]:
            return steps
        nodes = packs.select("group", "pos", "digest")


def build(rows: DataFrame, doc: str, group: str, columns: list[str], carry: list[str] = ()) -> Manifest:
    """The tree over ``rows``: groups by ``group`` (null first, then by UTF-8 bytes), leaves by ``doc``.

    A leaf is the digest of ``columns``. ``carry`` names further columns that stay
    with the leaves. Null ids come first; rows that tie in their id stand by their
    digests, and rows that are the same in all columns are leaves each. An empty
    table has no root. Other columns are not read; clashing names do no harm, as
    all columns are renamed on the way in.
    """
    spark = ship(rows.sparkSession)
    folder = new_work_folder(spark, "manifest")
    # The group as text that sorts null first and is never null.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    carried = [f"carry_{i}" for i in range(len(carry))]
    slim = rows.select(
        key.alias("group"), F.col(doc).alias("doc"), leaf_digest(*columns).alias("leaf"),
        *(F.col(name).alias(alias) for name, alias in zip(carry, carried)),
    )
    slim = stored(slim, f"{folder}/leaves")
    members = running(slim, "group", ["doc", "leaf"], f"{folder}/members").withColumn("rank", F.col("rank") - 1)
    lower = _tree(members.select("group", F.col("rank").alias("pos"), F.col("leaf").alias("digest")), f"{folder}/lower")
    tops = lower[-1].select(F.lit("").alias("group"), F.col("group").alias("name"), "digest")
    groups = running(tops, "group", ["name"], f"{folder}/groups").withColumn("rank", F.col("rank") - 1)
    upper = _tree(groups.select("group", F.col("rank").alias("pos"), "digest"), f"{folder}/upper")
    return Manifest(spark, folder, members, list(carry), lower, groups, upper)


def _store(packs: DataFrame) -> DataFrame:
    """The packs under their digests, each once, however often it stands in the tree."""
    return packs.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("n", "levels", "records")))


def _opened(requests: DataFrame, packs: DataFrame) -> DataFrame:
    """Requests for the nodes below a pack, from requests for packs."""

    def open_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("group", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("top", pa.string()), ("root", pa.string()), ("path", _SIDE)])
        for batch in batches:
            for row in batch.to_pylist():
                records = {r["digest"]: r["children"] for r in row["records"]}
                made = []
                for rank in range(row["n"]):
                    digest, passed = descend(records, row["digest"], rank, row["levels"])
                    path = row["path"] + [{"left": left, "right": right} for left, right in passed]
                    made.append({"group": row["group"], "pos": row["pos"] * PACK + rank, "digest": digest, "top": row["top"], "root": row["root"], "path": path})
                yield pa.RecordBatch.from_pylist(made, schema=schema)

    kept = "group string, pos long, digest string, top string, root string, path " + _SIDES
    return requests.join(_store(packs), "digest").mapInArrow(open_packs, kept)


def prove(manifest: Manifest) -> DataFrame:
    """``doc, group, leaf, rank, subroot, root, path`` and the carried columns, per leaf.

    ``path`` goes from the leaf to the root: at each level the digests of the run's
    other nodes, those to the left and those to the right, each concatenated.
    """
    folder = manifest.folder
    none = F.array().cast(_SIDES)
    requests = manifest.upper[-1].select("group", "pos", "digest", F.lit("").alias("top"), F.col("digest").alias("root"), none.alias("path"))
    for i, packs in reversed(list(enumerate(manifest.upper))):
        requests = stored(_opened(requests, packs), f"{folder}/asked-upper-{i}")
    named = manifest.groups.select(F.col("rank").alias("pos"), F.col("name"))
    requests = requests.join(named, "pos").select(F.col("name").alias("group"), F.lit(0).cast("long").alias("pos"), "digest", F.col("digest").alias("top"), "root", "path")
    for i, packs in reversed(list(enumerate(manifest.lower))[1:]):
        requests = stored(_opened(requests, packs), f"{folder}/asked-lower-{i}")

    # The last packs are opened where their leaves are: one row per leaf comes out.
    carried = [f"carry_{i}" for i in range(len(manifest.carried))]
    fields = {f.name: f.dataType.simpleString() for f in manifest.members.schema}
    leaf = F.struct("rank", "doc", "leaf", *carried)
    of_block = manifest.members.groupBy("group", F.floor(F.col("rank") / PACK).alias("pos")).agg(F.array_sort(F.collect_list(leaf)).alias("leaves"))
    schema = f"doc {fields['doc']}, `group` string, leaf string, rank long, subroot string, root string, path {_SIDES}"
    schema += "".join(f", {c} {fields[c]}" for c in carried)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = {f.name: f.type for f in batch.schema.field("leaves").type.value_type}
            wanted = pa.schema([
                ("doc", kinds["doc"]), ("group", pa.string()), ("leaf", pa.string()), ("rank", pa.int64()), ("subroot", pa.string()),
                ("root", pa.string()), ("path", _SIDE), *((c, kinds[c]) for c in carried),
            ])
            for row in batch.to_pylist():
                records = {r["digest"]: r["children"] for r in row["records"]}
                above = [{"left": s["left"], "right": s["right"]} for s in reversed(row["path"])]
                made = []
                for one in row["leaves"]:
                    digest, passed = descend(records, row["digest"], one["rank"] % PACK, row["levels"])
                    if digest != one["leaf"]:
                        raise ValueError(f"manifest: the path of leaf {one['leaf']} leads to {digest}")
                    path = [{"left": left, "right": right} for left, right in reversed(passed)] + above
                    made.append({**one, "group": row["group"], "subroot": row["top"], "root": row["root"], "path": path})
                yield pa.RecordBatch.from_pylist(made, schema=wanted)

    found = requests.join(_store(manifest.lower[0]), "digest").join(of_block, ["group", "pos"]).mapInArrow(answer, schema)
    group = F.when(F.col("group") != "", F.expr("substring(`group`, 2)"))
    named = [F.col(a).alias(name) for a, name in zip(carried, manifest.carried)]
    return found.select("doc", group.alias("group"), "leaf", "rank", "subroot", "root", "path", *named)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


_LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*_LEAF)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    docs = docs.withColumn("changed", F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text")))
    docs = docs.withColumn("tampered", leaf_digest("doc_id", "source", "lang", "n_chars", "changed"))
    proofs = build(docs, "doc_id", "source", list(_LEAF), carry=["tampered"]).proofs()
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = proofs.withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    return folded.select(
        F.col("doc").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def crc32_sql(text: str) -> str:
    """DuckDB has no CRC-32: bit by bit over the bytes of ``text``, which is ASCII."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: {step})"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295)"


def _op12_sql(levels: int = 12, top: int = 6) -> str:
    """Level by level; ``levels`` over a source do for 3 ** levels rows of it."""

    def part(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"

    whole = " || ".join(part(c) for c in _LEAF)
    changed = " || ".join(part(c) for c in (*_LEAF[:-1], "changed"))
    steps = [f"""
WITH docs AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents
), up_0 AS (
  SELECT doc_id, sha256({whole}) AS leaf, sha256({changed}) AS folded, coalesce('=' || source, '') AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, '' AS path
  FROM docs
), node_0 AS (SELECT g, pos, leaf AS digest FROM up_0)"""]

    def climb(name: str, n: int, up: str) -> str:
        found = up
        for i in range(n):
            a, b = f"{name}_{i}", f"{name}_{i + 1}"
            sides = f"coalesce((SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM {a} s WHERE s.g = u.g AND s.pos // 3 = u.pos // 3 AND s.pos {{}} u.pos), '')"
            steps.append(f"""
, {name}_size_{i} AS (SELECT g, count(*) AS n FROM {a} GROUP BY g)
, {b} AS (
  SELECT g, CASE WHEN n > 1 THEN pos // 3 ELSE pos END AS pos, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY a.pos)) ELSE min(digest) END AS digest
  FROM {a} a JOIN {name}_size_{i} USING (g) GROUP BY g, n, CASE WHEN n > 1 THEN a.pos // 3 ELSE a.pos END
), {name}_side_{i} AS (
  SELECT u.g, u.pos, {sides.format("<")} AS l, {sides.format(">")} AS r FROM {a} u
), up_{name}_{i + 1} AS (
  SELECT u.* EXCLUDE (folded, pos, path), CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded,
    CASE WHEN n > 1 THEN u.pos // 3 ELSE u.pos END AS pos, CASE WHEN n > 1 THEN path || l || r ELSE path END AS path
  FROM {found} u JOIN {name}_size_{i} USING (g) JOIN {name}_side_{i} s ON s.g = u.g AND s.pos = u.pos
)""")
            found = f"up_{name}_{i + 1}"
        return found

    last = climb("node", levels, "up_0")
    steps.append(f"""
, top_0 AS (SELECT '' AS g, g AS name, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, digest FROM node_{levels})
, up_top_0 AS (
  SELECT u.doc_id, u.leaf, u.folded, t.g, t.pos, u.path, t.digest AS subroot FROM {last} u JOIN top_0 t ON t.name = u.g
)""")
    last = climb("top", top, "up_top_0")
    return "".join(steps) + f"""
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(path) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM {last} u JOIN top_{top} t ON t.g = u.g"""


OP12_SQL = _op12_sql()
