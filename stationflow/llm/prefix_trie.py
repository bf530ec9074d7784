"""A trie of conversations by their turns, and totals of its subtrees by tree contraction.

A node is a sequence of first turns; conversations that start with it are its members.
Prefixes are told apart by a sum of 128 bits over their turns' SHA-256 marks, each
taken with its place, so a running sum over sorted turns names every prefix, and a
conversation of any length is summed by many tasks.

Totals over subtrees come by contraction in rounds of joins. Each round rakes: leaves
leave the tree and their totals are added up at their parents. Then it compresses: of
the nodes with one child left, those whose random number exceeds that of their parent
and that of their child are spliced out; the child goes to the grandparent and carries
what was gathered on the way. No two neighbours are spliced in one round, a third of a
chain goes in each, and after about log(n) rounds nothing is left. The rounds are then
gone through backwards, and each spliced node gets its total from its child's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_work_folder
from .manifest import crc32_sql
from .scan import running
from .shipping import ship
from .steps import stored

# Ids of one node that are put into one piece of text before they meet.
_PIECE = 4096


def marked(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, mark, chars``: turns without their texts; null role or text is empty."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    mark = F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)
    rows = turns.where(F.col(conv).isNotNull())
    return rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), mark.alias("mark"), F.length(said).cast("long").alias("chars"))


def _key(of: str) -> Column:
    """Four numbers of 32 bits as two longs."""
    pairs = [F.shiftleft(F.col(f"{of}_{i}"), 32).bitwiseOR(F.col(f"{of}_{i + 1}")) for i in (0, 2)]
    return F.struct(pairs[0].alias("a"), pairs[1].alias("b"))


def prefixes(turns: DataFrame, folder: str) -> DataFrame:
    """``conv_id, depth, node, parent, chars, total`` per turn of ``conv_id, depth, mark, chars, total``."""
    placed = F.unhex(F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("mark")), 256))
    summed = running(turns.withColumn("mark", placed), "conv_id", ["depth"], folder, mark="mark")
    return summed.select("conv_id", "depth", _key("upto").alias("node"), _key("before").alias("parent"), "chars", "total")


def trie(convs: DataFrame, turns: DataFrame, folder: str) -> DataFrame:
    """The nodes: ``node, depth, parent, conv_id, n_convs, chars, parent_conv_id, n_children``.

    ``convs`` has every ``conv_id``, ``turns`` the ``prefixes``; conversations without
    turns are members of the root alone. No conversations, no nodes.
    """
    nodes = turns.groupBy("node").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.first("chars").alias("chars"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.struct(zero.alias("a"), zero.alias("b")).alias("node"), zero.alias("depth"),
        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"), "conv_id", "n_convs", zero.alias("chars"),
    )
    nodes = stored(nodes.unionByName(root), f"{folder}/nodes")
    children = stored(nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")), f"{folder}/children")
    nodes = nodes.join(children.withColumnRenamed("parent", "node"), "node", "left")
    nodes = stored(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), f"{folder}/counted")

    # A parent with more than a 256th of all nodes below it is one of 256 at most:
    # these are broadcast, so that no join key has more than a 256th of the rows.
    crowded = F.lit(nodes.count() / 256)
    named = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = named.where(F.col("n_children") > crowded).select("parent", F.col("parent_conv_id").alias("hot_conv_id"))
    rest = named.where(F.col("n_children") <= crowded).drop("n_children")
    told = nodes.join(F.broadcast(hot), "parent", "left")
    near = told.where("hot_conv_id IS NOT NULL OR parent IS NULL").withColumn("parent_conv_id", F.col("hot_conv_id"))
    far = told.where("hot_conv_id IS NULL AND parent IS NOT NULL").join(rest, "parent", "left")
    return stored(near.unionByName(far).drop("hot_conv_id"), f"{folder}/trie")


def _luck(node: Column | str, turn: int) -> Column:
    node = F.col(node) if isinstance(node, str) else node
    return F.xxhash64(F.lit(turn), node["a"], node["b"])


def subtree_totals(nodes: DataFrame, weights: list[str], folder: str) -> DataFrame:
    """``node`` and, per weight, the sum of it over the node's subtree, the node included.

    ``nodes`` is a forest: ``node, parent, n_children`` and the weights, as longs;
    the parent of a root is null. Each round is written below ``folder``.
    """
    gathered, carried = [f"sum_{w}" for w in weights], [f"carry_{w}" for w in weights]
    pushed = [f"push_{w}" for w in weights]
    kind = nodes.schema["node"].dataType
    zero = F.lit(0).cast("long")
    start = nodes.select(
        "node", "parent", F.col("n_children").alias("m"), *(F.col(w).cast("long").alias(g) for w, g in zip(weights, gathered)),
        *(zero.alias(c) for c in carried), F.lit(None).cast(kind).alias("gone"), *(zero.alias(p) for p in pushed),
    )
    rounds = [stored(start, f"{folder}/round-0")]
    while True:
        now = rounds[-1]
        if now.where("m > 0").isEmpty():
            break
        # Rake: leaves are added up at their parents, which learn who is left below them.
        leaf = F.col("m") == 0
        below = now.where("parent IS NOT NULL").groupBy("parent").agg(
            F.count_if(~leaf).alias("left"), F.max(F.when(~leaf, F.col("node"))).alias("only"),
            *(F.sum(F.when(leaf, F.col(g) + F.col(c)).otherwise(0)).alias(f"add_{g}") for g, c in zip(gathered, carried)),
        )
        inner = now.where(~leaf).drop("gone", "m", *pushed).join(below.withColumnRenamed("parent", "node"), "node")
        inner = inner.withColumns({g: F.col(g) + F.col(f"add_{g}") for g in gathered})
        # Compress: of the nodes with one child, those that exceed both neighbours.
        turn = len(rounds)
        mine = _luck("node", turn)
        out = (F.col("left") == 1) & F.col("parent").isNotNull() & (mine > _luck("parent", turn)) & (mine > _luck("only", turn))
        inner = inner.withColumn("out", F.coalesce(out, F.lit(False))).select("node", "parent", F.col("left").alias("m"), "only", "out", *gathered, *carried)
        spliced = inner.where("out").select(
            F.col("only").alias("node"), F.col("node").alias("gone"), F.col("parent").alias("up"),
            *(F.col(g).alias(f"add_{g}") for g in gathered), *(F.col(c).alias(f"add_{c}") for c in carried),
        )
        kept = inner.where("NOT out").drop("only", "out").join(spliced, "node", "left")
        add = lambda name: F.coalesce(F.col(f"add_{name}"), zero)
        moved = kept.select(
            "node", F.coalesce("up", "parent").alias("parent"), "m", *gathered,
            *((F.col(c) + add(g) + add(c)).alias(c) for g, c in zip(gathered, carried)), "gone",
            # The spliced node's total is this node's total and what stood between.
            *((F.col(c) + add(g)).alias(p) for g, c, p in zip(gathered, carried, pushed)),
        )
        rounds.append(stored(moved, f"{folder}/round-{turn}"))

    # Backwards: what a round spliced out has a child that a later round settled.
    spark, done = nodes.sparkSession, []
    for turn in range(len(rounds) - 1, -1, -1):
        now = rounds[turn]
        settled = now.where("m = 0").select("node", *gathered)
        known = settled
        if done:
            known = settled.unionByName(spark.read.schema(settled.schema).parquet(*done))
        again = now.where("gone IS NOT NULL").select("node", "gone", *pushed).join(known, "node")
        again = again.select(F.col("gone").alias("node"), *((F.col(g) + F.col(p)).alias(g) for g, p in zip(gathered, pushed)))
        stored(settled.unionByName(again), f"{folder}/settled-{turn}")
        done.append(f"{folder}/settled-{turn}")
    return spark.read.parquet(*done).toDF("node", *weights)


def joined_ids(members: DataFrame, folder: str) -> DataFrame:
    """``node, ends_sha256``: SHA-256 of each node's ids of ``node, conv_id``, ascending and comma-joined.

    Ids are sorted over all tasks and put into pieces of text; the pieces of a node
    are then hashed one after the other, so a node of any size passes through a task
    without being held in it.
    """
    spark = ship(members.sparkSession)
    kind = "struct<a:bigint,b:bigint>"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            made, at = [], 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or nodes[i] != nodes[at] or i - at == _PIECE:
                    made.append({"node": nodes[at], "first": ids[at], "ids": ",".join(map(str, ids[at:i]))})
                    at = i
            yield pa.RecordBatch.from_pylist(made, schema=pa.schema([("node", batch.schema.field("node").type), ("first", pa.int64()), ("ids", pa.string())]))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            schema = pa.schema([("node", batch.schema.field("node").type), ("ends_sha256", pa.string())])
            made = []
            for row in batch.to_pylist():
                if row["node"] != node:
                    if node is not None:
                        made.append({"node": node, "ends_sha256": state.hexdigest()})
                    node, state = row["node"], hashlib.sha256(row["ids"].encode())
                else:
                    state.update(b"," + row["ids"].encode())
            yield pa.RecordBatch.from_pylist(made, schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], schema=schema)

    by = ["node", "conv_id"]
    short = members.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(pieces, f"node {kind}, first long, ids string")
    short = stored(short, f"{folder}/pieces")
    return short.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashes, f"node {kind}, ends_sha256 string")


def prefix_nodes(convs: DataFrame, turns: DataFrame, folder: str) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv_id, depth, mark, chars, total``).

    ``depth`` counts the turns of a conversation from 1, ``total`` is their number,
    ``convs`` names every ``conv_id`` once. Returns ``node`` (what tells it from all
    others), ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, and over its subtree ``n_leaves`` and
    ``saved_tokens``: characters of last turns that further members share;
    ``ends_sha256`` is that of the members that end there.
    """
    ship(convs.sparkSession)
    walked = stored(prefixes(turns, f"{folder}/prefixes"), f"{folder}/walked")
    nodes = trie(convs, walked, f"{folder}/trie")
    weighed = nodes.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    })
    totals = subtree_totals(weighed, ["n_leaves", "saved_tokens"], f"{folder}/totals")
    zero = F.lit(0).cast("long")
    silent = convs.join(turns.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    ends = walked.where("depth = total").select("node", "conv_id").union(
        silent.select(F.struct(zero.alias("a"), zero.alias("b")).alias("node"), "conv_id")
    )
    hashed = joined_ids(ends, f"{folder}/ends")
    return nodes.drop("chars", "parent").join(totals, "node", "left").join(hashed, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    )


def numbered(turns: DataFrame, folder: str) -> DataFrame:
    """``marked`` turns with their ``rank`` in the conversation: null turns first, ties by their marks."""
    return running(turns, "conv_id", ["turn", "mark"], folder)


def rebuilt(turns: DataFrame, convs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin as another: ``conv_id, depth, mark, chars, total``.

    Conversation c takes the first h turns of c - c % ``every``, h = crc32(c) % ``most``,
    and goes on with its own after its first h.
    """
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    asked = convs.select("conv_id", "n_own", (crc % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    lent = turns.where((F.col("conv_id") % every == 0) & (F.col("rank") < most))
    held = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    asked = asked.join(held, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    asked = asked.withColumn("total", F.col("k") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    lent = lent.select(F.col("conv_id").alias("base"), "rank", "mark", "chars").join(asked, "base").where("rank <= h")
    lent = lent.select("conv_id", F.col("rank").alias("depth"), "mark", "chars", "total")
    own = turns.join(asked.select("conv_id", "h", "k", "total"), "conv_id").where("rank > h")
    return lent.union(own.select("conv_id", (F.col("rank") - F.col("h") + F.col("k")).alias("depth"), "mark", "chars", "total"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    work = new_work_folder(spark, "prefix-trie")
    table = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = numbered(marked(table), f"{work}/numbered")
    convs = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")), f"{work}/convs")
    found = prefix_nodes(convs.select("conv_id"), rebuilt(turns, convs), work)
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


OP13_SQL = f"""
WITH said AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT DISTINCT conv_id, {crc32_sql("conv_id::VARCHAR")} % 6 AS h, conv_id - conv_id % 100 AS base FROM said
), lent AS (
  SELECT c.conv_id, s.i AS d, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.base AND s.i <= c.h
), k AS (
  SELECT c.conv_id, h, (SELECT count(*) FROM lent l WHERE l.conv_id = c.conv_id) AS k FROM convs c
), turns AS (
  SELECT * FROM lent UNION ALL
  SELECT s.conv_id, s.i - k.h + k.k, s.role, s.text FROM said s JOIN k ON s.conv_id = k.conv_id AND s.i > k.h
), walked AS (
  SELECT conv_id, d, length(text) AS chars, text,
    string_agg(sha256(strlen(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY d) AS node,
    max(d) OVER (PARTITION BY conv_id) AS total
  FROM turns
), paths AS (
  SELECT conv_id, d, chars, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY d), '') AS parent, total FROM walked
  UNION ALL SELECT conv_id, 0, 0, '', NULL, coalesce((SELECT max(d) FROM turns t WHERE t.conv_id = c.conv_id), 0) FROM convs c
), nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (d = total), '')) AS ends_sha256
  FROM paths GROUP BY node, d
), counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.parent = n.node) AS n_children FROM nodes n
), totals AS (
  SELECT above.node, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM counted n JOIN paths above ON above.conv_id = n.conv_id AND above.d <= n.d GROUP BY above.node
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t USING (node) LEFT JOIN nodes p ON p.node = n.parent"""
