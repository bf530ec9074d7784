"""Neighbours, the Merkle manifest and the prefix trie against plain versions and odd tables."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from stationflow.llm import manifest, neighbours, prefix_trie, scan
from stationflow.session import new_work_folder


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- ranks and running sums ---------------------------------------------------------------

def test_ranks_and_sums_cross_tasks(spark):
    rng = random.Random(5)
    rows = [("big" if rng.random() < 0.6 else f"g{rng.randrange(40)}", i) for i in range(3000)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "g string, i long").withColumn("mark", F.unhex(F.sha2(F.col("i").cast("string"), 256)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scan.running(table, "g", ["i"], new_work_folder(spark, "scan"), mark="mark").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = collections.defaultdict(list)
    for g, i in sorted(rows):
        groups[g].append(i)
    found = {(r.g, r.i): r for r in got}
    for g, ids in groups.items():
        total = np.zeros(4, np.uint64)
        for rank, i in enumerate(ids, 1):
            r = found[g, i]
            assert [r[f"before_{k}"] for k in range(4)] == total.tolist()
            total = (total + np.frombuffer(hashlib.sha256(str(i).encode()).digest()[:16], "<u4")) & np.uint64(0xFFFFFFFF)
            assert (r["rank"], [r[f"upto_{k}"] for k in range(4)]) == (rank, total.tolist())


# -- op11 -------------------------------------------------------------------------------

def nearest(vectors, queries, k):
    """Exact neighbours: query -> [(id, score)]."""
    out = {}
    for query, q in queries:
        best = {}
        for i, x in vectors:
            if i != query:
                n = max(len(q), len(x))
                pad = lambda v: np.array([float(c) for c in v] + [0.0] * (n - len(v)))
                score = 0.0
                for a, b in zip(pad(q), pad(x)):
                    score += a * b
                best[i] = score
        out[query] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def test_neighbours_of_the_table(spark, tables):
    got = driver.queries()["op11_neighbours"](spark, tables).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    want = nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert found.keys() == want.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    every = {q: dict(nearest(rows, [(q, dict(rows)[q])], len(rows))[q]) for q in list(want)[:5]}
    for q, exact in every.items():
        assert all(score == exact[i] for i, score in found[q])
        assert found[q] == sorted(found[q], key=lambda p: (-p[1], p[0]))


def test_recall_with_many_lists(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 3
    rows = [(i, (centres[i % 30] + rng.normal(size=16)).tolist()) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = neighbours.build(table, "vec_id", "embedding", kept=11, sample=1000, size=50)
    assert len(index.centroids.points) == 64
    lists = index.lists.select("list", F.explode("items").alias("i")).select("list", F.explode("i.ids").alias("id"))
    assert lists.select("id").distinct().count() == 3000
    assert lists.count() > 3000  # boundary vectors stand in several lists
    asked = [r for r in rows if r[0] % 100 == 0]
    got = neighbours.search(index, table.where("vec_id % 100 = 0"), "vec_id", "embedding", k=10).collect()
    want = nearest(rows, asked, 10)
    found = collections.defaultdict(set)
    for r in got:
        found[r.query_id].add(r.id)
    assert sum(len(found[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_the_walk_finds_what_a_full_search_finds():
    rng = np.random.default_rng(4)
    sample = rng.normal(size=(4000, 8))
    model = neighbours.fit(sample, 8, float(np.sqrt((sample**2).sum(1).max())), 256)
    points = model.placed(rng.normal(size=(200, 8)), True)
    far = np.sqrt(np.maximum(((points[:, None, :].astype(float) - model.points[None]) ** 2).sum(2), 0))
    row, at = model.near(points, 1.2)
    want = {(i, j) for i, j in zip(*np.nonzero(far <= 1.2 * far.min(1, keepdims=True)))}
    assert len(want & set(zip(row.tolist(), at.tolist()))) >= 0.99 * len(want)
    assert len(want) > neighbours._BEAM  # more than a first beam holds


def test_neighbours_of_copies_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(100)] + [
        (100, [0.5, 0.5]), (101, [-1.0, 0.0]), (102, None), (103, [0.0, 0.0]), (104, [1.0, None]), (105, [nan, 1.0]),
        (106, [inf, 1.0]), (107, []), (108, [2.0]), (None, [1.0, 0.0]), (100, [0.5, 0.5]), (109, [0.0, 3.0]), (109, [-0.1, 9.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("list", F.lit(1))
    index = neighbours.build(table, "vec_id", "embedding", kept=4)
    got = neighbours.search(index, table.where("vec_id >= 99 OR vec_id IN (0, 50) OR vec_id IS NULL"), "vec_id", "embedding", k=3)
    found = collections.defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.id, r.score))
    assert found[0] == [(108, 2.0), (1, 1.0), (2, 1.0)]
    assert found[50] == [(108, 2.0), (0, 1.0), (1, 1.0)]
    assert found[99] == found[50]
    assert found[101] == [(109, 0.0), (100, -0.5), (0, -1.0)]
    assert set(found) == {0, 50, 99, 100, 101, 108, 109}
    assert found[108][0] == (0, 2.0)


def test_neighbours_of_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(20, [1.0, 2.0]), (3, [1.0, 0.0])], kind)
    got = neighbours.search(neighbours.build(few, "vec_id", "embedding"), few.where("vec_id % 20 = 0"), "vec_id", "embedding")
    assert [tuple(r) for r in got.collect()] == [(20, 1, 3, 1.0)]
    none = spark.createDataFrame([], kind)
    assert neighbours.search(neighbours.build(none, "vec_id", "embedding"), none, "vec_id", "embedding").collect() == []
    with pytest.raises(ValueError, match="20 neighbours"):
        neighbours.search(neighbours.build(few, "vec_id", "embedding"), few, "vec_id", "embedding", k=30)


# -- op12 -------------------------------------------------------------------------------

def plain_tree(nodes):
    """Root, and per node its siblings level by level: (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for k, path in enumerate(paths):
            run, p = runs[at[k] // 3], at[k] % 3
            path.append(("".join(run[:p]), "".join(run[p + 1 :])))
            at[k] //= 3
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_proofs(rows):
    """(doc, group, leaf, subroot, root, path) of rows (doc, group, text), sorted."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    root, tops = plain_tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for g, (subroot, paths), top in zip(names, trees, tops):
        for (_, _, leaf, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), paths):
            out.append((str(row[0]), g or "", leaf, subroot, root, path + top))
    return sorted(out)


@pytest.mark.parametrize("sizes", [[1], [3], [4], [729, 1], [730, 5, 1, 2], [2200, 28], [1] * 40])
def test_proofs_of_groups_of_all_sizes(spark, sizes):
    rows = [(i, None if g == 1 else f"s{g}é", f"text {i}\n{g}") for g, n in enumerate(sizes) for i in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    made = manifest.build(table, "doc_id", "source", ["doc_id", "source", "text"])
    got = made.proofs().withColumn("back", manifest.fold(F.col("leaf"), F.col("path"))).collect()
    assert all(r.back == r.root for r in got)
    shown = sorted((str(r.doc), r.group or "", r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in got)
    assert shown == plain_proofs(rows)
    records = {r.digest: r.children for r in made.records().collect()}
    assert all(sha("".join(v)) == k for k, v in records.items())
    assert made.root().first().root == got[0].root


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None), (1, "a", "x"), (1, "a", "x"), (1, "a", ""), (None, "a", "y"), (2, "-", None), (2, "", "z" * 300_000), (3, "", "é\n")]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("group", F.lit(7)).withColumn("digest", F.lit("d"))
    got = manifest.build(table, "doc_id", "source", ["doc_id", "source", "text"], carry=["digest", "text"]).proofs().collect()
    assert sorted((str(r.doc), r.group or "", r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in got) == plain_proofs(rows)
    assert {r.digest for r in got} == {"d"} and sorted(str(r.text) for r in got) == sorted(str(t) for _, _, t in rows)
    empty = manifest.build(table.limit(0), "doc_id", "source", ["doc_id"])
    assert empty.proofs().collect() == [] and empty.root().collect() == []


def test_tampering_shows(spark, tables):
    got = driver.queries()["op12_manifest"](spark, tables).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (docs[r.doc_id].text or "")
        assert r.verified is not changed and (r.folded_root == r.root) is r.verified
    assert {r.verified for r in got} == {True, False}


# -- op13 -------------------------------------------------------------------------------

def plain_trie(sequences):
    """Nodes of conv -> [(role, text)], as the query returns them."""
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) or 1
        saved[node] = sum(saved[c] for c in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(sequences[c]) == len(node)))
        up = min(members[node[:-1]]) if node else -1
        if node:
            children[node[:-1]].append(node)
        out.append((min(members[node]), len(node), up, len(members[node]), len(below), leaves[node], saved[node], sha(ends)))
    return sorted(out)


def plain_rebuilt(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[:2], sha(f"{len(t[2].encode())}:{t[2]}{t[3]}")))] for c, turns in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def nodes_of(rows):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in rows)


def test_trie_of_the_table(spark, tables):
    rows = spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert nodes_of(driver.queries()["op13_prefix_trie"](spark, tables).collect()) == plain_trie(plain_rebuilt(rows))


def test_trie_of_chains_hubs_and_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "é"])) for c in range(100, 260) for t in range(rng.randrange(1, 7))]
    rows += [(c, 0, "user", "hello") for c in range(1000, 1400)] + [(c, 1, "user", f"own {c}") for c in range(1000, 1400)]
    rows += [(7000, t, "user", f"{t}") for t in range(300)] + [(7001, t, "user", f"{t}" if t < 200 else "else") for t in range(250)]
    rows += [(5, None, "user", "first"), (5, 1, None, None), (5, 1, None, None), (None, 1, "user", "lost"), (6, 3, "b", "x"), (6, 3, "a", "x")]
    rows += [(8000, 0, "user", "x" * 100_000)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.withColumn("node", F.lit(1)).withColumn("rank", F.lit("r")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = driver.queries()["op13_prefix_trie"](spark, str(tmp_path)).collect()
    assert nodes_of(got) == plain_trie(plain_rebuilt(rows))


def test_trie_of_no_conversations(spark, tmp_path):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    assert driver.queries()["op13_prefix_trie"](spark, str(tmp_path)).collect() == []


def test_subtree_totals_of_random_forests(spark):
    rng = random.Random(9)
    parent = {i: (None if i < 3 else rng.randrange(max(0, i - rng.choice([1, 1, 1, 30])), i)) for i in range(800)}
    weight = {i: rng.randrange(-5, 50) for i in parent}
    n_children = collections.Counter(parent.values())
    node = lambda i: None if i is None else (i, -i)
    table = spark.createDataFrame(
        [(node(i), node(p), n_children[i], weight[i]) for i, p in parent.items()],
        "node struct<a:bigint,b:bigint>, parent struct<a:bigint,b:bigint>, n_children long, w long",
    )
    want = dict(weight)
    for i in range(799, 2, -1):
        want[parent[i]] += want[i]
    folder = new_work_folder(spark, "forest")
    got = prefix_trie.subtree_totals(table, ["w"], folder).collect()
    assert {r.node.a: r.w for r in got} == want


def test_ids_are_hashed_in_order_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_PIECE", 7)
    rows = [((g, 0), i * 3 % 1000) for g in range(3) for i in range(1 if g else 1000)]
    table = spark.createDataFrame(rows, "node struct<a:bigint,b:bigint>, conv_id long").repartition(8)
    got = {r.node.a: r.ends_sha256 for r in prefix_trie.joined_ids(table, new_work_folder(spark, "ids")).collect()}
    assert got == {g: sha(",".join(str(i) for i in sorted(i for n, i in rows if n[0] == g))) for g in range(3)}
