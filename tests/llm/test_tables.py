"""URL filters, chat formatting, licence scans, and the registered queries against their SQL."""

from __future__ import annotations

import importlib.metadata
import random
import re
import textwrap

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from stationflow.llm import chat, components, licence_texts, licences, near_dedup, pii, quality, registry, url_rules

from . import brute

NATIVE = ("op2_pii", "op5_url_rules", "op8_chat")


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, tables, name):
    got = driver.queries()[name](spark, tables)
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(str(r[c]) for c in sorted(columns)) for r in got.collect()]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert sorted(rows) == sorted(tuple(str(r[i]) for i in order) for r in expected.fetchall())


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, tables, name):
    plan = driver.queries()[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def fits(host, path, rule):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def test_url_rules_against_all_rules(spark):
    rng = random.Random(8)
    labels, paths = ["a", "b", "org", "com", "example", "A1", "x-y", ""], ["", "/", "/a", "/a/b", "/a/b/c", "/b", "/é"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    rules = {(host(rng.randint(1, 3)), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http{rng.choice('s ')}://{host(rng.randint(1, 5))}{rng.choice(paths)}{rng.choice(['', '?q=://x/', '#top', '/z'])}" for _ in range(600)]
    urls += [None, "", "no scheme/a", "://", "://org", "x://ORG/a://b", "http://org?x/a", "a\nb://c.org/d\ne?"]
    pages = spark.createDataFrame([(i, u, "k", 1) for i, u in enumerate(urls)], "page_id long, url string, key string, range int")
    found = url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), default="method")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert len(got) == len(urls)
    lowered = [(h.translate(brute.LOWER), p, v, h + p) for h, p, v in rules if h]
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        name = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(name) :])[0]
        name = name.translate(brute.LOWER)
        best = max(((len(r[3]), r[2] == "block", r[3], r[2]) for r in lowered if fits(name, path, r)), default=None)
        assert got[i] == (name, path, *((best[2], best[3]) if best else (None, "method"))), url


def test_url_rules_with_nothing(spark):
    pages = spark.createDataFrame([(None, None), (1, "http://a.org/x"), (1, "http://a.org/x")], "page_id long, url string")
    none = spark.createDataFrame([(None, "/", "block"), ("", "", "block")], "host string, path string, verdict string")
    got = sorted((str(r.page_id), r.host, r.rule, r.verdict) for r in url_rules.judge_urls(pages, none).collect())
    assert got == [("1", "a.org", None, "allow"), ("1", "a.org", None, "allow"), ("None", "", None, "allow")]
    rules = spark.createDataFrame([("org", None, "block")], "host string, path string, verdict string")
    assert sorted(r.verdict for r in url_rules.judge_urls(pages, rules).collect()) == ["allow", "block", "block"]
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


EVENTS = "conv_id long, seq long, message long, event string, role string, text string"


def folded(spark, events):
    rows = chat.fold_events(spark.createDataFrame(events, EVENTS)).orderBy("conv_id", "position").collect()
    return [(r.conv_id, r.role, r.text) for r in rows]


def test_deltas_edits_and_regenerations_are_folded(spark):
    log = [
        (1, 1, 1, "delta", "user", "What"), (1, 2, 1, "delta", None, " now?"),
        (1, 3, 2, "delta", "assistant", "Bad"), (1, 4, 2, "delta", None, " answer"),
        (1, 5, 3, "delta", "user", "No."), (1, 6, 2, "regenerate", None, None),
        (1, 7, 2, "delta", "assistant", "Good"), (1, 8, 2, "delta", None, None), (1, 9, 2, "delta", None, " answer"),
        (1, 10, 4, "delta", "user", "thx"), (1, 11, 4, "edit", None, "Thanks"), (1, 12, 4, "delta", None, "!"),
        (1, 13, 5, "typing", "user", "..."), (2, 1, 1, "delta", "user", "other"), (None, 1, 1, "delta", None, "no id"),
    ]
    want = [(None, None, "no id"), (1, "user", "What now?"), (1, "assistant", "Good answer"), (1, "user", "Thanks!"), (2, "user", "other")]
    random.Random(1).shuffle(log)
    assert folded(spark, log) == want


def test_a_message_regenerated_and_left_is_gone(spark):
    assert folded(spark, [(1, 1, 1, "delta", "user", "a"), (1, 2, 1, "regenerate", None, None)]) == []
    assert folded(spark, []) == []


def test_marks_in_texts_are_read_back(spark):
    pieces = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<\\/s>", "[\\INST]", "<", "[", "/s>", "INST]", "a", "\n", "é😀", "$1", ""]
    rng = random.Random(6)
    turns = [(c, t, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 3))) if t % 3 == 0 else ["assistant", "user", None][t % 3],
              None if rng.random() < 0.05 else "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))) for c in range(120) for t in range(rng.randint(1, 6))]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = chat.render(chat.fold_events(chat.table_events(rows)))
    read = done.select("conv_id", "n_turns", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("said"))
    for r in read.collect():
        own = [t for t in turns if t[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(t[2] or "", t[3] or "") for t in own]
        assert list(r.said) == [t[3] or "" for t in own if t[2] == "assistant"]
        assert r.n_turns == len(own) and r.formatted.count(chat.END) == len(own)


def test_repeated_turns_are_all_kept(spark):
    rows = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "user", "a"), (1, 0, "assistant", "c")], "conv_id long, turn long, role string, text string")
    done = chat.render(chat.fold_events(chat.table_events(rows)))
    turns = done.select(chat.read_turns(F.col("formatted")).alias("t")).first().t
    assert [t.text for t in turns] == ["a", "c", "b", "b"]


def test_components(spark, tmp_path):
    rng = random.Random(9)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(500, 500 + i) for i in range(1, 60)]
    edges += [(900 + i, 901 + i) for i in range(70)] + [(7, 7), (None, 3), (3, None)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(frame, str(tmp_path / "c")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {n: root(n) for n in parent}
    assert components.components(frame.limit(0), str(tmp_path / "e")).count() == 0


def test_licences_on_held_out_lines(spark):
    rng = random.Random(3)
    filler = "the station reads wind and rain each hour and sends them on to the city where a table is kept".split()
    plain = lambda: " ".join(rng.choice(filler) for _ in range(rng.randint(4, 30)))
    known = [
        ("Released under the MIT License.", "mit"), ("The code: Released under the MIT License", "mit"),
        ("(c) 2021 Someone. Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("# Licensed under CC BY 4.0.", "cc-by"),
    ]
    rows = [(i, plain() + "\n" + line + "\n\n" + plain(), family) for i, (line, family) in enumerate(known * 5)]
    rows += [(100 + i, "\n".join(plain() for _ in range(8)), "") for i in range(60)]
    rows += [(200, None, ""), (201, "", ""), (202, " \n ", ""), (203, "Licensed under the Gadget License.", "")]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    classifier = licences.train(docs)
    found = {r.doc_id: r for r in licences.scan_licences(docs, classifier).collect()}
    assert all(",".join(found[i].families) == family for i, _, family in rows)
    assert found[203].n_unknown == 1 and found[200].n_paragraphs == 0
    assert sum(found[i].n_licence for i in range(100, 160)) <= 6
    assert licences.scan_licences(docs.limit(0), classifier).count() == 0


@pytest.fixture(scope="module")
def licence_judge(spark, tables):
    return licences.train(spark.read.parquet(f"{tables}/documents.parquet"))


def licence_rows(spark, judge, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(licences.scan_licences(docs, judge).collect(), key=lambda r: r.doc_id)]


def test_licences_in_other_shapes(spark, licence_judge):
    texts = licence_texts.LICENCES
    mit, bsd, gnu = texts["mit"].texts[0], texts["bsd"].texts[0], texts["gpl-3.0"].texts[0]
    flat = lambda t: " ".join(t.split())
    wrapped = lambda t, n: "\n".join(textwrap.wrap(flat(t), n))
    marked = "\n".join("# " + line for line in gnu.split("\n"))
    shapes = [
        (flat(mit.split("\n\n")[0]), "mit", 1), (wrapped(mit.split("\n\n")[0], 31), "mit", 1), (mit, "mit", 3), (wrapped(bsd, 60), "bsd", 1),
        (bsd.split("\n\n")[0], "bsd", 1), ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "lgpl", 1),
        ("// SPDX-License-Identifier: MIT", "mit", 1), ("Boost Software License - Version 1.0 - August 17th, 2003", "boost", 1),
        (marked, "gpl-3.0", 3), (f"{flat(mit)} Licensed under CC BY 4.0. That is all there is to say.", "cc-by,mit", 1), ("MIT License", "mit", 1),
    ]
    shapes += [(flat(t), family, 1) for family, licence in texts.items() for t in licence.texts[:1] if len(t.split()) < 200]
    for (text, family, n), row in zip(shapes, licence_rows(spark, licence_judge, [s[0] for s in shapes]), strict=True):
        assert (",".join(row.families), row.n_paragraphs) == (family, n), text


def test_licences_of_real_files(spark, licence_judge):
    """Texts as distributions ship them; none of these wrappings was trained on."""
    wanted = {"attrs": "mit", "urllib3": "mit", "pytest": "mit", "PyYAML": "mit", "Pygments": "bsd", "zstandard": "bsd", "idna": "bsd", "requests": "apache-2.0"}
    found = {}
    for name in wanted:
        try:
            files = importlib.metadata.files(name) or []
        except importlib.metadata.PackageNotFoundError:
            continue
        texts = [f.locate().read_text(errors="replace") for f in files if "LICENSE" in f.name.upper() and f.locate().exists()]
        if texts:
            found[name] = texts[0]
    if not found:
        pytest.skip("no licence files")
    for name, row in zip(found, licence_rows(spark, licence_judge, list(found.values())), strict=True):
        assert wanted[name] in row.families and len(row.families) == 1, name


def test_licences_of_no_family_and_plain_text(spark, licence_judge):
    import inspect
    import statistics

    none = ["Licensed under the Gadget Public License.", "SPDX-License-Identifier: Artistic-2.0", "Use of this software is subject to the Foo license terms."]
    rows = licence_rows(spark, licence_judge, none)
    assert all(r.n_unknown == 1 and not r.families for r in rows)
    prose = [" ".join(p.split()) for _, f in inspect.getmembers(statistics, callable) for p in (inspect.getdoc(f) or "").split("\n\n") if ">>>" not in p]
    prose = [p for p in prose if not re.search("licen[sc]e|copyright", p, re.I)]
    rows = licence_rows(spark, licence_judge, prose)
    assert len(prose) > 100 and not any(r.families for r in rows)
    assert sum(r.n_unknown for r in rows) <= 0.01 * sum(r.n_paragraphs for r in rows)
    junk = ["the " * 500, "", None, " \n\n ", "?!", "a", "x" * 200_000, "Licensed under the " * 2]
    assert [(r.n_licence, r.n_unknown) for r in licence_rows(spark, licence_judge, junk[:-1])] == [(0, 0)] * 7


def test_licences_rows_and_names(spark, licence_judge):
    line = "Released under the MIT License."
    docs = spark.createDataFrame(
        [(None, line, "a"), (1, line, "b"), (1, line, "c"), (1, None, None)], "id long, body string, families string"
    ).withColumn("n_unknown", F.lit(3)).withColumn("text", F.lit("none")).withColumn("doc_id", F.lit(9))
    rows = licences.scan_licences(docs, licence_judge, doc="id", text="body").collect()
    assert sorted((r.doc_id or 0, r.n_licence) for r in rows) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    empty = licences.train(docs.limit(0), doc="id", text="body")
    assert [r.families for r in licence_rows(spark, empty, [line, "The station reads the wind."])] == [["mit"], []]
    own = licences.train(docs, "id", "body", {"house": licence_texts.Licence(("House Licence",), (), ("Whoever enters may read all books of this house but shall take none away from it.",))})
    rows = licence_rows(spark, own, ["Note: whoever enters may read all books of this house but shall take none away from it."])
    assert rows[0].families == ["house"]


def test_licence_pieces_against_plain_version():
    rng = random.Random(5)
    marks = [" ", " ", " ", " ", "\n", ". ", "\n\n", " \n \t\n", ".", "; ", "\n# \n", "é "]
    texts = ["".join(rng.choice(["a", "bc", "ü1", "Lic"]) + rng.choice(marks[: rng.choice([4, 6, 12])]) for _ in range(rng.randint(0, 300))) for _ in range(80)]
    texts = ["", None, "...", "a", *texts, "a\n\nb"]
    p = licences.pieces(pa.array(texts, pa.string()))
    words, paragraph_of = [], []
    expected = set()
    for i, text in enumerate(texts):
        lines, paragraphs = (text or "").split("\n"), [[]]
        for line in lines:
            if not re.search(brute.PLAIN, line.lower()):
                paragraphs.append([])
            paragraphs[-1].append(line)
        for lines in paragraphs:
            base = len(words)
            sentences = []
            for line in lines:
                for sentence in re.split(r"(?<=[.!?;])(?=[ \t\r\n])", line):
                    got = re.findall(brute.PLAIN, sentence.lower())
                    if got:
                        sentences.append((len(words), len(words) + len(got)))
                        words += got
            n = len(words) - base
            if not n:
                continue
            paragraph_of.append(i)
            number = len(paragraph_of) - 1
            at = 0
            while at == 0 or at + licences.WINDOW // 2 < n:
                expected.add((base + at, min(base + at + licences.WINDOW, base + n), number, True))
                at += licences.WINDOW // 2
            for a, b in sentences:
                if b - a <= licences.WINDOW and (b - a < n or n > licences.WINDOW):
                    expected.add((a, b, number, False))
    got = list(zip(p.first.tolist(), p.last.tolist(), p.paragraph.tolist(), p.window.tolist()))
    assert len(got) == len(set(got)) and set(got) == expected and p.text_of.tolist() == paragraph_of
    for i in range(0, len(got), 7):
        own = words[got[i][0] : got[i][1]]
        assert len(p.triples(i)) == (len(set(zip(own, own[1:], own[2:]))) if len(own) > 2 else 1)


def test_pipeline_against_plain_versions(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    tests = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    good = [r.doc_id for r in quality.judge(docs, quality.train(docs, labels)).where("kept").collect()]
    assert not any(brute.quality(texts[i])[5] for i in good)
    parts = brute.near_components([(i, texts[i]) for i in good], 80)
    kept = [i for i in sorted(good) if parts[i][1] == i]
    hit = brute.contamination([texts[i] for i in kept], tests)
    kept = [i for i, (_, n, _) in zip(kept, hit) if not n]
    redacted = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, tables).collect()}
    assert sorted(got) == kept and 0 < len(kept) < len(texts)
    assert all(r.same and r.decoded_sha256 == brute.sha(redacted[i]) and r.n_tokens == len(r.ids) for i, r in got.items())


def test_stages_return_the_columns_of_documents(spark, tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "bpe"]
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).schema.simpleString() == docs.schema.simpleString()


def test_sources_keep_off_local_state():
    import os

    top = os.path.dirname(os.path.abspath(near_dedup.__file__))
    for name in os.listdir(top):
        if name.endswith(".py"):
            with open(os.path.join(top, name), encoding="utf-8") as file:
                text = file.read()
            assert "localCheckpoint" not in text and "toPandas" not in text and "crossJoin" not in text
