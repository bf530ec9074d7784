"""URL filters by a sort-merge range join.

A host is turned round, label by label, and closed by a dot: ``a.example.org`` is
``org.example.a.``, and a rule's host and all its subdomains are the keys from
``org.example.`` up to ``org.example/``. Rule keys and the distinct keys of the
pages are sorted together over ranges; a sweep along each range keeps the innermost
open interval of every depth, which is the stack of nested rules, and closes an
interval when the key has left it. A range starts with the rules open at its first
key. Pages take the stack of their host and the longest rule whose path fits.

All of it is DataFrame functions. A host with very many pages is one key of the
sweep; the join back to its pages is one that Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_work_folder

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _outer_keys(key: Column) -> Column:
    """The keys of all parents of a key's host."""
    labels = F.slice(F.split(key, r"\.", -1), 1, F.size(F.split(key, r"\.", -1)) - 1)
    upto = F.sequence(F.lit(1), F.size(labels) - 1)
    prefixes = F.transform(upto, lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    return F.when(F.size(labels) > 1, prefixes).otherwise(F.array().cast("array<string>"))


def rule_stacks(hosts: DataFrame, rules: DataFrame, folder: str) -> DataFrame:
    """``key, rules`` of every host key that some rule's host contains.

    ``hosts`` has distinct ``key``s; ``rules`` has ``key, path, rule, verdict``.
    """
    spark = hosts.sparkSession
    by_host = rules.groupBy("key").agg(F.collect_list(F.struct("path", "rule", "verdict")).alias("rules"))
    starts = by_host.select("key", F.lit(0).alias("kind"), "rules")
    points = hosts.select("key", F.lit(1).alias("kind"), F.lit(None).cast(by_host.schema["rules"].dataType).alias("rules"))
    ranged = starts.unionByName(points).repartitionByRange("key").withColumn("range", F.spark_partition_id())
    ranged.write.parquet(f"{folder}/ranges")
    ranged = spark.read.parquet(f"{folder}/ranges")
    # Rules that are open where a range starts.
    first = ranged.groupBy("range").agg(F.min("key").alias("low"))
    outer = first.select("range", F.explode(_outer_keys(F.col("low"))).alias("key"))
    carried = outer.join(starts, "key").select("key", "kind", "rules", "range")
    events = ranged.unionByName(carried)

    depth = F.size(F.split("key", r"\.", -1)) - 1
    deepest = by_host.agg(F.max(depth)).first()[0] or 0
    along = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = [
        F.last(F.when((F.col("kind") == 0) & (depth == d), F.struct("key", "rules")), ignorenulls=True).over(along)
        for d in range(1, deepest + 1)
    ]
    if not levels:
        return hosts.select("key", F.lit(None).cast(by_host.schema["rules"].dataType).alias("rules")).where("false")
    swept = events.select("key", "kind", F.array(*levels).alias("stack")).where("kind = 1")
    here = F.filter("stack", lambda s: s.isNotNull() & F.startswith(F.col("key"), s["key"]))
    return swept.select("key", F.flatten(F.transform(here, lambda s: s["rules"])).alias("rules")).where(F.size("rules") > 0)


def judge_urls(pages: DataFrame, rules: DataFrame, page: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains
    where the path starts with the rule's. Of the rules that fit, the longest (host
    and path) wins, of equally long ones the one that blocks. Without any, the
    verdict is ``default`` and ``rule`` is null. A url that is null or has no
    ``://`` has an empty host and path, which no rule fits; rules with a null or
    empty host are left out, a null path is empty.
    """
    spark = pages.sparkSession
    folder = new_work_folder(spark, "url-rules")
    known = rules.where("host <> ''").select(
        host_key(F.translate("host", _UPPER, _LOWER)).alias("key"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"),
        "verdict",
    ).distinct()
    read = pages.select(F.col(page).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    read = read.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    hosts = read.select(host_key(F.col("host")).alias("key")).distinct()
    stacks = rule_stacks(hosts, known, folder).withColumnRenamed("key", "host_key")
    joined = read.join(stacks, host_key(F.col("host")) == stacks["host_key"], "left")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(
        F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("n"), (r["verdict"] == "block").alias("b"), r["rule"].alias("rule"), r["verdict"].alias("verdict")))
    )
    return joined.select("page_id", "host", "path", best.alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


# The rules that are asked for.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), rules)


OP5_SQL = r"""
WITH r(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
s AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
m AS (
  SELECT k, rh || rp AS rule, v, row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC) AS i
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM m WHERE i = 1) USING (k)
"""
