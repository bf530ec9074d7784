"""The file readers: given tables written out in other formats and read back in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import processing_time
from ...operators import derive_city_day, enrich
from ...schemas import CATEGORY, CITY_DAY, CITY_DAY_DOCUMENT, CITY_READING_FILE, PRODUCT
from ...session import new_work_folder
from ...sources import delimited, json_array, json_dir_stream, nested_json, split_json_array
from ...streaming import batch_folder_writer, read_batches
from ..city_table import POSITION, extract, transform
from ..repair import write_delimited
from .replay import drain
from .tables import PROPS, comparable, table


def json_folder_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a folder of JSON files, streamed a few files at a time."""
    work = new_work_folder(spark, "json-folder")
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("file_id"),
        F.col("event_type").alias("city"),
        F.from_json("props", PROPS)["k"].alias("temperature"),
        F.col("user_id").alias("humidity"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    events.repartition(6).write.json(f"{work}/in")
    stream = json_dir_stream(spark, f"{work}/in", CITY_READING_FILE, files_per_trigger=2)
    drain(stream, "append", batch_folder_writer(f"{work}/out"), name="json-folder")
    stored = read_batches(spark, f"{work}/out")
    return stored.select(
        "file_id", "city", F.col("temperature").cast("double").alias("temperature"), "humidity", "timestamp",
        F.col("pressure").isNull().cast("int").alias("missing"),
    )


def _documents(orders: DataFrame) -> DataFrame:
    """Orders as nested documents, one per customer, each order a record."""
    record = F.struct(
        F.col("o_orderstatus").alias("city"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("temperature"),
        F.col("o_custkey").alias("humidity"),
        F.lit(1000).alias("pressure"),
        F.lit(1.5).alias("wind_speed"),
        F.col("o_orderpriority").alias("condition"),
        F.col("o_orderkey").cast("double").alias("precipitation"),
    )
    return orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list(record)).alias("weather_data")).select("weather_data")


def nested_document_records(spark, folder):
    """Nested documents in line form, read back and spread into records."""
    work = new_work_folder(spark, "nested")
    _documents(table(spark, folder, "orders")).write.json(f"{work}/documents")
    records = extract(spark, f"{work}/documents", whole_file=False)
    return records.select("city", "date", "temperature", "humidity", "condition", "precipitation", "ordinal")


def nested_document_order(spark, folder):
    """Every record has a place of its own, and one row of each key stays."""
    work = new_work_folder(spark, "nested-order")
    _documents(table(spark, folder, "orders")).write.json(f"{work}/documents")
    records = extract(spark, f"{work}/documents", whole_file=False)
    places = records.agg(F.count("*").alias("records"), F.count_distinct(*POSITION, "ordinal").alias("places"))
    kept = transform(records).agg(F.count("*").alias("kept"), F.count_distinct("record_id").alias("keys"))
    both = places.unionByName(kept, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in ("records", "places", "kept", "keys")))


def whole_documents(spark, folder):
    """Documents that fill a file each: one per nation, its suppliers as records."""
    work = new_work_folder(spark, "whole")
    suppliers = table(spark, folder, "supplier")
    record = F.struct(
        F.col("s_name").alias("city"), F.lit("2024-01-01").alias("date"), F.col("s_acctbal").alias("temperature")
    )
    documents = suppliers.groupBy("s_nationkey").agg(F.sort_array(F.collect_list(record)).alias("weather_data"))
    documents.write.partitionBy("s_nationkey").json(f"{work}/documents")
    read = nested_json(spark, f"{work}/documents/*", CITY_DAY_DOCUMENT)
    return read.select(F.explode("weather_data").alias("r")).select("r.city", "r.date", "r.temperature")


def _big_documents(orders: DataFrame, path: str, documents: int = 4) -> None:
    """Orders as a few documents over many lines, each of them one file."""
    record = F.struct(
        F.col("o_orderstatus").alias("city"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("temperature"), F.col("o_custkey").alias("humidity"),
        F.concat(F.col("o_orderpriority"), F.lit(' "}{[, \\')).alias("condition"), F.col("o_orderkey").cast("double").alias("precipitation"),
    )
    rows = orders.select(F.pmod("o_orderkey", F.lit(documents)).alias("k"), F.col("o_orderkey").alias("at"), F.to_json(record).alias("value"))
    # One row a document. A join that deals the rows by ``k`` would make the union count as dealt by ``k`` too: no shuffle
    # would follow, and head, rows and foot, each with tasks of their own, would be files of their own.
    first = rows.groupBy("k").agg(F.min("at").alias("first"))
    rows = rows.join(F.broadcast(first), "k").select("k", "at", F.concat(F.when(F.col("at") == F.col("first"), "").otherwise(","), "value").alias("value"))
    head = first.select("k", F.lit(-1).cast("long").alias("at"), F.lit('{"metadata": {"weather_data": [{"city": "none"}]},\n"weather_data": [').alias("value"))
    foot = first.select("k", F.lit(2**62).alias("at"), F.lit('],\n"more": [{"city": "none"}]}').alias("value"))
    lines = rows.union(head).union(foot).repartition("k").sortWithinPartitions("k", "at")
    lines.drop("at").write.partitionBy("k").text(path)


def nested_document_split(spark, folder):
    """Big nested documents, each read by as many tasks as its file has splits."""
    work = new_work_folder(spark, "big-documents")
    _big_documents(table(spark, folder, "orders"), f"{work}/documents")
    records = split_json_array(spark, f"{work}/documents", CITY_DAY, f"{work}/split", "weather_data")
    return records.select(
        "city", "date", "temperature", F.col("humidity").cast("double").alias("humidity"), "condition", "precipitation",
        F.col("pressure").isNull().cast("int").alias("missing"),
    )


def array_and_categories(spark, folder):
    """Products as lines of JSON arrays, categories as a delimited file, joined."""
    work = new_work_folder(spark, "arrays")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.col("p_brand").alias("product_name"),
        F.pmod(F.col("p_partkey"), F.lit(10)).cast("long").alias("category_id"),
        F.col("p_size").cast("long").alias("manufacturer_id"),
        F.col("p_retailprice").alias("price"),
    )
    product = F.struct(*parts.columns)
    lines = parts.groupBy("category_id", "manufacturer_id").agg(F.to_json(F.sort_array(F.collect_list(product))).alias("value"))
    lines.select("value").write.text(f"{work}/products")
    categories = parts.groupBy("category_id").agg(
        F.concat(F.lit("category "), F.col("category_id")).alias("category_name"), F.min("product_name").alias("description")
    )
    write_delimited(categories, f"{work}/categories")
    products = json_array(spark, f"{work}/products", PRODUCT, whole_file=False)
    return enrich(products, delimited(spark, f"{work}/categories", CATEGORY), "category_id")


def stamped_rows(spark, folder):
    """Processing and creation times are set on every row."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("city"), F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("temperature"), F.col("o_custkey").alias("precipitation"),
    )
    stamped = derive_city_day(orders).withColumn("processing_time", processing_time())
    return comparable(
        stamped.select(
            "o_orderkey",
            F.col("created_at").isNotNull().cast("int").alias("created"),
            F.col("processing_time").isNotNull().cast("int").alias("processed"),
        )
    )


QUERIES = {
    "json_folder_stream": json_folder_stream,
    "nested_document_records": nested_document_records,
    "nested_document_order": nested_document_order,
    "whole_documents": whole_documents,
    "nested_document_split": nested_document_split,
    "array_and_categories": array_and_categories,
    "stamped_rows": stamped_rows,
}

ORACLE = {
    "nested_document_split": """
    SELECT o_orderstatus AS city, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS temperature,
           CAST(o_custkey AS DOUBLE) AS humidity, o_orderpriority || ' "}{[, \\' AS condition,
           CAST(o_orderkey AS DOUBLE) AS precipitation, CAST(1 AS INTEGER) AS missing
    FROM orders""",
    "json_folder_stream": """
    SELECT event_id AS file_id, event_type AS city,
           CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) AS temperature,
           user_id AS humidity, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, CAST(1 AS INTEGER) AS missing
    FROM events""",
    "nested_document_records": """
    SELECT o_orderstatus AS city, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS temperature,
           o_custkey AS humidity, o_orderpriority AS condition, CAST(o_orderkey AS DOUBLE) AS precipitation,
           CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, strftime(o_orderdate, '%Y-%m-%d'),
                                   o_totalprice, o_orderpriority, o_orderkey) - 1 AS INTEGER) AS ordinal
    FROM orders""",
    "nested_document_order": """
    SELECT count(*) AS records, count(*) AS places,
           count(DISTINCT o_orderstatus || strftime(o_orderdate, '%Y-%m-%d')) AS kept,
           count(DISTINCT o_orderstatus || strftime(o_orderdate, '%Y-%m-%d')) AS keys
    FROM orders""",
    "whole_documents": """
    SELECT s_name AS city, '2024-01-01' AS date, s_acctbal AS temperature FROM supplier""",
    "array_and_categories": """
    WITH p AS (
      SELECT CAST(p_partkey AS BIGINT) AS product_id, p_brand AS product_name, CAST(p_partkey % 10 AS BIGINT) AS category_id,
             CAST(p_size AS BIGINT) AS manufacturer_id, p_retailprice AS price FROM part),
    c AS (SELECT category_id, 'category ' || category_id AS category_name, min(product_name) AS description FROM p GROUP BY 1)
    SELECT p.*, category_name, description FROM p JOIN c USING (category_id)""",
    "stamped_rows": """
    SELECT o_orderkey, CAST(1 AS INTEGER) AS created, CAST(1 AS INTEGER) AS processed FROM orders""",
}
