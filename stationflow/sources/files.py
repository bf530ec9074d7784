"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";"
) -> DataFrame:
    """Delimited text with a header line; columns are taken by position in ``schema``."""
    return (
        spark.read.schema(schema).option("sep", sep).option("header", True)
        .option("encoding", "UTF-8").csv(path)
    )


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in ``value``. Long files are split between tasks."""
    return spark.read.text(path)


def positional_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a delimited export whose columns are known by position only.

    Parsing and rejecting is ``operators.lines.positional_fields``: the rule
    "at least n fields, skip headers wherever they stand" is not one a CSV
    reader has.
    """
    return text_lines(spark, path)


def nested_json(spark: SparkSession, path: str, schema: T.StructType, whole_file: bool = True) -> DataFrame:
    """JSON documents that nest their records in an array, one row per document.

    With ``whole_file`` a file is one document over many lines, read by one task:
    fit for many moderate files. Volume belongs in JSON Lines
    (``whole_file=False``), which splits.

    ``source_file``, ``block`` and ``document`` order the documents: the file, where
    the split begins that the document is read from, and its place among what is
    read there. Documents of a file stand in that order.
    """
    reader = spark.read.schema(schema).option("multiLine", whole_file)
    return reader.json(path).withColumns(
        {
            "source_file": F.col("_metadata.file_path"),
            "block": F.col("_metadata.file_block_start"),
            "document": F.monotonically_increasing_id(),
        }
    )


def json_array(
    spark: SparkSession, path: str, schema: T.StructType, whole_file: bool = True
) -> DataFrame:
    """JSON arrays; each element is a row.

    A file that is one array over many lines is read by one task. With
    ``whole_file=False`` every line is an array, and files split.
    """
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


def json_dir_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = 1
) -> DataFrame:
    """A growing folder of JSON files as a stream, ``files_per_trigger`` at a time.

    One file per trigger replays a folder step by step. Set it to a few per core,
    or None for no limit, to keep up with volume.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)
