"""A training corpus from raw documents: good, distinct, clean and encoded.

Each stage takes the documents its predecessor kept. ``run`` writes what each stage
returns into the shared folder and reads it again, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import bpe, decontamination, near_dedup, pii, quality
from stationflow.session import drop_folder, new_work_folder, work_folders


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null, empty or short text is not kept; a null id is judged as any other. Long
    texts are judged whole, repeated rows alike. No documents give none, and no labels,
    or labels of one class, leave the base rules alone.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, at 80 percent: that of the least id.

    Texts without words, null among them, and rows with a null id stay. Rows that
    share an id are one document and stay or go together.
    """
    return near_dedup.keep_one(docs, percent=80)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item.

    Null and empty texts hold none and stay, and so does everything if there is no
    item with a word. Rows that share the id of one that goes, go with it.
    """
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    Null stays null, other columns stay as they are; repeated rows are treated alike.
    """
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256, same`` of each row.

    A null text is encoded as an empty one and has no tokens.
    """
    return bpe.encoded_documents(docs)


STAGES = [
    ("quality", good),
    ("near_dedup", distinct),
    ("decontamination", unseen),
    ("pii", redacted),
    ("bpe", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table of documents."""
    folder = new_work_folder(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        # What a stage keeps for itself goes as soon as its result is written, and so does what it read.
        with work_folders(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        if number:
            drop_folder(spark, f"{folder}/{number - 1}-{STAGES[number - 1][0]}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
