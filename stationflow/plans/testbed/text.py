from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import words
from ...functions.text import CONSONANTS, VOWELS
from ...operators import explode_records, letter_word_stats, non_blank, to_metric_rows
from .tables import table


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, dealt to as many tasks as a shuffle has, at every size.

    Counting letters and words costs about ten times what moving the text does, and
    files may come with a single row group, which is a single task.
    """
    rows = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as non-blank lines."""
    split = _documents(spark, folder).select("doc_id", "lang", F.split("text", "\n").alias("value"))
    return non_blank(explode_records(split, "value", keep=["doc_id", "lang"]))


def letter_word_stats_query(spark, folder):
    return letter_word_stats(_documents(spark, folder), "text")


def letter_stats_by_lang(spark, folder):
    return letter_word_stats(_documents(spark, folder), "text", ["lang"])


def text_metric_rows(spark, folder):
    return to_metric_rows(letter_stats_by_lang(spark, folder), ["lang"])


def line_stats_by_lang(spark, folder):
    """The same statistics read line by line, with the lines counted."""
    counts = [F.count("*").alias("line_count"), F.max(F.length("value")).alias("longest_line")]
    return letter_word_stats(_lines(spark, folder), "value", ["lang"], counts)


def word_list(spark, folder):
    """Words per document in order, joined."""
    return _documents(spark, folder).select(
        "doc_id", F.md5(F.array_join(words(F.col("text")), " ")).alias("words_md5")
    )


QUERIES = {
    "letter_word_stats": letter_word_stats_query,
    "letter_stats_by_lang": letter_stats_by_lang,
    "text_metric_rows": text_metric_rows,
    "line_stats_by_lang": line_stats_by_lang,
    "word_list": word_list,
}

# No look-around in this dialect: take whole runs of word characters, keep the pure ones.
_WORDS = (
    r"list_filter(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+'), "
    r"lambda x: regexp_full_match(x, '[а-яА-Яa-zA-Z]+'))"
)


def _stats_sql(source: str, text: str, key: str = "", extra: str = "") -> str:
    by = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""
    WITH src AS ({source}),
    per AS (
      SELECT {by} {text} AS t, length({text}) - length(translate({text}, '{VOWELS}', '')) AS v,
             length({text}) - length(translate({text}, '{CONSONANTS}', '')) AS c,
             {_WORDS.format(text)} AS w FROM src),
    s AS (
      SELECT {by} CAST(sum(v) AS BIGINT) AS vowel, CAST(sum(c) AS BIGINT) AS consonant,
             CAST(sum(len(w)) AS BIGINT) AS word_count,
             CAST(sum(length(array_to_string(w, ''))) AS BIGINT) AS total_chars {extra}
      FROM per {group})
    SELECT *, CAST(total_chars AS DOUBLE) / word_count AS average_word_length,
           vowel + consonant AS total_letters FROM s"""


_BY_LANG = _stats_sql("SELECT lang, text FROM documents", "text", "lang")
_LINES = f"""
    SELECT doc_id, lang, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '
           || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)) AS line
    FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)"""

ORACLE = {
    "letter_word_stats": _stats_sql("SELECT text FROM documents", "text"),
    "letter_stats_by_lang": _BY_LANG,
    "text_metric_rows": f"""
    WITH st AS ({_BY_LANG}),
    m AS (
      SELECT lang, 'average_word_length' AS metric,
             format('{{:.2f}}', average_word_length) AS value FROM st WHERE word_count > 0
      UNION ALL SELECT lang, 'vowel', CAST(vowel AS VARCHAR) FROM st
      UNION ALL SELECT lang, 'consonant', CAST(consonant AS VARCHAR) FROM st
      UNION ALL SELECT lang, 'total_letters', CAST(total_letters AS VARCHAR) FROM st
      UNION ALL SELECT lang, 'word_count', CAST(word_count AS VARCHAR) FROM st)
    SELECT * FROM m""",
    "line_stats_by_lang": _stats_sql(
        f"SELECT lang, line FROM ({_LINES}) WHERE line <> ''", "line", "lang",
        ", count(*) AS line_count, CAST(max(length(t)) AS INTEGER) AS longest_line",
    ),
    "word_list": f"""
    SELECT doc_id, md5(array_to_string({_WORDS.format('text')}, ' ')) AS words_md5
    FROM documents""",
}
