"""Letter and word statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import letter_counts, word_chars, word_count


def letter_word_stats(
    texts: DataFrame,
    text: str = "value",
    keys: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Sums over all texts (of each key) and the mean word length.

    Texts may be lines or whole documents: no count crosses a line end. The mean
    is null when there is no word. Per-text counts are summed before the shuffle,
    so what moves is one row per task and key, whatever one key's share.
    """
    column = F.col(text)
    vowels, consonants = letter_counts(column)
    sums = texts.groupBy(*keys).agg(
        F.coalesce(F.sum(vowels), F.lit(0)).alias("vowel"),
        F.coalesce(F.sum(consonants), F.lit(0)).alias("consonant"),
        F.coalesce(F.sum(word_count(column)), F.lit(0)).alias("word_count"),
        F.coalesce(F.sum(word_chars(column)), F.lit(0)).alias("total_chars"),
        *extra,
    )
    return sums.select(
        *keys,
        F.try_divide(F.col("total_chars"), F.col("word_count")).alias("average_word_length"),
        "vowel",
        "consonant",
        (F.col("vowel") + F.col("consonant")).alias("total_letters"),
        "word_count",
        "total_chars",
        *sums.columns[len(keys) + 4 :],
    )


def to_metric_rows(stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Statistics as ``metric``/``value`` text rows; the mean has two decimals.

    A mean that does not exist (no words) has no row.
    """
    values = stats.select(
        *keys,
        F.format_string("%.2f", "average_word_length").alias("average_word_length"),
        *(F.col(n).cast("string").alias(n) for n in ("vowel", "consonant", "total_letters", "word_count")),
        (F.col("word_count") > 0).alias("_has_words"),
    )
    metrics = ["average_word_length", "vowel", "consonant", "total_letters", "word_count"]
    return (
        values.unpivot([*keys, "_has_words"], metrics, "metric", "value")
        .where(F.col("_has_words") | (F.col("metric") != "average_word_length"))
        .drop("_has_words")
    )
