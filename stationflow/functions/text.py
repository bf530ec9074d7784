"""Letter and word counts over Latin and Cyrillic text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. ``y`` and ``ё`` are vowels; ``ъ`` and ``ь`` are in neither set.
VOWELS = "aeiouyаеёиоуыэюяAEIOUYАЕЁИОУЫЭЮЯ"
CONSONANTS = (
    "bcdfghjklmnpqrstvwxzбвгджзйклмнпрстфхцчшщ"
    "BCDFGHJKLMNPQRSTVWXZБВГДЖЗЙКЛМНПРСТФХЦЧШЩ"
)
WORD_LETTERS = "а-яА-Яa-zA-Z"

# A run of word letters with no word character (letter, number, underscore) on
# either side. A word with ``ё``, a digit or ``_`` in it is therefore no word at
# all. Look-arounds instead of \b: what \b means depends on the JDK. The run is
# possessive, so a rejected run is not tried again letter by letter.
WORD = rf"(?<![\p{{L}}\p{{N}}_])[{WORD_LETTERS}]++(?![\p{{L}}\p{{N}}_])"


def letter_counts(text: Column) -> tuple[Column, Column]:
    """Vowel and consonant counts.

    Deleting a set of characters and comparing lengths is several times faster
    than counting regex matches; the sets are disjoint, so the second deletion
    works on what the first one left.
    """
    without_vowels = F.translate(text, VOWELS, "")
    without_letters = F.translate(without_vowels, CONSONANTS, "")
    return (
        F.length(text) - F.length(without_vowels),
        F.length(without_vowels) - F.length(without_letters),
    )


def vowel_count(text: Column) -> Column:
    return letter_counts(text)[0]


def consonant_count(text: Column) -> Column:
    return letter_counts(text)[1]


def words(text: Column) -> Column:
    """All words of ``text``, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def word_chars(text: Column) -> Column:
    """Sum of the word lengths."""
    return F.length(F.array_join(words(text), ""))
