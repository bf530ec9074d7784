"""Column expressions: everything here is built from Spark's own functions."""

from .bands import PRECIPITATION_RU, TEMPERATURE_EN, TEMPERATURE_RU, Bands, band
from .dates import (
    date_key,
    date_key_of,
    date_time_label,
    event_time,
    iso_text,
    processing_time,
)
from .numbers import repair_spreadsheet_number, strip, to_number, typed_value
from .text import consonant_count, letter_counts, vowel_count, words, word_chars, word_count

__all__ = [
    "Bands", "band", "TEMPERATURE_EN", "TEMPERATURE_RU", "PRECIPITATION_RU",
    "date_key", "date_key_of", "date_time_label", "event_time", "iso_text", "processing_time",
    "strip", "to_number", "typed_value", "repair_spreadsheet_number",
    "vowel_count", "consonant_count", "letter_counts", "words", "word_count", "word_chars",
]
