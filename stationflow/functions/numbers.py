"""Text to number, without raising on bad input (ANSI casts would)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a text strip removes at both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
_DIGITS = r"[0-9](?:_?[0-9])*"
_FLOAT = (
    rf"^{_SPACE}([-+]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][-+]?{_DIGITS})?){_SPACE}$"
)
_PLAIN = r"^[-+0-9.eE \t\r\n]+$"
_INTEGER = rf"^{_SPACE}([-+]?{_DIGITS})(?:\.0*)?{_SPACE}$"


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at its ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def _matched(text: Column, pattern: str, kind: str) -> Column:
    # No match extracts the empty string, which casts to null: one regex and one
    # cast per value, and ``text`` is evaluated once.
    digits = F.regexp_extract(text.cast("string"), pattern, 1)
    return F.translate(digits, "_", "").try_cast(kind)


def to_number(text: Column) -> Column:
    """``text`` as DOUBLE, null where it is no decimal number.

    What Spark's cast takes but a decimal literal is not stays out: type suffixes
    (``1d``), hexadecimal floats, ``nan`` and ``inf``. White space around a number
    is allowed, and so are digit groups joined by single underscores (``1_000``).
    A literal too large for a DOUBLE is infinite.

    Text of plain number characters, the usual case, goes straight to the cast;
    only what is left is matched against the whole grammar.
    """
    text = text.cast("string")
    return F.when(text.rlike(_PLAIN), text.try_cast("double")).otherwise(
        _matched(text, _FLOAT, "double")
    )


def repair_spreadsheet_number(value: Column, year: int | str = 2025) -> Column:
    """Undo a spreadsheet's number-to-date conversion.

    ``12.5`` typed into a date-minded spreadsheet comes back as ``12.05.<year>``
    or ``<year>-05-12``; the day is what survives of the number. Plain numbers
    pass, everything else becomes null. The dotted form is looked at first.
    """
    text = value.cast("string")
    dated = text.contains(str(year))
    dotted_day = F.substring_index(text, ".", 1)
    dashed_day = F.substring_index(F.get(F.split(text, "-", 4), F.lit(2)), " ", 1)
    return to_number(
        F.when(dated & text.contains("."), dotted_day)
        .when(dated & text.contains("-"), dashed_day)
        .otherwise(text)
    )


def typed_value(value: Column, kind: T.DataType | str) -> Column:
    """A raw field as ``kind``: blank and ``nan`` are null, text is stripped.

    Text that does not read as the declared number is null as well; an integer
    may be written with a zero fraction (``5.0``).
    """
    name = kind if isinstance(kind, str) else kind.simpleString()
    if name in ("double", "float"):
        return to_number(value).cast(name)
    if name in ("tinyint", "smallint", "int", "bigint"):
        return _matched(value, _INTEGER, name)
    if name.startswith("decimal"):
        return _matched(value, _FLOAT, name)
    bare = strip(value.cast("string"))
    known = F.when(~F.lower(bare).isin("", "nan"), bare)
    return known if name == "string" else known.try_cast(name)
