"""Date keys, labels and clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(year: Column, month: Column, day: Column) -> Column:
    """``Y-M-D`` without padding; null when a part is null."""
    return F.concat(
        year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")
    )


def date_key_of(moment: Column) -> Column:
    """The unpadded day key of a date or timestamp."""
    return date_key(F.year(moment), F.month(moment), F.dayofmonth(moment))


def date_time_label(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """``Y-MM-DD HH:00`` from integer parts; null when a part is null."""

    def two(part: Column) -> Column:
        return F.lpad(part.cast("string"), 2, "0")

    return F.concat(
        year.cast("string"), F.lit("-"), two(month), F.lit("-"), two(day),
        F.lit(" "), two(hour), F.lit(":00"),
    )


def event_time(text: Column) -> Column:
    """ISO text as a timestamp, null where it is none."""
    return F.try_to_timestamp(text)


def processing_time() -> Column:
    """The clock of the query: one value per batch query or micro-batch."""
    return F.current_timestamp()


def iso_text(moment: Column) -> Column:
    """A timestamp as ISO text with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
