"""Lookup joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def enrich(
    rows: DataFrame, lookup: DataFrame, key: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """``rows`` with the columns of ``lookup``.

    No broadcast hint: Spark broadcasts the lookup when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` (known from the files, or measured
    at run time by AQE), and otherwise joins by shuffle, where AQE splits the
    partition of a hot key. Rows without a match keep nulls.
    """
    return rows.join(lookup, key if isinstance(key, str) else list(key), how)
