"""Record-level repairs and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import repair_spreadsheet_number, typed_value


def repair_columns(rows: DataFrame, columns: Sequence[str], year: int | str = 2025) -> DataFrame:
    """``rows`` with the named columns freed from number-to-date conversion."""
    return rows.withColumns(
        {name: repair_spreadsheet_number(F.col(name), year) for name in columns}
    )


def normalize(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw fields to the types of ``schema``; blank and ``nan`` become null.

    Columns of ``rows`` that the schema does not name are left as they are.
    """
    declared = {field.name: field.dataType for field in schema.fields}
    return rows.select(
        *(
            typed_value(F.col(name), declared[name]).alias(name) if name in declared else F.col(name)
            for name in rows.columns
        )
    )


def explode_records(
    documents: DataFrame, records: str, keep: Sequence[str] = (), ordinal: str = "ordinal"
) -> DataFrame:
    """One row per element of the array ``records``, with its position.

    Struct elements are spread into columns; others keep the array's name.
    """
    element = documents.schema[records].dataType.elementType
    # The inner form would have a filter on the array's size inferred and moved to
    # where the array comes from; if that is a parser, it would parse again.
    exploded = documents.select(
        *keep, F.posexplode_outer(F.col(records)).alias(ordinal, "_record")
    ).where(F.col(ordinal).isNotNull())
    if isinstance(element, T.StructType):
        values = [F.col("_record")[name].alias(name) for name in element.fieldNames()]
    else:
        values = [F.col("_record").alias(records)]
    return exploded.select(*keep, ordinal, *values)
