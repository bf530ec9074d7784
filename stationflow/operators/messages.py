"""JSON payloads of messages and lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_text
from .once import computed_once


def parse_json(
    messages: DataFrame,
    schema: T.StructType,
    keep: Sequence[Column | str] = (),
    fields: Mapping[str, str] | None = None,
    value: str = "value",
    drop_null: bool = False,
    require: Sequence[str] = (),
) -> DataFrame:
    """Parse ``value`` (text or UTF-8 bytes) by ``schema`` and flatten it.

    ``keep``      columns of the envelope to carry along, aliased as wanted
    ``fields``    payload field -> output name; all fields under their own names
                  if not given. Only these are parsed.
    ``drop_null`` drop messages without payload. Text that is no JSON parses to a
                  struct of nulls and stays; use ``require`` against it.
    ``require``   payload fields that must be there
    """
    names = fields or {name: name for name in schema.fieldNames()}
    wanted = T.StructType([f for f in schema.fields if f.name in names or f.name in require])
    text = F.col(value).cast("string")
    if drop_null:
        # The payload of null, empty and blank text is null.
        messages = messages.where(text.rlike(r"[^\x00-\x20]"))
    parsed = computed_once(messages, keep, "_payload", F.from_json(text, wanted))
    carried = parsed.columns[:-1]
    for name in require:
        parsed = parsed.where(F.col("_payload")[name].isNotNull())
    return parsed.select(
        *carried, *(F.col("_payload")[name].alias(alias) for name, alias in names.items())
    )


def to_json_value(
    rows: DataFrame, key: str | None = None, sent_at: str | None = "kafka_timestamp"
) -> DataFrame:
    """Rows as topic messages: a JSON ``value``, plus ``key`` if one is named.

    ``sent_at`` names a field that receives the time of sending as ISO text.
    """
    fields = [F.col(name) for name in rows.columns if name != sent_at]
    if sent_at:
        fields.append(iso_text(F.current_timestamp()).alias(sent_at))
    columns = [F.to_json(F.struct(*fields)).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return rows.select(*columns)
