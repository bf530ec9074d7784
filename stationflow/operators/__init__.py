"""DataFrame -> DataFrame operators."""

from .daily import (
    DailyThresholds,
    daily_extremes,
    daily_phenomena,
    render_daily_text,
    tag_phenomena,
)
from .enrich import enrich
from .etl import (
    KeyConflict,
    LoadResult,
    NullValue,
    dedupe_keep_first,
    derive_city_day,
    drop_incomplete,
    keep_first_seen,
    load_table,
    unseen_rows,
)
from .lines import non_blank, positional_fields
from .messages import parse_json, to_json_value
from .records import explode_records, normalize, repair_columns
from .report import count_rows, extremes, first_distinct, overall, per_group, preview, value_counts
from .text_stats import letter_word_stats, to_metric_rows
from .windows import Metric, distinct_count, group_metrics, numbered, windowed_agg

__all__ = [
    "DailyThresholds", "daily_extremes", "daily_phenomena", "render_daily_text", "tag_phenomena",
    "enrich",
    "KeyConflict", "LoadResult", "NullValue", "dedupe_keep_first", "derive_city_day", "drop_incomplete",
    "keep_first_seen", "load_table", "unseen_rows",
    "non_blank", "positional_fields",
    "parse_json", "to_json_value",
    "explode_records", "normalize", "repair_columns",
    "count_rows", "extremes", "first_distinct", "overall", "per_group", "preview", "value_counts",
    "letter_word_stats", "to_metric_rows",
    "Metric", "distinct_count", "group_metrics", "numbered", "windowed_agg",
]
