"""Readers. Each returns a DataFrame with a declared schema."""

from .files import (
    delimited,
    json_array,
    json_dir_stream,
    nested_json,
    positional_lines,
    text_lines,
)
from .json_split import split_json_array
from .topics import kafka_options, kafka_stream, socket_lines

__all__ = [
    "delimited", "positional_lines", "text_lines", "nested_json", "json_array",
    "json_dir_stream", "split_json_array", "kafka_options", "kafka_stream", "socket_lines",
]
