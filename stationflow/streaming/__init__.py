"""Starting, bounding and sinking streaming queries."""

from .commits import CommittedTable, LateSplit, ManifestTable, RunningTable
from .keyed_table import KeyedTable
from .queries import (
    LateRows,
    checkpoint_for,
    console_options,
    run_for,
    start_query,
    stop_all,
)
from .sinks import (
    batch_folder_writer,
    document_shape,
    document_writer,
    fan_out,
    read_batches,
    to_topic,
    topic_options,
)

__all__ = [
    "start_query", "checkpoint_for", "console_options", "run_for", "stop_all", "LateRows",
    "CommittedTable", "KeyedTable", "LateSplit", "ManifestTable", "RunningTable",
    "batch_folder_writer", "document_shape", "document_writer", "fan_out", "read_batches",
    "to_topic", "topic_options",
]
