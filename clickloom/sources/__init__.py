"""Readers: log files, event directories, topics, tables, snapshots."""

from .files import (
    read_events_dir,
    read_rejected,
    read_segment,
    read_split_events,
    read_user_visits,
    read_weblog,
)
from .snapshots import (
    latest_snapshot,
    read_snapshot,
    read_snapshot_counts,
    snapshot_path,
)
from .tables import (
    SourceSpec,
    json_files,
    read_table,
    relational,
    search_index,
    wide_column,
)
from .topics import TopicSpec, read_topic_batch, read_topic_stream

__all__ = [
    "SourceSpec",
    "TopicSpec",
    "json_files",
    "latest_snapshot",
    "read_events_dir",
    "read_rejected",
    "read_segment",
    "read_snapshot",
    "read_snapshot_counts",
    "read_split_events",
    "read_table",
    "read_topic_batch",
    "read_topic_stream",
    "read_user_visits",
    "read_weblog",
    "relational",
    "search_index",
    "snapshot_path",
    "wide_column",
]
