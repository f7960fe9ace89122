"""Structured Streaming: update-mode topic sink and query control."""

from .control import stop_streams
from .levels import RevisionLog
from .sinks import AVAILABLE_NOW, read_compacted, read_updates, write_topic_stream

__all__ = ["AVAILABLE_NOW", "RevisionLog", "read_compacted", "read_updates", "stop_streams", "write_topic_stream"]
