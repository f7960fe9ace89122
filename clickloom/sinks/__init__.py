"""Writers: ranked text, tables, split events, snapshots."""

from .files import write_ranked
from .snapshots import write_snapshot
from .split import split_by_kind, split_messages
from .tables import SinkSpec, write_table

__all__ = [
    "SinkSpec",
    "split_by_kind",
    "split_messages",
    "write_ranked",
    "write_snapshot",
    "write_table",
]
