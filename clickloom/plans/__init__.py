"""Whole jobs composed of sources, operators and sinks."""

from ..paths import pinned
from .affinity import rank_domains
from .count_store import read_count_store, store_matrix, update_count_store
from .features import build_features, feature_table, pinned_visits
from .mart import build_mart
from .settings import REQUIRED, job_conf
from .split_events import split_events, split_topic
from .stream_kpis import kpi_messages, stream_kpis
from .users_items import update_users_items

__all__ = [
    "REQUIRED",
    "build_features",
    "build_mart",
    "feature_table",
    "job_conf",
    "kpi_messages",
    "pinned",
    "pinned_visits",
    "rank_domains",
    "read_count_store",
    "split_events",
    "split_topic",
    "store_matrix",
    "stream_kpis",
    "update_count_store",
    "update_users_items",
]
