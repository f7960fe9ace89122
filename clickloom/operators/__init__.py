"""DataFrame operators: counts, matrices, rankings, KPIs, features, checks."""

from .affinity import segment_affinity, valid_log_rows
from .checks import KindChecks, KindTotals, bucket_distribution, kind_checksums, reconcile
from .features import (
    count_vector,
    count_vector_sparse,
    feature_matrix,
    time_features,
    to_dense,
    top_items,
    vocabulary,
)
from .kpis import latest_kpis, window_kpis
from .lookups import fits_broadcast, salted_join
from .mart import (
    explode_visits,
    profile_mart,
    shop_category_matrix,
    web_category_matrix,
)
from .matrix import (
    count_map,
    count_long,
    count_matrix,
    distinct_values,
    max_event_date,
    merge_counts,
    merge_matrix,
    sum_by_key,
    to_long,
    to_wide,
    union_missing,
)

__all__ = [
    "KindChecks",
    "KindTotals",
    "count_map",
    "bucket_distribution",
    "count_long",
    "count_matrix",
    "count_vector",
    "count_vector_sparse",
    "distinct_values",
    "explode_visits",
    "feature_matrix",
    "fits_broadcast",
    "kind_checksums",
    "latest_kpis",
    "max_event_date",
    "merge_counts",
    "merge_matrix",
    "profile_mart",
    "reconcile",
    "salted_join",
    "segment_affinity",
    "shop_category_matrix",
    "sum_by_key",
    "time_features",
    "to_dense",
    "to_long",
    "to_wide",
    "top_items",
    "union_missing",
    "valid_log_rows",
    "vocabulary",
    "web_category_matrix",
    "window_kpis",
]
