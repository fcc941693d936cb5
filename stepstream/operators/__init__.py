from stepstream.operators.aggregate import (
    argmax,
    count_by,
    keyed_sum,
    latest,
    latest_by_key,
    open_window_counts,
    total,
    window_bounds,
    window_count,
    word_count,
)
from stepstream.operators.ordering import latest_n, preview, top_counts
from stepstream.operators.previous import previous_value

__all__ = [
    "argmax",
    "count_by",
    "keyed_sum",
    "latest",
    "latest_by_key",
    "latest_n",
    "open_window_counts",
    "preview",
    "previous_value",
    "top_counts",
    "total",
    "window_bounds",
    "window_count",
    "word_count",
]
