from pennant.functions.columns import (
    asc_last,
    desc_last,
    first_item,
    first_seen,
    joined,
    list_position,
    padded,
    ratio,
    remap,
    rounded_mean,
    rounded_units,
    year_span,
)
from pennant.functions.folds import ordered_sum
from pennant.functions.prefix import sums_before

__all__ = [
    "asc_last", "desc_last", "first_item", "first_seen", "joined", "list_position", "ordered_sum",
    "padded", "ratio", "remap", "rounded_mean", "rounded_units", "sums_before", "year_span",
]
