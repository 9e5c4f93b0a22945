"""Column -> Column helpers. All are built-in Spark expressions (no UDFs)."""

from marquee.functions.binning import bin_label
from marquee.functions.exact import exact_mean, exact_sum, fixed_point, mean_from
from marquee.functions.lists import list_size, literal_pattern, single_valued, split_list
from marquee.functions.predicates import contains_any, float_literal
from marquee.functions.temporal import (
    days_between,
    in_year,
    year_at_least,
    year_below,
    year_of,
    year_start,
)
from marquee.functions.util import as_col, as_cols

__all__ = [
    "bin_label",
    "exact_mean",
    "exact_sum",
    "fixed_point",
    "mean_from",
    "list_size",
    "literal_pattern",
    "single_valued",
    "split_list",
    "contains_any",
    "float_literal",
    "days_between",
    "in_year",
    "year_at_least",
    "year_below",
    "year_of",
    "year_start",
    "as_col",
    "as_cols",
]
