"""DataFrame -> DataFrame operators the questions reduce to."""

from marquee.operators.aggregate import count_by, count_through, max_by_group, mean_by, row_count, table_counts
from marquee.operators.explode import explode_list
from marquee.operators.groups import above_group_mean, group_list
from marquee.operators.joins import exists_in, with_names
from marquee.operators.keyfilter import key_filter, late_lookup, may_hold
from marquee.operators.preview import preview
from marquee.operators.ranking import first_per_group, number_rows, top_n_per_group
from marquee.operators.skew import hot_key_join
from marquee.operators.spans import year_span

__all__ = [
    "count_by",
    "count_through",
    "max_by_group",
    "mean_by",
    "row_count",
    "table_counts",
    "explode_list",
    "above_group_mean",
    "group_list",
    "exists_in",
    "with_names",
    "hot_key_join",
    "key_filter",
    "late_lookup",
    "may_hold",
    "preview",
    "first_per_group",
    "number_rows",
    "top_n_per_group",
    "year_span",
]
