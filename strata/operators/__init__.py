"""DataFrame operators: filters, tagging and union, typing, nesting, numbering, splits."""

from strata.operators.filters import high_rise, high_rise_condition
from strata.operators.inspect import distinct_sorted, distinct_values, top_n
from strata.operators.nest import (
    document_json,
    event_struct,
    nest_events,
    nest_paged,
    nest_slots,
    nest_two_levels,
)
from strata.operators.project import account_for, accounts, cast_columns, integral, null_tokens, to_english
from strata.operators.rank import cumulative_by_range, row_number_by_range
from strata.operators.sizing import broadcast_if_small, measure
from strata.operators.split import (
    balanced_split,
    cut_points,
    hash_bucket,
    hash_split,
    keyed_split,
    md5_order,
    random_split,
)
from strata.operators.tagging import (
    ColumnMismatch,
    assert_same_columns,
    content_sums,
    reconcile_contents,
    reconcile_counts,
    same_columns_by_source,
    source_counts,
    tag,
    tagged_union,
    union_all,
)

__all__ = [
    "ColumnMismatch", "account_for", "accounts", "assert_same_columns", "balanced_split", "broadcast_if_small",
    "cast_columns", "content_sums", "cumulative_by_range", "cut_points", "distinct_sorted", "distinct_values",
    "document_json", "event_struct", "hash_bucket", "hash_split", "high_rise",
    "high_rise_condition", "integral", "keyed_split", "md5_order", "measure", "nest_events", "nest_paged",
    "nest_slots", "nest_two_levels", "null_tokens", "random_split", "reconcile_contents", "reconcile_counts",
    "row_number_by_range", "same_columns_by_source", "source_counts", "tag", "tagged_union",
    "to_english", "top_n", "union_all",
]
