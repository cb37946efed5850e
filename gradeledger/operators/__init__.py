"""Reusable operators: DataFrame in, DataFrame out, columns given by name."""

from gradeledger.operators.accounts import account_group_for, account_groups, long_groups
from gradeledger.operators.dedup import distinct_on
from gradeledger.operators.matching import (
    attach_grade,
    in_scope,
    latest_before,
    match_asof,
    match_pinned_version,
)
from gradeledger.operators.quality import (
    changed_columns,
    diff_reports,
    find_duplicates,
    metric_slice,
    report_difference,
    row_balance,
    side_by_side,
    step_counts,
)
from gradeledger.operators.ratings import (
    eligible_ratings,
    final_rating,
    split_by_model,
    usable_context,
)
from gradeledger.operators.skew import key_places, weighed_join
from gradeledger.operators.statements import change_vs_previous, choose_statement_version

__all__ = [
    "account_group_for", "account_groups", "attach_grade", "change_vs_previous",
    "changed_columns", "choose_statement_version", "diff_reports", "distinct_on", "eligible_ratings",
    "final_rating", "find_duplicates", "in_scope", "key_places", "latest_before", "long_groups", "match_asof",
    "match_pinned_version", "metric_slice", "report_difference", "row_balance", "side_by_side",
    "split_by_model", "step_counts", "usable_context", "weighed_join",
]
