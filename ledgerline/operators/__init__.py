"""Reusable relational operators (DataFrame in, DataFrame out)."""

from ledgerline.operators.activity import daily_counts, distinct_group_changes, group_changes, merged_windows  # noqa: F401
from ledgerline.operators.asof import asof_join  # noqa: F401
from ledgerline.operators.bitmaps import distinct_counts, distinct_counts_of_sets, member_bitmaps  # noqa: F401
from ledgerline.operators.bridge import best_match_by_key, bridge_on_email  # noqa: F401
from ledgerline.operators.hot_keys import heavy_keys, left_join_hot_keys  # noqa: F401
from ledgerline.operators.joins import left_join_skew_safe  # noqa: F401
from ledgerline.operators.sharing import grouping_rows, shared  # noqa: F401
from ledgerline.operators.sorting import display_order  # noqa: F401
from ledgerline.operators.spines import day_spine, expand_months, month_spine, snapshot_date  # noqa: F401
from ledgerline.operators.windows import (  # noqa: F401
    agg_over,
    attach_scalars,
    latest_by,
)
