"""DataFrame building blocks shared by the jobs."""

from sitepulse.operators.aggregates import (
    column_profile, conditional_counts, crosstab_counts, frequency, horizon_counts, pivot_agg,
    pivot_mode, pivot_text, pivot_unique, share_of_total, slope, summed_measures,
    two_level_sums,
)
from sitepulse.operators.intervals import (
    clip_intervals, covered_points, downtime_minutes, overlapping,
)
from sitepulse.operators.joins import (
    active_sites, anti, densify, flag_members, natural_join, null_safe_anti, null_safe_semi,
    outer_combine, outer_join_sums, semi, without_matches,
)
from sitepulse.operators.keyed import (
    dedupe, first_per_key, group_size, last_non_null, latest_per_key, latest_values, peer_latest,
    superseded,
)
from sitepulse.operators.ranking import (
    bucket_by_rank, pct_rank, pct_ranks, quantiles, rank_histogram, ranks_from,
)
from sitepulse.operators.rowsets import (
    drop_matching, ensure_columns, except_rows, exclusive_classes, move_first, top_rows, union_all,
)

__all__ = [
    "active_sites", "anti", "bucket_by_rank", "clip_intervals", "column_profile",
    "conditional_counts", "covered_points", "crosstab_counts", "dedupe", "densify",
    "downtime_minutes", "drop_matching", "ensure_columns", "except_rows", "exclusive_classes",
    "first_per_key", "flag_members", "frequency", "group_size", "horizon_counts", "last_non_null",
    "latest_per_key", "latest_values", "move_first", "natural_join", "null_safe_anti",
    "null_safe_semi", "outer_combine", "outer_join_sums", "overlapping", "pct_rank", "pct_ranks",
    "peer_latest", "pivot_agg", "pivot_mode", "pivot_text", "pivot_unique", "quantiles", "rank_histogram",
    "ranks_from", "semi",
    "share_of_total", "slope", "summed_measures", "superseded", "top_rows", "two_level_sums",
    "union_all", "without_matches",
]
