"""Relational operators: each takes and returns lazy DataFrames."""

from . import analysis, quality
from .dedup import dominant_match, latest_per_key
from .exact import exact_sums
from .joins import (DEFAULT_BROADCAST_ROWS, has_at_most, have_at_most, keyed_join, left_join_nullsafe_split,
                    lookup_join, orphans, select_keys)
from .margin import derive_margin, rank_groups, rollup_groups, rollup_ranked, usable_ratio
from .project import clean_in_place, rename_project
from .rank import exact_percentiles, global_rank, value_distribution
from .skew import bloom_filter, hot_keys, pruned_join, pruned_orphans, split_join

__all__ = [
    "analysis", "quality", "dominant_match", "latest_per_key", "exact_sums", "DEFAULT_BROADCAST_ROWS",
    "has_at_most", "have_at_most", "keyed_join", "left_join_nullsafe_split", "lookup_join", "orphans",
    "select_keys", "derive_margin", "rank_groups", "rollup_groups", "rollup_ranked", "usable_ratio", "clean_in_place",
    "rename_project", "exact_percentiles", "global_rank", "value_distribution", "bloom_filter", "hot_keys", "pruned_join", "pruned_orphans", "split_join",
]
