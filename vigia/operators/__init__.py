from .analysis import Analysis, Measure, run, run_fused, run_shared
from .distribution import approx_percentiles, exact_percentiles, exact_summary, global_rank
from .joins import insert_if_absent, lookup, with_server_attributes
from .partials import daily_state, merge_state, read_state, run_from_state, write_state
from .quality import Rule, dependency_report, event_rules, mark_rules, quality_report, split_by_rules
from .sketches import daily_sketches, rank_bounds, read_sketches, sketch_percentiles, write_sketches
from .windows import first_per_key, rank_groups, top_k, top_per_group

__all__ = [
    "Analysis",
    "Measure",
    "Rule",
    "approx_percentiles",
    "daily_sketches",
    "daily_state",
    "dependency_report",
    "event_rules",
    "exact_percentiles",
    "exact_summary",
    "first_per_key",
    "global_rank",
    "insert_if_absent",
    "lookup",
    "merge_state",
    "mark_rules",
    "quality_report",
    "rank_bounds",
    "rank_groups",
    "read_sketches",
    "read_state",
    "run",
    "run_from_state",
    "run_fused",
    "run_shared",
    "sketch_percentiles",
    "split_by_rules",
    "top_k",
    "top_per_group",
    "with_server_attributes",
    "write_sketches",
    "write_state",
]
