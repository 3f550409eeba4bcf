"""DataFrame -> DataFrame operators."""

from envlake.operators.cleaning import clean_collected, clean_weather
from envlake.operators.lookup import duplicate_keys, left_lookup, seed_copy
from envlake.operators.ordering import preview, sorted_observations
from envlake.operators.quality import (
    coverage,
    coverage_of_parts,
    dataset_summary,
    expected_windows,
    missing_window_count,
    missing_windows,
    missing_windows_by_bits,
    summary_of_parts,
)
from envlake.operators.reshape import parse_cells, unpivot_hours, unpivot_measures
from envlake.operators.stacking import header_drift, stack_by_name, stack_by_position

__all__ = [
    "clean_collected",
    "clean_weather",
    "coverage",
    "coverage_of_parts",
    "dataset_summary",
    "duplicate_keys",
    "expected_windows",
    "header_drift",
    "left_lookup",
    "missing_window_count",
    "missing_windows",
    "missing_windows_by_bits",
    "parse_cells",
    "preview",
    "seed_copy",
    "sorted_observations",
    "stack_by_name",
    "stack_by_position",
    "summary_of_parts",
    "unpivot_hours",
    "unpivot_measures",
]
