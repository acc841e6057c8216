"""DataFrame -> DataFrame operators."""

from .analysis import distinct_values, global_max, group_max, local_day_slice, time_slice, top_k
from .dedup import keep_first, total_order
from .effective import effective_dated_join, fits_broadcast, intervals_from_starts
from .ordering import with_position, write_ordered
from .quality import (
    Check,
    ObservedChecks,
    check_accepted_values,
    check_not_null,
    check_relationships,
    check_unique,
    quality_report,
    raise_on_error,
    row_checks,
)
from .partitioning import spread
from .quarantine import Quarantine, quarantine
from .union import union_categories

__all__ = [
    "distinct_values",
    "global_max",
    "group_max",
    "time_slice",
    "local_day_slice",
    "top_k",
    "keep_first",
    "total_order",
    "effective_dated_join",
    "fits_broadcast",
    "intervals_from_starts",
    "with_position",
    "write_ordered",
    "Check",
    "ObservedChecks",
    "check_accepted_values",
    "check_not_null",
    "check_relationships",
    "check_unique",
    "quality_report",
    "raise_on_error",
    "row_checks",
    "union_categories",
    "spread",
    "Quarantine",
    "quarantine",
]
