"""DataFrame operators."""

from trunkline.operators.calls import normalize_calls
from trunkline.operators.carriers import (
    carriers_from_numbering,
    carriers_from_portability,
    upsert_carriers,
)
from trunkline.operators.history import dedup_portability, upsert_history
from trunkline.operators.plan import consolidate_plan, rejected_ranges
from trunkline.operators.quality import (
    both_valid,
    carrier_counts,
    invalid_count,
    load_report,
    load_totals,
    portability_rate,
)
from trunkline.operators.resolve import (
    asof_per_call,
    assigned_carrier,
    carrier_change,
    enrich_calls,
    numbers_to_query,
    ported_carrier,
    resolve_carriers,
    resolve_carriers_at,
)
from trunkline.operators.segments import plan_segments
from trunkline.operators.validity import carrier_changes, with_validity

__all__ = [
    "asof_per_call",
    "assigned_carrier",
    "both_valid",
    "carrier_change",
    "carrier_changes",
    "carrier_counts",
    "carriers_from_numbering",
    "carriers_from_portability",
    "consolidate_plan",
    "dedup_portability",
    "enrich_calls",
    "invalid_count",
    "load_report",
    "load_totals",
    "normalize_calls",
    "numbers_to_query",
    "plan_segments",
    "ported_carrier",
    "portability_rate",
    "rejected_ranges",
    "resolve_carriers",
    "resolve_carriers_at",
    "upsert_carriers",
    "upsert_history",
    "with_validity",
]
