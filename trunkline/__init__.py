"""Call-record analytics on Spark: numbers, portability, numbering plan, carriers."""

from trunkline.functions import normalize_number, normalize_number_pair
from trunkline.operators import (
    asof_per_call,
    carrier_change,
    enrich_calls,
    normalize_calls,
    resolve_carriers,
)
from trunkline.plans.loads import Warehouse, load_numbering, load_portability
from trunkline.sources import preview_files
from trunkline.streaming import load_portability_stream

__all__ = [
    "Warehouse",
    "asof_per_call",
    "carrier_change",
    "enrich_calls",
    "load_numbering",
    "load_portability",
    "load_portability_stream",
    "normalize_calls",
    "normalize_number",
    "normalize_number_pair",
    "preview_files",
    "resolve_carriers",
]
