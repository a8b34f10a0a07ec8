"""Files in, tables out."""

from trunkline.sources.discovery import file_inventory, file_type, list_files
from trunkline.sources.history_store import compact_history, merge_history, read_history
from trunkline.sources.numbering import scan_archives, stage_numbering
from trunkline.sources.portability import (
    accepted,
    rejected,
    scan_portability,
    type_portability,
)
from trunkline.sources.preview import encoding_probe, header_check, preview_files
from trunkline.sources.tables import write_result

__all__ = [
    "accepted",
    "compact_history",
    "encoding_probe",
    "file_inventory",
    "file_type",
    "header_check",
    "list_files",
    "merge_history",
    "preview_files",
    "read_history",
    "rejected",
    "scan_archives",
    "scan_portability",
    "stage_numbering",
    "type_portability",
    "write_result",
]
