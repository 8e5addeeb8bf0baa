"""Reading payloads, the lake and the lookup tables."""

from .lake import (
    finished_days_only,
    last_finished_days,
    late_days,
    ledger,
    open_table,
    raw_file_count,
    read_days,
    read_raw,
)
from .lookups import read_breakpoints, read_cities
from .payloads import payload_stream, read_payloads

__all__ = [
    "last_finished_days",
    "late_days",
    "ledger",
    "finished_days_only",
    "open_table",
    "payload_stream",
    "raw_file_count",
    "read_breakpoints",
    "read_cities",
    "read_days",
    "read_payloads",
    "read_raw",
]
