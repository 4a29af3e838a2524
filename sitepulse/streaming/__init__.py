"""The polling reports as Structured Streaming jobs."""

from sitepulse.streaming.jobs import (
    acknowledged_tickets, distinct_tickets, fault_lifecycle, near_violation_feed, offline_sessions,
    silent_sites, slot_counts, sliding_counts,
)
from sitepulse.streaming.late import late_counts, slot_handler, slot_totals
from sitepulse.streaming.run import event_stream, run_available, run_batches
from sitepulse.streaming.state import fault_states, open_faults, site_alarms

__all__ = [
    "acknowledged_tickets", "distinct_tickets", "event_stream", "fault_lifecycle", "fault_states",
    "late_counts", "near_violation_feed", "offline_sessions", "open_faults", "run_available",
    "run_batches", "silent_sites", "site_alarms", "sliding_counts", "slot_counts", "slot_handler",
    "slot_totals",
]
