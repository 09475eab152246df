"""Writers: period replacement, run ledger, reconciliation, scratch space."""

from lossmill.sinks.ledger import append_ledger, last_operations
from lossmill.sinks.scratch import scratch_path
from lossmill.sinks.tables import reconcile, replace_outcomes, replace_period, replace_periods

__all__ = [
    "append_ledger",
    "last_operations",
    "reconcile",
    "replace_outcomes",
    "replace_period",
    "replace_periods",
    "scratch_path",
]
