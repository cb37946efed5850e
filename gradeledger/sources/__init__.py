"""Source tables, their normalisation, and the report and audit sinks."""

from gradeledger.sources.commits import PublishConflict
from gradeledger.sources.sinks import (
    append_audit,
    read_audit,
    read_report,
    read_steps,
    register_view,
    write_report,
)
from gradeledger.sources.tables import ReportSource

__all__ = [
    "PublishConflict", "ReportSource", "append_audit", "read_audit", "read_report", "read_steps",
    "register_view", "write_report",
]
