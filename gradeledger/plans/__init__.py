"""The two reports, their revisions and variants, and the jobs that write them."""

from gradeledger.plans.jobs import run_report_p, run_report_r
from gradeledger.plans.position import report_p
from gradeledger.plans.risk import report_r

__all__ = ["report_p", "report_r", "run_report_p", "run_report_r"]
