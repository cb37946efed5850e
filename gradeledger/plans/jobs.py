"""The two report jobs: build, replace the snapshot, log; never raise."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from gradeledger.config import ReportConfig
from gradeledger.operators.funnel import Funnel
from gradeledger.operators.reuse import Keeper
from gradeledger.plans.position import report_p
from gradeledger.plans.risk import report_r
from gradeledger.sources.sinks import append_audit, audit_record, write_report
from gradeledger.sources.tables import ReportSource

log = logging.getLogger(__name__)


def _run(
    spark: SparkSession,
    function: str,
    target: str,
    out: str,
    cfg: ReportConfig,
    build: Callable[[Keeper, Funnel], DataFrame],
    clock: Callable[[], datetime],
    view: str | None,
) -> bool:
    """Success flag. The snapshot, its audit record and the row counts of its steps, which the
    build counts on the way, are one commit. A failure anywhere leaves
    the old snapshot and is logged; if not even that can be written, nothing is raised."""
    now, keeper, funnel, path = clock(), Keeper(cfg.sharing), Funnel(), f"{out}/{target}"

    def record(count: int, message: str) -> dict:
        return audit_record(function, target, count, message, now)

    try:
        write_report(
            build(keeper, funnel), path, cfg.ref_date, view,
            audit=lambda count: record(count, f"{target} has been populated"),
            steps=funnel.counts,
        )
        return True
    except Exception as failure:
        message = f"Failure in function: {function}: {failure}"
        log.warning("%s", message)
    finally:
        keeper.release()
    try:
        append_audit(spark, path, record(0, message))
    except Exception as failure:
        log.warning("the audit log can't be written: %s", failure)
    return False


def _config(cfg: ReportConfig | None, ref_date: date) -> ReportConfig:
    return replace(cfg, ref_date=ref_date) if cfg else ReportConfig(ref_date)


def run_report_p(
    spark: SparkSession,
    source: ReportSource,
    ref_date: date,
    out: str,
    cfg: ReportConfig | None = None,
    clock: Callable[[], datetime] = datetime.now,
    view: str | None = None,
) -> bool:
    """Write report P for a date below ``out``; ``cfg`` selects a revision, ``view`` names a
    view that shall show the latest snapshot."""
    cfg = _config(cfg, ref_date)
    return _run(
        spark, "run_report_p", "report_p", out, cfg,
        lambda keep, mark: report_p(source, cfg, keep, mark), clock, view,
    )


def run_report_r(
    spark: SparkSession,
    source: ReportSource,
    ref_date: date,
    out: str,
    cfg: ReportConfig | None = None,
    clock: Callable[[], datetime] = datetime.now,
    view: str | None = None,
) -> bool:
    """Write report R for a date below ``out``; ``cfg`` and ``view`` as for report P."""
    cfg = _config(cfg, ref_date)
    return _run(
        spark, "run_report_r", "report_r", out, cfg,
        lambda keep, mark: report_r(source, cfg, keep, mark), clock, view,
    )
