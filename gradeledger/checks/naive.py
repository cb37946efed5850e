"""Report R with one join per account group, to measure what the single pass is worth."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gradeledger.config import ReportConfig
from gradeledger.operators.accounts import account_group_for
from gradeledger.operators.reuse import Keep, Keeper
from gradeledger.plans import risk
from gradeledger.sources.tables import ReportSource


def groups_by_ten_joins(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """The columns of ``risk.groups_in_scope``, each group read and joined by itself."""
    balances = risk.macros_all(source, cfg, scope)
    wide = balances.select(*risk.SCOPE_KEYS).distinct()
    for group in cfg.accounts:
        wide = wide.join(account_group_for(balances, group), list(risk.SCOPE_KEYS), "left")
    return wide


def report_r_long(source: ReportSource, cfg: ReportConfig, keep: Keep | None = None) -> DataFrame:
    keep = keep or Keeper("none")
    scope = keep(risk.perimeter_r(source, cfg))
    found = keep(risk.statements_in_scope(source, cfg, scope))
    return risk.assemble(source, found, groups_by_ten_joins(source, cfg, scope), cfg)
