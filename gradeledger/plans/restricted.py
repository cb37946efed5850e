"""Reports of some customers, evaluated from the sources up for these alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeledger.config import GENERATIONS, ReportConfig
from gradeledger.operators.quality import metric_slice
from gradeledger.operators.reuse import Keep, Keeper, shared
from gradeledger.operators.sieve import Sieve
from gradeledger.plans.matched import union_all
from gradeledger.plans.position import report_p
from gradeledger.plans.risk import (
    CAPITAL,
    SCOPE_COLUMNS,
    assemble,
    groups_in_scope,
    perimeter_r,
    statements_in_scope,
)
from gradeledger.sources.tables import ReportSource

#: Ids up to which a restriction is a list in the filters of the scans.
MOST_IDS = 1_000


class Ids:
    """Some ids: a short list, or a table that scans are sieved by.

    A sieve lets a few rows of other ids through and shuffles none; the reports leave these rows
    out, as they ask for their customers again.

    Only ``MOST_IDS`` and one more are ever looked at here. The ids are made once, in the shared
    folder: each scan that they cut would else repeat the plan that finds them, and plans of
    that size fill the driver.
    """

    def __init__(self, table: DataFrame):
        (self.name,) = table.columns
        self.table = shared(table.where(F.col(self.name).isNotNull()).distinct(), "checkpoint")
        found = [r[0] for r in self.table.limit(MOST_IDS + 1).collect()]
        self.listed = sorted(found) if len(found) <= MOST_IDS else None
        self.sieve = Sieve(self.table)

    def cut(self, df: DataFrame) -> DataFrame:
        if self.listed is not None:
            return df.where(F.col(self.name).isin(self.listed))
        return self.sieve.cut(df, [self.name])


class RestrictedSource(ReportSource):
    """Another source's tables cut to some entities, and balances to some financials, before
    anything is shuffled. A list of ids reaches the scans of number columns."""

    def __init__(self, source: ReportSource, entities: Ids, financials: Ids | None = None):
        super().__init__(source.spark, source.root)
        self.source, self.entities, self.financials = source, entities, financials

    def table(self, name: str) -> DataFrame:
        return self.source.table(name)

    def load_ratings_new(self) -> DataFrame:
        return self.entities.cut(super().load_ratings_new())

    def load_ratings_old(self) -> DataFrame:
        return self.entities.cut(super().load_ratings_old())

    def load_entities(self, generation: str) -> DataFrame:
        return self.entities.cut(super().load_entities(generation))

    def load_statements_new(self) -> DataFrame:
        return self.entities.cut(super().load_statements_new())

    def load_statement_headers_old(self) -> DataFrame:
        return self.entities.cut(super().load_statement_headers_old())

    def load_balances(self, generation: str, accounts: Sequence[int] | None = None) -> DataFrame:
        found = super().load_balances(generation, accounts)
        return found if self.financials is None else self.financials.cut(found)


def entities_of(source: ReportSource, customers: Column) -> Ids:
    """Entities of which some version, whenever, belongs to the customers (a condition on ``cdi``).

    An entity's final rating may carry another version's customer; the reports tell by theirs.
    """
    parts = [
        source.load_entities(g).withColumnRenamed("cdicode", "cdi").where(customers).select("entityid")
        for g in GENERATIONS
    ]
    return Ids(union_all(parts))


def report_p_of(source: ReportSource, cfg: ReportConfig, customers: Column) -> DataFrame:
    """Report P's rows of the customers that a condition on ``cdi`` chooses.

    A rating is an entity's own matter, so other entities can be left out from the start.
    """
    return report_p(RestrictedSource(source, entities_of(source, customers)), cfg).where(customers)


def report_r_of(
    source: ReportSource, cfg: ReportConfig, customers: Column, keep: Keep | None = None
) -> DataFrame:
    """Report R's rows of the customers that a condition on ``cdi`` chooses.

    Customers give entities, these the perimeter, and its financial ids the balances.
    """
    keep = keep or Keeper("none")
    own = RestrictedSource(source, entities_of(source, customers))
    scope = perimeter_r(own, cfg).withColumnRenamed("cdicode", "cdi").where(customers)
    scope = keep(scope.withColumnRenamed("cdi", "cdicode").select(*SCOPE_COLUMNS))
    narrow = RestrictedSource(source, own.entities, Ids(scope.select("financialid")))
    found = keep(statements_in_scope(own, cfg, scope, CAPITAL))
    groups = keep(groups_in_scope(narrow, cfg, scope))
    return assemble(own, found, groups, cfg, keep)


def slice_of(
    source: ReportSource, cfg: ReportConfig, customers: Sequence[str], year: str | None = None,
    cols: Sequence[str] = (),
) -> DataFrame:
    """Chosen columns of report R for some customers, of one year or all."""
    chosen = report_r_of(source, cfg, F.col("cdi").isin(list(customers)))
    return metric_slice(chosen, year=year, cols=cols)
