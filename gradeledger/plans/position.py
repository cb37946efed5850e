"""Report P: the position report, one row per rated entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeledger.config import FINANCIALS, GENERATIONS, NON_FINANCIALS, OLD, ReportConfig
from gradeledger.functions.scalars import (
    canonical_tax_id,
    day_month_year,
    newest,
    presence_flag,
    zoned_text,
)
from gradeledger.operators.dedup import distinct_on
from gradeledger.operators.funnel import Mark, unmarked
from gradeledger.operators.ratings import split_by_model
from gradeledger.operators.reuse import Keep, Keeper
from gradeledger.operators.statements import choose_statement_version
from gradeledger.plans.matched import (
    STATEMENT_TIES,
    final_rating_p,
    perimeter,
    perimeter_statements,
    union_all,
)
from gradeledger.sources.tables import ReportSource

REPORT_P_COLUMNS = (
    "cdi", "afm", "grade", "approveddate", "nextreviewdate", "ratingmodelname", "fiscalyear",
    "salesrevenues", "totalassets", "entityid", "overrideflag", "creditcommitteedate",
)

# Among statements of one year: newest version, then the largest id *as text*.
YEAR_ORDER_P = (
    "-sourcepopulateddate_financial", "-statement_text", "-versionid_financial", "-pkid_",
)
YEAR_KEYS = ("entityid", "cdicode", "afm", "statementyear")


def perimeter_p(source: ReportSource, cfg: ReportConfig, mark: Mark = unmarked) -> DataFrame:
    """The statements in scope of report P's final ratings."""
    found = mark("perimeter", perimeter(final_rating_p(source, cfg, mark), cfg))
    return found.where(F.col("match_kind") == FINANCIALS)


def statements_in_scope(
    source: ReportSource, cfg: ReportConfig, scope: DataFrame, generations=GENERATIONS
) -> DataFrame:
    """Every version of the statements in scope, with the report's two amounts."""
    return union_all([
        perimeter_statements(scope, source, cfg, g, ["salesrevenues", "totalassets"]).select(
            "pkid_", "generation", "entityid", "cdicode", "afm", "ratingscalevalue", "finalgrade",
            "approveddate", "nextreviewdate", "modelid", "statementyear", "statement_text",
            "salesrevenues", "totalassets", "creditcommitteedate", "versionid_financial",
            "sourcepopulateddate_financial", "sourcepopulateddate_rating",
        )
        for g in generations
    ])


def chosen_statements(
    source: ReportSource,
    cfg: ReportConfig,
    generations=GENERATIONS,
    strict: bool = False,
    keep: Keep | None = None,
    mark: Mark = unmarked,
) -> DataFrame:
    """The chosen version of each statement in scope of report P's final ratings.

    ``strict`` leaves out statements that have no version known at rating time.
    """
    keep = keep or Keeper("none")
    scope = keep(perimeter_p(source, cfg, mark))
    found = mark("statements", statements_in_scope(source, cfg, scope, generations))
    if strict:
        found = found.where("sourcepopulateddate_financial <= sourcepopulateddate_rating")
    return choose_statement_version(
        found, ["generation", "pkid_"], "sourcepopulateddate_financial",
        "sourcepopulateddate_rating", STATEMENT_TIES,
    )


def year_labels(df: DataFrame) -> DataFrame:
    """The report's twelve text columns."""
    return df.select(
        F.col("cdicode").alias("cdi"),
        "afm",
        F.col("ratingscalevalue").alias("grade"),
        zoned_text("approveddate").alias("approveddate"),
        day_month_year("nextreviewdate").alias("nextreviewdate"),
        F.col("modelid").alias("ratingmodelname"),
        F.col("statementyear").cast("string").alias("fiscalyear"),
        F.col("salesrevenues").cast("string").alias("salesrevenues"),
        F.col("totalassets").cast("string").alias("totalassets"),
        F.col("entityid").cast("string").alias("entityid"),
        presence_flag("finalgrade").alias("overrideflag"),
        day_month_year("creditcommitteedate").alias("creditcommitteedate"),
    )


def statement_per_year(
    source: ReportSource, cfg: ReportConfig, generations=GENERATIONS, strict: bool = False
) -> DataFrame:
    """One statement per entity and fiscal year, before labelling."""
    chosen = chosen_statements(source, cfg, generations, strict)
    return distinct_on(chosen, YEAR_KEYS, YEAR_ORDER_P)


def report_p_years(source: ReportSource, cfg: ReportConfig) -> DataFrame:
    """Report P's columns for every fiscal year in scope."""
    return year_labels(statement_per_year(source, cfg))


def report_p(
    source: ReportSource, cfg: ReportConfig, keep: Keep | None = None, mark: Mark = unmarked
) -> DataFrame:
    """Report P: the latest fiscal year per entity, customer and canonical tax id.

    Choosing the statement of each year and then the latest year are two steps of
    one order, so one window does both. ``mark`` may be a ``Funnel``.
    """
    latest = distinct_on(
        chosen_statements(source, cfg, keep=keep, mark=mark),
        ["entityid", "cdicode", canonical_tax_id("afm")],
        [newest(F.col("statementyear").cast("string")), *YEAR_ORDER_P],
    )
    return mark("report", year_labels(latest))


def report_p_nonfin(source: ReportSource, cfg: ReportConfig) -> DataFrame:
    """Entities whose final rating is not a financials model, without statement data."""
    _, others = split_by_model(final_rating_p(source, cfg), cfg.financial_models)
    listed = others.where(F.col("match_kind") == NON_FINANCIALS).where(
        (F.col("generation") != OLD) | (F.col("approvalstatus") == cfg.approved_status)
    )
    empty = ("statementyear", "salesrevenues", "totalassets")
    return year_labels(listed.select("*", *[F.lit(None).cast("string").alias(c) for c in empty]))
