"""Alternatives the reports once tried: stricter scopes, other ranks, seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.config import GENERATIONS, NEW, OLD, ReportConfig
from gradeledger.operators.dedup import distinct_on
from gradeledger.operators.matching import in_scope
from gradeledger.operators.ratings import LATEST_PAIR_ORDER, final_rating
from gradeledger.operators.skew import merge_join
from gradeledger.operators.statements import change_vs_previous
from gradeledger.plans.matched import (
    STATEMENT_TIES,
    final_rating_r,
    perimeter_versions,
    ratings_union,
    union_all,
)
from gradeledger.plans.position import statement_per_year, year_labels
from gradeledger.plans.risk import (
    AMOUNT,
    CAPITAL,
    LATEST_BALANCE,
    SCOPE_KEYS,
    share_capital_base,
    statements_in_scope,
)
from gradeledger.sources.tables import ReportSource

STATEMENT_KEYS = ("entityid", "financialid", "statementid")
OWNER = ["entityid", "cdicode", "afm"]
# What the choice of the pinned balance version reads.
LATEST = ("sourcepopulateddate_", "accountid", "versionid_")


def strict_asof(source: ReportSource, cfg: ReportConfig) -> DataFrame:
    """New statements per year, only versions known at rating time."""
    return year_labels(statement_per_year(source, cfg, (NEW,), strict=True))


def rank_per_version(source: ReportSource, cfg: ReportConfig) -> DataFrame:
    """The final rating per rating record and version instead of per entity."""
    return final_rating(
        ratings_union(source, cfg), ["entityid", "pkid_", "versionid_"],
        ["-sourcepopulateddate_rating", "-generation", F.col("finalgrade").desc_nulls_last(),
         F.col("ratingscalevalue").desc_nulls_last(), *LATEST_PAIR_ORDER],
    )


def balance_pinned(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """New balances of the one version that was the latest before the rating."""
    rating = scope.where(F.col("generation") == NEW).select(
        *STATEMENT_KEYS, "sourcepopulateddate_rating"
    )
    on, earlier = ["financialid", "statementid"], (
        F.col("sourcepopulateddate_") < F.col("sourcepopulateddate_rating")
    )
    pinned = distinct_on(
        in_scope(source.load_balances(NEW), rating, on, cfg.splits, LATEST).where(earlier),
        STATEMENT_KEYS,
        ["-sourcepopulateddate_", "accountid", "-versionid_"],
    ).select(*STATEMENT_KEYS, "versionid_")
    found = in_scope(
        source.load_balances(NEW, cfg.account_codes), rating, on, cfg.splits, AMOUNT
    ).where(earlier)
    return (
        found.join(pinned, [*STATEMENT_KEYS, "versionid_"])
        .select(*STATEMENT_KEYS, "versionid_", "accountid", "sourcepopulateddate_",
                "originrounding", "originbalance")
        .distinct()
    )


def reviewed_only(source: ReportSource, cfg: ReportConfig) -> DataFrame:
    """New balances whose statement version is marked as reviewed."""
    scope = (
        perimeter_versions(final_rating_r(source, cfg), cfg)
        .where(F.col("generation") == NEW)
        .select(
            "generation", "entityid", "financialid", F.col("statementid").cast("int"),
            F.col("statementid_version").cast("int").alias("statement_version"),
        )
    )
    reviewed = source.load_historical_statements().where("status = 'Reviewed'").select(
        "financialid", "statementid", F.col("versionid_").alias("statement_version"),
        F.col("dimhistoricalstatementid_").alias("id_"),
    )
    wanted = merge_join(scope, reviewed, ["financialid", "statementid", "statement_version"])
    found = in_scope(
        source.load_balances(NEW, cfg.account_codes), wanted,
        ["financialid", "statementid", "id_"], cfg.splits, AMOUNT,
    )
    return distinct_on(found, [*STATEMENT_KEYS, "accountid"], LATEST_BALANCE)


def _seeds(
    source: ReportSource, cfg: ReportConfig, scope: DataFrame, first: DataFrame
) -> DataFrame:
    """Per owner the statement of the year before its ``first_year``, in the rating's scope or
    not: the latest version known at rating time of each statement, then the newest.

    Headers meet owners that have a first year, and only statements of which some version is
    of the year before go on; the old generation's metrics are read for these alone.
    """
    owners = scope.select(
        "generation", "entityid", "financialid", "cdicode", "afm", "approveddate",
        "approvalstatus", "sourcepopulateddate_rating",
    ).distinct().join(first, OWNER)
    header = ["pkid_", "versionid_", *STATEMENT_KEYS, "statementyear", "statementmonths",
              "statementdatekey_", "sourcepopulateddate_"]
    year_before = F.col("statementyear") == F.col("first_year") - 1
    parts = []
    for g in GENERATIONS:
        owner = owners.where(F.col("generation") == g)
        if g == OLD:
            owner = owner.where(F.col("approvalstatus") == cfg.approved_status)
            headers = source.load_statement_headers_old().select(*header)
        else:
            headers = source.load_statements_new().select(*header, *CAPITAL)
        known = in_scope(
            headers, owner, ["entityid", "financialid"], cfg.splits, ["pkid_", "versionid_"]
        ).where(F.col("sourcepopulateddate_") <= F.col("sourcepopulateddate_rating"))
        some = F.max(year_before).over(Window.partitionBy("pkid_"))
        able = known.withColumn("_some", some).where("_some").drop("_some")
        if g == OLD:
            able = merge_join(
                able, source.load_statement_metrics_old().select("pkid_", "versionid_", *CAPITAL),
                ["pkid_", "versionid_"],
            )
        parts.append(able.withColumnsRenamed({
            "versionid_": "versionid_financial",
            "sourcepopulateddate_": "sourcepopulateddate_financial",
        }))
    latest = distinct_on(
        union_all(parts), ["generation", "pkid_"],
        ["-sourcepopulateddate_financial", *STATEMENT_TIES],
    )
    return distinct_on(
        latest.where(year_before), OWNER,
        ["-statementyear", "-sourcepopulateddate_financial", "-versionid_financial", "-pkid_"],
    )


def prior_year_seed(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """Share-capital change with the year before the first one in scope as a start.

    Seed rows carry ``exclude_from_rating``, the others ``include_in_rating``. An owner whose
    customer or tax id is NULL equals no other and gets no seed.
    """
    base = share_capital_base(statements_in_scope(source, cfg, scope, CAPITAL))
    first = base.groupBy(*OWNER).agg(F.min("statementyear").alias("first_year"))
    seeds = _seeds(source, cfg, scope, first)
    cols = ["pkid_", *SCOPE_KEYS, "cdicode", "afm", "statementyear", "statementmonths",
            "statementdatekey_", "versionid_financial", "sourcepopulateddate_financial", *CAPITAL]
    both = union_all([
        seeds.select(*cols, F.lit("exclude_from_rating").alias("seed_flag")),
        base.select(*cols, F.lit("include_in_rating").alias("seed_flag")),
    ])
    return change_vs_previous(
        both, [*OWNER, "financialid"],
        ["statementdatekey_", "statementid", "pkid_"], CAPITAL,
    )
