"""Rating filters and the choice of one final rating per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeledger.config import NEW, ReportConfig
from gradeledger.functions import context
from gradeledger.functions.scalars import end_of, start_of
from gradeledger.operators.dedup import distinct_on

RATING_COLUMNS = (
    "pkid_", "versionid_", "entityid", "entityversion", "approveid", "approveddate",
    "sourcepopulateddate_rating", "modelid", "nextreviewdate", "creditcommitteedate",
    "islatestapprovedscenario", "approvalstatus", "financialcontext", "generation",
)


def eligible_ratings(df: DataFrame, cfg: ReportConfig, generation: str) -> DataFrame:
    """Ratings of one generation that may count on the reference date.

    New ratings are bounded by approval time and must be approved already. Old ones
    are bounded by the time they reached the source, may still be unapproved, and
    carry their entity version inside the context.
    """
    live = df.where(~F.col("isdeleted_") & F.col("isprimary"))
    if generation == NEW:
        kept = live.where(
            (F.col("approveddate") >= start_of(cfg.go_live))
            & (F.col("approveddate") <= end_of(cfg.ref_date))
            & F.col("islatestapprovedscenario")
            & (F.col("approvalstatus") == cfg.approved_status)
        ).withColumn("entityversion", F.col("entity_version_match").cast("int"))
    else:
        known = F.col("sourcepopulateddate_")
        kept = live.where(
            (known >= start_of(cfg.go_live))
            & (known <= end_of(cfg.ref_date))
            & context.has_entity_version("financialcontext")
        ).withColumn("entityversion", context.entity_version("financialcontext"))
    return (
        kept.withColumn("generation", F.lit(generation))
        .withColumnRenamed("sourcepopulateddate_", "sourcepopulateddate_rating")
        .select(*RATING_COLUMNS)
    )


def split_by_model(df: DataFrame, models: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(financials, non-financials); a rating without a model is in neither."""
    financials = F.col("modelid").isin(list(models))
    return df.where(financials), df.where(~financials)


def usable_context(df: DataFrame, col: str = "financialcontext", min_len: int = 16) -> DataFrame:
    return df.where(context.usable(col, min_len))


def is_approved() -> Column:
    return F.col("approveddate").isNotNull() & F.coalesce("islatestapprovedscenario", F.lit(False))


def approved(df: DataFrame) -> DataFrame:
    return df.where(is_approved())


# Total orders, as for ``distinct_on``. The leading keys are the reports' own; the rest
# only fix ties. ``-generation`` puts "old" before "new".
ENTITY_ORDER = ("-sourcepopulateddate_entity", "cdicode", "afm")
RATING_ORDER = ("-sourcepopulateddate_rating", "-versionid_", "-pkid_")
LATEST_PAIR_ORDER = (ENTITY_ORDER[0], *RATING_ORDER, *ENTITY_ORDER[1:])
FINAL_ORDER_P = (RATING_ORDER[0], "-generation", *RATING_ORDER[1:])
FINAL_ORDER_R = (RATING_ORDER[0], ENTITY_ORDER[0], "-generation", *RATING_ORDER[1:],
                 *ENTITY_ORDER[1:])


def final_rating(
    df: DataFrame,
    keys: Sequence[str] = ("entityid",),
    order: Sequence[str | Column] = FINAL_ORDER_P,
) -> DataFrame:
    """The last approved rating per key."""
    return distinct_on(approved(df), keys, order)
