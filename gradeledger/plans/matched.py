"""Ratings with entity data, and the perimeter: the steps both reports share.

Two forms exist for each report. The step form keeps every matched rating, for
inspection. The final form keeps only what can still become an entity's final
rating: both sides of each join are cut to one row per join key first, by the same
order that decides later, so the result is the same and no hot entity is joined
row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeledger.config import FINANCIALS, NEW, NON_FINANCIALS, OLD, ReportConfig
from gradeledger.functions import context
from gradeledger.functions.scalars import end_of
from gradeledger.operators.dedup import distinct_on
from gradeledger.operators.funnel import Mark, unmarked
from gradeledger.operators.matching import (
    attach_grade,
    in_scope,
    match_asof,
    match_pinned_version,
)
from gradeledger.operators.ratings import (
    ENTITY_ORDER,
    FINAL_ORDER_P,
    FINAL_ORDER_R,
    LATEST_PAIR_ORDER,
    RATING_ORDER,
    approved,
    eligible_ratings,
    final_rating,
    is_approved,
    split_by_model,
    usable_context,
)
from gradeledger.operators.sieve import Sieve
from gradeledger.operators.skew import merge_join
from gradeledger.sources.tables import ReportSource, in_portfolio, tagged_union

# Stands for the version of ratings that are matched by time.
ANY_VERSION = -1

# Order among matched versions of one rating record: latest entity data, then as ties.
ASOF_ORDER = (ENTITY_ORDER[0], *RATING_ORDER[:2], *ENTITY_ORDER[1:])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def eligible(source: ReportSource, cfg: ReportConfig, generation: str) -> DataFrame:
    return eligible_ratings(source.load_ratings(generation), cfg, generation)


def eligible_financials(source: ReportSource, cfg: ReportConfig, generation: str) -> DataFrame:
    """Report R's ratings: financials models with a usable context only."""
    financials, _ = split_by_model(eligible(source, cfg, generation), cfg.financial_models)
    return usable_context(financials, min_len=cfg.min_context)


def entities(source: ReportSource, cfg: ReportConfig, generation: str) -> DataFrame:
    return in_portfolio(source.load_entities(generation), cfg.portfolio).drop("creditportfolio")


def nonfin_entities(source: ReportSource, cfg: ReportConfig, generation: str) -> DataFrame:
    """Entity versions for as-of matching, those known on the reference date."""
    owner = OLD if generation == OLD else cfg.nonfin_entity_gen
    return (
        entities(source, cfg, owner)
        .where(F.col("sourcepopulateddate_entity") <= end_of(cfg.ref_date))
        .drop("versionid_")
    )


def _kind(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("match_kind", F.lit(kind))


# -- step form ---------------------------------------------------------------

def pinned_matches(ratings: DataFrame, source, cfg: ReportConfig, generation: str) -> DataFrame:
    """Every rating with each row of its pinned entity version."""
    matched = match_pinned_version(
        ratings, entities(source, cfg, generation), ["entityid"], "entityversion",
        end_of(cfg.ref_date),
    )
    return _kind(matched, FINANCIALS)


def asof_matches(ratings: DataFrame, source, cfg: ReportConfig, generation: str) -> DataFrame:
    """Every rating record with the latest entity version before it."""
    matched = match_asof(
        ratings, nonfin_entities(source, cfg, generation), ["entityid"],
        "sourcepopulateddate_rating", "sourcepopulateddate_entity", order=ENTITY_ORDER[1:],
    )
    return _kind(distinct_on(matched, ["pkid_", "entityid"], ASOF_ORDER), NON_FINANCIALS)


def latest_pairs(source, cfg: ReportConfig, generation: str) -> DataFrame:
    """Financials ratings of report P: the one with the newest entity data per entity."""
    financials, _ = split_by_model(eligible(source, cfg, generation), cfg.pinned)
    return distinct_on(
        best_pinned(financials, source, cfg, generation), ["entityid"], LATEST_PAIR_ORDER
    )


def rating_entity_p(source, cfg: ReportConfig, generation: str) -> DataFrame:
    _, others = split_by_model(eligible(source, cfg, generation), cfg.pinned)
    return latest_pairs(source, cfg, generation).unionByName(
        asof_matches(others, source, cfg, generation)
    )


def ratings_union(source, cfg: ReportConfig) -> DataFrame:
    """Old and new matched ratings of report P with their grades, distinct."""
    parts = [
        attach_grade(
            rating_entity_p(source, cfg, g), source.load_entity_rating(g),
            source.load_rating_scale(),
        )
        for g in (OLD, NEW)
    ]
    return union_all(parts).distinct()


def rating_entity_r(source, cfg: ReportConfig, generation: str) -> DataFrame:
    return pinned_matches(
        eligible_financials(source, cfg, generation), source, cfg, generation
    ).distinct()


# -- final form --------------------------------------------------------------

def best_pinned(ratings: DataFrame, source, cfg: ReportConfig, generation: str) -> DataFrame:
    """Per entity and version the best rating with the best entity row.

    All ratings of an (entity, version) meet the same entity rows, so the best pair
    is the best of each side, and the join is one-to-one on the key both sides were
    just partitioned by.
    """
    rating = distinct_on(ratings, ["entityid", "entityversion"], RATING_ORDER)
    known = entities(source, cfg, generation).where(
        F.col("sourcepopulateddate_entity") <= end_of(cfg.ref_date)
    )
    entity = distinct_on(known, ["entityid", "versionid_"], ENTITY_ORDER).withColumnRenamed(
        "versionid_", "entityversion"
    )
    return _kind(merge_join(rating, entity, ["entityid", "entityversion"]), FINANCIALS)


def candidate_ratings(source, cfg: ReportConfig, mark: Mark = unmarked) -> DataFrame:
    """Of each generation and kind, the ratings that can still become an entity's final one.

    Of financials ratings the last one per pinned version, ``matched_version``. Of the others
    the last approved one per entity: a later rating has every earlier entity version an
    earlier rating has, so the last one is matched if any is. Old records of the others are
    first cut to their own last row, approved or not: an unapproved one hides the approved
    ones before it. One scan of each rating table: both kinds share the two cuts, each with
    its own part of the key.
    """
    financials = F.col("modelid").isin(list(cfg.pinned))
    ratings = union_all(
        [mark(f"eligible_{g}", eligible(source, cfg, g)) for g in (OLD, NEW)]
    ).withColumn(
        "match_kind", F.when(financials, FINANCIALS).when(~financials, NON_FINANCIALS)
    )
    pinned, old = F.col("match_kind") == FINANCIALS, F.col("generation") == OLD
    dated = F.col("sourcepopulateddate_rating").isNotNull()
    able = F.when(pinned, F.col("entityversion").isNotNull()).otherwise(dated & (old | is_approved()))
    record = F.when(pinned, F.col("entityversion").cast("long")).when(old, F.col("pkid_"))
    keys = ["generation", "match_kind", "entityid"]
    of_record = distinct_on(
        ratings.where(F.col("match_kind").isNotNull() & able), [*keys, record], RATING_ORDER
    )
    version = F.when(pinned, F.col("entityversion")).otherwise(F.lit(ANY_VERSION))
    return distinct_on(
        of_record.where(pinned | is_approved()).withColumn("matched_version", version),
        [*keys, "matched_version"], RATING_ORDER,
    )


def versions_by_use(source, cfg: ReportConfig) -> DataFrame:
    """Entity versions known on the reference date, a row for each generation and kind of
    ratings that may meet them. One scan of each entity table."""
    parts = []
    for owner in (OLD, NEW):
        uses = [(owner, FINANCIALS)] + [
            (g, NON_FINANCIALS) for g in (OLD, NEW)
            if owner == (OLD if g == OLD else cfg.nonfin_entity_gen)
        ]
        use = F.explode(F.array(*[
            F.struct(F.lit(g).alias("generation"), F.lit(k).alias("match_kind")) for g, k in uses
        ]))
        parts.append(
            entities(source, cfg, owner)
            .where(F.col("sourcepopulateddate_entity") <= end_of(cfg.ref_date))
            .withColumn("_use", use).select("*", "_use.*").drop("_use")
        )
    version = F.when(F.col("match_kind") == FINANCIALS, F.col("versionid_")).otherwise(
        F.lit(ANY_VERSION)
    )
    return union_all(parts).withColumn("matched_version", version).drop("versionid_")


def final_rating_p(source, cfg: ReportConfig, mark: Mark = unmarked) -> DataFrame:
    """One rating per entity over all models, graded.

    Pinned and as-of matches are one join: a financials rating meets the rows of its version,
    another one every version of its entity before it. On the rating's side a key has one row,
    so there are no more pairs than entity rows, and the newest entity data wins for both.
    """
    keys = ["generation", "match_kind", "entityid"]
    pairs = in_scope(
        versions_by_use(source, cfg), mark("candidates", candidate_ratings(source, cfg, mark)),
        [*keys, "matched_version"], cfg.splits,
    )
    before = F.col("sourcepopulateddate_entity") < F.col("sourcepopulateddate_rating")
    matched = distinct_on(
        pairs.where((F.col("match_kind") == FINANCIALS) | before), keys, LATEST_PAIR_ORDER
    ).drop("matched_version")
    return mark("final", graded(final_rating(matched, order=FINAL_ORDER_P), source))


def graded(ratings: DataFrame, source) -> DataFrame:
    """Grades for ratings of both generations; the better of repeated ones, and of the labels
    that the scale repeats for one grade the last by name. One row per rating stays."""
    grades = distinct_on(
        tagged_union(source.load_entity_rating(OLD), source.load_entity_rating(NEW)),
        ["generation", "approveid"], [F.col("finalgrade").desc_nulls_last()],
    )
    scale = distinct_on(
        source.load_rating_scale().select(
            F.col("ratingscalekey_").alias("finalgrade"), "ratingscalevalue"
        ),
        ["finalgrade"], [F.col("ratingscalevalue").desc_nulls_last()],
    )
    # rows without an approval have no grade; they would be one hot key
    spread = F.when(F.col("approveid").isNull(), F.xxhash64("entityid")).otherwise(F.lit(0))
    found = merge_join(
        ratings.withColumn("_spread", spread),
        grades.withColumn("_spread", F.lit(0).cast("long")),
        ["generation", "approveid", "_spread"], "left",
    )
    return found.drop("_spread").join(scale, "finalgrade", "left")


def final_rating_r(source, cfg: ReportConfig, mark: Mark = unmarked) -> DataFrame:
    """One financials rating per entity: the last approved one."""
    candidates = [
        best_pinned(
            approved(mark(f"eligible_{g}", eligible_financials(source, cfg, g))), source, cfg, g
        )
        for g in (OLD, NEW)
    ]
    return mark("final", final_rating(union_all(candidates), order=FINAL_ORDER_R))


# -- perimeter ---------------------------------------------------------------

def perimeter(final: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One row per statement in scope of each financials rating.

    ``statementid`` is an int for joins, ``statement_text`` the text it came as.
    """
    financials, _ = split_by_model(final, cfg.financial_models)
    scoped = context.explode_statements(
        financials.withColumn("financialid", context.financial_id("financialcontext")),
        distinct=True,
    )
    return scoped.withColumnRenamed("statementid", "statement_text").withColumn(
        "statementid", F.col("statement_text").cast("int")
    )


def perimeter_versions(final: DataFrame, cfg: ReportConfig) -> DataFrame:
    """As ``perimeter``, with the statement version paired in lockstep."""
    financials, _ = split_by_model(final, cfg.financial_models)
    return context.explode_statements(
        financials.withColumn("financialid", context.financial_id("financialcontext")),
        with_version=True,
    )


SIEVED = ("generation", "financialid", "statementid")


def scope_sieve(scope: DataFrame) -> Sieve:
    """Of the statements in scope; their financial and statement ids are in every table."""
    return Sieve(scope.select(*SIEVED))


def perimeter_statements(
    scope: DataFrame, source, cfg: ReportConfig, generation: str, columns: list[str],
    sieve: Sieve | None = None,
) -> DataFrame:
    """Statement versions in scope, with the wanted metrics.

    Old headers meet the perimeter before their metrics do, so only statements in
    scope take part in the wide join. Old ratings are checked for approval only here,
    after the ranking: an entity whose last rating is unapproved has no statements.
    With ``sieve`` (of the scope) most other rows are left out before they are shuffled.
    """
    keys = ["entityid", "financialid", "statementid"]
    header = [
        "pkid_", "versionid_", *keys, "statementyear", "statementmonths", "statementdatekey_",
        "sourcepopulateddate_",
    ]
    rating = scope.where(F.col("generation") == generation).withColumnsRenamed(
        {"pkid_": "pkid_rating", "versionid_": "versionid_rating"}
    )
    if generation == NEW:
        found = merge_join(
            statements_near(source.load_statements_new(), NEW, sieve).select(*header, *columns),
            rating, keys,
        )
    else:
        version = ["pkid_", "versionid_"]
        near = statements_near(source.load_statement_headers_old(), OLD, sieve).select(*header)
        metrics = source.load_statement_metrics_old().select(*version, *columns)
        if sieve is not None:
            metrics = Sieve(near.select(*version)).cut(metrics, version)
        found = merge_join(merge_join(near, rating, keys), metrics, version).where(
            F.col("approvalstatus") == cfg.approved_status
        )
    return found.withColumnsRenamed(
        {
            "versionid_": "versionid_financial",
            "sourcepopulateddate_": "sourcepopulateddate_financial",
        }
    )


def statements_near(df: DataFrame, generation: str, sieve: Sieve | None) -> DataFrame:
    """Statements that may be in scope: all of them without a sieve."""
    return df if sieve is None else sieve.cut(df, [F.lit(generation), *SIEVED[1:]])


STATEMENT_TIES = ("-approveddate", "-versionid_financial")
