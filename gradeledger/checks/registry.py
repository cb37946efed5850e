"""Every operator as a query over the derived tables, beside its oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeledger.checks.derived import CONFIG, DerivedSource
from gradeledger.checks.oracle import first_per, ratio, scaled, with_steps, zoned
from gradeledger.config import ACCOUNT_GROUPS, NEW, OLD, ROUNDING_FACTORS, ReportConfig
from gradeledger.functions import context, scalars
from gradeledger.operators import (
    account_group_for,
    attach_grade,
    changed_columns,
    distinct_on,
    find_duplicates,
    long_groups,
    report_difference,
    side_by_side,
    split_by_model,
    step_counts,
    usable_context,
)
from gradeledger.operators.reuse import Keeper, shared_dir
from gradeledger.plans import matched, position, restricted, risk, variants
from gradeledger.plans.jobs import run_report_p, run_report_r
from gradeledger.plans.matched import union_all
from gradeledger.sources.layout import lay_out
from gradeledger.sources.sinks import (
    append_audit,
    audit_record,
    export_report,
    read_audit,
    read_report,
    read_steps,
    register_view,
    write_report,
)
from gradeledger.sources.tables import (
    METRICS,
    ReportSource,
    balances_unified,
    in_portfolio,
    statements_unified,
    tagged_union,
)

BOTH = (OLD, NEW)

# Dates, times, flags and nullable integers are compared as text, which both engines
# write alike.
AS_TEXT = {
    "approveddate", "sourcepopulateddate_", "sourcepopulateddate_rating",
    "sourcepopulateddate_entity", "sourcepopulateddate_financial", "nextreviewdate",
    "creditcommitteedate", "islatestapprovedscenario", "isprimary", "isdeleted_", "finalgrade",
    "statementid_version", "statementid_text", "o_orderdate", "publish_day",
}


@dataclass(frozen=True)
class Check:
    """A query, its output columns and the DuckDB source that must equal it."""

    columns: tuple[str, ...]
    build: Callable[[ReportSource], DataFrame]
    sql: str | None
    cfg: ReportConfig = CONFIG

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(DerivedSource(spark, sf_dir)).select(*[
            F.col(c).cast("string").alias(c) if c in AS_TEXT else c for c in self.columns
        ])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cols = ", ".join(
            f"CAST({c} AS VARCHAR) AS {c}" if c in AS_TEXT else c for c in self.columns
        )
        source = self.sql if self.sql.isidentifier() else f"({self.sql})"
        return with_steps(f"SELECT {cols} FROM {source} AS answer", self.cfg)


CHECKS: dict[str, Check] = {}


def check(
    name: str, columns: Sequence[str], sql: str | None, build: Callable[[ReportSource], DataFrame],
    cfg: ReportConfig = CONFIG,
) -> None:
    CHECKS[name] = Check(tuple(columns), build, sql, cfg)


def words(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def scope(source: ReportSource) -> DataFrame:
    return risk.perimeter_r(source, CONFIG)


def _both_balances(source: ReportSource) -> ReportSource:
    """For reports that read both generations' balances."""
    return source.with_booked_lines() if isinstance(source, DerivedSource) else source


def found_r(source: ReportSource, columns: Sequence[str] = METRICS) -> DataFrame:
    return risk.statements_in_scope(source, CONFIG, scope(source), columns)


def every_rating(source: ReportSource) -> DataFrame:
    return tagged_union(source.load_ratings_old(), source.load_ratings_new())


def each_generation(step, source: ReportSource, cfg: ReportConfig = CONFIG) -> DataFrame:
    return union_all([step(source, cfg, g) for g in BOTH])


# -- columns -----------------------------------------------------------------

RATING = words(
    "pkid_ versionid_ entityid entityversion approveid approveddate sourcepopulateddate_rating "
    "modelid nextreviewdate creditcommitteedate islatestapprovedscenario approvalstatus "
    "financialcontext generation"
)
ENTITY = words("sourcepopulateddate_entity afm cdicode")
MATCHED = (*RATING, *ENTITY, "match_kind")
GRADED = (*MATCHED, "finalgrade", "ratingscalevalue")
BALANCE = words(
    "statementid financialid accountid versionid_ sourcepopulateddate_ originrounding originbalance"
)
MACRO = ("entityid", *BALANCE)
P_COLUMNS, R_COLUMNS = position.REPORT_P_COLUMNS, risk.REPORT_R_COLUMNS
CHOSEN_P = words(
    "pkid_ generation entityid cdicode afm statementyear statement_text salesrevenues totalassets "
    "versionid_financial sourcepopulateddate_financial sourcepopulateddate_rating"
)
CHOSEN_R = words(
    "pkid_ generation entityid statementid financialid cdicode afm versionid_rating statementyear "
    "versionid_financial sourcepopulateddate_financial sourcepopulateddate_rating"
) + METRICS
CAPITAL_BASE = words(
    "pkid_ generation entityid statementid financialid cdicode afm statementyear statementmonths "
    "statementdatekey_ versionid_financial sourcepopulateddate_financial commonsharecapital "
    "sharepremium"
)
CAPITAL_CHANGE = CAPITAL_BASE + words(
    "prev_commonsharecapital prev_sharepremium chg_commonsharecapital chg_sharepremium"
)

# -- sources -----------------------------------------------------------------

check(
    "src_ratings",
    words("pkid_ versionid_ financialcontext entityid approveddate approveid sourcepopulateddate_ "
          "islatestapprovedscenario isprimary isdeleted_ nextreviewdate creditcommitteedate "
          "approvalstatus modelid entity_version_match generation"),
    "all_ratings", every_rating,
)
check(
    "statements_unified",
    words("pkid_ versionid_ entityid financialid statementid statementyear statementmonths "
          "statementdatekey_ sourcepopulateddate_") + METRICS + ("generation",),
    "SELECT s.*, m.* EXCLUDE (pkid_, versionid_), 'old' AS generation FROM statement_old s "
    "JOIN statement_metrics_old m ON s.pkid_ = m.pkid_ AND s.versionid_ = m.versionid_ "
    "UNION ALL BY NAME SELECT * REPLACE (CAST(entityid AS INT) AS entityid, CAST(financialid AS "
    "INT) AS financialid, CAST(statementid AS INT) AS statementid), 'new' AS generation "
    "FROM statement_new",
    statements_unified,
)
check(
    "balances_unified", (*BALANCE, "generation"), "bal_all",
    lambda s: balances_unified(s, CONFIG.account_codes),
)
check(
    "rating_grade_lookup",
    words("pkid_ generation approveid finalgrade ratingscalevalue graded"),
    "SELECT r.pkid_, r.generation, r.approveid, f.finalgrade, d.ratingscalevalue, "
    "CASE WHEN d.ratingscalevalue IS NULL THEN 'false' ELSE 'true' END AS graded "
    "FROM all_ratings r LEFT JOIN (SELECT *, 'old' AS generation FROM entityrating_old UNION ALL "
    "SELECT *, 'new' AS generation FROM entityrating_new) f ON r.approveid = f.approveid "
    "AND r.generation = f.generation "
    "LEFT JOIN ratingscale d ON f.finalgrade = d.ratingscalekey_",
    lambda s: union_all([
        attach_grade(
            s.load_ratings(g).withColumn("generation", F.lit(g)),
            s.load_entity_rating(g), s.load_rating_scale(),
        )
        for g in BOTH
    ]),
)

# -- filters and parsing -----------------------------------------------------

for generation in BOTH:
    check(
        f"ratings_{generation}_eligible", (*RATING, "ratingscalevalue", "graded"),
        f"SELECT e.*, d.ratingscalevalue, CASE WHEN d.ratingscalevalue IS NULL THEN 'false' "
        f"ELSE 'true' END AS graded FROM elig_{generation} e "
        f"LEFT JOIN entityrating_{generation} f ON e.approveid = f.approveid "
        "LEFT JOIN ratingscale d ON f.finalgrade = d.ratingscalekey_",
        lambda s, g=generation: attach_grade(
            matched.eligible(s, CONFIG, g), s.load_entity_rating(g), s.load_rating_scale()
        ),
    )
check(
    "ratings_by_model_class", (*RATING, "model_class"),
    "SELECT *, CASE WHEN modelid IN ('FA_FIN', 'PdModelCcategory') THEN 'financials' "
    "ELSE 'non_financials' END AS model_class FROM elig WHERE modelid IS NOT NULL",
    lambda s: union_all([
        part.withColumn("model_class", F.lit(kind))
        for g in BOTH
        for part, kind in zip(
            split_by_model(matched.eligible(s, CONFIG, g), CONFIG.financial_models),
            ("financials", "non_financials"),
            strict=True,
        )
    ]),
)
check(
    "context_usable", words("pkid_ generation financialcontext"),
    "SELECT * FROM all_ratings WHERE financialcontext IS NOT NULL AND financialcontext NOT IN "
    "('0', '', '###') AND length(financialcontext) > 16",
    lambda s: usable_context(every_rating(s)),
)
check(
    "context_entity_version", words("pkid_ generation entityversion"),
    "SELECT *, CAST(regexp_extract(financialcontext, ';([^;#]*)#', 1) AS INT) AS entityversion "
    "FROM all_ratings WHERE regexp_matches(financialcontext, ';([^;#]*)#')",
    lambda s: context.parse_context(every_rating(s)),
)
check(
    "context_financial_id", words("pkid_ generation financialid"),
    "SELECT *, CAST(regexp_extract(financialcontext, '^[^:]*') AS INT) AS financialid "
    "FROM all_ratings WHERE length(financialcontext) > 16",
    lambda s: usable_context(every_rating(s)).withColumn(
        "financialid", context.financial_id("financialcontext")
    ),
)
CONTEXT_ITEMS = (
    "SELECT pkid_, generation, item FROM all_ratings, unnest(string_split(regexp_replace("
    "financialcontext, '.*#([^:*]+)', '\\1'), ';')) AS u(item)"
)
check(
    "context_statements", words("pkid_ generation statementid"),
    f"SELECT pkid_, generation, regexp_extract(item, '^(\\d+)', 1) AS statementid "
    f"FROM ({CONTEXT_ITEMS}) WHERE regexp_matches(item, '^\\d')",
    lambda s: context.explode_statements(every_rating(s)),
)
check(
    "context_statement_versions", words("pkid_ generation statementid statementid_version"),
    "SELECT pkid_, generation, ids[i] AS statementid, versions[i] AS statementid_version FROM ("
    "SELECT *, unnest(range(1, greatest(len(ids), len(versions)) + 1)) AS i FROM ("
    "SELECT *, regexp_extract_all(item, '^(\\d+)', 1) AS ids, "
    f"regexp_extract_all(item, ':(\\d+)', 1) AS versions FROM ({CONTEXT_ITEMS})))",
    lambda s: context.explode_statements(every_rating(s), with_version=True),
)
check(
    "entity_portfolio_filter",
    words("entityid versionid_ sourcepopulateddate_entity afm cdicode generation"),
    "SELECT *, ent_version AS versionid_ FROM ent_all WHERE creditportfolio = 'ALPHA_CP'",
    lambda s: tagged_union(*[in_portfolio(s.load_entities(g), CONFIG.portfolio) for g in BOTH]),
)

# -- matching and ranking ----------------------------------------------------

check(
    "entity_version_match", MATCHED,
    "SELECT *, 'financials' AS match_kind FROM (SELECT * FROM pinned_old UNION ALL "
    "SELECT * FROM pinned_new) WHERE modelid IN ('FA_FIN', 'PdModelCcategory')",
    lambda s: union_all([
        matched.pinned_matches(
            split_by_model(matched.eligible(s, CONFIG, g), CONFIG.pinned)[0], s, CONFIG, g
        )
        for g in BOTH
    ]),
)
check(
    "entity_asof_match", MATCHED,
    "SELECT *, 'non_financials' AS match_kind FROM (SELECT * FROM asof_old UNION ALL "
    "SELECT * FROM asof_new)",
    lambda s: union_all([
        matched.asof_matches(
            split_by_model(matched.eligible(s, CONFIG, g), CONFIG.pinned)[1], s, CONFIG, g
        )
        for g in BOTH
    ]),
)
check(
    "entity_latest_pair", MATCHED,
    "SELECT *, 'financials' AS match_kind FROM (SELECT * FROM pair_old UNION ALL "
    "SELECT * FROM pair_new)",
    lambda s: each_generation(matched.latest_pairs, s),
)
check(
    "rating_entity_p", MATCHED, "SELECT * FROM matched_old UNION ALL SELECT * FROM matched_new",
    lambda s: each_generation(matched.rating_entity_p, s),
)
check(
    "rating_entity_r", MATCHED, "SELECT * FROM r_pinned_old UNION ALL SELECT * FROM r_pinned_new",
    lambda s: each_generation(matched.rating_entity_r, s),
)
check(
    "ratings_union", (*GRADED, "graded"), "ratings_union",
    lambda s: matched.ratings_union(s, CONFIG),
)
check("final_rating_p", GRADED, "final_p", lambda s: matched.final_rating_p(s, CONFIG))
check("final_rating_r", MATCHED, "final_r", lambda s: matched.final_rating_r(s, CONFIG))
check(
    "distinct_on_basic", words("o_custkey o_orderkey o_orderdate"),
    first_per("orders", "o_custkey", "o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST"),
    lambda s: distinct_on(
        s.spark.read.parquet(f"{s.root}/orders.parquet"), ["o_custkey"],
        ["-o_orderdate", "-o_orderkey"],
    ),
)
check(
    "override_flag", words("entityid pkid_ generation overrideflag"),
    "SELECT *, CASE WHEN finalgrade IS NULL THEN 'false' ELSE 'true' END AS overrideflag "
    "FROM final_p",
    lambda s: matched.final_rating_p(s, CONFIG).withColumn(
        "overrideflag", scalars.presence_flag("finalgrade")
    ),
)

# -- perimeter and statements ------------------------------------------------

check(
    "perimeter_p", words("pkid_ entityid generation financialid statement_text statementid "
                         "match_kind"),
    "perim_p", lambda s: matched.perimeter(matched.final_rating_p(s, CONFIG), CONFIG),
)
check(
    "perimeter_r", words("pkid_ entityid generation financialid statementid statementid_version"),
    "SELECT pkid_, entityid, generation, financialid, ids[i] AS statementid, versions[i] AS "
    "statementid_version FROM (SELECT *, unnest(range(1, greatest(len(ids), len(versions)) + 1)) "
    "AS i FROM (SELECT *, CAST(regexp_extract(financialcontext, '^[^:]*') AS INT) AS financialid, "
    "regexp_extract_all(item, '^(\\d+)', 1) AS ids, regexp_extract_all(item, ':(\\d+)', 1) AS "
    "versions FROM items_r))",
    lambda s: matched.perimeter_versions(matched.final_rating_r(s, CONFIG), CONFIG),
)
check(
    "perimeter_statements", CHOSEN_P, "found_p",
    lambda s: position.statements_in_scope(s, CONFIG, position.perimeter_p(s, CONFIG)),
)
check(
    "statement_asof_choice", CHOSEN_P, "chosen_p",
    lambda s: position.chosen_statements(s, CONFIG),
)
check("statement_per_year", CHOSEN_P, "year_p", lambda s: position.statement_per_year(s, CONFIG))
check("report_p_years", P_COLUMNS, "p_years", lambda s: position.report_p_years(s, CONFIG))
check("report_p", P_COLUMNS, "report_p", lambda s: position.report_p(s, CONFIG))
check("report_p_nonfin", P_COLUMNS, "p_nonfin", lambda s: position.report_p_nonfin(s, CONFIG))

# -- balances, groups, share capital, report R -------------------------------

check("macros_new", MACRO, "macros_new", lambda s: risk.macros_new(s, CONFIG, scope(s)))
check("macros_old", MACRO, "macros_old", lambda s: risk.macros_old(s, CONFIG, scope(s)))
# The same joins with keys weighed first, and on tables laid out by their keys.
WEIGHED, WHERE_THEY_LIE = replace(CONFIG, splits=0), replace(CONFIG, splits=1)
check("macros_old_weighed", MACRO, "macros_old", lambda s: risk.macros_old(s, WEIGHED, scope(s)))


def _laid_out(source: ReportSource) -> ReportSource:
    """The source tables in buckets, below a folder and under names of their own."""
    run = uuid.uuid4().hex
    return lay_out(source, f"laid_{run}_", f"{shared_dir(source.spark)}/laid-{run}", 16)


check(
    "account_groups_bucketed", (*risk.SCOPE_KEYS, *ACCOUNT_GROUPS), "groups_wide",
    lambda s: (lambda laid: risk.groups_in_scope(laid, WHERE_THEY_LIE, scope(laid)))(_laid_out(s)),
)
check(
    "account_groups", (*risk.SCOPE_KEYS, *ACCOUNT_GROUPS), "groups_wide",
    lambda s: risk.groups_in_scope(s, CONFIG, scope(s)),
)
for group in ACCOUNT_GROUPS:
    check(
        f"ag_{group}", (*risk.SCOPE_KEYS, group), f"ag_{group}",
        lambda s, g=group: account_group_for(risk.macros_all(s, CONFIG, scope(s)), g),
    )
check(
    "ag_lookup", (*risk.SCOPE_KEYS, "account_group", "amount"),
    " UNION ALL ".join(
        f"SELECT {', '.join(risk.SCOPE_KEYS)}, '{g}' AS account_group, {g} AS amount FROM ag_{g} "
        f"WHERE {g} IS NOT NULL" for g in ACCOUNT_GROUPS
    ),
    lambda s: long_groups(risk.macros_all(s, CONFIG, scope(s))),
)


def _one_group(source: ReportSource) -> DataFrame:
    """The debt of one statement: the first one of the first entity."""
    balances = risk.macros_all(source, CONFIG, scope(source))
    debt = balances.where(F.col("accountid").isin([abs(c) for c in ACCOUNT_GROUPS["total_debt"]]))
    first = debt.select(*ONE_STATEMENT).orderBy(*ONE_STATEMENT).first()
    return account_group_for(balances, "total_debt", **first.asDict())


ONE_STATEMENT = ("entityid", "financialid", "statementid")
check(
    "ag_lookup_one", (*risk.SCOPE_KEYS, "total_debt"),
    f"SELECT a.* FROM ag_total_debt a JOIN (SELECT {', '.join(ONE_STATEMENT)} FROM ag_total_debt "
    f"ORDER BY {', '.join(ONE_STATEMENT)} LIMIT 1) USING ({', '.join(ONE_STATEMENT)})",
    _one_group,
)
check(
    "share_capital_base", CAPITAL_BASE, "capital_base",
    lambda s: risk.share_capital_base(found_r(s, risk.CAPITAL)),
)
check(
    "share_capital_change", CAPITAL_CHANGE, "capital_change",
    lambda s: risk.share_capital_change(found_r(s, risk.CAPITAL), CONFIG),
)
check(
    "report_r_years", CHOSEN_R, "year_r", lambda s: risk.report_r_years(found_r(s), CONFIG)
)


def _report_r(source: ReportSource, cfg: ReportConfig = CONFIG) -> DataFrame:
    return risk.report_r(_both_balances(source), cfg, Keeper("files"))


check(
    "report_r_metrics", R_COLUMNS, "report_r",
    lambda s: risk.report_r_metrics(_both_balances(s), CONFIG, Keeper("files")),
)
check(
    "report_r", R_COLUMNS,
    first_per("report_r", "entityid, cdi, afm, fnc_year", "approveddate DESC NULLS FIRST"),
    _report_r,
)

# -- scalar functions --------------------------------------------------------

check(
    "taxid_canonical", words("entityid versionid_ generation afm canonical"),
    "SELECT *, ent_version AS versionid_, CASE WHEN regexp_full_match(afm, '0+') THEN '00000000' "
    "ELSE afm END AS canonical FROM ent_all",
    lambda s: tagged_union(*[s.load_entities(g) for g in BOTH]).withColumn(
        "canonical", scalars.canonical_tax_id("afm")
    ),
)
check(
    "entity_version_key", words("pkid_ generation entity_key"),
    "SELECT *, CAST(entityid AS VARCHAR) || '|' || CAST(versionid_ AS VARCHAR) AS entity_key "
    "FROM all_ratings",
    lambda s: every_rating(s).withColumn(
        "entity_key", scalars.entity_version_key("entityid", "versionid_")
    ),
)
check(
    "date_labels", words("pkid_ generation review committee approved approved_key publish_day"),
    "SELECT *, strftime(nextreviewdate, '%d-%m-%Y') AS review, "
    "strftime(creditcommitteedate, '%d-%m-%Y') AS committee, "
    f"{zoned('approveddate')} AS approved, strftime(approveddate, '%Y%m%d') AS approved_key, "
    "CAST(approveddate AS DATE) AS publish_day FROM all_ratings",
    lambda s: every_rating(s).select(
        "pkid_", "generation",
        scalars.day_month_year("nextreviewdate").alias("review"),
        scalars.day_month_year("creditcommitteedate").alias("committee"),
        scalars.zoned_text("approveddate").alias("approved"),
        scalars.compact_date("approveddate").alias("approved_key"),
        scalars.date_of_key(scalars.compact_date("approveddate").cast("int")).alias("publish_day"),
    ),
)
check(
    "ratio_guarded", words("pkid_ versionid_ generation plain filled"),
    " UNION ALL ".join(
        f"SELECT pkid_, versionid_, '{g}' AS generation, {ratio('totalassets', 'ebitda')} AS plain, "
        f"{ratio('netprofit', 'ebitda', null_as_zero=True)} AS filled FROM {table}"
        for g, table in {
            NEW: "statement_new",
            OLD: "statement_old JOIN statement_metrics_old USING (pkid_, versionid_)",
        }.items()
    ),
    lambda s: tagged_union(s.load_statements(OLD), s.load_statements(NEW)).select(
        "pkid_", "versionid_", "generation",
        scalars.guarded_ratio("totalassets", "ebitda").alias("plain"),
        scalars.guarded_ratio("netprofit", "ebitda", null_as_zero=True).alias("filled"),
    ),
)
check(
    "amount_scaling", (*BALANCE, "generation", "amount"),
    f"SELECT *, {scaled('originbalance', 'originrounding', ROUNDING_FACTORS)} AS amount "
    "FROM bal_all",
    lambda s: balances_unified(s, CONFIG.account_codes).withColumn(
        "amount", scalars.scale_amount("originbalance", "originrounding", ROUNDING_FACTORS)
    ),
)

# -- quality -----------------------------------------------------------------

NO_PORTFOLIO = replace(CONFIG, portfolio=None)
BALANCE_KEY = words("financialid statementid accountid versionid_")
check(
    "dq_duplicates", (*BALANCE_KEY, "generation", "n_rows"),
    " UNION ALL ".join(
        f"SELECT {', '.join(f'CAST({c} AS INT) AS {c}' for c in BALANCE_KEY)}, '{g}' AS generation, "
        f"count(*) AS n_rows FROM balance_{g} GROUP BY ALL HAVING count(*) > 1" for g in BOTH
    ),
    lambda s: find_duplicates(
        tagged_union(s.load_balances(OLD), s.load_balances(NEW)), (*BALANCE_KEY, "generation")
    ),
)
check(
    "step_counts", words("step n_rows"),
    " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS n_rows FROM {table}"
        for step, table in {
            "eligible_old": "elig_old", "eligible_new": "elig_new",
            "matched_old": "matched_old", "matched_new": "matched_new", "final": "final_p",
            "perimeter": "perim_p", "report": "report_p",
        }.items()
    ),
    lambda s: step_counts({
        "eligible_old": matched.eligible(s, CONFIG, OLD),
        "eligible_new": matched.eligible(s, CONFIG, NEW),
        "matched_old": matched.rating_entity_p(s, CONFIG, OLD),
        "matched_new": matched.rating_entity_p(s, CONFIG, NEW),
        "final": matched.final_rating_p(s, CONFIG),
        "perimeter": matched.perimeter(matched.final_rating_p(s, CONFIG), CONFIG),
        "report": position.report_p(s, CONFIG),
    }),
)


def _two_revisions(source: ReportSource) -> tuple[DataFrame, DataFrame]:
    return position.report_p_years(source, CONFIG), position.report_p(source, NO_PORTFOLIO)


DIFF_COLUMNS = tuple(c for c in P_COLUMNS if c != "creditcommitteedate")
_some = ", ".join(DIFF_COLUMNS)
_other = "SELECT * FROM (" + with_steps(f"SELECT {_some} FROM report_p", NO_PORTFOLIO) + ")"
check(
    "report_diff", (*DIFF_COLUMNS, "side"),
    f"SELECT *, 'a' AS side FROM (SELECT {_some} FROM p_years EXCEPT {_other})"
    f" UNION ALL SELECT *, 'b' AS side FROM (({_other}) EXCEPT SELECT {_some} FROM p_years)",
    lambda s: report_difference(*_two_revisions(s), ignore=("creditcommitteedate",)),
)
# Few columns, so that rows repeat on both sides.
REPEATED = ("grade", "ratingmodelname", "fiscalyear")
_few = ", ".join(REPEATED)
_other_few = "SELECT * FROM (" + with_steps(f"SELECT {_few} FROM report_p", NO_PORTFOLIO) + ")"
check(
    "report_diff_all", (*REPEATED, "side"),
    f"SELECT *, 'a' AS side FROM (SELECT {_few} FROM p_years EXCEPT ALL {_other_few})"
    f" UNION ALL SELECT *, 'b' AS side FROM (({_other_few}) EXCEPT ALL SELECT {_few} FROM p_years)",
    lambda s: report_difference(
        *[df.select(*REPEATED) for df in _two_revisions(s)], every=True
    ),
)
CHANGE_KEYS = ("entityid", "cdi", "afm")
_rest = [c for c in P_COLUMNS if c not in CHANGE_KEYS]
_keyed = ", ".join(CHANGE_KEYS) + ", count(*) AS n, " + ", ".join(f"min({c}) AS {c}" for c in _rest)
_differing = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _rest)
check(
    "report_changes", (*CHANGE_KEYS, "change", "columns"),
    f"SELECT {', '.join(f'coalesce(a.{c}, b.{c}) AS {c}' for c in CHANGE_KEYS)}, "
    "CASE WHEN a.n > 1 OR b.n > 1 THEN 'repeated' WHEN a.n IS NULL THEN 'added' "
    "WHEN b.n IS NULL THEN 'removed' WHEN concat_ws(',', " + _differing + ") <> '' THEN 'changed' "
    "ELSE 'same' END AS change, CASE WHEN a.n = 1 AND b.n = 1 THEN concat_ws(',', " + _differing
    + f") ELSE '' END AS columns FROM (SELECT {_keyed} FROM p_years GROUP BY ALL) a FULL JOIN "
    f"(SELECT {_keyed} FROM ({with_steps('SELECT * FROM report_p', NO_PORTFOLIO)}) GROUP BY ALL) b ON "
    + " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in CHANGE_KEYS),
    lambda s: changed_columns(*_two_revisions(s), CHANGE_KEYS).withColumn(
        "columns", F.array_join("columns", ",")
    ),
)
_text_r = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in R_COLUMNS)


def _side_by_side(source: ReportSource) -> DataFrame:
    return side_by_side(*[
        restricted.report_r_of(source, cfg, F.expr("cdi LIKE '%1%'"), Keeper("files"))
        .where("fnc_year = '1996'")
        for cfg in (CONFIG, NO_PORTFOLIO)
    ])


# Rows of two revisions that are put side by side: a part of the customers, one year.
SELECTED = "cdi LIKE '%1%' AND fnc_year = '1996'"
check(
    "report_side_by_side", ("source", *R_COLUMNS),
    f"SELECT 'a' AS source, {_text_r} FROM report_r WHERE {SELECTED} UNION ALL SELECT 'b' AS source, "
    f"{_text_r} FROM ({with_steps('SELECT * FROM report_r', NO_PORTFOLIO)}) WHERE {SELECTED}",
    lambda s: _side_by_side(_both_balances(s)),
)


def _slice(source: ReportSource) -> DataFrame:
    """Report R of the first customers by name."""
    known = tagged_union(source.load_entities(OLD), source.load_entities(NEW))
    first = known.where("cdicode IS NOT NULL").select("cdicode").distinct().orderBy("cdicode").limit(20)
    customers = [r.cdicode for r in first.collect()]
    return restricted.slice_of(source, CONFIG, customers, cols=("balancedividendspayable",))


_customers = (
    "SELECT DISTINCT cdicode FROM (SELECT cdicode FROM entity_old UNION SELECT cdicode FROM "
    "entity_new) WHERE cdicode IS NOT NULL ORDER BY cdicode LIMIT 20"
)
check(
    "metric_slice", words("cdi afm fnc_year balancedividendspayable approveddate entityid"),
    f"SELECT * FROM report_r WHERE cdi IN ({_customers})", _slice,
)
check(
    "report_p_slice", P_COLUMNS, "SELECT * FROM report_p WHERE cdi LIKE '%2'",
    lambda s: restricted.report_p_of(s, CONFIG, F.expr("cdi LIKE '%2'")),
)

# -- jobs, sinks, log --------------------------------------------------------


# Report R's job at the size of a cluster: a step's shuffles go before the next one's come.
IN_FILES = replace(CONFIG, sharing="files")


def _out(spark: SparkSession) -> str:
    """A folder of its own for each run, below the shared one where that is named."""
    return f"{shared_dir(spark)}/gradeledger-{uuid.uuid4().hex}"


def _must(ok: bool) -> None:
    if not ok:
        raise RuntimeError("the report job failed; see its audit log")


def _job_p(source: ReportSource) -> str:
    out = _out(source.spark)
    _must(run_report_p(source.spark, source, CONFIG.ref_date, out, CONFIG))
    return out


def _rerun_view(source: ReportSource) -> DataFrame:
    """A view registered over another report's rows, once the job ran without its name."""
    out, name = _out(source.spark), f"report_p_view_{uuid.uuid4().hex}"
    other = position.report_p(source, NO_PORTFOLIO).limit(5)
    write_report(other, f"{out}/report_p", CONFIG.ref_date)
    register_view(source.spark, f"{out}/report_p", name)
    _must(run_report_p(source.spark, source, CONFIG.ref_date, out, CONFIG))
    return source.spark.table(name)


def _job_r(source: ReportSource) -> DataFrame:
    """What the job wrote for report R."""
    out = _out(source.spark)
    _must(run_report_r(source.spark, _both_balances(source), CONFIG.ref_date, out, IN_FILES))
    return read_report(source.spark, f"{out}/report_r", CONFIG.ref_date)


def _export(source: ReportSource) -> DataFrame:
    """Report P exported in presentation order and read back: each row with its place, from the
    files' order and the rows' within their file."""
    folder = f"{_out(source.spark)}/export"
    export_report(position.report_p(source, CONFIG), folder, PRESENTED)
    file = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("int")
    rows = source.spark.read.parquet(folder).withColumns({
        "file": file, "row": F.expr("_metadata.row_index"),
    })
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select(
        "file", F.coalesce(before, F.lit(0)).alias("before")
    )
    return rows.join(sizes, "file").withColumn("place", F.col("before") + F.col("row") + 1)


def _audit(source: ReportSource) -> DataFrame:
    out = _out(source.spark)
    spark, when = source.spark, datetime(2000, 9, 29)
    _must(run_report_r(spark, _both_balances(source), CONFIG.ref_date, out, IN_FILES, lambda: when))
    append_audit(spark, f"{out}/etl_log", audit_record("check", "report_r", 0, "appended", when))
    log = read_audit(spark, f"{out}/report_r", f"{out}/etl_log")
    return log.withColumn("n_written", F.lit(read_report(spark, f"{out}/report_r").count()))


check(
    "report_p_roundtrip", P_COLUMNS, "report_p",
    lambda s: read_report(s.spark, f"{_job_p(s)}/report_p", CONFIG.ref_date),
)
check(
    "report_view", P_COLUMNS, "report_p",
    _rerun_view,
)
check("report_r_roundtrip", R_COLUMNS, "report_r", _job_r)
# The presentation order; text columns that tell rows of one year apart come last.
PRESENTED = words("entityid cdi afm fiscalyear")
check(
    "report_p_export", ("place", *PRESENTED),
    "SELECT row_number() OVER (ORDER BY entityid NULLS FIRST, cdi NULLS FIRST, afm NULLS FIRST, "
    "fiscalyear NULLS FIRST) AS place, * FROM report_p",
    _export,
)
check(
    "job_steps", words("step n_rows"),
    " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS n_rows FROM {table}"
        for step, table in {
            "eligible_old": "elig_old", "eligible_new": "elig_new", "final": "final_p",
            "perimeter": "perim_p", "statements": "found_p", "report": "report_p",
        }.items()
    ),
    lambda s: read_steps(s.spark, f"{_job_p(s)}/report_p").where("step <> 'candidates'"),
)
LOGGED = words("t_ JobId ETLFunction SourceTableCount TargetTableName TargetTableCount LogMessage SchemaName")
check(
    "audit_log", (*LOGGED, "n_written"),
    "SELECT 'reports.etl_log' AS t_, 'populate_report200009290000' AS JobId, f AS ETLFunction, "
    "CAST(0 AS BIGINT) AS SourceTableCount, 'report_r' AS TargetTableName, "
    "CASE f WHEN 'check' THEN 0 ELSE n END AS TargetTableCount, m AS LogMessage, "
    "'reports' AS SchemaName, n AS n_written FROM (SELECT count(*) AS n FROM report_r), "
    "(VALUES ('check', 'appended'), ('run_report_r', 'report_r has been populated')) AS v(f, m)",
    _audit,
)

# -- revisions and variants --------------------------------------------------

PINNED_ONE = replace(CONFIG, pinned_models=("FA_FIN",))
OLD_ENTITIES = replace(CONFIG, nonfin_entity_gen=OLD)
LAG_YEAR = replace(CONFIG, lag_order="year")
for name, cfg in {
    "rev_p_no_portfolio": NO_PORTFOLIO, "rev_p_pinned_models": PINNED_ONE,
}.items():
    check(name, P_COLUMNS, "report_p", lambda s, c=cfg: position.report_p(s, c), cfg)
check(
    "rev_p_nonfin_entity_gen", P_COLUMNS, "p_nonfin",
    lambda s: position.report_p_nonfin(s, OLD_ENTITIES), OLD_ENTITIES,
)
for name, cfg in {"rev_r_no_portfolio": NO_PORTFOLIO, "rev_r_lag_order": LAG_YEAR}.items():
    check(name, R_COLUMNS, "report_r", lambda s, c=cfg: _report_r(s, c), cfg)

check("var_strict_asof", P_COLUMNS, "strict_years", lambda s: variants.strict_asof(s, CONFIG))
check(
    "var_rank_per_version", (*GRADED, "graded"), "ranked_versions",
    lambda s: variants.rank_per_version(s, CONFIG),
)
check(
    "var_balance_pinned", MACRO, "balance_pinned",
    lambda s: variants.balance_pinned(s, CONFIG, scope(s)),
)
check(
    "var_reviewed_only", MACRO, "reviewed_only", lambda s: variants.reviewed_only(s, CONFIG)
)
check(
    "var_prior_year_seed", (*CAPITAL_CHANGE, "seed_flag"), "seeded_change",
    lambda s: variants.prior_year_seed(s, CONFIG, scope(s)),
)
