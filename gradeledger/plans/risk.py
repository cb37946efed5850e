"""Report R: the risk-metrics report, one row per entity and full fiscal year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeledger.config import GENERATIONS, NEW, OLD, ReportConfig
from gradeledger.functions.scalars import (
    compact_date,
    date_of_key,
    day_month_year,
    end_of,
    entity_version_key,
    guarded_ratio,
    money,
    money_or_zero,
    start_of,
    zero,
    zoned_text,
)
from gradeledger.operators.accounts import scaled_balances, sum_groups
from gradeledger.operators.dedup import distinct_on
from gradeledger.operators.funnel import Mark, unmarked
from gradeledger.operators.matching import in_scope
from gradeledger.operators.reuse import Keep, Keeper
from gradeledger.operators.sieve import Sieve
from gradeledger.operators.skew import merge_join
from gradeledger.operators.statements import change_vs_previous, choose_statement_version
from gradeledger.plans.matched import (
    STATEMENT_TIES,
    final_rating_r,
    perimeter,
    perimeter_statements,
    scope_sieve,
    statements_near,
    union_all,
)
from gradeledger.sources.tables import METRICS, ReportSource

SCOPE_KEYS = ("generation", "entityid", "statementid", "financialid")
# What is read of a perimeter: of the rating, beside the statement's keys.
SCOPE_COLUMNS = (
    *SCOPE_KEYS, "versionid_", "cdicode", "afm", "approveddate", "approvalstatus",
    "creditcommitteedate", "sourcepopulateddate_rating",
)
# A statement's header as stored, and the names that chosen statements have for it.
HEADER = (
    "pkid_", "versionid_", "entityid", "financialid", "statementid", "statementyear",
    "statementmonths", "statementdatekey_", "sourcepopulateddate_",
)
HEADER_AS = {
    "versionid_": "versionid_financial", "sourcepopulateddate_": "sourcepopulateddate_financial",
}

# Output name to statement metric, for metrics shown as zero when missing.
SHOWN = {
    "csh": "cashandequivalents", "ebitda": "ebitda", "eqty": "totequityreserves",
    "nt_incm": "netprofit", "sales_revenue": "salesrevenues",
    "netfixedassets": "netfixedassets", "totalassets": "totalassets",
    "commonsharecapital": "commonsharecapital", "totalliabilities": "totalliabilities",
    "grossprofit": "grossprofit", "ebit": "ebit", "workingcapital": "workingcapital",
    "flowsoperationalactivity": "dcfcffrmoperact",
    "flowsinvestmentactivity": "dcfcffrominvestact",
    "flowsfinancingactivity": "dcfcffromfinact", "grossprofitmargin": "grossprofitmargin",
    "netprofitmargin": "netprofitmargin", "ebitdamargin": "ebitdamargin",
    "totalliabilitiestototalequity": "debttoequity", "returnonassets": "returnonassets",
    "returnonequity": "returnontoteqres", "currentratio": "currentratio",
    "quickratio": "quickratio",
}
# Output name to account group, shown as zero when missing.
SHOWN_GROUPS = {
    "gdwill": "goodwill", "inventory": "inventories", "nettradereceivables": "net_receivables",
    "tradepayable": "trade_payables", "totalbankingdebt": "total_debt",
    "shorttermbankingdebt": "short_debt", "longtermbankingdebt": "long_debt",
    "balancedividendspayable": "dividends",
}

REPORT_R_COLUMNS = (
    "cdi", "afm", "csh", "ebitda", "eqty", "gdwill", "nt_incm", "sales_revenue",
    "netfixedassets", "inventory", "nettradereceivables", "totalassets", "commonsharecapital",
    "tradepayable", "totalbankingdebt", "shorttermbankingdebt", "longtermbankingdebt",
    "totalliabilities", "grossprofit", "ebit", "profitbeforetax", "workingcapital",
    "flowsoperationalactivity", "flowsinvestmentactivity", "flowsfinancingactivity",
    "chgcommonsharecapital_chgsharepremium", "balancedividendspayable", "grossprofitmargin",
    "netprofitmargin", "ebitdamargin", "totalbankingdebttoebitda", "netbankingdebttoebitda",
    "totalliabilitiestototalequity", "returnonassets", "returnonequity", "interestcoverage",
    "currentratio", "quickratio", "fnc_year", "creditcommitteedate", "publish_date",
    "approveddate", "reference_date", "entityid",
)

# Among statements of one year: newest version, then the largest id *as a number*.
YEAR_ORDER_R = (
    "-sourcepopulateddate_financial", "-statementid", "-versionid_financial", "-pkid_",
)
CAPITAL = ("commonsharecapital", "sharepremium")
# What a balance is worth, and where its rows go when a statement is split.
AMOUNT = ("accountid", "originrounding", "originbalance")
LATEST_BALANCE = ("-sourcepopulateddate_", "-versionid_", "-originbalance", "-originrounding")


def perimeter_r(source: ReportSource, cfg: ReportConfig, mark: Mark = unmarked) -> DataFrame:
    """The statements in scope of report R's final ratings."""
    return mark("perimeter", perimeter(final_rating_r(source, cfg, mark), cfg))


def _approved_in_window(df: DataFrame, cfg: ReportConfig):
    """Old ratings are bounded by approval time only when their data is read."""
    return df.where(
        (F.col("generation") != OLD)
        | (
            (F.col("approveddate") >= start_of(cfg.go_live))
            & (F.col("approveddate") <= end_of(cfg.ref_date))
        )
    )


def _scope_of(scope: DataFrame, generation: str, *columns: str) -> DataFrame:
    return scope.where(F.col("generation") == generation).select(*SCOPE_KEYS, *columns)


def _balances_near(
    source: ReportSource, cfg: ReportConfig, scope: DataFrame, generation: str
) -> DataFrame:
    """Balances of the wanted accounts, most of those out of scope left out before they are
    shuffled. Tables that are joined where they lie are not shuffled."""
    sieve = None if cfg.splits == 1 else scope_sieve(scope)
    return statements_near(source.load_balances(generation, cfg.account_codes), generation, sieve)


def macros_new(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """New balances in scope, the latest per account."""
    found = in_scope(
        _balances_near(source, cfg, scope, NEW), _scope_of(scope, NEW),
        ["financialid", "statementid"], cfg.splits, AMOUNT,
    )
    return distinct_on(
        found,
        ["entityid", "financialid", "statementid", "accountid"],
        LATEST_BALANCE,
    )


def macros_old(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """Old balances in scope, every version, equal rows once."""
    return old_in_scope(source, cfg, scope).distinct()


def old_in_scope(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """As ``macros_old``, equal rows repeated: for groupings that drop repeats themselves."""
    return in_scope(
        _balances_near(source, cfg, scope, OLD),
        _scope_of(_approved_in_window(scope, cfg), OLD),
        ["financialid", "statementid"], cfg.splits, AMOUNT,
    )


def macros_all(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    cols = [*SCOPE_KEYS, "accountid", "versionid_", "sourcepopulateddate_",
            "originrounding", "originbalance"]
    return union_all(
        [m(source, cfg, scope).select(*cols) for m in (old_in_scope, macros_new)]
    )


def groups_in_scope(source: ReportSource, cfg: ReportConfig, scope: DataFrame) -> DataFrame:
    """The account groups of every statement in scope. New balances are one per
    account already; only old ones need the distinct of ``account_groups``."""
    old = scaled_balances(old_in_scope(source, cfg, scope), cfg.rounding_map).distinct()
    new = scaled_balances(macros_new(source, cfg, scope), cfg.rounding_map)
    return sum_groups(old.unionByName(new), cfg.accounts, largest=cfg.largest)


def statements_in_scope(
    source: ReportSource, cfg: ReportConfig, scope: DataFrame, columns=METRICS
) -> DataFrame:
    """Every version of the statements in scope, with the wanted metrics."""
    sieve = scope_sieve(scope)
    return union_all([
        perimeter_statements(scope, source, cfg, g, list(columns), sieve).select(
            "pkid_", *SCOPE_KEYS, "cdicode", "afm", "versionid_rating", "statementyear",
            "statementmonths", "statementdatekey_", "creditcommitteedate", "approveddate",
            "versionid_financial", "sourcepopulateddate_financial", "sourcepopulateddate_rating",
            *columns,
        )
        for g in GENERATIONS
    ])


def share_capital_base(found: DataFrame) -> DataFrame:
    """Latest version of each statement in scope, whatever its length or time."""
    return distinct_on(
        found.select(
            "pkid_", *SCOPE_KEYS, "cdicode", "afm", "statementyear", "statementmonths",
            "statementdatekey_", "versionid_financial", "sourcepopulateddate_financial",
            "approveddate", *CAPITAL,
        ),
        ["generation", "pkid_"],
        ["-sourcepopulateddate_financial", *STATEMENT_TIES],
    )


def capital_change(base: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Change of share capital and premium against the statement before."""
    when = "statementdatekey_" if cfg.lag_order == "date" else "statementyear"
    return change_vs_previous(
        base, ["entityid", "cdicode", "afm", "financialid"], [when, "statementid", "pkid_"],
        CAPITAL,
    )


def share_capital_change(found: DataFrame, cfg: ReportConfig) -> DataFrame:
    return capital_change(share_capital_base(found), cfg)


def report_r_years(found: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One full-year statement per entity and fiscal year, with all its metrics."""
    found = _approved_in_window(found, cfg).where(
        F.col("statementmonths") == cfg.statement_months
    )
    chosen = choose_statement_version(
        found, ["generation", "pkid_"], "sourcepopulateddate_financial",
        "sourcepopulateddate_rating", STATEMENT_TIES,
    )
    return distinct_on(
        chosen, ["entityid", "versionid_rating", "cdicode", "afm", "statementyear"], YEAR_ORDER_R
    )


def report_r_metrics(
    source: ReportSource, cfg: ReportConfig, keep: Keep | None = None, mark: Mark = unmarked
) -> DataFrame:
    """The 44 columns. Statements are chosen by their headers; the account groups, made in
    one pass, the share-capital change and the metrics then join to the chosen rows only.

    Results are kept where two or more branches read them, and so that each step can let go of
    what the ones before needed.
    """
    keep = keep or Keeper("none")
    scope = keep(perimeter_r(source, cfg, mark).select(*SCOPE_COLUMNS))
    found = keep(mark("statements", statements_in_scope(source, cfg, scope, CAPITAL)))
    groups = keep(groups_in_scope(source, cfg, scope))
    return mark("report", assemble(source, found, groups, cfg, keep))


def metrics_of(source: ReportSource, chosen: DataFrame) -> DataFrame:
    """The metrics of chosen statement versions, by ``_row`` (see ``row_of``), which each has once.

    Of rows that have one header the first by their metrics counts.
    """
    own = {c: F.col(c) for c in HEADER}
    known = dict.fromkeys(HEADER, F.lit(None)) | {c: own[c] for c in HEADER[:2]}
    kind = row_type(chosen)

    def rows(df: DataFrame, generation: str, columns: dict) -> DataFrame:
        fields = [F.lit(generation).alias("generation"), *[v.alias(c) for c, v in columns.items()]]
        return df.select(F.struct(*fields).cast(kind).alias("_row"), *METRICS)

    every = rows(source.load_statements_new(), NEW, own).unionByName(
        rows(source.load_statement_metrics_old(), OLD, known)
    )
    wanted = Sieve(chosen.select(row_of().cast(kind).alias("_row")))
    return distinct_on(wanted.cut(every, ["_row"]), ["_row"], METRICS)


def row_of() -> Column:
    """What tells a statement's metrics row from others: all of its header in the new generation,
    where it has both; its id and version in the old one. As a struct, in which NULLs are equal."""
    new = F.col("generation") == NEW
    header = {c: F.col(HEADER_AS.get(c, c)) for c in HEADER}
    return F.struct(
        "generation",
        *[(v if c in HEADER[:2] else F.when(new, v)).alias(c) for c, v in header.items()],
    )


def row_type(chosen: DataFrame) -> str:
    """The type of ``row_of``, which both sides of a join are cast to: they may differ in what
    can be NULL, and a cast that Spark adds to one side would cost another shuffle."""
    return chosen.select(row_of().alias("row")).dtypes[0][1]


def assemble(
    source: ReportSource, found: DataFrame, groups: DataFrame, cfg: ReportConfig,
    keep: Keep | None = None,
) -> DataFrame:
    """Chosen statements, account groups, share-capital change and metrics to report columns."""
    keep = keep or Keeper("none")
    years = keep(report_r_years(found, cfg).drop(*CAPITAL))
    change = distinct_on(
        share_capital_change(found, cfg), SCOPE_KEYS,
        ["-statementdatekey_", "-pkid_"],
    ).select(*SCOPE_KEYS, *[f"chg_{c}" for c in CAPITAL])
    narrow = years.join(groups, list(SCOPE_KEYS), "left").join(change, list(SCOPE_KEYS), "left")
    row = row_of().cast(row_type(years))
    wide = merge_join(narrow.withColumn("_row", row), metrics_of(source, years), ["_row"])

    debt, cash = money("total_debt"), money("cashandequivalents")
    made = {
        "cdi": F.col("cdicode"),
        "afm": F.col("afm"),
        **{name: money_or_zero(metric) for name, metric in SHOWN.items()},
        **{name: money_or_zero(group) for name, group in SHOWN_GROUPS.items()},
        "profitbeforetax": money("profitbeforetax"),
        "chgcommonsharecapital_chgsharepremium": money(
            money("chg_commonsharecapital") + money("chg_sharepremium")
        ),
        "totalbankingdebttoebitda": guarded_ratio(debt, "ebitda"),
        "netbankingdebttoebitda": guarded_ratio(F.coalesce(debt, zero()) - cash, "ebitda"),
        "interestcoverage": guarded_ratio("ebitda", "interest", null_as_zero=True),
        "fnc_year": F.col("statementyear").cast("string"),
        "creditcommitteedate": day_month_year("creditcommitteedate"),
        "publish_date": compact_date(date_of_key("statementdatekey_")),
        "approveddate": zoned_text("approveddate"),
        "reference_date": F.lit(cfg.ref_date.strftime("%Y%m%d")),
        "entityid": entity_version_key("entityid", "versionid_rating"),
    }
    return wide.select(*[made[name].alias(name) for name in REPORT_R_COLUMNS])


def report_r(
    source: ReportSource, cfg: ReportConfig, keep: Keep | None = None, mark: Mark = unmarked
) -> DataFrame:
    """Report R. Each entity comes from one generation, so the metrics rows are
    already unique on (entity, customer, tax id, year)."""
    return report_r_metrics(source, cfg, keep, mark)
