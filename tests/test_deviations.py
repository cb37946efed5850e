"""Cases that once went wrong on both sides of the comparison, and rows that must differ."""

from dataclasses import replace
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from gradeledger.config import ACCOUNT_GROUPS, NEW, OLD, ROUNDING_FACTORS
from gradeledger.checks.derived import CONFIG, DerivedSource
from gradeledger.operators import account_group_for, account_groups, long_groups
from gradeledger.plans import matched, position, risk, variants
from helpers import CFG, MemorySource, balance, entity, rating, statement

SF = "/root/testdata/sf0.001"


def test_repeated_scale_keys_give_one_row_per_entity(spark):
    source = MemorySource(
        spark, rating_new=[rating(True, 7, "2023-03-04")], entity_new=[entity(True, 7)],
        entityrating_new=[{"approveid": 1, "finalgrade": 5}],
        ratingscale=[{"ratingscalekey_": 5, "ratingscalevalue": v} for v in ("A", "B", None)],
    )
    rows = matched.final_rating_p(source, CFG).collect()
    assert [r.ratingscalevalue for r in rows] == ["B"]


def test_owner_without_tax_id_gets_no_seed(spark):
    def world(gc18):
        return MemorySource(
            spark, rating_new=[rating(True, 7, "2023-03-04")],
            entity_new=[entity(True, 7, gc18=gc18)],
            statement_new=[
                statement(True, 7, 1, 2021, "2022-05-01", commonsharecapital=5, sharepremium=1),
                statement(True, 7, 9, 2020, "2021-05-01", commonsharecapital=3, sharepremium=1),
            ],
        )

    def seeds(gc18):
        source = world(gc18)
        rows = variants.prior_year_seed(source, CFG, risk.perimeter_r(source, CFG)).collect()
        return [r.seed_flag for r in rows].count("exclude_from_rating")

    assert seeds("123456789") == 1 and seeds(None) == 0


def test_equal_old_balances_are_shown_once(spark):
    twice = [balance(False, 7, 1, 1520, 10), balance(False, 7, 1, 1520, 10)]
    source = MemorySource(
        spark, rating_old=[rating(False, 7, "2023-03-04")], entity_old=[entity(False, 7)],
        balance_old=twice,
    )
    scope = risk.perimeter_r(source, CFG)
    assert scope.count() > 0
    assert risk.macros_old(source, CFG, scope).count() == 1
    assert risk.old_in_scope(source, CFG, scope).count() == 2


def test_groups_follow_their_parameters(spark):
    rows = [("new", 7, 1, 1, 10, 0, 2), ("new", 7, 1, 1, 11, 0, 5), ("new", 8, 1, 1, 10, 1, 9)]
    balances = spark.createDataFrame(
        rows, "generation string, entityid int, statementid int, financialid int, accountid int, "
        "originrounding int, originbalance int",
    )
    own = {"stock": (10, -11), "peak": (10, 11)}
    asked = {"groups": own, "rounding_map": {0: 1, 1: 10}, "largest": ("peak",)}
    assert [int(r.stock) for r in account_group_for(balances, "stock", entityid=7, **asked).collect()] == [-3]
    assert [int(r.peak) for r in account_group_for(balances, "peak", entityid=8, **asked).collect()] == [90]
    wide = account_groups(balances, own, {0: 1, 1: 10}, largest=("peak",)).orderBy("entityid").collect()
    assert [(int(r.stock), int(r.peak)) for r in wide] == [(-3, 5), (90, 90)]
    long = long_groups(balances, **asked).collect()
    assert sorted((r.entityid, r.account_group, int(r.amount)) for r in long) == [
        (7, "peak", 5), (7, "stock", -3), (8, "peak", 90), (8, "stock", 90),
    ]


def test_lookup_reads_one_pass(spark):
    source = DerivedSource(spark, SF)
    plan = long_groups(risk.macros_all(source, CONFIG, risk.perimeter_r(source, CONFIG)))
    one = risk.groups_in_scope(source, CONFIG, risk.perimeter_r(source, CONFIG))
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert count(plan) <= count(one)


def test_revisions_differ_from_the_default(spark):
    source = DerivedSource(spark, SF)
    base_p, base_r = (set(map(str, f(source, CONFIG).collect())) for f in (position.report_p, risk.report_r))
    default, old = (
        set(map(str, position.report_p_nonfin(source, c).collect()))
        for c in (CONFIG, replace(CONFIG, nonfin_entity_gen=OLD))
    )
    assert default != old
    for change in ({"portfolio": None}, {"pinned_models": ("FA_FIN",)}):
        other = set(map(str, position.report_p(source, replace(CONFIG, **change)).collect()))
        assert other - base_p or base_p - other, change
    for change in ({"portfolio": None}, {"lag_order": "year"}):
        other = set(map(str, risk.report_r(source, replace(CONFIG, **change)).collect()))
        assert other != base_r, change


def test_both_sides_of_the_difference_have_rows(spark):
    from gradeledger.checks.registry import CHECKS

    sides = {r.side for r in CHECKS["report_diff"].run(spark, SF).select("side").distinct().collect()}
    assert sides == {"a", "b"}


def test_fixed_values():
    """Written out by hand, so that a changed constant can't pass on both sides."""
    assert ROUNDING_FACTORS == {0: 1, 1: 1000, 2: 100000}
    assert dict(ACCOUNT_GROUPS) == {
        "inventories": (1520, 1521, 1522, 1523),
        "net_receivables": (1640, 1641, 1642, 1643, 1646, -1650),
        "trade_payables": (2680, 2685, 2686, 2687),
        "total_debt": (2100, 2110, 2115, 2120, 2130, 2150, 2400, 2410, 2415, 2420, 2430, 2440, 2450, 2460, 2470),
        "short_debt": (2400, 2410, 2415, 2420, 2430, 2440, 2450, 2460, 2470),
        "long_debt": (2100, 2110, 2115, 2120, 2130, 2150),
        "dividends": (5950, 5960),
        "interest": (3400,),
        "goodwill": (1100,),
    }
    assert len(risk.REPORT_R_COLUMNS) == 44 and len(position.REPORT_P_COLUMNS) == 12
    assert CFG.largest == ("goodwill",) and NEW == "new"


def test_every_metric_reaches_its_column(spark):
    """A statement in which each metric and account has a value of its own."""
    shown = {
        "cashandequivalents": "csh", "ebitda": "ebitda", "totequityreserves": "eqty", "netprofit": "nt_incm",
        "salesrevenues": "sales_revenue", "netfixedassets": "netfixedassets", "totalassets": "totalassets",
        "commonsharecapital": "commonsharecapital", "totalliabilities": "totalliabilities",
        "grossprofit": "grossprofit", "ebit": "ebit", "profitbeforetax": "profitbeforetax",
        "workingcapital": "workingcapital", "dcfcffrmoperact": "flowsoperationalactivity",
        "dcfcffrominvestact": "flowsinvestmentactivity", "dcfcffromfinact": "flowsfinancingactivity",
        "grossprofitmargin": "grossprofitmargin", "netprofitmargin": "netprofitmargin",
        "ebitdamargin": "ebitdamargin", "debttoequity": "totalliabilitiestototalequity",
        "returnonassets": "returnonassets", "returnontoteqres": "returnonequity",
        "currentratio": "currentratio", "quickratio": "quickratio",
    }
    values = {m: Decimal(100 + i) for i, m in enumerate(sorted(shown))}
    accounts = {
        1100: "1", 1520: "2", 1523: "4", 1640: "8", 1650: "3", 2680: "16", 2110: "32", 2410: "64",
        5950: "128", 5960: "256", 3400: "512",
    }
    source = MemorySource(
        spark, rating_new=[rating(True, 7, "2023-03-04")], entity_new=[entity(True, 7)],
        statement_new=[statement(True, 7, 1, 2021, "2022-05-01", **values)],
        balance_new=[balance(True, 7, 1, code, amount) for code, amount in accounts.items()],
    )
    (row,) = risk.report_r(source, CFG).collect()
    assert {out: row[out] for out in shown.values()} == {out: values[m] for m, out in shown.items()}
    assert {c: int(row[c]) for c in (
        "gdwill", "inventory", "nettradereceivables", "tradepayable", "totalbankingdebt",
        "shorttermbankingdebt", "longtermbankingdebt", "balancedividendspayable",
    )} == {
        "gdwill": 1, "inventory": 6, "nettradereceivables": 5, "tradepayable": 16, "totalbankingdebt": 96,
        "shorttermbankingdebt": 64, "longtermbankingdebt": 32, "balancedividendspayable": 384,
    }
    ebitda, cash = values["ebitda"], values["cashandequivalents"]
    cents = Decimal("0.01")
    assert row.totalbankingdebttoebitda == (96 / ebitda).quantize(cents, ROUND_HALF_UP)
    assert row.netbankingdebttoebitda == ((96 - cash) / ebitda).quantize(cents, ROUND_HALF_UP)
    assert row.interestcoverage == (ebitda / 512).quantize(cents, ROUND_HALF_UP)


def test_ratings_without_approval_stay_out_of_the_grade_join(spark):
    from gradeledger.operators import attach_grade

    df = spark.createDataFrame([(1, "a"), (None, "b"), (9, "c")], "approveid int, x string")
    grades = spark.createDataFrame([(1, 5)], "approveid int, finalgrade int")
    scale = spark.createDataFrame([(5, "AA")], "ratingscalekey_ int, ratingscalevalue string")
    rows = {r.x: (r.ratingscalevalue, r.graded) for r in attach_grade(df, grades, scale).collect()}
    assert rows == {"a": ("AA", "true"), "b": (None, "false"), "c": (None, "false")}
    assert df.where(F.col("approveid").isNull()).count() == 1
