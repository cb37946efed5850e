"""Report traps, one hand-written case each."""

from dataclasses import replace
from decimal import Decimal

import pytest

from gradeledger.plans.position import report_p, report_p_nonfin, report_p_years
from gradeledger.plans.risk import (
    REPORT_R_COLUMNS,
    report_r,
    share_capital_change,
    statements_in_scope,
)
from gradeledger.plans.risk import perimeter_r as scope_r
from helpers import CFG, MemorySource, at, balance, entity, metrics_of, rating, statement

D = Decimal


def new_world(spark, ratings, statements=None, **tables):
    """New-generation tables around entity 7."""
    stated = statements or [statement(True, 7, 1, 2021, "2022-05-01")]
    return MemorySource(
        spark, rating_new=ratings, statement_new=stated,
        **({"entity_new": [entity(True, 7)]} | tables),
    )


def old_world(spark, ratings, statements=None, metrics=None, **tables):
    stated = statements or [statement(False, 7, 1, 2021, "2022-05-01")]
    return MemorySource(
        spark, rating_old=ratings, statement_old=stated,
        statement_metrics_old=metrics or [metrics_of(s) for s in stated],
        **({"entity_old": [entity(False, 7)]} | tables),
    )


def test_report_p_row(spark):
    source = new_world(
        spark, [rating(True, 7, "2023-03-04 05:06:07.5")],
        entityrating_new=[{"approveid": 1, "finalgrade": 4}],
        ratingscale=[{"ratingscalekey_": 4, "ratingscalevalue": "BB"}],
    )
    assert [tuple(r) for r in report_p(source, CFG).collect()] == [(
        "c7", "123456789", "BB", "2023-03-04 05:06:07.5+00", "02-01-2024", "FA_FIN", "2021",
        "1.00", "1.00", "7", "true", "02-01-2023",
    )]


def test_old_wins_a_tie(spark):
    stated = [statement(False, 7, 1, 2021, "2022-05-01")]
    source = MemorySource(
        spark, rating_new=[rating(True, 7, "2023-03-04", pkid_=9, nextreviewdate=None)],
        rating_old=[rating(False, 7, "2023-03-04", pkid_=1)],
        entity_new=[entity(True, 7)], entity_old=[entity(False, 7, cdicode="old")],
        statement_new=[statement(True, 7, 1, 2021, "2022-05-01")], statement_old=stated,
        statement_metrics_old=[metrics_of(s) for s in stated],
    )
    assert [r.cdi for r in report_p(source, CFG).collect()] == ["old"]
    assert [r.cdi for r in report_r(source, CFG).collect()] == ["old"]


def test_later_other_model_suppresses_in_p_not_in_r(spark):
    source = new_world(spark, [
        rating(True, 7, "2023-03-04"),
        rating(True, 7, "2023-04-04", pkid_=2, modelid="OTHER"),
    ])
    assert report_p(source, CFG).count() == 0
    assert report_p_nonfin(source, CFG).count() == 1
    assert report_r(source, CFG).count() == 1


def test_model_without_id_is_dropped(spark):
    source = new_world(spark, [
        rating(True, 7, "2023-03-04"), rating(True, 7, "2023-04-04", pkid_=2, modelid=None),
    ])
    assert report_p(source, CFG).count() == 1


def test_unapproved_last_old_rating_removes_the_entity(spark):
    source = old_world(spark, [
        rating(False, 7, "2023-03-04"),
        rating(False, 7, "2023-04-04", pkid_=2, approvalstatus="1"),
    ])
    assert report_p(source, CFG).count() == 0
    assert report_r(source, CFG).count() == 0


def test_unapproved_last_new_rating_falls_back(spark):
    source = new_world(spark, [
        rating(True, 7, "2023-03-04"),
        rating(True, 7, "2023-04-04", pkid_=2, approvalstatus="1"),
    ])
    assert report_p(source, CFG).count() == 1


def test_newer_entity_version_beats_newer_rating_in_p_only(spark):
    source = new_world(
        spark,
        [rating(True, 7, "2023-03-04", entity_version_match="2"),
         rating(True, 7, "2023-04-04", pkid_=2, entity_version_match="1")],
        entity_new=[entity(True, 7, "2021-02-01"),
                    entity(True, 7, "2022-02-01", versionid_=2, cdicode="second")],
    )
    assert [r.cdi for r in report_p(source, CFG).collect()] == ["second"]
    assert [r.cdi for r in report_r(source, CFG).collect()] == ["c7"]


@pytest.mark.parametrize(
    ("time", "rows"), [("2023-09-29 23:59:59", 1), ("2023-09-29 23:59:59.5", 0),
                       ("2021-01-06 00:00:00", 1), ("2021-01-05 23:59:59", 0)]
)
def test_window_of_the_reference_date(spark, time, rows):
    early = {"entity_new": [entity(True, 7, "2020-02-01")]}
    assert report_p(new_world(spark, [rating(True, 7, time)], **early), CFG).count() == rows


def test_old_ratings_are_bounded_by_arrival(spark):
    late = [rating(False, 7, "2023-03-04", sourcepopulateddate_=at("2023-09-30"))]
    assert report_p(old_world(spark, late), CFG).count() == 0


def test_same_year_text_and_number_order(spark):
    scope = rating(True, 7, "2023-03-04", financialcontext="7:1;1#9:1;10:1;1234567")
    source = new_world(spark, [scope], [
        statement(True, 7, 9, 2021, "2022-05-01", salesrevenues=D("9.00")),
        statement(True, 7, 10, 2021, "2022-05-01", salesrevenues=D("10.00")),
    ])
    assert [r.salesrevenues for r in report_p(source, CFG).collect()] == ["9.00"]
    assert [r.sales_revenue for r in report_r(source, CFG).collect()] == [D("10.00")]


def test_latest_year_is_kept(spark):
    source = new_world(spark, [rating(True, 7, "2023-03-04")], [
        statement(True, 7, i, 2018 + i, "2022-05-01") for i in (1, 2, 3)
    ])
    assert [r.fiscalyear for r in report_p(source, CFG).collect()] == ["2021"]
    assert report_p_years(source, CFG).count() == 3


def test_portfolio(spark):
    other = {"entity_new": [entity(True, 7, creditportfolio="OTHER")]}
    source = new_world(spark, [rating(True, 7, "2023-03-04")], **other)
    assert report_p(source, CFG).count() == 0
    assert report_p(source, replace(CFG, portfolio=None)).count() == 1


def test_pinned_models_revision(spark):
    source = new_world(spark, [rating(True, 7, "2023-03-04", modelid="PdModelCcategory")])
    assert report_p(source, CFG).count() == 1
    assert report_p(source, replace(CFG, pinned_models=("FA_FIN",))).count() == 0


def test_nonfin_entity_generation_revision(spark):
    source = new_world(
        spark, [rating(True, 7, "2023-03-04", modelid="OTHER")],
        entity_old=[entity(False, 7, cdicode="from_old")],
    )
    assert [r.cdi for r in report_p_nonfin(source, CFG).collect()] == ["c7"]
    cfg = replace(CFG, nonfin_entity_gen="old")
    assert [r.cdi for r in report_p_nonfin(source, cfg).collect()] == ["from_old"]


def test_old_header_without_metrics_is_not_chosen(spark):
    first, second = (
        statement(False, 7, 1, 2021, day, versionid_=v)
        for day, v in (("2022-05-01", 1), ("2022-06-01", 2))
    )
    source = old_world(
        spark, [rating(False, 7, "2023-03-04")], [first, second],
        [metrics_of(first, salesrevenues=D("3.00"))],
    )
    assert [r.salesrevenues for r in report_p(source, CFG).collect()] == ["3.00"]


def metrics_of_r(spark, booked=(), **metrics):
    stated = [statement(True, 7, 1, 2021, "2022-05-01", **metrics)]
    source = new_world(
        spark, [rating(True, 7, "2023-03-04")], stated,
        balance_new=[balance(True, 7, 1, a, v) for a, v in booked],
    )
    df = report_r(source, CFG)
    assert tuple(df.columns) == REPORT_R_COLUMNS
    assert {t for _, t in df.dtypes[2:38]} == {"decimal(19,2)"}
    return df.first()


def test_no_debt_rows(spark):
    row = metrics_of_r(spark, ebitda=D("10.00"), cashandequivalents=D("4.00"))
    assert row.totalbankingdebttoebitda is None
    assert row.netbankingdebttoebitda == D("-0.40")
    assert row.totalbankingdebt == D("0.00")
    assert row.interestcoverage == D("0.00")
    assert row.chgcommonsharecapital_chgsharepremium is None


def test_zero_and_null_ebitda(spark):
    row = metrics_of_r(spark, [(2100, "5.00"), (3400, "2.00")], ebitda=D("0.00"))
    assert row.totalbankingdebttoebitda == row.netbankingdebttoebitda == D("0.00")
    row = metrics_of_r(spark, [(2100, "5.00"), (3400, "2.00")], ebitda=None)
    assert row.totalbankingdebttoebitda is None and row.netbankingdebttoebitda is None
    assert row.ebitda == D("0.00") and row.interestcoverage is None


def test_null_cash_and_profit_stay_null(spark):
    row = metrics_of_r(spark, [(2100, "5.00")], cashandequivalents=None, profitbeforetax=None,
                       ebitda=D("2.00"))
    assert row.csh == D("0.00") and row.profitbeforetax is None
    assert row.netbankingdebttoebitda is None and row.totalbankingdebttoebitda == D("2.50")


def test_debt_parts_add_up(spark):
    row = metrics_of_r(spark, [(2100, "5.00"), (2400, "7.00"), (1100, "3.00"), (9999, "8.00")])
    assert row.totalbankingdebt == row.shorttermbankingdebt + row.longtermbankingdebt == D("12.00")
    assert row.gdwill == D("3.00")
    assert (row.publish_date, row.reference_date, row.entityid) == ("20211231", "20230929", "7|1")


def test_latest_new_balance_per_account(spark):
    source = new_world(
        spark, [rating(True, 7, "2023-03-04")],
        balance_new=[
            balance(True, 7, 1, 1520, "5.00", sourcepopulateddate_=at("2023-01-01")),
            balance(True, 7, 1, 1520, "6.00", sourcepopulateddate_=at("2023-08-01")),
            balance(True, 7, 1, 1521, "1.00", sourcepopulateddate_=at("2020-01-01")),
        ],
    )
    assert report_r(source, CFG).first().inventory == D("7.00")


def test_every_old_balance_version_counts(spark):
    source = old_world(
        spark, [rating(False, 7, "2023-03-04")],
        balance_old=[balance(False, 7, 1, 1520, v) for v in ("5.00", "5.00", "6.00")],
    )
    assert report_r(source, CFG).first().inventory == D("11.00")


def test_half_year_statement_counts_for_the_change_only(spark):
    amounts = [("2.00", 12), ("5.00", 6), ("9.00", 12)]
    stated = [
        statement(True, 7, i, 2018 + i, "2022-05-01", statementmonths=m,
                  commonsharecapital=D(v), sharepremium=D("1.00"))
        for i, (v, m) in enumerate(amounts, start=1)
    ]
    source = new_world(spark, [rating(True, 7, "2023-03-04")], stated)
    got = {r.fnc_year: r.chgcommonsharecapital_chgsharepremium
           for r in report_r(source, CFG).collect()}
    assert got == {"2019": None, "2021": D("4.00")}


def test_lag_order_revision(spark):
    stated = [
        statement(True, 7, 1, 2021, "2022-05-01", statementdatekey_=20201231,
                  commonsharecapital=D("1.00")),
        statement(True, 7, 2, 2020, "2022-05-01", statementdatekey_=20211231,
                  commonsharecapital=D("5.00")),
    ]
    source = new_world(spark, [rating(True, 7, "2023-03-04")], stated)
    found = statements_in_scope(source, CFG, scope_r(source, CFG))

    def changes(cfg):
        return {r.statementid: r.chg_commonsharecapital
                for r in share_capital_change(found, cfg).collect()}

    assert changes(CFG) == {1: None, 2: D("4.00")}
    assert changes(replace(CFG, lag_order="year")) == {1: D("-4.00"), 2: None}


def test_report_r_ignores_short_contexts(spark):
    source = new_world(spark, [rating(True, 7, "2023-03-04", financialcontext="7:1;1#1:1")])
    assert report_p(source, CFG).count() == 1
    assert report_r(source, CFG).count() == 0


def test_bad_parameters():
    for wrong in ({"lag_order": "x"}, {"sharing": "x"}, {"nonfin_entity_gen": "x"}):
        with pytest.raises(ValueError, match="must be|unknown"):
            replace(CFG, **wrong)
