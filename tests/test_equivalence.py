"""The short plan of each report against its step form, on random data with a hot key."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gradeledger.config import NEW, OLD
from gradeledger.operators.ratings import FINAL_ORDER_P, FINAL_ORDER_R, final_rating
from gradeledger.plans import matched
from gradeledger.plans.matched import union_all
from helpers import CFG, MemorySource, at, entity, rating


def world(spark, seed):
    """One entity holds a third of all rows; times collide; records have versions."""
    rnd = random.Random(seed)

    def owner():
        return 0 if rnd.random() < 0.35 else rnd.randrange(1, 25)

    def day():
        return str(at("2021-01-01") + timedelta(days=rnd.randrange(0, 1000, 20)))

    ratings = {NEW: [], OLD: []}
    for i in range(700):
        g = rnd.choice((NEW, OLD))
        when, number, version = day(), owner(), rnd.randrange(1, 5)
        record = rnd.randrange(250)
        more = {
            "pkid_": record, "versionid_": i, "approveid": i,
            "approvalstatus": rnd.choice("22221"), "isdeleted_": rnd.random() < 0.1,
            "islatestapprovedscenario": rnd.random() < 0.8,
            "modelid": rnd.choice(("FA_FIN", "PdModelCcategory", "OTHER", "OTHER", None)),
            "financialcontext": f"{number}:1;{version}#1:1;2:1;3:1;4:1",
            "sourcepopulateddate_": at(when) + timedelta(days=rnd.choice((0, 0, 20))),
        }
        if rnd.random() < 0.1:
            more["approveddate"] = None
        if g == NEW:
            more["entity_version_match"] = str(version)
        ratings[g].append(rating(g == NEW, number, when, **more))

    def versions(new):
        return [
            entity(new, owner(), day(), versionid_=rnd.randrange(1, 5), gc18=f"t{i}",
                   cdicode=f"c{rnd.randrange(9)}",
                   creditportfolio=rnd.choice(("ALPHA_CP", "ALPHA_CP", "OTHER")))
            for i in range(300)
        ]

    return MemorySource(
        spark, rating_new=ratings[NEW], rating_old=ratings[OLD],
        entity_new=versions(True), entity_old=versions(False),
    )


def same(a, b):
    cols = sorted(set(a.columns) & set(b.columns))
    left, right = (
        sorted(tuple(map(str, r)) for r in df.select(*cols).collect()) for df in (a, b)
    )
    assert left == right
    return len(left)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_final_rating_p(spark, seed):
    source = world(spark, seed)
    for cfg in (CFG, replace(CFG, pinned_models=("FA_FIN",), portfolio=None)):
        steps = union_all([matched.rating_entity_p(source, cfg, g) for g in (OLD, NEW)])
        final = matched.final_rating_p(source, cfg)
        assert same(final, final_rating(steps, order=FINAL_ORDER_P)) > 10
        kinds = {r.match_kind for r in final.select("match_kind").distinct().collect()}
        assert kinds == {"financials", "non_financials"}


@pytest.mark.parametrize("seed", [4, 5])
def test_final_rating_r(spark, seed):
    source = world(spark, seed)
    steps = union_all([matched.rating_entity_r(source, CFG, g) for g in (OLD, NEW)])
    final = matched.final_rating_r(source, CFG)
    assert same(final, final_rating(steps, order=FINAL_ORDER_R)) > 10
    assert final.count() == final.select("entityid").distinct().count()


def test_asof_step_against_all_pairs(spark):
    source = world(spark, 6)
    ratings = matched.eligible(source, CFG, OLD).where("modelid = 'OTHER'").drop("generation")
    versions = matched.nonfin_entities(source, CFG, OLD)
    pairs = ratings.join(versions, "entityid").where(
        F.col("sourcepopulateddate_entity") < F.col("sourcepopulateddate_rating")
    )
    from gradeledger.operators import distinct_on

    brute = distinct_on(pairs, ["pkid_", "entityid"], matched.ASOF_ORDER)
    assert same(matched.asof_matches(ratings, source, CFG, OLD), brute) > 10
