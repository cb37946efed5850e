"""Registered queries against their SQL, and the pipeline's stages on the small tables."""

from pathlib import Path

import duckdb
import pytest

from gradeledger.llm.queries import ORACLES, QUERIES, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        duck.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours = QUERIES[name](spark, SF)
    theirs = duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    got = sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)
    at = [theirs.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in theirs.fetchall()), key=repr)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        if name != "source_mixing":
            assert 0.5 * before < docs.count() <= before
            before = docs.count()
    last = pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
    assert {r.doc_id for r in last.collect()} <= {r.doc_id for r in table(spark, SF, "documents").collect()}
