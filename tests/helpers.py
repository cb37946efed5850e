"""Hand-written source tables for tests."""

from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gradeledger.config import ReportConfig
from gradeledger.sources.tables import METRICS, SCHEMAS, ReportSource

CFG = ReportConfig(ref_date=date(2023, 9, 29))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


class MemorySource(ReportSource):
    """Source tables from lists of dicts; missing columns are NULL, tables empty."""

    def __init__(self, spark, **tables):
        super().__init__(spark)
        self.rows = tables

    def raw(self, name):
        schema = StructType.fromDDL(SCHEMAS[name])
        rows = self.rows.get(name, [])
        unknown = {k for r in rows for k in r} - set(schema.names)
        assert not unknown, unknown
        full = [{c: r.get(c) for c in schema.names} for r in rows]
        table = pa.Table.from_pylist(full, schema=to_arrow_schema(schema))
        return self.spark.createDataFrame(table, schema)


def rating(new: bool, entity: int, day: str, **more):
    row = {
        "pkid_": 1, "versionid_": 1, "entityid": str(entity) if new else entity,
        "financialcontext": f"{entity}:1;1#1:1;2:1;3:1;4:1", "approveddate": at(day),
        "approveid": 1, "sourcepopulateddate_": at(day), "islatestapprovedscenario": True,
        "isprimary": True, "isdeleted_": False, "nextreviewdate": date(2024, 1, 2),
        "creditcommitteedate": date(2023, 1, 2), "approvalstatus": "2", "modelid": "FA_FIN",
    }
    if new:
        row["entity_version_match"] = "1"
    return row | more


def entity(new: bool, number: int, day: str = "2021-02-01", **more):
    return {
        "entityid": str(number) if new else number, "versionid_": 1,
        "sourcepopulateddate_": at(day), "gc18": "123456789", "cdicode": f"c{number}",
        "creditportfolio": "ALPHA_CP",
    } | more


def statement(new: bool, number: int, stmt: int | str, year: int, day: str, **more):
    def as_id(v):
        return str(v) if new else int(v)

    row = {
        "pkid_": number * 100 + int(stmt), "versionid_": 1, "entityid": as_id(number),
        "financialid": as_id(number), "statementid": as_id(stmt), "statementyear": year,
        "statementmonths": 12, "statementdatekey_": year * 10000 + 1231,
        "sourcepopulateddate_": at(day),
    }
    if new:
        row |= {m: Decimal("1.00") for m in METRICS}
    return row | more


def metrics_of(row, **more):
    return {"pkid_": row["pkid_"], "versionid_": row["versionid_"]} | {
        m: Decimal("1.00") for m in METRICS
    } | more


def balance(new: bool, number: int, stmt: int, account: int, amount: str, **more):
    def typed(v):
        return str(v) if new else v

    return {
        "statementid": typed(stmt), "financialid": typed(number), "accountid": typed(account),
        "versionid_": 1, "sourcepopulateddate_": at("2023-01-01"),
        "originrounding": "0" if new else Decimal("0.00"),
        "originbalance": amount if new else Decimal(amount),
    } | more
