"""Source tables derived from the star-schema test tables, in Spark and in DuckDB.

Column expressions are the same text in both engines; only the row generators differ
(``explode`` in Spark, inline value lists in DuckDB).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeledger.config import ReportConfig
from gradeledger.operators.reuse import stored
from gradeledger.sources.tables import METRICS, SCHEMAS, ReportSource

CONFIG = ReportConfig(ref_date=date(2000, 9, 29), go_live=date(1996, 1, 6))

# Account codes of the derived balances, by l_partkey % 33.
ACCOUNTS = (
    1100, 1520, 1521, 1522, 1523, 1640, 1641, 1642, 1643, 1646, 1650, 2680, 2685, 2686, 2687,
    2100, 2110, 2115, 2120, 2130, 2150, 2400, 2410, 2415, 2420, 2430, 2440, 2450, 2460, 2470,
    5950, 5960, 3400,
)

RATING = {
    "pkid_": "o_orderkey",
    "financialcontext": """CASE WHEN o_orderkey % 29 = 0 THEN '###'
        WHEN o_orderkey % 31 = 0 THEN '0' ELSE concat(CAST(o_custkey AS STRING), ':1;', CAST(o_orderkey % 3 + 1 AS STRING), '#',
        CAST(o_orderkey % 3 + 1 AS STRING), ':1;', CAST(o_orderkey % 3 + 2 AS STRING), ':2;',
        CAST(o_orderkey % 3 + 3 AS STRING), ':1') END""",
    "entityid": "CAST(o_custkey AS STRING)",
    "approveddate": "o_orderdate",
    "approveid": "o_orderkey",
    "sourcepopulateddate_": "o_orderdate + INTERVAL '1' DAY",
    "islatestapprovedscenario": "o_orderkey % 7 <> 0",
    "nextreviewdate": "CAST(o_orderdate + INTERVAL '365' DAY AS DATE)",
    "creditcommitteedate": "CAST(o_orderdate AS DATE)",
    "approvalstatus": "CASE WHEN o_orderkey % 10 = 9 THEN '1' ELSE '2' END",
    "modelid": """CASE o_orderkey % 5 WHEN 0 THEN 'OTHER_MODEL' WHEN 1 THEN 'PdModelCcategory'
        ELSE 'FA_FIN' END""",
    "entity_version_match": "CAST(o_orderkey % 3 + 1 AS STRING)",
    "versionid_": "CAST(o_orderkey % 4 + 1 AS INT)",
    "isdeleted_": "o_orderkey % 13 = 0",
    "isprimary": "o_orderkey % 11 <> 0",
}
RATING_OLD = {k: v for k, v in RATING.items() if k != "entity_version_match"} | {
    "entityid": "CAST(o_custkey AS INT)",
    "approveddate": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END",
}
ENTITY_RATING = {
    "approveid": "o_orderkey",
    "finalgrade": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 12 END",
}
RATING_SCALE = {
    "ratingscalekey_": "n_nationkey",
    "ratingscalevalue": "concat('G', CAST(n_nationkey AS STRING))",
}
ENTITY_OLD = {
    "entityid": "CAST(c_custkey AS INT)",
    "versionid_": "ver",
    "sourcepopulateddate_":
        "CAST(DATE '1995-01-01' + CAST(ver * 200 + c_custkey % 100 AS INT) AS TIMESTAMP)",
    "gc18": """CASE WHEN c_custkey % 17 = 0 THEN '000' WHEN c_custkey % 19 = 0 THEN '000000000'
        ELSE concat('1', lpad(CAST(c_custkey AS STRING), 8, '0')) END""",
    "cdicode": "CAST(c_custkey * 7 + ver AS STRING)",
    "creditportfolio": "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'OTHER_CP' ELSE 'ALPHA_CP' END",
}
# New entity data comes a few days later and carries other customer ids.
ENTITY_NEW = ENTITY_OLD | {
    "entityid": "CAST(c_custkey AS STRING)",
    "sourcepopulateddate_":
        "CAST(DATE '1995-01-01' + CAST(ver * 200 + c_custkey % 100 + 40 AS INT) AS TIMESTAMP)",
    "cdicode": "CAST(c_custkey * 7 + ver + 1000000 AS STRING)",
}
STATEMENT_KEY = {"pkid_": "c_custkey * 10 + stmt", "versionid_": "ver"}
HEADER_OLD = {
    "entityid": "CAST(c_custkey AS INT)",
    "financialid": "CAST(c_custkey AS INT)",
    "statementid": "CAST(stmt AS INT)",
    "statementyear": "1994 + stmt",
    "statementmonths": "CASE WHEN (c_custkey + stmt) % 6 = 0 THEN 6 ELSE 12 END",
    "statementdatekey_": """CASE WHEN c_custkey % 5 = 0 THEN (2004 - stmt) * 10000 + 1231
        ELSE (1994 + stmt) * 10000 + 1231 END""",
    "sourcepopulateddate_": """CAST(DATE '1996-01-01'
        + CAST((c_custkey * 37) % 1500 + stmt * 30 + ver * 200 AS INT) AS TIMESTAMP)""",
}
HEADER_NEW = HEADER_OLD | {
    "entityid": "CAST(c_custkey AS STRING)",
    "financialid": "CAST(c_custkey AS STRING)",
    "statementid": "CAST(stmt AS STRING)",
}
METRIC_EXPRS = {
    "ebitda": """CASE WHEN c_custkey % 23 = 0 THEN CAST(0 AS DECIMAL(19,2))
        WHEN c_custkey % 29 = 0 THEN CAST(NULL AS DECIMAL(19,2))
        ELSE CAST(CAST(c_acctbal AS DECIMAL(19,2)) * stmt AS DECIMAL(19,2)) END""",
    **{
        name: f"""CASE WHEN (c_custkey + {i}) % 41 = 0 THEN CAST(NULL AS DECIMAL(19,2))
        ELSE CAST(CAST(c_acctbal AS DECIMAL(19,2)) * (stmt + {i}) + ver AS DECIMAL(19,2)) END"""
        for i, name in enumerate(METRICS[1:])
    },
}
BALANCE_OLD = {
    "statementid": "CAST(l_orderkey % 5 + 1 AS INT)",
    "financialid": "CAST(o_custkey AS INT)",
    "accountid": "accountid",
    "versionid_": "l_linenumber",
    "sourcepopulateddate_": "l_shipdate",
    "originrounding": "CAST(l_suppkey % 4 AS DECIMAL(19,2))",
    "originbalance": "CAST(l_extendedprice AS DECIMAL(19,2))",
}
BALANCE_NEW = {
    "statementid": "CAST(l_orderkey % 5 + 1 AS STRING)",
    "financialid": "CAST(o_custkey AS STRING)",
    "accountid": "CAST(accountid AS STRING)",
    "versionid_": "l_linenumber",
    "sourcepopulateddate_": "l_shipdate",
    "originrounding": "CAST(l_suppkey % 4 AS STRING)",
    "originbalance": "CAST(CAST(l_extendedprice AS DECIMAL(19,2)) AS STRING)",
    "id_": "o_custkey * 100 + (l_orderkey % 5 + 1) * 10 + l_linenumber % 2 + 1",
}
HISTORICAL = {
    "financialid": "CAST(c_custkey AS STRING)",
    "statementid": "CAST(stmt AS STRING)",
    "versionid_": "ver",
    "status": "CASE WHEN (c_custkey + stmt) % 3 = 0 THEN 'Draft' ELSE 'Reviewed' END",
    "dimhistoricalstatementid_": "c_custkey * 100 + stmt * 10 + ver",
}

# Table name to (columns, row set, filter).
TABLES = {
    "rating_new": (RATING, "orders", "o_orderkey % 2 = 0"),
    "rating_old": (RATING_OLD, "orders", "o_orderkey % 2 = 1"),
    "entityrating_new": (ENTITY_RATING, "orders", "o_orderkey % 2 = 0"),
    "entityrating_old": (ENTITY_RATING, "orders", "o_orderkey % 2 = 1"),
    "ratingscale": (RATING_SCALE, "nation", "n_nationkey BETWEEN 1 AND 10"),
    "entity_new": (ENTITY_NEW, "customer_versions", None),
    "entity_old": (ENTITY_OLD, "customer_versions", None),
    "statement_new": (STATEMENT_KEY | HEADER_NEW | METRIC_EXPRS, "customer_statements", None),
    "statement_old": (STATEMENT_KEY | HEADER_OLD, "customer_statements", None),
    "statement_metrics_old": (STATEMENT_KEY | METRIC_EXPRS, "customer_statements", None),
    "balance_new": (BALANCE_NEW, "booked_lines", None),
    "balance_old": (BALANCE_OLD, "booked_lines", None),
    "historical_statement": (HISTORICAL, "customer_statements", None),
}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


class DerivedSource(ReportSource):
    """The report source tables, derived by Spark from the star-schema tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._booked: DataFrame | None = None

    def with_booked_lines(self) -> DerivedSource:
        """This source with the lines of both generations' balances joined to their orders once,
        in files, and not by each reader: for reports that read both."""
        found = DerivedSource(self.spark, self.root)
        found._booked = stored(self._rows("booked_lines"))
        return found

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def _rows(self, name: str) -> DataFrame:
        def numbered(df: DataFrame, column: str, n: int) -> DataFrame:
            return df.select("*", F.explode(F.array(*map(F.lit, range(1, n + 1)))).alias(column))

        if name in ("customer_versions", "customer_statements"):
            # a file of few bytes is one task, which would make all the rows of its customers
            dealt = self._read("customer").repartition(self.spark.sparkContext.defaultParallelism)
            if name == "customer_versions":
                return numbered(dealt, "ver", 3)
            return numbered(numbered(dealt, "stmt", 5), "ver", 2)
        if name == "booked_lines" and self._booked is not None:
            return self._booked
        if name == "booked_lines":
            account = F.element_at(
                F.array(*map(F.lit, ACCOUNTS)), (F.col("l_partkey") % 33 + 1).cast("int")
            )
            # what the tables read of a line, in few distinct values, before it is shuffled
            lines = self._read("lineitem").select(
                "l_orderkey", account.alias("accountid"), (F.col("l_suppkey") % 4).alias("l_suppkey"),
                "l_extendedprice", "l_linenumber", "l_shipdate",
            )
            return lines.join(
                self._read("orders").select("o_orderkey", "o_custkey"),
                F.col("l_orderkey") == F.col("o_orderkey"),
            )
        return self._read(name)

    def raw(self, name: str) -> DataFrame:
        columns, rows, keep = TABLES[name]
        df = self._rows(rows)
        return (df if keep is None else df.where(keep)).selectExpr(*_select(columns))


def store(spark: SparkSession, sf_dir: str, root: str) -> ReportSource:
    """Write the derived tables in their stored types, and a source that reads them."""
    derived = DerivedSource(spark, sf_dir)
    for name, ddl in SCHEMAS.items():
        types = StructType.fromDDL(ddl)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in types]
        derived.table(name).select(*typed).repartition(8).write.parquet(f"{root}/{name}")
    return ReportSource(spark, root)


DUCK_ROWS = {
    "customer_versions": "customer CROSS JOIN (VALUES (1), (2), (3)) v(ver)",
    "customer_statements":
        "customer CROSS JOIN (VALUES (1), (2), (3), (4), (5)) s(stmt) "
        "CROSS JOIN (VALUES (1), (2)) v(ver)",
    "booked_lines":
        "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN (VALUES "
        + ", ".join(f"({i}, {a})" for i, a in enumerate(ACCOUNTS))
        + ") acc(idx, accountid) ON l_partkey % 33 = idx",
}


def duckdb_table(name: str) -> str:
    """The same table as a DuckDB query."""
    columns, rows, keep = TABLES[name]
    where = "" if keep is None else f" WHERE {keep}"
    return f"SELECT {', '.join(_select(columns))} FROM {DUCK_ROWS.get(rows, rows)}{where}"
