"""The source tables of both generations and their normalisation.

The new generation keeps ids and amounts as text, the old one as numbers. They are
brought to one type here, once, so that every later join compares native columns.
Times are ``timestamp_ntz``: the reports compare wall-clock times, whatever the
session's zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeledger.config import NEW, OLD
from gradeledger.functions.scalars import MONEY
from gradeledger.operators.skew import merge_join

# Metrics of a financial statement, in source order.
METRICS = (
    "ebitda", "cashandequivalents", "totequityreserves", "netprofit", "salesrevenues",
    "netfixedassets", "totalassets", "commonsharecapital", "sharepremium", "totalliabilities",
    "grossprofit", "ebit", "profitbeforetax", "workingcapital", "dcfcffrmoperact",
    "dcfcffrominvestact", "dcfcffromfinact", "grossprofitmargin", "netprofitmargin",
    "ebitdamargin", "debttoequity", "returnonassets", "returnontoteqres", "currentratio",
    "quickratio",
)

_RATING = (
    "pkid_ long, versionid_ int, financialcontext string, entityid {id}, "
    "approveddate timestamp_ntz, approveid long, sourcepopulateddate_ timestamp_ntz, "
    "islatestapprovedscenario boolean, isprimary boolean, isdeleted_ boolean, "
    "nextreviewdate date, creditcommitteedate date, approvalstatus string, modelid string"
)
_ENTITY = (
    "entityid {id}, versionid_ int, sourcepopulateddate_ timestamp_ntz, gc18 string, "
    "cdicode string, creditportfolio string"
)
_KEY = "pkid_ long, versionid_ int"
_HEADER = (
    "entityid {id}, financialid {id}, statementid {id}, statementyear int, "
    "statementmonths int, statementdatekey_ int, sourcepopulateddate_ timestamp_ntz"
)
_METRICS = ", ".join(f"{m} {MONEY}" for m in METRICS)
_BALANCE = (
    "statementid {id}, financialid {id}, accountid {id}, versionid_ int, "
    "sourcepopulateddate_ timestamp_ntz, originrounding {amount}, originbalance {amount}"
)

# Table name to schema, as stored.
SCHEMAS = {
    "rating_new": _RATING.format(id="string") + ", entity_version_match string",
    "rating_old": _RATING.format(id="int"),
    "entityrating_new": "approveid long, finalgrade long",
    "entityrating_old": "approveid long, finalgrade long",
    "ratingscale": "ratingscalekey_ int, ratingscalevalue string",
    "entity_new": _ENTITY.format(id="string"),
    "entity_old": _ENTITY.format(id="int"),
    "statement_new": f"{_KEY}, {_HEADER.format(id='string')}, {_METRICS}",
    "statement_old": f"{_KEY}, {_HEADER.format(id='int')}",
    "statement_metrics_old": f"{_KEY}, {_METRICS}",
    "balance_new": _BALANCE.format(id="string", amount="string") + ", id_ long",
    "balance_old": _BALANCE.format(id="int", amount=MONEY),
    "historical_statement": (
        "financialid string, statementid string, versionid_ int, status string, "
        "dimhistoricalstatementid_ long"
    ),
}


def _typed(df: DataFrame, **casts: str) -> DataFrame:
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else c for c in df.columns])


class ReportSource:
    """Reads the source tables below one root, each ``<root>/<name>`` in parquet.

    A subclass may supply the stored tables another way by overriding ``raw``; all
    loaders normalise whatever it returns.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        """A stored table with its times made zone-free."""
        if name not in self._tables:
            df = self.raw(name)
            zoned = [c for c, t in df.dtypes if t == "timestamp"]
            self._tables[name] = _typed(df, **dict.fromkeys(zoned, "timestamp_ntz"))
        return self._tables[name]

    def load_ratings_new(self) -> DataFrame:
        return _typed(self.table("rating_new"), entityid="int")

    def load_ratings_old(self) -> DataFrame:
        return self.table("rating_old").withColumn(
            "entity_version_match", F.lit(None).cast("string")
        )

    def load_ratings(self, generation: str) -> DataFrame:
        return self.load_ratings_new() if generation == NEW else self.load_ratings_old()

    def load_entity_rating(self, generation: str) -> DataFrame:
        return self.table(f"entityrating_{generation}")

    def load_rating_scale(self) -> DataFrame:
        return self.table("ratingscale").withColumn(
            "ratingscalekey_", F.col("ratingscalekey_").cast("long")
        )

    def load_entities(self, generation: str) -> DataFrame:
        """Entity versions: ``afm`` is the tax id, ``cdicode`` the customer id."""
        return _typed(self.table(f"entity_{generation}"), entityid="int").select(
            "entityid",
            "versionid_",
            F.col("sourcepopulateddate_").alias("sourcepopulateddate_entity"),
            F.col("gc18").alias("afm"),
            "cdicode",
            "creditportfolio",
        )

    def load_statements_new(self) -> DataFrame:
        return _typed(
            self.table("statement_new"), entityid="int", financialid="int", statementid="int"
        )

    def load_statement_headers_old(self) -> DataFrame:
        return self.table("statement_old")

    def load_statement_metrics_old(self) -> DataFrame:
        return self.table("statement_metrics_old")

    def load_statements_old(self) -> DataFrame:
        """Header joined to metrics, in the columns of the new generation."""
        return merge_join(
            self.load_statement_headers_old(), self.load_statement_metrics_old(),
            ["pkid_", "versionid_"],
        )

    def load_statements(self, generation: str) -> DataFrame:
        return self.load_statements_new() if generation == NEW else self.load_statements_old()

    def load_balances(self, generation: str, accounts: Sequence[int] | None = None) -> DataFrame:
        """Balances of the given accounts.

        The account filter compares the stored type, so it reaches the scan, and the
        text of other accounts is never cast.
        """
        df = self.table(f"balance_{generation}")
        if accounts is not None:
            stored = [str(a) for a in accounts] if generation == NEW else list(accounts)
            df = df.where(F.col("accountid").isin(stored))
        return _typed(
            df, statementid="int", financialid="int", accountid="int",
            originrounding=MONEY, originbalance=MONEY,
        )

    def load_historical_statements(self) -> DataFrame:
        return _typed(self.table("historical_statement"), financialid="int", statementid="int")


def tagged_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows under each other with their generation, common columns only."""
    cols = [c for c in old.columns if c in new.columns]

    def tag(df: DataFrame, generation: str) -> DataFrame:
        return df.select(*cols).withColumn("generation", F.lit(generation))

    return tag(old, OLD).unionByName(tag(new, NEW))


def statements_unified(source: ReportSource) -> DataFrame:
    return tagged_union(source.load_statements_old(), source.load_statements_new())


def balances_unified(source: ReportSource, accounts: Sequence[int]) -> DataFrame:
    return tagged_union(
        source.load_balances(OLD, accounts), source.load_balances(NEW, accounts)
    )


def in_portfolio(df: DataFrame, portfolio: str | None) -> DataFrame:
    return df if portfolio is None else df.where(F.col("creditportfolio") == portfolio)
