"""Parser of the packed context key stored with each rating.

A context reads ``financialid:v;entityversion#stmt:ver;stmt:ver;…``. Everything
here is regular expressions and array functions, so a row is parsed where it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeledger.functions.scalars import col

# The patterns that define the packed format.
ENTITY_VERSION = r";([^;#]*)#"
FINANCIAL_ID = r"^[^:]*"
BEFORE_STATEMENTS = r"(?s).*#([^:*]+)"
STATEMENT_ID = r"^(\d+)"
STATEMENT_VERSION = r":(\d+)"


def usable(c: str | Column, min_len: int = 16) -> Column:
    """True for contexts long enough to hold keys; implies not NULL, '', '0', '###'."""
    return F.length(col(c)) > min_len


def has_entity_version(c: str | Column) -> Column:
    return col(c).rlike(ENTITY_VERSION)


def entity_version(c: str | Column) -> Column:
    """Entity version as an int; an empty one (``;#``) is a cast error."""
    c = col(c)
    return F.when(has_entity_version(c), F.regexp_extract(c, ENTITY_VERSION, 1).cast("int"))


def statement_items(c: str | Column) -> Column:
    """The ``stmt:ver`` items after the last ``#`` that has something behind it."""
    return F.split(F.regexp_replace(col(c), BEFORE_STATEMENTS, "$1"), ";")


def statement_ids(c: str | Column) -> Column:
    """Statement ids of a context, as text, in order; items without one are left out."""
    ids = F.transform(statement_items(c), lambda item: F.regexp_extract(item, STATEMENT_ID, 1))
    return F.filter(ids, lambda i: i != "")


def financial_id(c: str | Column) -> Column:
    """Financial id as an int. Guarded, so that contexts without any statement,
    which drop out of every perimeter, are not cast."""
    c = col(c)
    return F.when(
        F.size(statement_ids(c)) > 0, F.regexp_extract(c, FINANCIAL_ID, 0).cast("int")
    )


def parse_context(df: DataFrame, context: str = "financialcontext") -> DataFrame:
    """Add ``financialid`` and ``entityversion``; rows without an entity version drop."""
    return (
        df.where(has_entity_version(context))
        .withColumn("financialid", financial_id(context))
        .withColumn("entityversion", entity_version(context))
    )


def explode_statements(
    df: DataFrame,
    context: str = "financialcontext",
    with_version: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """One row per statement id in the context.

    With ``with_version`` the ids and versions of an item are paired in lockstep,
    the shorter list padded with NULL. ``distinct`` lists a repeated id once, which
    costs no shuffle here and keeps later joins one-to-one.
    """
    if not with_version:
        ids = statement_ids(context)
        ids = F.array_distinct(ids) if distinct else ids
        return df.select("*", F.explode(ids).alias("statementid"))
    item = F.col("_item")
    pairs = F.arrays_zip(
        F.regexp_extract_all(item, F.lit(STATEMENT_ID), 1).alias("statementid"),
        F.regexp_extract_all(item, F.lit(STATEMENT_VERSION), 1).alias("statementid_version"),
    )
    return df.select("*", F.explode(statement_items(context)).alias("_item")).select(
        *df.columns, F.inline(pairs)
    )
