"""Account-balance groups: every report line from one pass over the balances."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeledger.config import ACCOUNT_GROUPS, LARGEST_GROUPS, ROUNDING_FACTORS
from gradeledger.functions.scalars import scale_amount, signed_sum

GROUP_KEYS = ("generation", "entityid", "statementid", "financialid")


def scaled_balances(
    balances: DataFrame,
    rounding_map: Mapping[int, int] = ROUNDING_FACTORS,
    by: Sequence[str] = GROUP_KEYS,
) -> DataFrame:
    """(keys, account, amount in units), one row per balance."""
    amount = scale_amount("originbalance", "originrounding", rounding_map)
    return balances.select(*by, "accountid", amount.alias("amount"))


def sum_groups(
    amounts: DataFrame,
    groups: Mapping[str, Sequence[int]] = ACCOUNT_GROUPS,
    by: Sequence[str] = GROUP_KEYS,
    largest: Collection[str] = LARGEST_GROUPS,
) -> DataFrame:
    """One row per key with a column per group; NULL where the group has no balance.

    Groups in ``largest`` are read, not summed: the largest amount where several exist.
    """
    aggregates = []
    for name, codes in groups.items():
        if name in largest:
            total = F.max(F.when(F.col("accountid").isin(list(codes)), F.col("amount")))
        else:
            total = signed_sum("amount", "accountid", codes)
        aggregates.append(total.cast("decimal(37,2)").alias(name))
    return amounts.groupBy(*by).agg(*aggregates)


def account_groups(
    balances: DataFrame,
    groups: Mapping[str, Sequence[int]] = ACCOUNT_GROUPS,
    rounding_map: Mapping[int, int] = ROUNDING_FACTORS,
    by: Sequence[str] = GROUP_KEYS,
    largest: Collection[str] = LARGEST_GROUPS,
) -> DataFrame:
    """Every group from one pass: a repeated amount of an account counts once, a
    differing one counts again.

    The distinct spreads over accounts and amounts, so one heavy statement does not
    end in one task.
    """
    return sum_groups(scaled_balances(balances, rounding_map, by).distinct(), groups, by, largest)


def account_group_for(
    df: DataFrame,
    group: str,
    groups: Mapping[str, Sequence[int]] = ACCOUNT_GROUPS,
    rounding_map: Mapping[int, int] = ROUNDING_FACTORS,
    largest: Collection[str] = LARGEST_GROUPS,
    **keys,
) -> DataFrame:
    """One group's value for the given keys, such as ``entityid=…, statementid=…``.

    ``df`` holds balances; the filter is applied before the aggregation, so only the
    asked rows are read and summed. Groups, rounding codes and the groups that take the
    largest value are those of a ``ReportConfig``.
    """
    for name, value in keys.items():
        df = df.where(F.col(name) == F.lit(value))
    wanted = groups[group]
    df = df.where(F.col("accountid").isin([abs(c) for c in wanted]))
    return account_groups(df, {group: wanted}, rounding_map, largest=largest)


def long_groups(
    balances: DataFrame,
    groups: Mapping[str, Sequence[int]] = ACCOUNT_GROUPS,
    rounding_map: Mapping[int, int] = ROUNDING_FACTORS,
    largest: Collection[str] = LARGEST_GROUPS,
) -> DataFrame:
    """(keys, account_group, amount) of the groups that have a balance, from one pass."""
    wide = account_groups(balances, groups, rounding_map, largest=largest)
    return wide.unpivot(list(GROUP_KEYS), list(groups), "account_group", "amount").where(
        "amount IS NOT NULL"
    )
