"""Scalar column expressions shared by both reports. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def newest(c: str | Column) -> Column:
    """Descending with NULL first: the reports rank a missing date as the latest."""
    return col(c).desc_nulls_first()


def oldest(c: str | Column) -> Column:
    """Ascending with NULL last."""
    return col(c).asc_nulls_last()


def sort_keys(order: Iterable[str | Column]) -> list[Column]:
    """Sort columns from names: ``-x`` newest first, ``x`` oldest first; columns stay."""
    return [
        o if isinstance(o, Column) else newest(o[1:]) if o.startswith("-") else oldest(o)
        for o in order
    ]


def start_of(day: date) -> Column:
    """First instant of a day. Comparing with it, rather than casting the column
    to a date, lets the filter reach the parquet scan."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def end_of(day: date) -> Column:
    """The inclusive upper bound of a day: 23:59:59, so 23:59:59.5 is outside."""
    return F.lit(f"{day.isoformat()} 23:59:59").cast("timestamp_ntz")


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def zero() -> Column:
    return F.lit(Decimal("0.00")).cast(MONEY)


def money_or_zero(c: str | Column) -> Column:
    return F.coalesce(money(c), zero())


def presence_flag(c: str | Column) -> Column:
    return F.when(col(c).isNotNull(), "true").otherwise("false")


def canonical_tax_id(c: str | Column) -> Column:
    """All-zero tax ids of any length become eight zeros; others stay.

    ``\\z`` and not ``$``, which in Java also matches before a final newline.
    """
    c = col(c)
    return F.when(c.rlike(r"^0+\z"), F.lpad(c, 8, "0")).otherwise(c)


def guarded_ratio(n: str | Column, d: str | Column, null_as_zero: bool = False) -> Column:
    """n / d rounded half up to two digits, 0.00 for a zero denominator.

    A NULL denominator gives NULL, or 0.00 with ``null_as_zero``.
    """
    n, d = col(n), money(d)
    is_zero = d == zero()
    if null_as_zero:
        is_zero = d.isNull() | is_zero
    return F.when(is_zero, zero()).otherwise((n / d).cast(MONEY))


def scale_amount(balance: str | Column, code: str | Column, factors: Mapping[int, int]) -> Column:
    """Amount in units by rounding code; zero for an unknown or missing code."""
    balance, code = money(balance), col(code)
    scaled = None
    for key, factor in factors.items():
        amount = (balance * F.lit(Decimal(factor))).cast("decimal(27,2)")
        scaled = F.when(code == key, amount) if scaled is None else scaled.when(code == key, amount)
    return F.coalesce(scaled, F.lit(Decimal("0.00")).cast("decimal(27,2)"))


def day_month_year(c: str | Column) -> Column:
    return F.date_format(col(c), "dd-MM-yyyy")


def compact_date(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyyMMdd")


def date_of_key(c: str | Column) -> Column:
    """Integer yyyymmdd to a date; a bad key raises, as a cast would."""
    return F.to_date(col(c).cast("string"), "yyyyMMdd")


def zoned_text(c: str | Column) -> Column:
    """Wall-clock time with the session's zone offset: ``2023-09-29 10:11:12.5+00``."""
    c = col(c)
    text = F.concat(c.cast("string"), F.date_format(c.cast("timestamp"), "x"))
    return F.substring(text, 1, 30)


def entity_version_key(entity: str | Column, version: str | Column) -> Column:
    return F.concat_ws("|", col(entity).cast("string"), col(version).cast("string"))


def signed_sum(amount: str | Column, account: str | Column, codes: Sequence[int]) -> Column:
    """Sum of the amounts booked on the given accounts, negative codes subtracted.

    NULL when no row carries one of the codes, which the reports tell from zero.
    """
    amount, account = col(amount), col(account)
    plus = [c for c in codes if c >= 0]
    minus = [-c for c in codes if c < 0]
    picked = F.when(account.isin(plus), amount)
    if minus:
        picked = picked.when(account.isin(minus), -amount)
    return F.sum(picked)
