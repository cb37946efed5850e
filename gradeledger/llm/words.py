"""Word expressions on text columns. Words end at space and the ASCII control spaces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six separators.
SEPARATORS = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Array of the words; null counts as empty."""
    plain = F.translate(F.coalesce(text, F.lit("")), SEPARATORS, " " * len(SEPARATORS))
    return F.array_remove(F.split(plain, " "), "")


def without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")
