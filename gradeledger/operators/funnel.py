"""Row counts of named steps, taken while a query runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Funnel:
    """Marks steps of a plan; the query that runs them counts their rows on the way.

    No step is computed for its count. The counts are Spark's observed metrics: exact unless
    a task's output was lost and made again, which counts its rows again.
    """

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}

    def __call__(self, step: str, df: DataFrame) -> DataFrame:
        """``df``, counted as ``step`` when it runs. A step has one place in a plan."""
        if step in self._steps:
            raise ValueError(f"step {step!r} is marked already")
        self._steps[step] = Observation()
        return df.observe(self._steps[step], F.count(F.lit(1)).alias("n_rows"))

    def counts(self) -> dict[str, int]:
        """Rows of each marked step that has run, in the order of marking.

        A step that didn't run, because Spark found its result to be empty without, is missing.
        """
        seen = {step: s._jo.getRowOrEmpty() for step, s in self._steps.items() if s._jo}
        rows = {step: row.get() for step, row in seen.items() if row.isDefined()}
        return {step: row.getLong(0) for step, row in rows.items() if row.length()}


def unmarked(step: str, df: DataFrame) -> DataFrame:
    """In place of a funnel where nothing is counted."""
    return df


Mark = Callable[[str, DataFrame], DataFrame]
