"""Report parameters. Every business constant lives here and nowhere else."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from types import MappingProxyType

# Tags of the two source generations; an entity's final rating comes from one of them.
NEW, OLD = "new", "old"
GENERATIONS = (NEW, OLD)

# How a rating got its entity data.
FINANCIALS, NON_FINANCIALS = "financials", "non_financials"

# Account codes summed into each report line. A negative code is
# subtracted. Goodwill is not summed; see LARGEST_GROUPS.
ACCOUNT_GROUPS: Mapping[str, tuple[int, ...]] = MappingProxyType(
    {
        "inventories": (1520, 1521, 1522, 1523),
        "net_receivables": (1640, 1641, 1642, 1643, 1646, -1650),
        "trade_payables": (2680, 2685, 2686, 2687),
        "total_debt": (2100, 2110, 2115, 2120, 2130, 2150,
                       2400, 2410, 2415, 2420, 2430, 2440, 2450, 2460, 2470),
        "short_debt": (2400, 2410, 2415, 2420, 2430, 2440, 2450, 2460, 2470),
        "long_debt": (2100, 2110, 2115, 2120, 2130, 2150),
        "dividends": (5950, 5960),
        "interest": (3400,),
        "goodwill": (1100,),
    }
)

# Groups of which the largest value is read instead of the sum.
LARGEST_GROUPS: tuple[str, ...] = ("goodwill",)

# Multiplier of each rounding code; any other code means zero.
ROUNDING_FACTORS: Mapping[int, int] = MappingProxyType({0: 1, 1: 1000, 2: 100000})


@dataclass(frozen=True)
class ReportConfig:
    """Parameters of both reports; the defaults are the current revision.

    ``pinned_models`` is the model set matched by pinned entity version; ``None``
    means the financials models. ``portfolio=None`` lifts the portfolio filter.
    ``sharing`` says how results that several joins read are kept: ``persist``,
    ``checkpoint`` (reliable, for long lineages), ``files`` (parquet, and the disk of one step
    at a time) or ``none``. ``splits`` is the number
    of places the rows of one join key may go to; two are enough to let adaptive
    execution divide a hot key further. With 0 keys are weighed by a pass over their columns
    and each heavy one gets its own number; with 1 bucketed tables are joined where they lie.
    """

    ref_date: date
    go_live: date = date(2021, 1, 6)
    portfolio: str | None = "ALPHA_CP"
    financial_models: tuple[str, ...] = ("FA_FIN", "PdModelCcategory")
    pinned_models: tuple[str, ...] | None = None
    nonfin_entity_gen: str = NEW
    approved_status: str = "2"
    min_context: int = 16
    statement_months: int = 12
    lag_order: str = "date"
    rounding_map: Mapping[int, int] = field(default=ROUNDING_FACTORS)
    accounts: Mapping[str, tuple[int, ...]] = field(default=ACCOUNT_GROUPS)
    largest: tuple[str, ...] = LARGEST_GROUPS
    sharing: str = "persist"
    splits: int = 2

    def __post_init__(self):
        if self.lag_order not in ("date", "year"):
            raise ValueError(f"lag_order must be 'date' or 'year', not {self.lag_order!r}")
        if self.nonfin_entity_gen not in GENERATIONS:
            raise ValueError(f"nonfin_entity_gen must be one of {GENERATIONS}")
        if self.sharing not in ("persist", "checkpoint", "files", "none"):
            raise ValueError(f"unknown sharing mode {self.sharing!r}")

    @property
    def pinned(self) -> tuple[str, ...]:
        return self.financial_models if self.pinned_models is None else self.pinned_models

    @property
    def account_codes(self) -> tuple[int, ...]:
        return tuple(sorted({abs(code) for codes in self.accounts.values() for code in codes}))
