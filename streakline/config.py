"""Parameters of the indicators and of the landing table."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Upper bounds of the first four position buckets, as shares of the record range.
POSITION_BOUNDS = (Decimal("0.20"), Decimal("0.40"), Decimal("0.60"), Decimal("0.87"))

FIELDS = ("close", "high", "low", "open", "volume")


@dataclass(frozen=True)
class IndicatorParams:
    """Window lengths count rows (trading days), not calendar days.

    ``null_policy="else"`` sends a NULL input to the last arm of each
    classifier; ``"null"`` gives a NULL bucket, which belongs to no streak.
    """

    band_rows: int = 90
    short_rows: int = 50
    long_rows: int = 200
    min_periods: int = 1
    position_bounds: tuple[Decimal, ...] = POSITION_BOUNDS
    null_policy: str = "else"

    def __post_init__(self) -> None:
        if self.null_policy not in ("else", "null"):
            raise ValueError(f"unknown null_policy {self.null_policy!r}")
        if min(self.band_rows, self.short_rows, self.long_rows, self.min_periods) < 1:
            raise ValueError("window lengths and min_periods must be at least 1")
        if len(self.position_bounds) != 4 or list(self.position_bounds) != sorted(self.position_bounds):
            raise ValueError("position_bounds needs four ascending values")

    @property
    def history_rows(self) -> int:
        """Earlier rows per stock that a new day's indicators look back on."""
        return max(self.band_rows, self.short_rows, self.long_rows) - 1


@dataclass(frozen=True)
class LandingConfig:
    """Ticker set of a wide landing table; the columns follow from it."""

    tickers: tuple[str, ...]
    table: str = "stock_staging_table"
