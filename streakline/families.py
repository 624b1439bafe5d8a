"""The three bucket families. One description drives streaks, marts and increments of all three."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BucketFamily:
    name: str
    bucket_column: str
    run_column: str
    key_column: str
    mart: str
    dim: str
    buckets: tuple[tuple[int, str, str], ...]

    @property
    def bucket_names(self) -> tuple[str, ...]:
        return tuple(name for _, name, _ in self.buckets)


# Bucket ids and names of the three dimensions.
HIGH_LOW = BucketFamily(
    name="high_low",
    bucket_column="highest_lowest_valuation",
    run_column="high_low_streak_run",
    key_column="highest_lowest_valuation_key",
    mart="highest_lowest_stock_metric",
    dim="highest_lowest_valuation_dim",
    buckets=(
        (1, "near_record_low", "close lies in the lowest 20% of the record range"),
        (2, "lower_range", "close lies above 20% and up to 40% of the record range"),
        (3, "mid_range", "close lies above 40% and up to 60% of the record range, or the range is empty"),
        (4, "higher_range", "close lies above 60% and up to 87% of the record range"),
        (5, "near_record_high", "close lies above 87% of the record range"),
    ),
)

AVERAGE = BucketFamily(
    name="average",
    bucket_column="average_valuation",
    run_column="average_streak_run",
    key_column="stock_average_valuation_key",
    mart="stock_average_metric",
    dim="average_valuation_dim",
    buckets=(
        (1, "above", "close is more than one deviation over the rolling mean"),
        (2, "below", "close is more than one deviation under the rolling mean"),
        (3, "within", "close is at most one deviation away from the rolling mean"),
    ),
)

MOVING_AVG = BucketFamily(
    name="moving_avg",
    bucket_column="moving_avg_comparison",
    run_column="moving_avg_streak_run",
    key_column="moving_average_valuation_key",
    mart="moving_average_stock_metric",
    dim="moving_avg_comparison_dim",
    buckets=(
        (1, "bullish_alignment", "the short moving average is greater than the long one"),
        (2, "bearish_alignment", "the short moving average is not greater than the long one"),
    ),
)

FAMILIES = (HIGH_LOW, AVERAGE, MOVING_AVG)
