"""Price-streak analytics on PySpark: bars in, bucket streaks, alerts and back-tests out."""

from streakline.config import IndicatorParams
from streakline.families import AVERAGE, FAMILIES, HIGH_LOW, MOVING_AVG, BucketFamily

__all__ = ["AVERAGE", "FAMILIES", "HIGH_LOW", "MOVING_AVG", "BucketFamily", "IndicatorParams"]
