"""Column-level helpers: rounding, time, AQI scale."""

from .aqi_scale import (
    CATEGORIES,
    aqi_category,
    category_ordinal,
    pollutant_label,
)
from .rounding import half_even, half_up, stable_mean
from .timeparts import day_of, hour_start, local_today, whole_second_now

__all__ = [
    "CATEGORIES",
    "aqi_category",
    "category_ordinal",
    "day_of",
    "half_even",
    "half_up",
    "hour_start",
    "local_today",
    "pollutant_label",
    "stable_mean",
    "whole_second_now",
]
