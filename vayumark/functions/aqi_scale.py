"""The published AQI scale: categories, their limits and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category and the highest index it covers, in rising order.
CATEGORY_LIMITS = (
    ("Good", 50),
    ("Satisfactory", 100),
    ("Moderate", 200),
    ("Poor", 300),
    ("Very Poor", 400),
)
TOP_CATEGORY = "Severe"
CATEGORIES = (*(name for name, _ in CATEGORY_LIMITS), TOP_CATEGORY)

# At equal sub-index the pollutant listed first is the dominant one.
DOMINANCE_ORDER = ("pm2_5", "pm10", "no2", "o3", "so2", "co")

# How pollutants are written on a report.
POLLUTANT_LABELS = {
    "pm2_5": "PM2.5",
    "pm10": "PM10",
    "no2": "NO₂",
    "so2": "SO₂",
    "o3": "O₃",
    "co": "CO",
}
NO_LABEL = "–"


def _sql_array(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def aqi_category(aqi: str) -> Column:
    """Category of an index expression; null for a null index."""
    steps = " ".join(f"WHEN {aqi} <= {top} THEN '{name}'" for name, top in CATEGORY_LIMITS)
    return F.expr(f"CASE WHEN {aqi} IS NULL THEN NULL {steps} ELSE '{TOP_CATEGORY}' END")


def category_ordinal(category: str) -> Column:
    """Position of a category column on the scale, 0 to 5; null if there is none."""
    position = f"array_position({_sql_array(CATEGORIES)}, {category})"
    return F.expr(f"CAST(nullif({position}, 0) AS int) - 1")


def pollutant_label(pollutant: str) -> Column:
    """Display label of a pollutant column; a dash if there is none."""
    steps = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in POLLUTANT_LABELS.items())
    return F.expr(f"CASE {pollutant} {steps} ELSE '{NO_LABEL}' END")


# position in this array is the rank among equal sub-indices, 1 the lowest
_BY_RANK = _sql_array(tuple(reversed(DOMINANCE_ORDER)))


def top_pollutant(sub_index: str, pollutant: str) -> Column:
    """Aggregate: the pollutant of the highest sub-index, ties by dominance.

    Index and rank are packed into one integer, so the aggregation keeps a
    fixed-width buffer and stays a hash aggregation.
    """
    packed = f"max({sub_index} * 10 + CAST(array_position({_BY_RANK}, {pollutant}) AS int))"
    return F.expr(f"try_element_at({_BY_RANK}, {packed} % 10)")
