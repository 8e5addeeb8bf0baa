"""Rounding that gives the same answer whatever order the rows were summed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimals kept by `stable_mean`: far below any sensor's resolution and far above
# the noise (about 1e-12) that summing doubles in another order can leave.
MEAN_DECIMALS = 9


def stable_mean(value: str) -> Column:
    """Mean without the last-bit noise of floating-point summation.

    A shuffle delivers partial sums in any order, so two runs over the same rows
    may differ in the last bits of ``avg``; a later rounding to one decimal would
    turn that into a visible difference. Snapping to nine decimals removes it.
    """
    return F.expr(f"round(avg({value}), {MEAN_DECIMALS})")


def half_up(value: str, decimals: int) -> Column:
    """Round a column half away from zero to ``decimals`` places, scaling in binary.

    ``round`` works on the shortest decimal text of a double, which disagrees
    with engines that scale and round; this form agrees with them.
    """
    scale = float(10**decimals)
    magnitude = f"floor(abs({value}) * {scale}D + 0.5D) / {scale}D"
    return F.expr(
        f"CASE WHEN isnan({value}) THEN {value} "
        f"WHEN {value} < 0 THEN -({magnitude}) ELSE {magnitude} END"
    )


def half_even(value: str) -> Column:
    """Banker's rounding of an expression to an integer."""
    return F.expr(f"CAST(bround({value}, 0) AS int)")
