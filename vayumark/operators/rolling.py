"""Trailing means over a span of time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_of


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    hours: int,
    columns: Mapping[str, str],
    day: str = "window_day",
) -> DataFrame:
    """Mean and non-null count over ``(t - hours, t]`` for every row.

    ``columns`` maps an output prefix to an input column; results are named
    ``<prefix>_<hours>h_avg`` and ``<prefix>_<hours>h_hours``, the calendar day of
    a row ``day``.

    Time is cut into blocks of ``hours``. A window is the head of its own block up
    to ``t`` and the tail of the block before, later than ``t - hours``. Each row is
    handed to its own block and, ``hours`` later, to the next one; there heads are
    a frame that grows forwards and tails one that grows backwards. So gaps are
    exact without a self-join, the work is linear in the rows however many fall
    into one window, and a value leaves no trace in windows that do not hold it,
    because nothing is ever subtracted.

    There is one exchange, by keys and block: one key with a long history is spread
    over as many groups as it has blocks. Values that are not finite turn the
    windows that hold them into NaN and no others.
    """
    span = hours * 3_600_000_000
    # read off the wall clock, so the session's time zone has no part in it
    micros = F.expr(
        f"datediff(CAST({ts} AS date), DATE'1970-01-01') * 86400000000L + hour({ts}) * 3600000000L"
        f" + minute({ts}) * 60000000L + CAST(extract(SECOND FROM {ts}) * 1000000 AS bigint)"
    )
    roles = F.explode(
        F.array(
            F.struct(F.lit(True).alias("own"), micros.alias("at")),
            F.struct(F.lit(False).alias("own"), (micros + span).alias("at")),
        )
    )
    placed = (
        df.withColumn("_r", roles)
        .withColumns({"_own": F.col("_r.own"), "_at": F.col("_r.at")})
        .withColumn("_block", F.expr(f"(_at - pmod(_at, {span})) div {span}"))
        .drop("_r")
    )
    group = f"partition by {', '.join([*keys, '_block'])}"
    head = f"({group} order by _at range between unbounded preceding and current row)"
    tail = f"({group} order by _at desc range between unbounded preceding and 1 preceding)"
    totals, results = {}, {}
    for prefix, column in columns.items():
        value = f"CAST({column} AS double)"
        value = f"CASE WHEN isnan({value}) OR abs({value}) = double('Infinity') THEN double('NaN') ELSE {value} END"
        count, total = f"{prefix}_{hours}h_hours", f"_{prefix}_sum"
        frames = (("_own", head), ("NOT _own", tail))
        totals[count] = F.expr(" + ".join(f"count(CASE WHEN {role} THEN {column} END) over {w}" for role, w in frames))
        totals[total] = F.expr(
            " + ".join(f"coalesce(sum(CASE WHEN {role} THEN {value} END) over {w}, 0D)" for role, w in frames)
        )
        results[f"{prefix}_{hours}h_avg"] = F.expr(f"CASE WHEN {count} > 0 THEN {total} / {count} END")
    own = placed.withColumns(totals).filter("_own").withColumns({**results, day: day_of(ts)})
    return own.drop("_own", "_at", "_block", *(c for c in totals if c.startswith("_")))
