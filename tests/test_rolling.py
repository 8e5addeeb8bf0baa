"""The windowed means against brute force, including where days are split."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vayumark.functions import half_up, hour_start
from vayumark.operators.rolling import rolling_mean

START = datetime(2025, 3, 29)


def brute_force(rows, hours):
    span = timedelta(hours=hours)
    result = {}
    for key, ts, _ in rows:
        seen = [v for k, t, v in rows if k == key and ts - span < t <= ts and v is not None]
        result[key, ts] = (sum(seen) / len(seen) if seen else None, len(seen))
    return result


def windowed(spark, rows, hours):
    df = spark.createDataFrame(rows, "city_id string, ts timestamp_ntz, v double")
    got = rolling_mean(df, ["city_id"], "ts", hours, {"v": "v"}).collect()
    assert len(got) == len(rows)
    return {(r.city_id, r.ts): (r[f"v_{hours}h_avg"], r[f"v_{hours}h_hours"]) for r in got}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, (mean, n) in want.items():
        assert got[key][1] == n
        assert got[key][0] == pytest.approx(mean) if mean is not None else got[key][0] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    minutes=st.sets(st.integers(0, 4 * 24 * 60), min_size=1, max_size=60),
    hours=st.sampled_from([1, 8, 30]),
)
def test_any_times_and_spans(spark, minutes, hours):
    rows = [
        (f"c{m % 2}", START + timedelta(minutes=m), None if m % 7 == 0 else float(m % 11))
        for m in sorted(minutes)
    ]
    assert_same(windowed(spark, rows, hours), brute_force(rows, hours))


def test_window_is_open_at_its_start_and_crosses_midnight(spark):
    rows = [("c", START + timedelta(hours=h), float(h)) for h in (16, 23, 24, 31)]
    got = windowed(spark, rows, 8)
    assert got["c", START + timedelta(hours=24)] == (23.5, 2)  # hour 16 is exactly 8 h back
    assert got["c", START + timedelta(hours=31)] == (27.5, 2)


def test_a_value_that_is_not_finite_stays_in_its_windows(spark):
    rows = [("c", START + timedelta(hours=h), float("nan") if h == 2 else 1.0) for h in range(20)]
    got = windowed(spark, rows, 8)
    for h in range(20):
        mean, n = got["c", START + timedelta(hours=h)]
        assert n == min(h + 1, 8)
        assert (mean != mean) if 2 <= h < 10 else mean == 1.0


def test_session_zone_does_not_matter(spark):
    """In this zone the hour 02:00-03:00 of 30 March does not exist."""
    rows = [("c", START + timedelta(hours=h), float(h)) for h in range(48)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert_same(windowed(spark, rows, 8), brute_force(rows, 8))
        half_past = spark.createDataFrame(
            [(START + timedelta(hours=26, minutes=30),)], "ts timestamp_ntz"
        )
        assert half_past.select(hour_start("ts")).first()[0] == START + timedelta(hours=26)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rounding_helper(spark):
    values = [0.05, 0.15, 2.25, 59.949999999999996, -0.25, None, float("nan"), 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(half_up("x", 1)).collect()]
    assert got[:6] == [0.1, 0.2, 2.3, 60.0, -0.3, None]
    assert got[6] != got[6] and got[7] == 0.0


def test_a_huge_value_leaves_no_trace(spark):
    rows = [("c", START + timedelta(hours=h), 8e36 if h == 3 else 20.0 + h % 2) for h in range(30)]
    got = windowed(spark, rows, 8)
    want = brute_force(rows, 8)
    for h in (0, 1, 2, *range(11, 30)):
        key = "c", START + timedelta(hours=h)
        assert got[key] == pytest.approx(want[key], rel=1e-12)


def test_one_exchange_by_key_and_block(spark):
    df = spark.createDataFrame([("c", START, 1.0)], "city_id string, ts timestamp_ntz, v double")
    plan = rolling_mean(df, ["city_id"], "ts", 8, {"v": "v"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(city_id") == 1 and "_block" in plan
