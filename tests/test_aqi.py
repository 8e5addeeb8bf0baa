from datetime import date

import pytest
from pyspark.sql import functions as F

from vayumark.operators.aqi import daily_aqi, per_day, sub_indices, unpivot_pollutants
from vayumark.operators.daily import daily_averages, daily_rolling_max, pollutant_daily, rolling_8h
from vayumark.operators.staging import stage_hourly
from vayumark.sources import read_breakpoints, read_cities

from .readings import day_rows, raw


# one day with every pollutant in another band, one with a gap of nine hours, one off the scale
FULL, GAPPY, SMOKE = date(2024, 6, 3), date(2024, 6, 4), date(2024, 6, 5)
MIXED = {"pm2_5": 105.0, "pm10": 175.0, "no2": 60.0, "so2": 240.0, "o3": 25.0, "co": 6000.0}


@pytest.fixture(scope="module")
def hourly(spark):
    rows = (
        day_rows(FULL, city="kochi", **MIXED)
        + day_rows(GAPPY, [*range(6), *range(15, 24)], city="kochi")
        + day_rows(SMOKE, city="kochi", **{**MIXED, "pm10": 800.0})
    )
    return stage_hourly(raw(spark, rows))


@pytest.fixture(scope="module")
def fact(spark, hourly):
    rows = daily_aqi(pollutant_daily(hourly), read_breakpoints(spark)).collect()
    return {row.observed_date: row for row in rows}


def test_every_pollutant_is_placed_in_its_band(fact):
    row = fact[FULL]
    # halfway through Poor, Moderate and so on; CO is 6 mg/m3 between 2 and 10
    assert (row.pm2_5_sub_index, row.pm10_sub_index, row.no2_sub_index) == (250, 150, 75)
    assert (row.so2_sub_index, row.o3_sub_index, row.co_sub_index) == (153, 25, 150)
    assert (row.aqi, row.dominant_pollutant, row.aqi_category) == (250, "pm2_5", "Poor")
    assert row.daily_aqi_id == "kochi|2024-06-03" and row.pollutants_used == 6
    assert row.aqi_change_vs_prev_day is None and row.aqi_7d_avg == 250.0


def test_a_day_with_fifteen_hours_has_no_index(fact):
    row = fact[GAPPY]
    assert row.hours_reported == 15 and not row.is_aqi_valid
    assert (row.aqi, row.aqi_category, row.dominant_pollutant) == (None, None, None)
    # its eight-hour values still count, its means do not
    assert row.o3_sub_index is not None and row.pm10_sub_index is None
    assert fact[SMOKE].aqi_change_vs_prev_day is None


def test_smoke_off_the_scale_stays_on_top_of_it(fact):
    row = fact[SMOKE]
    assert (row.pm10_sub_index, row.aqi, row.dominant_pollutant) == (500, 500, "pm10")
    assert row.aqi_category == "Severe" and row.aqi_7d_avg == 375.0


def one_value(spark, pollutant, value, valid=True):
    return spark.createDataFrame(
        [("c", date(2025, 1, 1), pollutant, value, valid)],
        "city_id string, observed_date date, pollutant string, value double, is_valid boolean",
    )


@pytest.mark.parametrize(
    ("value", "expected"),
    [(0.0, [0]), (29.99, [50]), (30.0, [50]), (60.0, [100]), (380.0, [500]), (9999.0, [500]), (-1.0, [])],
)
def test_band_edges(spark, value, expected):
    found = sub_indices(one_value(spark, "pm2_5", value), read_breakpoints(spark)).collect()
    assert [row.sub_index for row in found] == expected


def test_unusable_values_have_no_sub_index(spark):
    bands = read_breakpoints(spark)
    assert sub_indices(one_value(spark, "pm10", 40.0, False), bands).isEmpty()
    assert sub_indices(one_value(spark, "pm10", None), bands).isEmpty()


def test_ties_go_to_the_fixed_order(spark):
    day = date(2025, 1, 1)
    order = ["pm2_5", "pm10", "no2", "o3", "so2", "co"]
    rows = [
        (f"{winner}", day, pollutant, 114)
        for n, winner in enumerate(order)
        for pollutant in reversed(order[n:])
    ]
    sub = spark.createDataFrame(
        rows, "city_id string, observed_date date, pollutant string, sub_index int"
    )
    for row in per_day(sub).collect():
        assert row.top_pollutant == row.city_id


def test_too_few_pollutants_or_no_particulate_is_invalid(spark):
    bands = read_breakpoints(spark)
    gone = dict(pm2_5=None, pm10=None)
    rows = day_rows(date(2025, 1, 1), city="gas", **gone) + day_rows(
        date(2025, 1, 1), city="two", no2=None, so2=None, o3=None, co=None
    )
    fact = daily_aqi(pollutant_daily(stage_hourly(raw(spark, rows))), bands)
    got = {r.city_id: (r.pollutants_used, r.is_aqi_valid, r.aqi) for r in fact.collect()}
    assert got == {"gas": (4, False, None), "two": (2, False, None)}


def test_one_pass_equals_the_separate_steps(spark, hourly):
    bands = read_breakpoints(spark)
    daily = pollutant_daily(hourly)
    parts = daily_averages(hourly).join(
        daily_rolling_max(rolling_8h(hourly)), ["city_id", "observed_date"], "left"
    )
    assert daily.exceptAll(parts.select(*daily.columns)).isEmpty()
    assert parts.select(*daily.columns).exceptAll(daily).isEmpty()

    rolled = per_day(sub_indices(unpivot_pollutants(daily), bands))
    fact = daily_aqi(daily, bands)
    columns = ["city_id", "observed_date", "pm10_sub_index", "pollutants_used"]
    used = fact.filter(F.col("pollutants_used") > 0)
    assert used.select(*columns).exceptAll(rolled.select(*columns)).isEmpty()


def test_lookup_tables(spark, tmp_path):
    assert read_cities(spark).count() == 10
    bands = read_breakpoints(spark)
    assert bands.count() == 36
    bands.toPandas().to_csv(tmp_path / "bands.csv", index=False)
    again = read_breakpoints(spark, str(tmp_path / "bands.csv"))
    assert again.exceptAll(bands).isEmpty() and bands.exceptAll(again).isEmpty()
