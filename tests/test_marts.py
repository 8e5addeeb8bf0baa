from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from vayumark.operators.aqi import daily_aqi
from vayumark.operators.daily import pollutant_daily
from vayumark.operators.marts import city_summary, dim_city, global_rank, latest_per_city, level_shifts
from vayumark.operators.staging import stage_hourly
from vayumark.plans import report
from vayumark.sources import read_breakpoints, read_cities

from .readings import patterned, raw

STEP = date(2024, 7, 20)


def facts(spark, rows):
    """(city, day, aqi, category, dominant) -> a fact with the columns marts need."""
    df = spark.createDataFrame(
        rows,
        "city_id string, observed_date date, aqi int, aqi_category string, dominant_pollutant string",
    )
    return df.withColumn("is_aqi_valid", F.col("aqi").isNotNull()).withColumn(
        "aqi_7d_avg", F.lit(1.5)
    )


@pytest.fixture(scope="module")
def summary_inputs(spark):
    last = date(2025, 2, 28)
    rows = []
    for back in range(40):
        day = last - timedelta(days=back)
        rows.append(("chennai", day, 150 + back, "Moderate", "pm2_5" if back % 2 else "pm10"))
        if back >= 5:
            rows.append(("pune", day, 80, "Satisfactory", "o3"))
    rows.append(("mumbai", last - timedelta(days=35), 250, "Poor", "no2"))
    rows.append(("patna", last + timedelta(days=1), None, None, None))
    return facts(spark, rows), dim_city(read_cities(spark))


def test_summary(summary_inputs):
    fact, dim = summary_inputs
    got = {r.city_id: r for r in city_summary(fact, dim).collect()}
    assert len(got) == 10
    chennai, pune, mumbai, patna = (got[c] for c in ("chennai", "pune", "mumbai", "patna"))
    # the window ends at the newest valid date, for every city
    assert (chennai.days_measured, pune.days_measured) == (30, 25)
    assert (chennai.avg_aqi_30d, chennai.worst_aqi_30d, chennai.best_aqi_30d) == (165, 179, 150)
    # 15 days each: the tie goes to the smaller name
    assert chennai.usual_dominant_pollutant == "pm10"
    assert (chennai.good_or_satisfactory_days, chennai.poor_or_worse_days) == (0, 0)
    assert (chennai.latest_aqi, chennai.latest_date) == (150, date(2025, 2, 28))
    assert (pune.good_or_satisfactory_days, pune.pollution_rank_30d) == (25, 2)
    # latest looks at all history, statistics only at the window
    assert (mumbai.latest_aqi, mumbai.days_measured, mumbai.avg_aqi_30d) == (250, None, None)
    assert mumbai.good_or_satisfactory_days is None and mumbai.usual_dominant_pollutant is None
    assert patna.latest_aqi is None
    assert chennai.pollution_rank_30d == 1
    assert {got[c].pollution_rank_30d for c in got if c not in ("chennai", "pune")} == {3}


def test_latest_agrees_with_summary(summary_inputs):
    fact, dim = summary_inputs
    columns = ["city_id", "latest_aqi", "latest_category", "latest_date"]
    measured = city_summary(fact, dim).filter("latest_aqi IS NOT NULL").select(*columns)
    assert measured.exceptAll(latest_per_city(fact).select(*columns)).isEmpty()


def test_rank_shares_ties_and_puts_null_last(spark):
    df = spark.createDataFrame([(5,), (9,), (9,), (None,), (1,), (None,)], "v int")
    got = sorted((-1 if r.v is None else r.v, r.place) for r in global_rank(df, "v", "place").collect())
    assert got == [(-1, 5), (-1, 5), (1, 4), (5, 3), (9, 1), (9, 1)]


def test_a_fall_is_found_among_steady_cities(spark):
    first, last = STEP - timedelta(days=24), STEP + timedelta(days=20)
    rows = patterned("kochi", 210.0, first, STEP - timedelta(days=1)) + patterned("kochi", 95.0, STEP, last)
    rows += patterned("surat", 45.0, first, last)
    fact = daily_aqi(pollutant_daily(stage_hourly(raw(spark, rows))), read_breakpoints(spark))
    (flag,) = level_shifts(fact).collect()
    assert flag.city_id == "kochi" and flag.direction == "down" and flag.shift_aqi <= -50
    assert STEP - timedelta(days=1) <= flag.shift_date <= STEP + timedelta(days=1)
    assert flag.level_shift_id == f"kochi|{flag.shift_date.isoformat()}"
    assert flag.after_avg_aqi - flag.before_avg_aqi == pytest.approx(flag.shift_aqi, abs=1)


def test_shifts_need_rows_on_both_sides_and_skip_invalid_days(spark):
    days = [date(2025, 1, 1) + timedelta(days=n) for n in range(40)]
    levels = [100 if n < 20 else 200 for n in range(40)]
    # invalid days in between do not count as rows
    rows = [("a", d, v, "x", "pm10") for d, v in zip(days, levels)]
    rows += [("a", d + timedelta(days=100), None, None, None) for d in days]
    # only nine days before the step: never flagged
    rows += [("b", d, 100 if n < 9 else 300, "x", "pm10") for n, d in enumerate(days)]
    got = level_shifts(facts(spark, rows)).collect()
    assert [(r.city_id, r.shift_date, r.shift_aqi) for r in got if r.city_id == "a"] == [
        ("a", days[20], 100)
    ]
    assert all(r.shift_date >= days[10] for r in got)


# two pairs six days apart, then a row of four over five days
SHIFT_ROWS = [
    ("2023-03-01", "Kochi", 40, 101, 61),
    ("2023-03-03", "Surat", 61, 130, 69),
    ("2023-03-09", "Kochi", 101, 43, -58),
    ("2023-11-20", "Agra", 220, 300, 80),
    ("2023-11-21", "Kochi", 44, 120, 76),
    ("2023-11-24", "Surat", 66, 140, 74),
    ("2023-11-24", "Gaya", 91, 155, 64),
]


@pytest.fixture
def shifts(spark):
    return spark.createDataFrame(
        SHIFT_ROWS,
        "shift_date string, city_name string, before_avg_aqi int, after_avg_aqi int, shift_aqi int",
    )


def test_rows_of_shifts_become_groups(shifts):
    got = {r.group_date: r for r in report.shift_groups(shifts).collect()}
    # 50.5 and 115.5 go to the even neighbour; (220 + 44 + 66 + 91) / 4 = 105.25
    assert {d: (r.shifts, r.before, r.after) for d, r in got.items()} == {
        "2023-03-01": (2, 50, 116),
        "2023-03-09": (1, 101, 43),
        "2023-11-20": (4, 105, 179),
    }
    causes = [got[d].likely_cause.split()[0] for d in sorted(got)]
    assert causes == ["Single", "Single", "Several"]
    last = report.shift_group_members(shifts).filter("group_date > '2023-11'").collect()
    assert sorted(r.city_name for r in last) == ["Agra", "Gaya", "Kochi", "Surat"]


@pytest.mark.parametrize(("gap", "groups"), [(3, 1), (4, 2)])
def test_a_gap_of_three_days_still_joins(spark, gap, groups):
    rows = [(date(2026, 1, 1), 1, 2), (date(2026, 1, 1) + timedelta(days=gap), 2, 4)]
    df = spark.createDataFrame(rows, "shift_date date, before_avg_aqi int, after_avg_aqi int")
    got = report.shift_groups(df)
    assert got.count() == groups
    if groups == 1:  # 1.5 and 3.0: half goes to even
        assert tuple(got.select("before", "after").first()) == (2, 3)


def test_groups_per_city(spark):
    rows = [("a", date(2026, 1, 1), 1, 2), ("b", date(2026, 1, 2), 2, 4), ("a", date(2026, 1, 9), 5, 5)]
    df = spark.createDataFrame(rows, "city_id string, shift_date date, before_avg_aqi int, after_avg_aqi int")
    got = {(r.city_id, r.group_date) for r in report.shift_groups(df, by=["city_id"]).collect()}
    assert got == {("a", "2026-01-01"), ("b", "2026-01-02"), ("a", "2026-01-09")}


def test_report_data_sets(spark, summary_inputs):
    fact, dim = summary_inputs
    summary = city_summary(fact, dim)
    daily = report.recent_daily(fact, dim, days=10)
    # ten days up to the newest of all facts, valid or not
    assert daily.agg(F.min("d"), F.max("d")).first() == ("2025-02-20", "2025-03-01")
    assert report.kpi_worst(summary).first().city_name == "Chennai"
    assert report.kpi_cleanest(summary).first().city_name == "Pune"
    stats = spark.createDataFrame([(4,)], "cities bigint")
    assert tuple(report.kpi_poor_cities(summary, stats).first()) == (1, 4)
    dominant = {r.city_id: r.dominant_pollutant for r in report.latest_dominant(daily).collect()}
    assert dominant == {"chennai": "pm10", "pune": "o3"}
    bars = [(r.city_name, r.dominant_label) for r in report.latest_bars(summary, daily).collect()]
    assert bars == [("Pune", "O₃"), ("Chennai", "PM10"), ("Mumbai", "–")]
    cells = {(r.city_name, r.d): r.category_ordinal for r in report.heatmap(daily).collect()}
    assert cells["Chennai", "2025-02-28"] == 2 and cells["Patna", "2025-03-01"] is None


def test_zero_counts_as_not_measured_for_the_cleanest(spark):
    rows = [("chennai", date(2025, 1, 1), 0, "Good", "co"), ("pune", date(2025, 1, 1), 7, "Good", "co")]
    summary = city_summary(facts(spark, rows), dim_city(read_cities(spark)))
    assert report.kpi_cleanest(summary).first().city_name == "Pune"


def test_history_stats(spark):
    rows = patterned("chennai", 50.0, date(2025, 1, 1), date(2025, 1, 2)) + patterned(
        "pune", 50.0, date(2025, 1, 2), date(2025, 1, 5)
    )
    hourly = stage_hourly(raw(spark, rows))
    got = report.history_stats(hourly).first()
    assert tuple(got) == (144, 2, date(2025, 1, 1), date(2025, 1, 5), 5, 0)
    made_up = hourly.withColumn("source", F.lit("synthetic_sample"))
    assert report.history_stats(made_up).first().has_synthetic == 1
    assert report.history_labels(report.history_stats(hourly)).first().first_day == "01 Jan 2025"
