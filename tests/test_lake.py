from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vayumark.operators.upsert import align_schema, conform, upsert_counts, upsert_latest
from vayumark.plans import landing
from vayumark.plans.landing import land, merge_into_lake, require_finished, stamp_lineage
from vayumark.schemas import RAW
from vayumark.sources import (
    finished_days_only,
    last_finished_days,
    open_table,
    raw_file_count,
    read_days,
    read_raw,
)

from vayumark.sources.lake import late_days, ledger

from .readings import day_rows, raw

D1, D2 = date(2025, 11, 1), date(2025, 11, 2)


def slices(spark, lake):
    rows = read_raw(spark, lake).groupBy(
        F.to_date("observed_at").alias("day"), "city_id", "run_id"
    ).count()
    return {(r.day, r.city_id, r.run_id): r["count"] for r in rows.collect()}


def test_a_load_over_midnight_fills_two_folders(spark, tmp_path):
    lake = str(tmp_path / "lake")
    assert open_table(spark, lake, RAW) is None
    night = day_rows(D1, (21, 22, 23), city="kochi") + day_rows(D2, (0, 1), city="kochi")
    land(raw(spark, night), lake)
    assert {p.name for p in (tmp_path / "lake").iterdir() if "=" in p.name} == {f"date={d.isoformat()}" for d in (D1, D2)}
    assert slices(spark, lake) == {(D1, "kochi", "t"): 3, (D2, "kochi", "t"): 2}
    assert raw_file_count(spark, lake).first().raw_files == 2
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "lake").rglob("*.parquet"))
    assert "date" not in read_raw(spark, lake).columns


def test_reload_replaces_the_slice_and_keeps_the_others(spark, tmp_path):
    lake = str(tmp_path / "lake")
    land(raw(spark, day_rows(D1) + day_rows(D2) + day_rows(D1, city="pune"), "r1"), lake)
    land(raw(spark, day_rows(D1, range(6)), "r2"), lake)
    assert slices(spark, lake) == {
        (D1, "chennai", "r2"): 6,
        (D2, "chennai", "r1"): 24,
        (D1, "pune", "r1"): 24,
    }


def test_merging_counts_what_it_adds_and_replaces(spark, tmp_path):
    lake = str(tmp_path / "lake")
    morning = raw(spark, day_rows(D2, range(7), city="kochi"), "m")
    assert merge_into_lake(morning, lake) == (7, 0)
    assert merge_into_lake(morning, lake) == (0, 7)
    wider = raw(spark, day_rows(D2, range(5, 12), city="kochi"), "w", datetime(2025, 1, 12))
    assert merge_into_lake(wider, lake) == (5, 2)
    assert merge_into_lake(raw(spark, day_rows(D2, range(6), city="kochi"), "old", datetime(2025, 1, 1)), lake) == (0, 0)
    assert slices(spark, lake) == {(D2, "kochi", "m"): 5, (D2, "kochi", "w"): 7}


def test_upsert_takes_newer_keeps_newer_and_adds(spark):
    old, new = datetime(2025, 11, 3), datetime(2025, 11, 4)
    target = raw(spark, day_rows(D1, range(3)), "t", new)
    source = (
        raw(spark, day_rows(D1, [0]), "older", old)
        .unionByName(raw(spark, day_rows(D1, [1]), "same", new))
        .unionByName(raw(spark, day_rows(D1, [2]), "null").withColumn("ingested_at", F.lit(None).cast("timestamp")))
        .unionByName(raw(spark, day_rows(D1, [3]), "first", old))
        .unionByName(raw(spark, day_rows(D1, [3]), "second", new))
    )
    got = {r.observed_at.hour: r.run_id for r in upsert_latest(target, source).collect()}
    assert got == {0: "t", 1: "same", 2: "t", 3: "second"}
    assert tuple(upsert_counts(target, source).first()) == (1, 1)


def test_read_days_skips_missing_folders(spark, tmp_path):
    lake = str(tmp_path / "lake")
    land(raw(spark, day_rows(D1) + day_rows(D2, range(5))), lake)
    assert read_days(spark, lake, [D2, date(2026, 1, 1)]).count() == 5
    assert read_days(spark, lake, [date(2026, 1, 1)]).count() == 0
    assert read_raw(spark, lake, D2).count() == 5
    plan = read_raw(spark, lake, D2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_conform_matches_by_name_ignoring_case(spark):
    df = spark.createDataFrame([("7", "x", 1)], "PM10 string, City_Id string, other int")
    row = conform(df, RAW).first()
    assert (row.city_id, row.pm10, row.pm2_5) == ("x", 7.0, None)
    with pytest.raises(ValueError, match="all match"):
        twice = spark.createDataFrame([("a", "b")], "City_Id string, other string")
        conform(twice.withColumnRenamed("other", "CITY_ID"), RAW)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(spark.createDataFrame([("abc",)], "pm10 string"), RAW).collect()


def test_align_schema_appends_and_fills(spark):
    target = spark.createDataFrame([], "a int, b string").schema
    got = align_schema(spark.createDataFrame([(1, 2.0)], "a int, c double"), target)
    assert got.columns == ["a", "b", "c"] and tuple(got.first()) == (1, None, 2.0)


def test_finished_days_follow_the_local_clock(spark):
    days = spark.createDataFrame([(date(2025, 1, d),) for d in range(1, 11)], "date date")
    evening = datetime(2025, 1, 8, 19, 0)  # 00:30 on the 9th in India
    got = [r.date.day for r in finished_days_only(days, now=evening).collect()]
    assert got == list(range(1, 9))
    assert [r.date.day for r in last_finished_days(days, 3, now=evening).collect()] == [6, 7, 8]
    require_finished(date(2025, 1, 8), spark, evening)
    with pytest.raises(ValueError, match="2025-01-09 is not a finished day"):
        require_finished(date(2025, 1, 9), spark, evening)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert finished_days_only(days, now=evening).count() == 8
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lineage_is_in_utc_and_whole_seconds(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = datetime(2025, 1, 8, 19, 0, 5, 999)
        row = (
            stamp_lineage(spark.range(1), "api", now=at)
            .selectExpr("source", "run_id", "unix_micros(ingested_at) % 1000000 AS micros")
            .first()
        )
        assert tuple(row) == ("api", "20250108T190005Z", 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def files(lake):
    """Data files of a lake by folder, with what identifies their contents."""
    return {str(p.relative_to(lake)): p.stat().st_mtime_ns for p in lake.rglob("*.parquet") if "_ledger" not in p.parts}


def test_reloading_one_of_many_cities_rewrites_its_bucket_alone(spark, tmp_path):
    lake = tmp_path / "lake"
    many = [row for n in range(300) for row in day_rows(D1, range(2), city=f"c{n}") + day_rows(D2, range(2), city=f"c{n}")]
    land(raw(spark, many, "r1"), str(lake), buckets=16)
    before = files(lake)
    assert len({f.rsplit("/", 1)[0] for f in before}) == 32
    land(raw(spark, day_rows(D2, range(3), city="c7"), "r2"), str(lake))
    after = files(lake)
    gone = {f.rsplit("/", 1)[0] for f in before.keys() - after.keys()}
    new = {f.rsplit("/", 1)[0] for f in after.keys() - before.keys()}
    assert gone == new and len(new) == 1 and next(iter(new)).startswith(f"date={D2}/bucket=")
    got = slices(spark, str(lake))
    assert len(got) == 600 and got[(D2, "c7", "r2")] == 3 and got[(D1, "c7", "r1")] == 2
    assert merge_into_lake(raw(spark, day_rows(D1, range(4), city="c9"), "m"), str(lake)) == (2, 2)
    assert len(after.keys() - files(lake).keys()) == 1
    assert set(read_raw(spark, str(lake)).columns) == set(RAW.names)
    assert read_days(spark, str(lake), [D1]).count() == 602
    with pytest.raises(ValueError, match="16 bucket"):
        land(raw(spark, many), str(lake), buckets=4)


def test_the_ledger_names_days_and_buckets_of_every_load(spark, tmp_path):
    lake = str(tmp_path / "lake")
    land(raw(spark, day_rows(D1) + day_rows(D2), "r1"), lake)
    land(raw(spark, day_rows(D1, range(6), city="pune"), "r2"), lake)
    merge_into_lake(raw(spark, day_rows(D2, range(3), city="pune"), "r3"), lake)
    rows = ledger(spark, lake).collect()
    assert {(r.date, r.run_id, r.rows, r.state) for r in rows} == {
        (D1, "r1", 24, "done"), (D2, "r1", 24, "done"), (D1, "r2", 6, "begun"), (D1, "r2", 6, "done"),
        (D2, "r3", 3, "begun"), (D2, "r3", 3, "done"),
    }
    times = {(r.run_id, r.state): r.at for r in rows}
    assert late_days(spark, lake, D2, times["r1", "done"]) == [D1]
    assert late_days(spark, lake, date(2026, 1, 1), times["r2", "done"]) == [D1, D2]
    assert late_days(spark, lake, D2, times["r3", "done"]) == []


def test_a_load_that_died_keeps_its_days_late_until_one_ends(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    land(raw(spark, day_rows(D1) + day_rows(D2), "r1"), lake)

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(landing, "_write_cells", die)
    with pytest.raises(RuntimeError, match="killed"):
        land(raw(spark, day_rows(D1), "r2"), lake)
    monkeypatch.undo()
    assert late_days(spark, lake, D2, datetime(2100, 1, 1)) == [D1]
    land(raw(spark, day_rows(D1), "r2"), lake)
    assert late_days(spark, lake, D2, datetime(2100, 1, 1)) == []


def test_a_lake_without_a_ledger_is_asked_for_write_times(spark, tmp_path):
    lake = str(tmp_path / "lake")
    placed = raw(spark, day_rows(D1) + day_rows(D2)).withColumn("date", F.to_date("observed_at"))
    placed.write.partitionBy("date").parquet(lake)
    assert late_days(spark, lake, D2, datetime(2000, 1, 1)) == [D1]
    assert late_days(spark, lake, D2, datetime(2100, 1, 1)) == []
    land(raw(spark, day_rows(D1, range(3)), "r2"), lake)
    assert slices(spark, lake) == {(D1, "chennai", "r2"): 3, (D2, "chennai", "t"): 24}


def test_rows_without_a_time_are_kept_apart_by_city(spark, tmp_path):
    lake = str(tmp_path / "lake")
    lost = raw(spark, day_rows(D1, [0]) + day_rows(D1, [1], city="pune")).withColumn("observed_at", F.lit(None).cast("timestamp_ntz"))
    land(lost, lake)
    land(lost.filter("city_id = 'pune'").withColumn("run_id", F.lit("r2")), lake)
    assert {(r.city_id, r.run_id) for r in read_raw(spark, lake).collect()} == {("chennai", "t"), ("pune", "r2")}
