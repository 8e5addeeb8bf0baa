"""One key holding a third of the rows: results stay whole and right."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from vayumark.operators.daily import daily_averages, rolling_8h
from vayumark.operators.quality import check_relationships, check_unique
from vayumark.operators.staging import stage_hourly
from vayumark.operators.upsert import upsert_counts, upsert_latest
from vayumark.schemas import RAW

ROWS = 30_000


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """A third copies of one reading, a third one city every 20 s, a third spread."""
    ids = spark.range(ROWS)
    rows = ids.selectExpr(
        "CASE id % 3 WHEN 0 THEN 'copy' WHEN 1 THEN 'busy' ELSE concat('c', id % 50) END AS city_id",
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, CASE id % 3 WHEN 0 THEN 0 "
        "WHEN 1 THEN (id - 1) / 3 * 20 ELSE (id div 50) * 3600 END) AS observed_at",
        "(id * 7 % 101) / 2 AS pm2_5",
        "(id * 11 % 97) / 2 AS pm10",
        "CAST(NULL AS double) AS no2",
        "1.0D AS so2",
        "CASE WHEN id % 5 > 0 THEN (id * 13 % 89) / 4 END AS o3",
        "(id * 17 % 83) * 8.0D AS co",
        "'made' AS source",
        "timestamp_seconds(1735689600 + id % 1000) AS ingested_at",
        "lpad(CAST(id AS string), 6, '0') AS run_id",
    )
    path = str(tmp_path_factory.mktemp("skew") / "raw")
    rows.write.parquet(path)
    return spark.read.schema(RAW).parquet(path), path


@pytest.fixture(scope="module")
def con(raw):
    con = duckdb.connect()
    con.execute(
        f"""CREATE TABLE hourly AS
        SELECT city_id, observed_at, pm2_5, o3, co / 1000.0 AS co_mg_m3, run_id FROM '{raw[1]}/*.parquet'
        QUALIFY row_number() OVER (PARTITION BY city_id, observed_at
                                   ORDER BY ingested_at DESC, run_id DESC) = 1"""
    )
    return con


def compare(df, rows):
    assert sorted(tuple(r) for r in df.collect()) == sorted(rows)


def test_one_copy_is_left_and_it_is_the_newest(raw, con):
    staged = stage_hourly(raw[0]).select("city_id", "observed_at", "run_id")
    compare(staged, con.execute("SELECT city_id, observed_at, run_id FROM hourly").fetchall())


def test_windows_of_a_busy_city(raw, con):
    columns = ["city_id", "observed_at", "o3_8h_avg", "o3_8h_hours", "co_8h_avg"]
    got = {tuple(r)[:2]: tuple(r)[2:] for r in rolling_8h(stage_hourly(raw[0])).select(*columns).collect()}
    want = con.execute(
        """SELECT h.city_id, h.observed_at, avg(w.o3), count(w.o3), avg(w.co_mg_m3)
        FROM hourly h JOIN hourly w ON w.city_id = h.city_id
         AND w.observed_at <= h.observed_at AND w.observed_at > h.observed_at - INTERVAL 8 HOUR
        GROUP BY h.city_id, h.observed_at"""
    ).fetchall()
    assert len(got) == len(want)
    for city, hour, o3, n, co in want:
        found = got[city, hour]
        assert found[1] == n
        # sums are taken in another order: equal up to the last digits
        assert (found[0] is None) == (o3 is None)
        assert o3 is None or abs(found[0] - o3) < 1e-9
        assert abs(found[2] - co) < 1e-9


def test_a_busy_city_is_spread_over_its_days(raw):
    """No shuffle of the windows or the daily means is by city alone."""
    plan = rolling_8h(stage_hourly(raw[0]))._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2
    assert all("observed_" in line or "_block" in line for line in shuffles)
    assert daily_averages(stage_hourly(raw[0])).filter("city_id = 'busy'").count() == 3


def test_checks_on_a_hot_key(spark, raw):
    rows = raw[0]
    assert check_unique(rows.filter("city_id = 'copy'"), "city_id").first().n == ROWS // 3
    known = rows.filter("city_id LIKE 'c%'").select("city_id").distinct()
    unknown = check_relationships(rows, known, "city_id").collect()
    assert [tuple(r) for r in unknown] == [("busy", ROWS // 3)]


def test_upsert_of_many_copies(spark, raw):
    rows = raw[0]
    target = spark.createDataFrame(
        [("copy", datetime(2025, 1, 1))], "city_id string, observed_at timestamp_ntz"
    )
    missing = [c for c in RAW.names if c not in target.columns]
    target = target.select("*", *(F.lit(None).cast(RAW[c].dataType).alias(c) for c in missing))
    target = target.withColumn("ingested_at", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    merged = upsert_latest(target, rows)
    keys = rows.select("city_id", "observed_at").distinct().count()
    assert merged.count() == keys
    assert merged.filter("city_id = 'copy'").count() == 1
    assert tuple(upsert_counts(target, rows).first()) == (keys - 1, 1)
