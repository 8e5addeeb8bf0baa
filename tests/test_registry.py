"""Registered queries against their SQL, and the promises about their plans."""

import inspect

import pytest

import __spark_entry__ as contract
from workloads.oracles import ORACLES
from workloads.queries import REGISTRY
from vayumark.operators import aqi, daily, marts, staging
from vayumark.sources import read_breakpoints
from workloads import adapters

from .compare import connect, spark_result, sql_result

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert REGISTRY.keys() == ORACLES.keys()
    assert REGISTRY.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    got = spark_result(contract.queries()[name](spark, SF_DIR))
    assert got == sql_result(con, contract.oracle_sql()[name])


def test_entry_carries_real_indices(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 30 and any(row.aqi is not None for row in rows)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fact_plan(spark) -> str:
    hourly = staging.stage_hourly(adapters.raw_hourly(spark, SF_DIR))
    return plan(aqi.daily_aqi(daily.pollutant_daily(hourly), read_breakpoints(spark)))


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(staging.stage_hourly(adapters.raw_copies(spark, SF_DIR)))
    lines = [line for line in text.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    kinds = ["limit " + line.rsplit(" ", 1)[1] if "Limit" in line else "exchange" for line in lines]
    assert kinds == ["limit Final", "exchange", "limit Partial"]


def test_fact_is_one_pass_over_its_input(spark):
    text = fact_plan(spark)
    assert text.count("FileScan") == 1
    # source hours, copies, blocks of hours, city days, trend: no other shuffle and no join but the bands'
    assert text.count("Exchange hashpartitioning") == 5
    assert text.count("Join") == 1 and "BroadcastHashJoin" in text
    assert "SortAggregate" not in text and "PythonUDF" not in text


def test_no_query_uses_a_product_or_python_rows(spark):
    fact = contract.queries()["latest_per_city"]
    for name in ("city_summary", "level_shifts", "shift_groups", "recent_daily", "upsert_latest"):
        text = plan(contract.queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text
    assert inspect.isfunction(fact)


def test_without_broadcast_the_results_stay(spark, con):
    """The band join has a shuffled form for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = fact_plan(spark)
        assert "BroadcastHashJoin" not in text
        assert "hashpartitioning(pollutant" not in text or "pmod(hash(city_id" in text.split("hashpartitioning(pollutant")[1].split("\n")[0]
        for name in ("daily_aqi", "city_summary"):
            got = spark_result(contract.queries()[name](spark, SF_DIR))
            assert got == sql_result(con, contract.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_summary_does_not_order_all_cities_in_one_task(spark):
    text = plan(marts.global_rank(spark.range(10), "id", "place"))
    assert "Window [" in text and "SinglePartition" not in text
