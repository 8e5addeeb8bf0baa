import copy
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vayumark.operators.payloads import (
    ContractError,
    contract_violations,
    flatten_payload,
    require_valid,
    split_valid,
)
from vayumark.plans.landing import ingest_payloads, land, stamp_lineage
from vayumark.sources import read_payloads, read_raw
from vayumark.streaming import arrivals

FIELDS = ["pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "carbon_monoxide"]


def document(hours: int = 24) -> dict:
    doc = {
        "latitude": 28.625,
        "longitude": 77.25,
        "generationtime_ms": 0.41,
        "timezone": "Asia/Kolkata",
        "elevation": 214.0,
        "hourly_units": {"time": "iso8601", **{name: "μg/m³" for name in FIELDS}},
        "hourly": {
            "time": [f"2025-11-01T{h:02}:00" for h in range(hours)],
            **{name: [10 * n + h for h in range(hours)] for n, name in enumerate(FIELDS, 1)},
        },
    }
    doc["hourly"]["ozone"][7] = None
    return doc


def damaged(path: tuple, value) -> dict:
    doc = copy.deepcopy(document())
    place = doc
    for step in path[:-1]:
        place = place[step]
    if value is KeyError:
        del place[path[-1]]
    else:
        place[path[-1]] = value(place[path[-1]]) if callable(value) else value
    return doc


CASES = {
    "good": (document(), []),
    "micro": (damaged(("hourly_units", "ozone"), "µg/m³"), []),
    "short": (damaged(("hourly", "sulphur_dioxide"), lambda v: v[5:]), [("sulphur_dioxide", "length")]),
    "negative": (damaged(("hourly", "nitrogen_dioxide", 17), -0.25), [("nitrogen_dioxide", "negative")]),
    "unit": (damaged(("hourly_units", "pm10"), "ppb"), [("pm10", "unit")]),
    "nounit": (damaged(("hourly_units", "pm2_5"), KeyError), [("pm2_5", "unit missing")]),
    "nocarbon": (damaged(("hourly", "carbon_monoxide"), KeyError), [("carbon_monoxide", "missing")]),
    "nozone": (damaged(("timezone",), KeyError), [("timezone", "missing")]),
    "nohourly": (damaged(("hourly",), KeyError), [("hourly", "missing")]),
    "nulltime": (damaged(("hourly", "time", 3), None), [("time", "null")]),
    "allnull": (damaged(("hourly", "ozone"), lambda v: [None] * len(v)), []),
}


@pytest.fixture(scope="module")
def payloads(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("payloads")
    for city, (doc, _) in CASES.items():
        (folder / f"city_id={city}").mkdir()
        (folder / f"city_id={city}" / "doc.json").write_text(json.dumps(doc, indent=1), "utf-8")
    return read_payloads(spark, str(folder))


def test_every_violation_is_found_and_nothing_else(payloads):
    found = {}
    for row in contract_violations(payloads).collect():
        found.setdefault(row.city_id, []).append((row.field, row.problem))
    assert found == {city: list(want) for city, (_, want) in CASES.items() if want}


def test_not_finite_values_are_rejected(spark, payloads):
    bad = payloads.filter("city_id = 'good'").selectExpr(
        "city_id", "latitude", "longitude", "timezone", "hourly_units",
        "named_struct('time', hourly.time, 'pm2_5', array_repeat(double('NaN'), 24), 'pm10', hourly.pm10, "
        "'nitrogen_dioxide', hourly.nitrogen_dioxide, 'sulphur_dioxide', hourly.sulphur_dioxide, "
        "'ozone', hourly.ozone, 'carbon_monoxide', hourly.carbon_monoxide) AS hourly",
    )
    assert [(r.field, r.problem) for r in contract_violations(bad).collect()] == [("pm2_5", "not finite")]


def test_malformed_document(spark, tmp_path):
    (tmp_path / "city_id=x").mkdir()
    (tmp_path / "city_id=x" / "doc.json").write_text('{"latitude": "north"')
    problems = {(r.field, r.problem) for r in contract_violations(read_payloads(spark, str(tmp_path))).collect()}
    assert ("document", "malformed") in problems


def test_rows_are_one_per_hour_with_renamed_columns(payloads):
    flat = flatten_payload(payloads.filter("city_id = 'good'"))
    assert flat.columns == ["city_id", "observed_at", "pm2_5", "pm10", "no2", "so2", "o3", "co"]
    rows = flat.orderBy("observed_at").collect()
    assert len(rows) == 24
    assert tuple(rows[0]) == ("good", datetime(2025, 11, 1, 0), 10.0, 20.0, 30.0, 40.0, 50.0, 60.0)
    assert rows[7].o3 is None and rows[-1].pm2_5 == 33.0


def test_one_bad_city_does_not_hide_the_others(spark, payloads, tmp_path):
    good, errors = split_valid(payloads)
    valid = {city for city, (_, want) in CASES.items() if not want}
    assert {r.city_id for r in good.select("city_id").collect()} == valid
    assert {r.city_id for r in errors.collect()} == CASES.keys() - valid

    lake = str(tmp_path / "lake")
    violations = ingest_payloads(payloads, lake, "api", "r1", strict=False)
    assert violations.count() == len(CASES) - len(valid)
    assert {r.city_id for r in read_raw(spark, lake).collect()} == valid


def test_all_failing_cities_are_quarantined(spark, payloads, tmp_path):
    bad = payloads.filter("city_id = 'negative'").drop("city_id")
    many = bad.withColumn("city_id", F.explode(F.array(*(F.lit(f"town{n}") for n in range(30)))))
    with pytest.raises(ContractError, match=f"30 violations.* 30 cities.*{tmp_path}") as failure:
        require_valid(many.select(*payloads.columns), f"{tmp_path}/bad")
    found = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert {(r.city_id, r.field) for r in found} == {(f"town{n}", "nitrogen_dioxide") for n in range(30)}
    assert failure.value.errors.count() == 30
    assert require_valid(payloads.filter("city_id = 'good'"), f"{tmp_path}/none").count() == 1


def test_strict_ingestion_lands_the_good_and_fails(spark, payloads, tmp_path):
    lake, broken = str(tmp_path / "lake"), sum(bool(want) for _, want in CASES.values())
    with pytest.raises(ContractError, match=f"{broken} violations"):
        ingest_payloads(payloads, lake, "api", "r1", quarantine=str(tmp_path / "bad"))
    assert read_raw(spark, lake).select("city_id").distinct().count() == len(CASES) - broken
    assert spark.read.parquet(str(tmp_path / "bad")).count() == broken


def test_a_document_without_a_city_is_refused(spark, payloads, tmp_path):
    nameless = payloads.filter("city_id = 'good'").withColumn("city_id", F.lit(None).cast("string"))
    assert [(r.field, r.problem) for r in contract_violations(nameless).collect()] == [("city_id", "missing")]
    lake = str(tmp_path / "lake")
    for _ in range(2):  # even unchecked, a null city is one slice
        land(stamp_lineage(flatten_payload(nameless), "api", "r1"), lake)
    assert read_raw(spark, lake).count() == 24


def test_arriving_files_are_ingested_once(spark, tmp_path, monkeypatch):
    """Two drops, the second with broken documents; then a run with nothing new."""
    inbox, lake, state = tmp_path / "inbox", str(tmp_path / "lake"), str(tmp_path / "state")

    def drop(*cities):
        for city in cities:
            (inbox / f"city_id={city}").mkdir(parents=True)
            (inbox / f"city_id={city}" / "doc.json").write_text(json.dumps(CASES[city][0]), "utf-8")

    seen, ingest = [], arrivals.ingest_payloads
    monkeypatch.setattr(arrivals, "ingest_payloads", lambda df, *a, **k: seen.append(df.count()) or ingest(df, *a, **k))
    args = (spark, str(inbox), lake, "api", state)
    drop("good", "micro")
    assert arrivals.ingest_arrivals(*args).count() == 0
    drop("allnull", "short", "nocarbon")
    with pytest.raises(ContractError, match="2 violations") as failure:
        arrivals.ingest_arrivals(*args)
    assert {(r.city_id, r.field) for r in failure.value.errors.collect()} == {("short", "sulphur_dioxide"), ("nocarbon", "carbon_monoxide")}
    assert arrivals.ingest_arrivals(*args).count() == 0
    assert seen == [2, 3]
    landed = read_raw(spark, lake).groupBy("city_id").count().collect()
    assert {(r.city_id, r["count"]) for r in landed} == {("good", 24), ("micro", 24), ("allnull", 24)}


def test_a_batch_that_failed_is_repeated_whole(spark, tmp_path, monkeypatch):
    inbox, lake, state = tmp_path / "inbox", str(tmp_path / "lake"), str(tmp_path / "state")
    for city in ("good", "micro", "unit"):
        (inbox / f"city_id={city}").mkdir(parents=True)
        (inbox / f"city_id={city}" / "doc.json").write_text(json.dumps(CASES[city][0]), "utf-8")
    args = (spark, str(inbox), lake, "api", state)
    ingest = arrivals.ingest_payloads

    def dying(*a, **k):
        ingest(*a, **k)
        raise RuntimeError("killed after landing")

    monkeypatch.setattr(arrivals, "ingest_payloads", dying)
    with pytest.raises(Exception, match="killed after landing"):
        arrivals.ingest_arrivals(*args, strict=False)
    monkeypatch.undo()
    assert [r.city_id for r in arrivals.ingest_arrivals(*args, strict=False).collect()] == ["unit"]
    assert read_raw(spark, lake).count() == 48
