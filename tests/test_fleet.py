from datetime import date

import pytest

from rivulet.operators import fleet
from rivulet.schemas import COUNTER_CACHE, DAILY_ROLLUP
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def cache(spark):
    data = [("A", 10.06, 1.0, None), ("B", 5.0, 9.0, None), ("C", 3.0, 3.0, None), ("unknown", 99.0, 0.0, None)]
    return spark.createDataFrame(data, COUNTER_CACHE)


@pytest.fixture(scope="module")
def automate(spark):
    return spark.createDataFrame([("A", "Acme"), ("B", "Acme"), ("C", None), ("D", "Beta")], "nom_automate string, client string")


def test_negative_differences_and_unknown_stations_are_left_out(cache, automate):
    assert tuple(fleet.fleet_recycled_total(cache, automate).first()) == (9.1, 2)


def test_restricted_to_organizations(spark, cache, automate):
    assert tuple(fleet.fleet_recycled_total(cache, automate, ["ACME"]).first()) == (9.1, 1)
    orgs = spark.createDataFrame([("acme",), ("Acme",)], "name string")
    assert tuple(fleet.fleet_recycled_total(cache, automate, orgs).first()) == (9.1, 1)
    assert tuple(fleet.fleet_recycled_total(cache, automate, []).first()) == (0.0, 0)
    assert tuple(fleet.fleet_recycled_total(cache, automate, orgs.limit(0)).first()) == (0.0, 0)


def test_export_filters_fills_and_sorts(spark):
    rates = [(1, 0.0), (2, 0.5), (3, 0.0), (4, None), (5, 0.0)]
    rows = [(date(2024, 1, d), s, v) for s in ("B", "A") for d, v in rates] + [(date(2024, 1, 3), "C", 0.0)]
    rollup = spark.createDataFrame(
        [tuple({"jour": d, "nom_automate": s, "taux_recyclage": v, "p1_mbar": 4}.get(f.name) for f in DAILY_ROLLUP) for d, s, v in rows],
        DAILY_ROLLUP,
    )
    columns = ["p1_mbar", "password", "taux_recyclage", "p1_mbar"]
    got = fleet.export_rollup(rollup, "daily", columns, ["A", "B"], date(2024, 1, 1), date(2024, 1, 4))
    assert got.columns == ["date", "nom_automate", "p1_mbar", "taux_recyclage"]
    assert [tuple(r) for r in got.collect()] == [
        (date(2024, 1, d), s, 4, v) for d, v in ((1, 0.5), (2, 0.5), (3, 0.5), (4, None)) for s in ("A", "B")
    ]
    everything = fleet.export_rollup(rollup, "daily", ["p1_mbar"], None)
    assert len(rows_of(everything, "date", "nom_automate")) == 11


def test_export_refuses_empty_requests(spark):
    rollup = spark.createDataFrame([], DAILY_ROLLUP)
    with pytest.raises(ValueError):
        fleet.export_rollup(rollup, "daily", ["password"], ["A"])
    with pytest.raises(ValueError):
        fleet.export_rollup(rollup, "daily", ["p1_mbar"], [])
