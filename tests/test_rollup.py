from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivulet.operators import hourly, rollup
from rivulet.plans.inputs import AS_OF, AS_OF_LONG, load_input
from rivulet.schemas import DAILY_ROLLUP, MONTHLY_ROLLUP, WEEKLY_ROLLUP
from tests.conftest import rows_of

R, AD, KWH = "compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3", "compteur_electrique_kwh"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def universe(spark):
    return spark.createDataFrame([("A",), ("Z",)], "nom_automate string")


def by_key(df, bucket):
    return {(r["nom_automate"], r[bucket]): r for r in df.collect()}


def test_daily(readings, universe):
    df = readings(
        {"horodatage": "2024-01-23 22:30", R: 1.0},  # 23:30 in Paris, before the window
        {"horodatage": "2024-01-23 23:10", R: 5.0, AD: 1.0, "ph": 700, "chlore_mv": 10},  # 24th in Paris
        {"horodatage": "2024-01-24 12:00", R: 9.0, AD: 2.0, "ph": 705, "temperature_deg": 125, "pression1_mbar": 1},
        {"horodatage": "2024-01-24 12:10", "pression1_mbar": 2, "chlore_mv": 11},
        {"horodatage": "2024-01-25 12:00", R: 10.0, AD: 9.0, KWH: 3.0},  # previous counters were null
        {"horodatage": "2024-01-25 12:01", R: 11.0, AD: 20.0, KWH: 3.456},
        {"horodatage": "2024-01-30 23:00", R: 99.0},  # 31st in Paris: not a full day
    )
    got = by_key(rollup.rollup_daily(df, universe, AS_OF), "jour")
    assert len(got) == 14
    first = got["A", date(2024, 1, 24)]
    assert (first["vol_renvoi_m3"], first["vol_adoucie_m3"], first["taux_recyclage"]) == (4.0, 1.0, 0.75)
    assert (first["ph_moyen"], first["temp_moy_c"], first["p1_mbar"]) == (7.03, 12.5, 2)
    assert (first["chlore_moy_mg_l"], first["taux_desinfection"]) == (10.5, 3.5)
    second = got["A", date(2024, 1, 25)]
    assert (second["vol_renvoi_m3"], second["vol_adoucie_m3"], second["taux_recyclage"]) == (1.0, 11.0, 0.0)
    assert second["conso_kwh"] == 0.46
    empty = got["Z", date(2024, 1, 30)]
    assert [empty[c] for c in ("vol_renvoi_m3", "taux_desinfection", "chlore_moy_mg_l", "conso_kwh")] == [0.0] * 4
    assert [empty[c] for c in ("ph_moyen", "temp_moy_c", "p1_mbar")] == [None] * 3
    assert empty["taux_recyclage"] == 0.0
    looking_back = by_key(rollup.rollup_daily(df, universe, AS_OF, lookback_buckets=1), "jour")
    assert looking_back["A", date(2024, 1, 24)]["vol_renvoi_m3"] == 8.0
    assert len(looking_back) == 14


def test_weekly_first_week_gap_and_lookback(readings, universe):
    df = readings(
        {"horodatage": "2024-01-03 12:00", R: 10.0},
        {"horodatage": "2024-01-10 12:00", R: 15.5, AD: 1.0, "ph": 700, "chlore_mv": 3},
        {"horodatage": "2024-01-11 12:00", R: 12.0, "ph": 801, "chlore_mv": 4, "temperature_deg": 201},
        {"horodatage": "2024-01-29 12:00", R: 20.25, AD: 4.0, "pression3_mbar": 7},  # two weeks without readings
    )
    weeks = by_key(rollup.rollup_weekly(df, universe, AS_OF), "semaine_debut")
    assert len(weeks) == 8
    assert weeks["A", date(2024, 1, 8)]["vol_renvoi_m3"] == 0.0
    assert weeks["A", date(2024, 1, 15)]["vol_renvoi_m3"] == 0.0
    last = weeks["A", date(2024, 1, 29)]
    assert (last["vol_renvoi_m3"], last["vol_adoucie_m3"], last["p3_mbar"], last["ph_med"]) == (4.75, 3.0, 7, None)
    assert last["taux_recyclage"] == pytest.approx(1.75 / 4.75)
    first = weeks["A", date(2024, 1, 8)]
    assert (first["ph_moyen"], first["ph_med"], first["taux_desinfection_med"]) == (7.51, 7.51, 1.17)
    assert (first["temp_moy_c"], first["temp_med_c"], first["chlore_med_mg_l"]) == (20.1, 20.1, 3.5)
    corrected = by_key(rollup.rollup_weekly(df, universe, AS_OF, lookback_buckets=1), "semaine_debut")
    assert corrected["A", date(2024, 1, 8)]["vol_renvoi_m3"] == 5.5
    assert len(corrected) == 8


def test_monthly_is_sparse_and_reads_one_month_more(readings):
    df = readings(
        {"horodatage": "2001-02-10 00:00", R: 10.0},
        {"horodatage": "2001-03-31 21:59", R: 14.0},
        {"horodatage": "2001-03-31 22:30", R: 20.0},  # April in Paris
        {"horodatage": "2001-08-31 21:00", R: 21.0},
        {"horodatage": "2001-08-31 22:00", R: 50.0},  # September in Paris
    )
    months = by_key(rollup.rollup_monthly(df, AS_OF_LONG), "mois_debut")
    got = {k[1]: v["vol_renvoi_m3"] for k, v in months.items()}
    assert got == {date(2001, 3, 1): 4.0, date(2001, 4, 1): 6.0, date(2001, 8, 1): 1.0}


def test_schemas(readings, universe):
    df = readings({"horodatage": "2024-01-29 12:00", R: 1.0})
    for got, schema in (
        (rollup.rollup_daily(df, universe, AS_OF), DAILY_ROLLUP),
        (rollup.rollup_weekly(df, universe, AS_OF), WEEKLY_ROLLUP),
        (rollup.rollup_monthly(df, AS_OF), MONTHLY_ROLLUP),
    ):
        want = [(f.name, f.dataType) for f in schema if f.name not in ("created_at", "updated_at")]
        assert [(f.name, f.dataType) for f in got.schema] == want


def test_a_day_equals_its_hours(spark):
    readings = load_input(spark, SF, "mesures")
    names = load_input(spark, SF, "mesures_aggregate")
    daily = rollup.rollup_daily(readings, names, AS_OF, tz="UTC").groupBy("nom_automate").agg(
        F.sum("conso_kwh").alias("kwh")
    )
    hours = hourly.hourly_energy(readings, AS_OF, hours=24 * 7).groupBy("nom_automate").agg(
        F.sum("conso_kwh").alias("kwh")
    )
    want = {r[0]: r[1] for r in hours.collect()}
    got = {r[0]: r[1] for r in daily.collect() if r[1] > 0}
    assert got.keys() == {k for k, v in want.items() if v > 0}
    for k, v in got.items():
        assert v == pytest.approx(want[k], abs=0.5)


def test_scans_are_pruned_and_nothing_is_crossed(spark, tmp_path):
    path = str(tmp_path / "mesures")
    load_input(spark, SF, "mesures").write.parquet(path)
    stored = spark.read.parquet(path)
    names = stored.select("nom_automate").distinct()
    for df, scans in (
        (rollup.rollup_daily(stored, names, AS_OF, stations=names), 2),
        (rollup.rollup_weekly(stored, names, AS_OF, stations=names), 2),
        (rollup.rollup_monthly(stored, AS_OF), 1),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == scans
        assert plan.count("PushedFilters: [IsNotNull(horodatage), GreaterThanOrEqual(horodatage") == scans - (
            1 if "jour" in df.columns or "semaine_debut" in df.columns else 0
        )
        assert "hauteur_cuve" not in plan
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert word not in plan


def test_known_stations_replace_the_history_scan(readings, spark):
    df = readings({"horodatage": "2024-01-29 12:00", R: 1.0, "nom_automate": "unlisted"})
    known = spark.createDataFrame([("K",)], "nom_automate string")
    got = rollup.rollup_daily(df, known, AS_OF, stations=known)
    assert {r[0] for r in got.select("nom_automate").distinct().collect()} == {"K"}


def test_rollups_agree_across_dst(readings, universe):
    start = datetime(2024, 3, 29)
    df = readings(*[{"horodatage": start + timedelta(hours=h), R: float(h)} for h in range(24 * 5)])
    got = by_key(rollup.rollup_daily(df, universe, datetime(2024, 4, 3)), "jour")
    # 23 hourly steps on the short Sunday
    assert got["A", date(2024, 3, 31)]["vol_renvoi_m3"] == 23.0
    assert got["A", date(2024, 4, 1)]["vol_renvoi_m3"] == 24.0
    assert rows_of(rollup.rollup_daily(df, universe, datetime(2024, 4, 3)), "nom_automate")
