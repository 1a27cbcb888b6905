from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivulet.operators import hourly
from tests.conftest import rows_of

AS_OF = datetime(2024, 1, 31)
PC = "compteur_eau_inst_renvoi_pc"
R, AD, KWH, REL = (
    "compteur_eau_renvoi_m3",
    "compteur_eau_adoucie_m3",
    "compteur_electrique_kwh",
    "compteur_eau_relevage_m3",
)


def at(text: str, **values):
    return {"horodatage": f"2024-01-30 {text}", **values}


def hour(h: int) -> datetime:
    return datetime(2024, 1, 30, h)


def test_window_is_half_open(readings):
    df = readings(
        {"horodatage": "2024-01-29 23:59:59", "chlore_mv": 3},
        {"horodatage": "2024-01-30 00:00:00", "chlore_mv": 6},
        {"horodatage": "2024-01-30 23:59:59", "chlore_mv": 9},
        {"horodatage": "2024-01-31 00:00:00", "chlore_mv": 12},
    )
    assert rows_of(hourly.hourly_disinfection_rate(df, AS_OF), "heure", "taux_desinfection") == [
        (hour(0), 2.0),
        (hour(23), 3.0),
    ]


def test_wrap_delta_between_present_hours(readings):
    df = readings(
        at("01:00", **{PC: 90}),
        at("01:30", **{PC: 91}),  # mean 90.5
        at("02:00", **{PC: 10}),  # wraps: 19.5 %
        at("05:00", **{PC: 10}),  # hours 3 and 4 are absent
        at("06:00"),  # an hour without value has no step, nor has the next
        at("07:00", **{PC: 50}),
    )
    assert rows_of(hourly.hourly_wrap_delta(df, AS_OF, PC), "heure", "delta_m3") == [
        (hour(2), 0.195),
        (hour(5), 0.0),
        (hour(6), None),
        (hour(7), None),
    ]


def test_wrap_delta_of_all_counters_keeps_stations_apart(readings):
    df = readings(
        at("01:00", **{PC: 1, "compteur_eau_inst_adoucie_pc": 5, "compteur_eau_inst_relevage_pc": 99}),
        at("02:00", **{PC: 2, "compteur_eau_inst_adoucie_pc": 4, "compteur_eau_inst_relevage_pc": 0}),
        at("02:00", **{PC: 80, "nom_automate": "B"}),
    )
    got = rows_of(
        hourly.hourly_wrap_delta_all(df, AS_OF), "nom_automate", "vol_renvoi_m3", "vol_adoucie_m3", "vol_relevage_m3"
    )
    assert got == [("A", 0.01, 0.99, 0.01)]


def test_hour_of_day_merges_both_ends_of_the_window(spark):
    rows = [
        ("A", datetime(2024, 1, 30, 8, 30), 10.0),
        ("A", datetime(2024, 1, 31, 8, 10), 20.0),  # later than as_of: this operator has no upper bound
        ("A", datetime(2024, 1, 30, 9, 0), 5.0),
        ("A", datetime(2024, 1, 29, 8, 0), 99.0),
    ]
    df = spark.createDataFrame(rows, "nom_automate string, rounded_timestamp timestamp_ntz, avg_pression5 double")
    got = rows_of(hourly.hour_of_day_mean(df, datetime(2024, 1, 31, 8)), "heure_num", "label", "moyenne_pression")
    assert got == [(8, "08:00", 15.0), (9, "09:00", 5.0)]


def test_recycling_rates_are_not_clamped(readings):
    df = readings(
        at("01:00", **{R: 10.0, AD: 10.0}),
        at("01:10", **{R: 12.0, AD: 15.0}),  # rate (2 - 5) / 2
        at("01:20", **{R: 99.0}),  # one counter missing: ignored
        at("02:00", **{R: 12.0, AD: 15.0}),  # no renvoi in the hour: 0
        {"horodatage": "2024-01-31 03:00", R: 14.0, AD: 15.0},  # no upper bound
    )
    assert rows_of(hourly.hourly_recycling_rate(df, AS_OF), "heure", "taux_recyclage") == [
        (hour(1), -1.5),
        (hour(2), 0.0),
        (datetime(2024, 1, 31, 3), 0.0),
    ]
    assert rows_of(hourly.recycling_rate_24h(df, AS_OF), "horodatage", "valeur") == [
        (datetime(2024, 1, 31, 3), -0.25)
    ]


def test_medians_interpolate_and_filter(readings):
    df = readings(
        at("01:00", temperature_deg=100, chlore_mv=10, ph=700, pression1_mbar=1),
        at("01:10", temperature_deg=205, chlore_mv=2001, ph=199, pression1_mbar=4),
        at("01:20", temperature_deg=601, chlore_mv=15, ph=1201),
        at("02:00", temperature_deg=-1, chlore_mv=-1, ph=100),
    )
    assert rows_of(hourly.hourly_temperature_median(df, AS_OF), "heure", "temp_med_c") == [(hour(1), 15.25)]
    assert rows_of(hourly.hourly_chlorine_median(df, AS_OF), "heure", "chlore_med_mv") == [(hour(1), 12.5)]
    assert rows_of(hourly.hourly_ph_median(df, AS_OF), "heure", "ph_mediane") == [(hour(1), 7.0)]
    # an hour without any pressure stays, with nulls
    assert rows_of(hourly.hourly_pressure_medians(df, AS_OF), "heure", "p1_med_mbar", "p2_med_mbar") == [
        (hour(1), 2.5, None),
        (hour(2), None, None),
    ]


def test_energy_of_the_first_reading_in_the_window_is_zero(readings):
    df = readings(
        {"horodatage": "2024-01-29 23:00", KWH: 1.0},
        at("00:10", **{KWH: 5.0}),
        at("00:20", **{KWH: 5.126}),
        at("01:00", **{KWH: 6.0}),
    )
    assert rows_of(hourly.hourly_energy(df, AS_OF), "heure", "conso_kwh") == [(hour(0), 0.13), (hour(1), 0.87)]


def test_energy_ratio_smooths_over_three_rows_and_skips_nulls(readings):
    steps = [(0, 0.0, 0.0), (1, 2.0, 1.0), (2, 3.0, 1.0), (3, 9.0, 3.0), (4, 9.0, 3.0), (5, 9.0, 3.0), (6, 9.0, 3.0)]
    df = readings(*[at(f"{h:02d}:00", **{KWH: k, REL: m}) for h, k, m in steps])
    # raw ratios: null, 2, null, 3, null, null, null
    assert rows_of(hourly.hourly_energy_ratio(df, AS_OF), "heure", "ratio") == [
        (hour(0), None),
        (hour(1), 2.0),
        (hour(2), 2.0),
        (hour(3), 2.5),
        (hour(4), 3.0),
        (hour(5), 3.0),
        (hour(6), None),
    ]


@pytest.mark.parametrize("stations", [["A"], "frame"])
def test_station_filter(spark, readings, stations):
    df = readings(at("01:00", chlore_mv=3), at("01:00", chlore_mv=3, nom_automate="B"))
    if stations == "frame":
        stations = spark.createDataFrame([("A",)], "nom_automate string")
    got = hourly.hourly_disinfection_rate(df, AS_OF, stations=stations)
    assert [r["nom_automate"] for r in got.collect()] == ["A"]


def test_instants_and_wall_clock_readings_agree(readings):
    df = readings(at("01:00", **{KWH: 1.0}), at("01:30", **{KWH: 2.0}), at("22:59", **{KWH: 4.0}))
    as_instants = df.withColumn("horodatage", F.col("horodatage").cast("timestamp"))
    for tz in ("UTC", "Europe/Paris"):
        want = rows_of(hourly.hourly_energy(df, AS_OF, tz=tz), "heure", "conso_kwh")
        assert rows_of(hourly.hourly_energy(as_instants, AS_OF, tz=tz), "heure", "conso_kwh") == want


def test_aware_as_of_counts_real_hours(readings):
    from zoneinfo import ZoneInfo

    df = readings(*[{"horodatage": f"2024-03-{d} {h:02d}:30", "chlore_mv": 3} for d in (30, 31) for h in range(24)])
    as_of = datetime(2024, 3, 31, 12, tzinfo=ZoneInfo("Europe/Paris"))  # 10:00 UTC, after the clock change
    hours = [r[0] for r in rows_of(hourly.hourly_disinfection_rate(df, as_of), "heure")]
    assert (len(hours), hours[0], hours[-1]) == (24, datetime(2024, 3, 30, 10), datetime(2024, 3, 31, 9))


def _day(spark, readings, day: str, offset_hours: int, hours: int, **columns):
    """A reading each half hour of a local day that starts offset_hours before UTC midnight."""
    start = datetime.fromisoformat(day) - timedelta(hours=offset_hours)
    rows = []
    for k in range(2 * hours):
        rows.append({"horodatage": (start + timedelta(minutes=30 * k)).isoformat(" "), **{c: f(k) for c, f in columns.items()}})
    return readings(*rows), start + timedelta(hours=hours)


@pytest.mark.parametrize(("day", "offset", "hours"), [("2024-10-27", 2, 25), ("2024-03-31", 1, 23)])
def test_days_of_the_clock_change_have_their_real_hours(spark, readings, day, offset, hours):
    df, end = _day(spark, readings, day, offset, hours, **{KWH: lambda k: float(k), REL: lambda k: 2.0 * k, PC: lambda k: k % 100, "ph": lambda k: 700 + k // 2})
    energy = hourly.hourly_energy(df, end, hours, tz="Europe/Paris").collect()
    assert len(energy) == hours and sorted(r["conso_kwh"] for r in energy) == [1.0] + [2.0] * (hours - 1)
    assert len({r["heure"] for r in energy}) == min(hours, 24)
    ratio = hourly.hourly_energy_ratio(df, end, hours, tz="Europe/Paris").collect()
    assert len(ratio) == hours and {r["ratio"] for r in ratio} == {0.5}
    wrap = hourly.hourly_wrap_delta(df, end, PC, hours, tz="Europe/Paris").collect()
    assert len(wrap) == hours - 1 and {r["delta_m3"] for r in wrap} == {0.02}
    medians = hourly.hourly_ph_median(df, end, hours, tz="Europe/Paris").collect()
    assert sorted(r["ph_mediane"] for r in medians) == [7.0 + k / 100 for k in range(hours)]
