import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from rivulet.operators import fill, series
from rivulet.schemas import DAILY_ROLLUP, VOLUMES, WEEKLY_ROLLUP
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def table(spark):
    def build(schema, *rows):
        data = [tuple({"nom_automate": "A", **r}.get(f.name) for f in schema) for r in rows]
        return spark.createDataFrame(data, schema)

    return build


def day(n: int) -> date:
    return date(2024, 1, n)


def test_rollup_series_zero_fills_and_labels(table):
    df = table(DAILY_ROLLUP, {"jour": day(2), "conso_kwh": None}, {"jour": day(1), "conso_kwh": 2.5})
    got = [tuple(r) for r in series.energy_series(df, "daily").collect()]
    assert got == [("A", day(1), "Monday", 2.5), ("A", day(2), "Tuesday", 0.0)]


def test_disinfection_column_depends_on_the_grain(table):
    daily = table(DAILY_ROLLUP, {"jour": day(1), "taux_desinfection": 1.0})
    weekly = table(WEEKLY_ROLLUP, {"semaine_debut": day(1), "taux_desinfection_avg": 2.0})
    assert series.disinfection_series(daily, "daily").columns[-1] == "taux_desinfection"
    assert series.disinfection_series(weekly, "weekly").first()["taux_desinfection_avg"] == 2.0


def test_rate_and_ratio(table):
    df = table(
        DAILY_ROLLUP,
        {"jour": day(1), "vol_renvoi_m3": 10.0, "vol_adoucie_m3": None, "vol_relevage_m3": 0.0, "conso_kwh": 4.0},
        {"jour": day(2), "vol_renvoi_m3": 0.0, "vol_adoucie_m3": 3.0, "vol_relevage_m3": 3.0, "conso_kwh": 1.0},
        {"jour": day(3), "vol_renvoi_m3": 4.0, "vol_adoucie_m3": 9.0, "vol_relevage_m3": 3.0, "conso_kwh": None},
        {"jour": day(4), "vol_renvoi_m3": None, "vol_adoucie_m3": 9.0, "vol_relevage_m3": None, "conso_kwh": 2.0},
    )
    assert rows_of(series.rate_from_volumes(df, "daily"), "bucket", "taux_recyclage") == [
        (day(1), 1.0), (day(2), 0.0), (day(3), 0.0), (day(4), 0.0),
    ]
    assert rows_of(series.ratio_from_rollup(df, "daily"), "bucket", "ratio") == [
        (day(1), 0.0), (day(2), 0.333), (day(3), 0.0), (day(4), 0.0),
    ]


def test_outliers_take_the_median_of_the_valid_values(table):
    df = table(
        DAILY_ROLLUP,
        {"jour": day(1), "ph_moyen": 7.0, "temp_moy_c": None},
        {"jour": day(2), "ph_moyen": None},  # reads 0, out of range for pH
        {"jour": day(3), "ph_moyen": 8.0},
        {"jour": day(4), "ph_moyen": 13.0},
        {"jour": day(1), "ph_moyen": 1.0, "nom_automate": "B"},  # nothing valid: unchanged
    )
    assert rows_of(series.ph_series(df, "daily"), "nom_automate", "bucket", "ph_moyen") == [
        ("A", day(1), 7.0), ("A", day(2), 7.5), ("A", day(3), 8.0), ("A", day(4), 7.5), ("B", day(1), 1.0),
    ]
    assert {r["temp_moy_c"] for r in series.temperature_series(df, "daily").collect()} == {0.0}


def test_pack_series_orders_by_time_and_zero_fills(table):
    df = table(
        DAILY_ROLLUP,
        {"jour": day(3), "vol_renvoi_m3": 3.0}, {"jour": day(1), "vol_renvoi_m3": 1.0}, {"jour": day(2)},
    ).withColumn("label", F.date_format("jour", "dd"))
    row = series.pack_series(df, "jour", "label", VOLUMES).first()
    assert row["labels"] == ["01", "02", "03"]
    assert row["vol_renvoi_m3"] == [1.0, 0.0, 3.0]
    kept = series.pack_series(df, "jour", "label", ["vol_renvoi_m3"], zero_fill=False).first()
    assert kept["vol_renvoi_m3"] == [1.0, None, 3.0]


def forward(values):
    out, last = [], None
    for v in values:
        if v is not None and v > 0:
            last = v
        out.append(last if v == 0 and last is not None else v)
    return out


def backward(values):
    first = next((v for v in values if v is not None and v > 0), None)
    out, leading = [], True
    for v in values:
        leading = leading and v == 0
        out.append(first if leading and first is not None else v)
    return out


def test_fills_follow_the_row_by_row_rule(spark):
    rng = random.Random(3)
    series_of = {f"S{i}": [rng.choice([0.0, 0.0, None, 0.5, 1.0]) for _ in range(rng.randint(1, 9))] for i in range(60)}
    rows = [(s, i, v) for s, vs in series_of.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "nom_automate string, i int, v double")

    def collect(out):
        got = {}
        for s, i, v in sorted(tuple(r) for r in out.select("nom_automate", "i", "v").fillna(-1.0).collect()):
            got.setdefault(s, []).append(None if v == -1.0 else v)
        return got

    assert collect(fill.ffill_zero(df, "v", "i")) == {s: forward(v) for s, v in series_of.items()}
    assert collect(fill.bfill_leading_zero(df, "v", "i")) == {s: backward(v) for s, v in series_of.items()}
    both = fill.bfill_leading_zero(fill.ffill_zero(df, "v", "i"), "v", "i")
    assert collect(both) == {s: backward(forward(v)) for s, v in series_of.items()}
