from datetime import datetime

from rivulet.operators import latest
from tests.conftest import rows_of

PC = "compteur_eau_inst_relevage_pc"
H = "hauteur_cuve_traitement_pc"
KWH = "compteur_electrique_kwh"


def test_latest_value_reads_null_as_zero_and_breaks_ties_by_seq(readings):
    df = readings(
        {"horodatage": "2024-01-01 10:00", PC: 5, "seq": 1},
        {"horodatage": "2024-01-01 10:00", PC: None, "seq": 2},
        {"horodatage": "2024-01-01 09:00", PC: 9, "seq": 3},
        {"horodatage": "2024-01-01 08:00", PC: 7, "seq": 4, "nom_automate": "B"},
    )
    assert rows_of(latest.latest_value(df, PC), "nom_automate", "horodatage", "valeur") == [
        ("A", datetime(2024, 1, 1, 10), 0.0),
        ("B", datetime(2024, 1, 1, 8), 7.0),
    ]


def test_latest_clamped_skips_nulls(readings):
    df = readings(
        {"horodatage": "2024-01-01 10:00", H: None},
        {"horodatage": "2024-01-01 09:00", H: 130},
        {"horodatage": "2024-01-01 08:00", H: -4, "nom_automate": "B"},
    )
    assert rows_of(latest.latest_clamped(df, H), "nom_automate", "valeur") == [("A", 100.0), ("B", 0.0)]


def test_latest_positive_and_counters(readings):
    r, a = "compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3"
    df = readings(
        {"horodatage": "2024-01-01 10:00", KWH: 0.0, r: 3.0},
        {"horodatage": "2024-01-01 09:00", KWH: 4.5, r: 2.0, a: 1.0},
        {"horodatage": "2024-01-01 09:00", KWH: -1.0, "nom_automate": "B"},
    )
    assert rows_of(latest.latest_positive(df), "nom_automate", "valeur") == [("A", 4.5)]
    as_of = datetime(2024, 1, 2)
    got = rows_of(latest.latest_counters(df, as_of), "nom_automate", r, a, "updated_at")
    assert got == [("A", 2.0, 1.0, as_of)]


def test_text_columns_are_ranked_before_the_shuffle(readings):
    df = readings({"horodatage": "2024-01-01 10:00", PC: 5}).repartition(3)
    texts = latest.latest_rows(df.select("nom_automate", "horodatage", df["nom_automate"].alias("t")))
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning(nom_automate") < plan.rindex("WindowGroupLimit")


def test_missing_and_early_times_come_last_in_order(readings):
    df = readings(
        {"horodatage": None, KWH: 1.0},
        {"horodatage": "1960-05-05 10:00:00.000001", KWH: 2.0},
        {"horodatage": None, KWH: 3.0, "nom_automate": "B"},
        {"horodatage": "1960-05-05 10:00", KWH: 4.0, "seq": 10**18},
        {"horodatage": "1960-05-05 10:00", KWH: 5.0, "seq": None},
    )
    assert rows_of(latest.latest_rows(df.select("nom_automate", "horodatage", "seq", KWH)), "nom_automate", KWH) == [("A", 2.0), ("B", 3.0)]


def test_nothing_is_sorted_before_the_shuffle(readings):
    df = readings({"horodatage": "2024-01-01", KWH: 1.0})
    for frame in (latest.latest_positive(df), latest.latest_counters(df, datetime(2024, 1, 2)), latest.latest_clamped(df, H)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and plan.count("HashAggregate") == 2
    text = latest.latest_rows(df.select("nom_automate", "horodatage", df["nom_automate"].alias("t")))
    assert text.collect()[0]["t"] == "A"
