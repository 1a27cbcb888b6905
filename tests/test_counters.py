import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivulet.operators import counters, hourly, rollup
from tests.conftest import rows_of

KWH = "compteur_electrique_kwh"


def total(df, **kw):
    slices = counters.counter_slices(df, {KWH: "kwh"}, **kw)
    return {r[0]: r[1] / 1e6 for r in slices.groupBy("nom_automate").agg(F.sum("kwh")).collect()}


def test_reset_null_and_first_reading(readings):
    df = readings(
        {"horodatage": "2024-01-01 00:00", KWH: 10.0},
        {"horodatage": "2024-01-01 00:01", KWH: 12.5},
        {"horodatage": "2024-01-01 00:02", KWH: 1.0},  # reset: nothing counted
        {"horodatage": "2024-01-01 00:03", KWH: 4.0},
        {"horodatage": "2024-01-01 00:04", KWH: None},  # a gap counts nothing on either side
        {"horodatage": "2024-01-01 00:30", KWH: 9.0},
        {"horodatage": "2024-01-01 02:00", KWH: 9.25},
    )
    assert total(df) == {"A": 2.5 + 3.0 + 0.25}


def test_step_belongs_to_the_slice_of_the_later_reading(readings):
    df = readings({"horodatage": "2024-01-01 00:59", KWH: 1.0}, {"horodatage": "2024-01-01 01:00", KWH: 3.0})
    got = rows_of(counters.counter_slices(df, {KWH: "kwh"}), "tranche", "kwh")
    assert got == [(datetime(2024, 1, 1, 0, 45), 0), (datetime(2024, 1, 1, 1, 0), 2_000_000)]


def test_equal_times_are_ordered_by_seq(readings):
    at = "2024-01-01 00:00"
    df = readings({"horodatage": at, KWH: 5.0, "seq": 2}, {"horodatage": at, KWH: 1.0, "seq": 1})
    assert total(df) == {"A": 4.0}


def test_readings_without_a_tie_breaker(readings):
    df = readings({"horodatage": "2024-01-01 00:00", KWH: 1.0}, {"horodatage": "2024-01-01 00:09", KWH: 2.5})
    assert total(df.drop("seq")) == {"A": 1.5}


def test_slicing_equals_a_plain_walk_over_each_station(readings):
    rng = random.Random(7)
    rows, want = [], {}
    for station in ("hot", "b", "c"):
        t, previous, first = datetime(2024, 1, 1), None, True
        want[station] = 0
        for _ in range(400 if station == "hot" else 40):
            t += timedelta(seconds=rng.choice([0, 1, 20, 299, 900, 4000]))
            value = None if rng.random() < 0.1 else rng.randrange(0, 5000) / 100
            if not first and value is not None and previous is not None:
                want[station] += max(round(value * 100) - round(previous * 100), 0)
            previous, first = value, False
            rows.append({"nom_automate": station, "horodatage": t, KWH: value, "seq": len(rows)})
    rng.shuffle(rows)
    got = total(readings(*rows))
    assert {k: round(v * 100) for k, v in got.items()} == want
    assert total(readings(*rows), width="1 minute") == got


def test_extra_aggregates_count_only_present_values(readings):
    df = readings(
        {"horodatage": "2024-01-01 00:00", "ph": 700}, {"horodatage": "2024-01-01 00:01", "ph": None, KWH: 1.0}
    )
    row = counters.counter_slices(df, {KWH: "kwh"}, {"ph": F.col("ph")}).first()
    assert (row["ph_sum"], row["ph_n"], row["kwh"]) == (700, 1, 0)


def test_counter_delta_sum_and_max_delta(readings):
    df = readings(
        {"horodatage": "2024-01-01 10:00", KWH: 10.0},
        {"horodatage": "2024-01-01 11:00", KWH: 11.0},
        {"horodatage": "2024-01-03 11:00", KWH: 15.5},
        {"horodatage": "2024-01-04 11:00", KWH: 2.0},
    )
    daily = counters.counter_delta_sum(df, {KWH: "kwh"}, F.col("tranche").cast("date").alias("jour"))
    assert rows_of(daily, "jour", "kwh") == [
        (date(2024, 1, 1), 1.0),
        (date(2024, 1, 3), 4.5),
        (date(2024, 1, 4), 0.0),
    ]
    peaks = counters.counter_max_delta(df, "jour", F.to_date("horodatage"), {KWH: "kwh"})
    assert rows_of(peaks, "jour", "kwh") == [
        (date(2024, 1, 1), 0.0),
        (date(2024, 1, 3), 4.5),
        (date(2024, 1, 4), 0.0),
    ]


def test_interval_consumption_drops_the_first_row(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 3.0), ("A", 3, 4.5), ("B", 1, 9.0)], "nom_automate string, h int, v double")
    assert rows_of(counters.interval_consumption(df, "h", "v"), "nom_automate", "h", "consommation") == [
        ("A", 2, 0.0),
        ("A", 3, 1.5),
    ]


def test_no_window_over_a_whole_station_of_raw_readings(readings):
    df = readings({"horodatage": "2024-01-01 00:00", KWH: 1.0})
    plan = counters.counter_slices(df, {KWH: "kwh"})._jdf.queryExecution().executedPlan().toString()
    raw_window = plan.split("Window")[-1]
    assert "tranche" in raw_window.split("Exchange hashpartitioning(")[1].split(")")[0]


def test_a_hot_station_is_spread_over_many_groups(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("nom_automate"),
        F.expr("timestampadd(SECOND, CAST(id * 2 AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("horodatage"),
    )
    sliced = rows.withColumn("tranche", F.window("horodatage", counters.SLICE)["start"])

    def largest_share(df):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) / sum(sizes)

    assert largest_share(sliced.repartition(16, "nom_automate")) > 1 / 3
    assert largest_share(sliced.repartition(16, "nom_automate", "tranche")) < 1 / 6


@pytest.mark.parametrize("width", ["7 minutes", "1 hour", "0 minutes", "90 minutes", "-5 minutes", "15", "1.5 minutes", ""])
def test_a_width_that_would_change_results_is_refused(readings, width):
    with pytest.raises(ValueError, match="slice"):
        counters.counter_slices(readings({"horodatage": "2024-01-01 00:00", KWH: 1.0}), {KWH: "kwh"}, width=width)


@pytest.mark.parametrize("width", ["1 minute", "30 seconds", "5 minutes"])
def test_a_narrower_slice_gives_the_same_hours_and_days(readings, width):
    rng = random.Random(4)
    start, rows, value = datetime(2024, 1, 29, 22), [], 0.0
    for _ in range(300):
        start += timedelta(seconds=rng.randint(1, 900))
        value = rng.choice([0.0, value + rng.random()])
        rows.append({"horodatage": start.isoformat(" "), KWH: value, "compteur_eau_relevage_m3": value * 2})
    rows += rows[:40]  # copies of a reading
    df, now = readings(*rows), datetime(2024, 1, 31)
    for op, column in ((hourly.hourly_energy, "conso_kwh"), (hourly.hourly_energy_ratio, "ratio")):
        assert rows_of(op(df, now, slice_width=width), "heure", column) == rows_of(op(df, now), "heure", column)
    days = [rows_of(rollup.rollup_daily(df, None, now, slice_width=w), "jour", "conso_kwh") for w in (width, counters.SLICE)]
    assert days[0] == days[1]
