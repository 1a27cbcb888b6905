"""Stored slices, day states, the kept station list."""

import os
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions.timegrain import PARIS, buckets, day_after
from rivulet.operators import rollup
from rivulet.operators.counters import TRANCHE, combine_slices, slice_summaries, summed_steps
from rivulet.operators.states import day_states, merged_states, spans_of_readings
from rivulet.plans.inputs import AS_OF, AS_OF_LONG, load_input
from rivulet.plans.jobs import read_states, read_summaries, refresh_states, refresh_stations, refresh_summaries, run_rollup
from rivulet.sources.tables import read_rollup
from tests.conftest import rows_of

R, KWH = "compteur_eau_renvoi_m3", "compteur_electrique_kwh"
SF = "/root/testdata/sf0.001"
COUNTERS = {R: "m3", KWH: "kwh"}


def all_rows(df):
    return sorted((repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect()))


def hour_of(df):
    return F.date_trunc("hour", F.col(TRANCHE).cast("timestamp")).cast("timestamp_ntz")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 240), st.none() | st.integers(0, 50), st.none() | st.integers(0, 50)), min_size=1, max_size=25))
def test_summaries_combine_to_that_of_the_whole(readings, minutes):
    start = datetime(2024, 1, 1)
    df = readings(*[{"horodatage": start + timedelta(minutes=m), R: a if a is None else float(a), KWH: b if b is None else float(b), "ph": a} for m, a, b in minutes])
    extra = {"ph": F.col("ph")}
    fine = slice_summaries(df, COUNTERS, extra, "5 minutes")
    names = list(COUNTERS.values())
    quarter = F.window(TRANCHE, "15 minutes")["start"]
    # 5 minutes -> 15 minutes -> hours is the same as 5 minutes -> hours, and as summing up quarters of an hour at once.
    once = combine_slices(fine, names, hour_of(fine), ["ph"])
    twice = combine_slices(fine, names, quarter, ["ph"])
    assert all_rows(twice) == all_rows(slice_summaries(df, COUNTERS, extra, "15 minutes"))
    assert all_rows(combine_slices(twice, names, hour_of(twice), ["ph"])) == all_rows(once)
    totals = [summed_steps(s, names).agg(F.sum("m3"), F.sum("kwh")).first() for s in (fine, twice, once)]
    assert totals[0] == totals[1] == totals[2]


def test_late_readings_replace_only_their_slice(spark, tmp_path):
    base, every = str(tmp_path), load_input(spark, SF, "mesures").cache()
    late = every.where("seq in (100, 500)")
    early = every.where("seq not in (100, 500)")
    path = refresh_summaries(spark, early, early, base)
    before = {r["jour"]: r["f"] for r in spark.read.parquet(path).select("jour", F.input_file_name().alias("f")).distinct().collect()}
    old = all_rows(read_summaries(spark, base))
    refresh_summaries(spark, every, late, base)
    after = {r["jour"]: r["f"] for r in spark.read.parquet(path).select("jour", F.input_file_name().alias("f")).distinct().collect()}
    days = {r[0].date() for r in late.select("horodatage").collect()}
    assert {d for d in after if after[d] != before.get(d)} == days
    changed = set(all_rows(read_summaries(spark, base))) - set(old)
    assert len(changed) == 2
    assert all_rows(read_summaries(spark, base)) == all_rows(rollup.daily_summaries(every))
    refresh_summaries(spark, every, late.limit(0), base)
    assert all_rows(read_summaries(spark, base)) == all_rows(rollup.daily_summaries(every))


def test_rollups_of_stored_states_read_no_readings(spark, tmp_path):
    base, every = str(tmp_path), load_input(spark, SF, "mesures").cache()
    aggregated = load_input(spark, SF, "mesures_aggregate")
    refresh_summaries(spark, every, every, base)
    refresh_states(spark, every, every, base)
    known = aggregated.union(every.select("nom_automate")).distinct()
    daily = rollup.daily_of_summaries(read_summaries(spark, base), known, AS_OF)
    assert all_rows(daily) == all_rows(rollup.rollup_daily(every, aggregated, AS_OF))
    for lookback in (0, 1):
        weekly = rollup.rollup_of_states(read_states(spark, base), "weekly", AS_OF, PARIS, known, lookback)
        assert all_rows(weekly) == all_rows(rollup.rollup_weekly(every, aggregated, AS_OF, lookback_buckets=lookback))
    run_rollup(spark, "weekly", None, aggregated, base, AS_OF, stored=True)
    stored = read_rollup(spark, base, "weekly").drop("created_at", "updated_at")
    assert all_rows(stored) == all_rows(rollup.rollup_weekly(every, aggregated, AS_OF))
    plan = weekly._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mois" in plan and "horodatage" not in plan


def test_states_of_odd_readings(spark, readings):
    nothing = {c: None for c in ("chlore_mv", "ph", "temperature_deg")}
    df = readings(
        {"horodatage": "2024-01-28 22:59", R: 1.0, "ph": 700},
        {"horodatage": "2024-01-28 23:00", "ph": 701, "pression1_mbar": 5},  # the 29th in Paris, another week
        {"horodatage": "2024-01-30 10:00", **nothing},
        {"horodatage": "2024-01-30 10:00", **nothing},
        {"horodatage": "2024-01-30 11:00", "ph": 650, "chlore_mv": 0, "nom_automate": "B"},
    )
    span = buckets(AS_OF, "weekly")
    merged = merged_states(day_states(df, PARIS), span, day_after(span, "weekly"), "w")
    assert all_rows(merged) == all_rows(spans_of_readings(df, span, "w"))
    states = day_states(df, PARIS)
    assert states.where("capteur is null").agg(F.sum("n")).first()[0] == 5
    assert rows_of(states.where("capteur is not null"), "jour", "nom_automate", "capteur", "valeur", "n") == sorted(
        [
            (date(2024, 1, 28), "A", "ph", 700, 1),
            (date(2024, 1, 29), "A", "ph", 701, 1),
            (date(2024, 1, 30), "B", "chlore_mv", 0, 1),
            (date(2024, 1, 30), "B", "ph", 650, 1),
        ],
        key=repr,
    )
    assert day_states(df.limit(0), PARIS).count() == 0


def test_a_reading_is_sent_once_for_its_sensors(readings):
    df = readings(*[{"horodatage": f"2024-01-28 10:{m:02}", R: float(m), "ph": 700 + m, "chlore_mv": m, "temperature_deg": m % 2} for m in range(60)])
    states = day_states(df, PARIS)
    plan = states._jdf.queryExecution().executedPlan().toString()
    totals, sensors = plan.split("Exchange hashpartitioning(")[1:]  # one shuffle each, none of them of unrolled readings
    assert "Expand" not in plan and "Generate inline" in totals and "Generate" not in sensors
    assert "pression" not in sensors.split("Scan")[0] and "compteur" not in sensors.split("Scan")[0]
    got = states.groupBy("capteur").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.max("vol_renvoi_m3").alias("top"))
    assert rows_of(got, "capteur", "rows", "n", "top") == sorted(
        [(None, 1, 60, 59000000), ("ph", 60, 60, None), ("chlore_mv", 60, 60, None), ("temperature_deg", 2, 60, None)], key=repr
    )


def test_monthly_states_hold_the_window_only(spark, tmp_path):
    base, every = str(tmp_path), load_input(spark, SF, "mesures_longues").where("horodatage >= '2001-01-01'").cache()
    path = refresh_states(spark, every.where("nom_automate <> 'ST3'"), every.where("nom_automate <> 'ST3'"), base)
    refresh_states(spark, every, every.where("nom_automate = 'ST3'"), base)
    got = rollup.rollup_of_states(read_states(spark, base), "monthly", AS_OF_LONG)
    assert all_rows(got) == all_rows(rollup.rollup_monthly(every, AS_OF_LONG))
    assert all(name.startswith(("mois=2001-", "_", ".")) for name in os.listdir(path))


def test_station_list_reads_on_from_its_mark(spark, tmp_path):
    base, path = str(tmp_path / "base"), str(tmp_path / "mesures")
    schema = "nom_automate string, horodatage timestamp_ntz"
    spark.createDataFrame([("A", datetime(2024, 1, 1)), ("B", datetime(2024, 1, 5)), (None, datetime(2024, 1, 5))], schema).write.parquet(path)
    assert rows_of(refresh_stations(spark, spark.read.parquet(path), base), "nom_automate") == [("A",), ("B",)]
    more = [("C", datetime(2024, 1, 6)), ("A", datetime(2024, 1, 6)), ("D", datetime(2024, 1, 4, 12)), ("E", datetime(2024, 1, 2))]
    spark.createDataFrame(more, schema).write.mode("append").parquet(path)
    plans = []
    readings = spark.read.parquet(path)
    original = type(readings).groupBy

    def noted(self, *a):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return original(self, *a)

    type(readings).groupBy = noted
    try:
        got = refresh_stations(spark, readings, base)
    finally:
        type(readings).groupBy = original
    # D came late by half a day, within the margin; E by three days, beyond it.
    assert rows_of(got, "nom_automate") == [("A",), ("B",), ("C",), ("D",)]
    assert any("GreaterThanOrEqual(horodatage,2024-01-04T00:00)" in p for p in plans)
    assert rows_of(refresh_stations(spark, readings, base, timedelta(days=9)), "nom_automate") == [("A",), ("B",), ("C",), ("D",), ("E",)]
    assert refresh_stations(spark, readings.limit(0), base).count() == 5
