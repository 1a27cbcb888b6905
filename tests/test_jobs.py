from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivulet.operators import rollup
from rivulet.plans.inputs import AS_OF, AS_OF_LONG, load_input
from rivulet.plans.jobs import refresh_latest_counters, run_rollup
from rivulet.sources.tables import read_rollup, read_table, write_rollup
from tests.conftest import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return {n: load_input(spark, SF, n) for n in ("mesures", "mesures_aggregate", "mesures_longues")}


def values(df):
    columns = [c for c in df.columns if c not in ("created_at", "updated_at")]
    return rows_of(df, *columns)


def test_daily_job_merges_purges_and_is_repeatable(spark, inputs, tmp_path):
    base = str(tmp_path)
    args = (inputs["mesures"], inputs["mesures_aggregate"], base)
    path = run_rollup(spark, "daily", *args, AS_OF - timedelta(days=2))
    # a row of the current day, as an earlier version might have left it
    today = read_rollup(spark, base, "daily").limit(1).withColumn("jour", F.lit(date(2024, 1, 31)))
    write_rollup(today, path, "jour")
    run_rollup(spark, "daily", *args, AS_OF)
    stored = read_rollup(spark, base, "daily")
    days = {r[0] for r in stored.select("jour").distinct().collect()}
    assert days == {date(2024, 1, d) for d in range(24, 31)}
    want = values(rollup.rollup_daily(inputs["mesures"], inputs["mesures_aggregate"], AS_OF))
    assert values(stored) == want
    kept = stored.where("jour = date'2024-01-25'").select("created_at", "updated_at").distinct().collect()
    assert [tuple(r) for r in kept] == [(datetime(2024, 1, 29), datetime(2024, 1, 31))]
    run_rollup(spark, "daily", *args, AS_OF)
    assert values(read_rollup(spark, base, "daily")) == want


def test_weekly_job_keeps_rows_of_vanished_stations(spark, inputs, tmp_path):
    base = str(tmp_path)
    gone = spark.createDataFrame([("gone",)], "nom_automate string")
    run_rollup(spark, "weekly", inputs["mesures"], gone, base, AS_OF)
    run_rollup(spark, "weekly", inputs["mesures"], gone.limit(0), base, AS_OF)
    names = {r[0] for r in read_rollup(spark, base, "weekly").select("nom_automate").distinct().collect()}
    assert "gone" in names
    run_rollup(spark, "weekly", inputs["mesures"], gone.limit(0), base, AS_OF, rebuild=True)
    rebuilt = read_rollup(spark, base, "weekly")
    assert "gone" not in {r[0] for r in rebuilt.select("nom_automate").distinct().collect()}
    assert values(rebuilt) == values(rollup.rollup_weekly(inputs["mesures"], gone.limit(0), AS_OF))


def test_monthly_job_replaces_its_window_and_keeps_older_months(spark, inputs, tmp_path):
    base = str(tmp_path)
    path = run_rollup(spark, "monthly", inputs["mesures_longues"], None, base, datetime(2001, 2, 15))
    before = read_rollup(spark, base, "monthly")
    stale = before.limit(1).withColumn("mois_debut", F.lit(date(2001, 8, 1))).withColumn("nom_automate", F.lit("stale"))
    write_rollup(stale, path, "mois_debut")
    ancient = before.limit(1).withColumn("mois_debut", F.lit(date(2000, 1, 1)))
    write_rollup(ancient, path, "mois_debut")
    older = values(before.where("mois_debut < date'2001-03-01' and mois_debut > date'2000-08-31'"))
    run_rollup(spark, "monthly", inputs["mesures_longues"], None, base, AS_OF_LONG)
    stored = read_rollup(spark, base, "monthly")
    assert stored.agg(F.min("mois_debut"), F.max("mois_debut")).first()[1] == date(2001, 8, 1)
    assert values(stored.where("mois_debut >= date'2001-03-01'")) == values(
        rollup.rollup_monthly(inputs["mesures_longues"], AS_OF_LONG)
    )
    assert values(stored.where("mois_debut < date'2001-03-01'")) == older


def test_monthly_job_empties_a_window_without_readings(spark, inputs, tmp_path):
    base = str(tmp_path)
    run_rollup(spark, "monthly", inputs["mesures_longues"], None, base, AS_OF_LONG)
    run_rollup(spark, "monthly", inputs["mesures_longues"].limit(0), None, base, AS_OF_LONG)
    assert read_rollup(spark, base, "monthly").count() == 0


def test_counter_cache_keeps_stale_stations(spark, readings, tmp_path):
    base, r, a = str(tmp_path), "compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3"
    first = readings(
        {"horodatage": "2024-01-01 00:00", r: 5.0, a: 1.0}, {"horodatage": "2024-01-01 00:00", r: 7.0, a: 2.0, "nom_automate": "B"}
    )
    second = readings({"horodatage": "2024-01-02 00:00", r: 6.0, a: 1.5})
    refresh_latest_counters(spark, first, base, datetime(2024, 1, 1, 12))
    refresh_latest_counters(spark, second, base, datetime(2024, 1, 2, 12))
    stored = read_table(spark, base, "cache_volumes_total")
    assert rows_of(stored, "nom_automate", r, a, "updated_at") == [
        ("A", 6.0, 1.5, datetime(2024, 1, 2, 12)), ("B", 7.0, 2.0, datetime(2024, 1, 1, 12)),
    ]
    refresh_latest_counters(spark, second, base, datetime(2024, 1, 2, 12), rebuild=True)
    assert read_table(spark, base, "cache_volumes_total").count() == 1


def test_command_line_runs_every_job(spark, inputs, tmp_path):
    from rivulet.__main__ import main

    readings, base = str(tmp_path / "mesures"), str(tmp_path / "base")
    inputs["mesures"].write.parquet(readings)
    common = ["--readings", readings, "--base", base, "--as-of", "2024-01-31", "--tz", "UTC"]
    for job, rows in (("daily", 8 * 7), ("weekly", 8 * 4), ("counters", 8)):
        path = main([job, *common])
        assert spark.read.parquet(path).count() == rows
    monthly = main(["monthly", *common, "--rebuild"])
    assert spark.read.parquet(monthly).count() == 8
    whole = {job: values(spark.read.parquet(main([job, *common, "--rebuild"]))) for job in ("daily", "weekly", "monthly")}
    for job, want in whole.items():
        path = main([job, *common, "--rebuild", "--arrivals", readings])
        assert values(spark.read.parquet(path)) == want
    with pytest.raises(SystemExit):
        main(["yearly", *common])
