import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.schemas import DAILY_ROLLUP, STATIONS, TABLES
from rivulet.sources import database, readings, sinks, tables
from tests.conftest import rows_of


def test_scan_prunes_partitions_rows_and_columns(spark, readings_table):
    got = readings.scan_readings(
        spark, readings_table, datetime(2024, 1, 2), datetime(2024, 1, 3), ["A"],
        ("nom_automate", "horodatage"), date_partition="d",
    )
    assert rows_of(got, "nom_automate", "horodatage") == [("A", datetime(2024, 1, 2, 5))]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(horodatage,2024-01-02T00:00)" in plan and "EqualTo(nom_automate,A)" in plan
    assert "ReadSchema: struct<nom_automate:string,horodatage:timestamp_ntz>" in plan
    assert "PartitionFilters: [isnotnull(d#" in plan


def test_scan_by_station_table(spark, readings_table):
    keys = spark.createDataFrame([("B",)], "nom_automate string")
    assert readings.scan_readings(spark, readings_table, stations=keys).count() == 1


def test_scan_pressure_avg(spark, tmp_path):
    path = str(tmp_path / "moyenne")
    rows = [("A", datetime(2024, 1, 1), 1.0), ("A", datetime(2024, 1, 2), 2.0), ("B", datetime(2024, 1, 2), 3.0)]
    spark.createDataFrame(rows, "nom_automate string, rounded_timestamp timestamp_ntz, avg_pression5 double").write.parquet(path)
    got = readings.scan_pressure_avg(spark, path, datetime(2024, 1, 2), ["A"])
    assert [tuple(r) for r in got.collect()] == [("A", datetime(2024, 1, 2), 2.0)]


def test_station_universe(spark):
    a = spark.createDataFrame([("A",), ("B",)], "nom_automate string")
    b = spark.createDataFrame([("B",), ("B",), ("C",)], "nom_automate string")
    assert rows_of(readings.station_universe(a, b), "nom_automate") == [("A",), ("B",), ("C",)]
    assert readings.station_universe(a, b.limit(0), known=b).count() == 3
    assert readings.station_universe(None, b).count() == 2


def test_empty_tables_have_their_schema(spark, tmp_path):
    for name, schema in TABLES.items():
        tables.ensure_table(spark, tables.table_path(str(tmp_path), name), schema)
        assert tables.read_table(spark, str(tmp_path), name).count() == 0
    for grain in ("daily", "weekly", "monthly"):
        assert tables.read_rollup(spark, str(tmp_path), grain).columns[-1] == "updated_at"


def test_ensure_table_leaves_existing_rows(spark, tmp_path):
    path = str(tmp_path / "automate")
    tables.replace_table(spark.createDataFrame([("S1", *[None] * 7)], STATIONS), path)
    tables.ensure_table(spark, path, STATIONS)
    assert tables.read_table(spark, str(tmp_path), "automate").count() == 1


def daily(spark, *rows):
    return spark.createDataFrame(
        [tuple({"jour": d, "nom_automate": s, "conso_kwh": v}.get(f.name) for f in DAILY_ROLLUP) for d, s, v in rows], DAILY_ROLLUP
    )


def test_write_rollup_replaces_only_its_buckets_even_from_itself(spark, tmp_path):
    base, path = str(tmp_path), str(tmp_path / "donnees_semaine")
    d1, d2, d3 = (date(2024, 1, d) for d in (1, 2, 3))
    tables.write_rollup(daily(spark, (d1, "A", 1.0), (d2, "A", 2.0), (d3, "A", 3.0)), path, "jour")
    stored = tables.read_rollup(spark, base, "daily")
    tables.write_rollup(stored.where(F.col("jour") == d2).withColumn("conso_kwh", F.lit(9.0)), path, "jour")
    assert rows_of(tables.read_rollup(spark, base, "daily"), "jour", "conso_kwh") == [(d1, 1.0), (d2, 9.0), (d3, 3.0)]
    assert tables.stored_buckets(spark, path, "jour") == [d1, d2, d3]
    assert tables.purge_buckets(spark, path, "jour", d2) == 1
    tables.write_rollup(daily(spark, (d3, "B", 5.0)), path, "jour", emptied=[d2, d3])
    assert rows_of(tables.read_rollup(spark, base, "daily"), "jour", "nom_automate") == [(d3, "B")]
    pruned = tables.read_rollup(spark, base, "daily").where(F.col("jour") == d3)
    assert "PartitionFilters: [isnotnull(jour#" in pruned._jdf.queryExecution().executedPlan().toString()
    leftovers = [p.name for p in tmp_path.iterdir() if "staged-" in p.name]
    assert leftovers == []


def test_staging_is_beside_the_table():
    first, second = tables.staging_path("/data/t"), tables.staging_path("/data/t/")
    assert first.startswith("/data/t.staged-") and second.startswith("/data/t.staged-") and first != second


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(date(2024, 1, 2), "A", None, 1.5), (date(2024, 1, 3), "B", 2, None)], "date date, nom_automate string, p1_mbar int, ph_moyen double")
    sinks.write_csv(df.coalesce(1), path)
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_text().splitlines() == ["date;nom_automate;p1_mbar;ph_moyen", "2024-01-02;A;;1.5", "2024-01-03;B;2;"]


def test_json(spark, tmp_path):
    df = spark.createDataFrame([("A", ["x", "y"], [1.0, 0.0], None)], "nom_automate string, labels array<string>, data array<double>, n int")
    sinks.write_json(df.coalesce(1), str(tmp_path / "json"))
    (part,) = (tmp_path / "json").glob("part-*")
    want = {"nom_automate": "A", "labels": ["x", "y"], "data": [1.0, 0.0], "n": None}
    assert json.loads(part.read_text()) == want
    assert json.loads(sinks.json_rows(df).first()[0]) == want


def test_database_slices_cover_the_range_without_overlap():
    slices = database.time_slices(datetime(2024, 1, 1), datetime(2024, 1, 2), 5)
    edges = [s.split("'")[1::2] for s in slices]
    assert len(edges) == 5 and edges[0][0] == "2024-01-01 00:00:00+00" and edges[-1][1] == "2024-01-02 00:00:00+00"
    assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))


def test_declared_key_columns_exist():
    for name, schema in TABLES.items():
        assert isinstance(schema, T.StructType) and len(schema.names) == len(set(schema.names)), name


@pytest.mark.parametrize("bucketed", [True, False])
def test_interrupted_swap_is_undone_or_finished(spark, tmp_path, monkeypatch, bucketed):
    base, path = str(tmp_path), str(tmp_path / "donnees_semaine")
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    tables.write_rollup(daily(spark, (d1, "A", 1.0), (d2, "A", 2.0)), path, "jour")
    rename, calls = tables._rename, []

    def broken(session, source, target):
        calls.append(target)
        if len(calls) == 2:  # the old rows are aside, the new ones not in place
            raise RuntimeError("stopped")
        rename(session, source, target)

    def swap():
        if bucketed:
            tables.write_rollup(daily(spark, (d2, "B", 5.0)), path, "jour")
        else:
            tables.replace_table(daily(spark, (d2, "B", 5.0)), path, "jour")

    monkeypatch.setattr(tables, "_rename", broken)
    with pytest.raises(RuntimeError):
        swap()
    monkeypatch.setattr(tables, "_rename", rename)
    tables.restore(spark, path)
    assert rows_of(tables.read_rollup(spark, base, "daily"), "jour", "nom_automate") == [(d1, "A"), (d2, "A")]
    swap()
    want = [(d1, "A"), (d2, "B")] if bucketed else [(d2, "B")]
    assert rows_of(tables.read_rollup(spark, base, "daily"), "jour", "nom_automate") == want
    assert [p.name for p in tmp_path.iterdir()] == ["donnees_semaine"]
