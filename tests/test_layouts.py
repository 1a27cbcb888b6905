"""Tables by a hash of their key, bucketed and partitioned readings, the ordered export file."""

import csv
import io
import os
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rivulet.functions.text import norm_email
from rivulet.operators import changes, entitlements, hourly, incidents, rollup
from rivulet.plans.inputs import AS_OF, load_input
from rivulet.plans.jobs import refresh_latest_counters
from rivulet.schemas import COUNTER_CACHE, STATION
from rivulet.sources import readings as rd
from rivulet.sources import sinks, tables
from tests.conftest import rows_of

SF = "/root/testdata/sf0.001"


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names}


def folders(path):
    return {os.path.relpath(os.path.dirname(f), path) for f in files(path) if f.endswith(".parquet")}


def test_a_change_of_few_keys_rewrites_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.range(2000).select("id", (F.col("id") % 7).alias("v"), F.lit("old").alias("w"))
    tables.write_keyed(target, path, ["id"], 64)
    assert tables.keyed_layout(spark, path) == (["id"], 64) and len(folders(path)) == 64
    before = files(path)
    edits = spark.createDataFrame([(i * 100, "new") for i in range(20)], "id long, w string")
    touched = tables.change_keyed(spark, path, target.schema, edits, lambda t, c: changes.full_update(t, c, ["id"]))
    after = files(path)
    rewritten = {os.path.relpath(os.path.dirname(f), path) for f in after if f.endswith(".parquet") and f not in before}
    assert rewritten == {f"partie={p}" for p in touched} and len(touched) <= 20
    assert all(after[f] == before[f] for f in before if os.path.relpath(os.path.dirname(f), path) not in rewritten)
    want = changes.full_update(target, edits, ["id"])
    got = tables.read_keyed(spark, path, target.schema)
    assert rows_of(got, "id", "v", "w") == rows_of(want, "id", "v", "w")
    assert tables.change_keyed(spark, path, target.schema, edits.limit(0), lambda t, c: t.limit(0)) == []
    gone = tables.change_keyed(spark, path, target.schema, got.select("id"), lambda t, c: changes.delete_keys(t, c))
    assert len(gone) == 64 and tables.read_keyed(spark, path, target.schema).count() == 0
    one = spark.createDataFrame([(5, 1, "back")], target.schema)
    tables.change_keyed(spark, path, target.schema, one, lambda t, c: changes.insert_absent(t, c, ["id"]))
    assert rows_of(tables.read_keyed(spark, path, target.schema), "id", "w") == [(5, "back")]


def test_a_cut_off_change_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    target = spark.range(100).select("id", F.lit(1).alias("v"))
    tables.write_keyed(target, path, ["id"], 4)
    rename, calls = tables._rename, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 4:
            raise OSError("lost")
        rename(*args)

    monkeypatch.setattr(tables, "_rename", failing)
    edits = spark.range(100).select("id", F.lit(2).alias("v"))

    def change(t, c):
        return changes.full_update(t, c, ["id"])

    with pytest.raises(OSError, match="lost"):
        tables.change_keyed(spark, path, target.schema, edits, change)
    monkeypatch.undo()
    tables.restore(spark, path)
    assert tables.read_keyed(spark, path, target.schema).count() == 100
    tables.change_keyed(spark, path, target.schema, edits, change)
    assert tables.read_keyed(spark, path, target.schema).agg(F.sum("v")).first()[0] == 200


def test_cache_refresh_touches_only_stations_with_readings(spark, tmp_path, readings):
    base, r, a = str(tmp_path), "compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3"
    many = readings(*[{"horodatage": "2024-01-01 00:00", "nom_automate": f"S{k}", r: 1.0, a: 1.0} for k in range(300)])
    path = refresh_latest_counters(spark, many, base, datetime(2024, 1, 1, 12))
    before = files(path)
    some = readings({"horodatage": "2024-01-02 00:00", "nom_automate": "S7", r: 2.0, a: 1.0}, {"horodatage": "2024-01-02 00:00", "nom_automate": "new", r: 3.0, a: 1.0})
    refresh_latest_counters(spark, some, base, datetime(2024, 1, 2, 12))
    kept = [f for f in files(path) if f in before and f.endswith(".parquet")]
    assert len(folders(path)) - len({os.path.dirname(f) for f in kept}) <= 2
    stored = tables.read_keyed(spark, path, COUNTER_CACHE)
    assert stored.count() == 301 and rows_of(stored.where("compteur_eau_renvoi_m3 > 1"), STATION, r) == [("S7", 2.0), ("new", 3.0)]
    # A cache written before there was a layout is read whole once and laid out.
    plain = str(tmp_path / "old" / "cache_volumes_total")
    stored.write.parquet(plain)
    refresh_latest_counters(spark, some, str(tmp_path / "old"), datetime(2024, 1, 3, 12))
    assert tables.is_keyed(spark, plain) and tables.read_keyed(spark, plain, COUNTER_CACHE).count() == 301


def windows_before_shuffles(df):
    """Whether the first window over readings has no exchange below it."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    last = max(i for i, line in enumerate(plan) if "Window [" in line)
    scan = next(i for i, line in enumerate(plan) if i > last and "FileScan" in line)
    return not any("Exchange" in line for line in plan[last:scan])


def test_bucketed_readings_are_not_shuffled(spark, tmp_path):
    every = load_input(spark, SF, "mesures")
    names = every.select(STATION).distinct()
    for by in ((STATION,), (STATION, "jour")):
        stored = rd.write_bucketed(rd.with_day(every), f"mesures_{len(by)}", str(tmp_path / str(len(by))), 8, by)
        for got, plain in (
            (hourly.hourly_energy(stored, AS_OF), hourly.hourly_energy(every, AS_OF)),
            (rollup.rollup_daily(stored, None, AS_OF, stations=names), rollup.rollup_daily(every, None, AS_OF, stations=names)),
        ):
            assert windows_before_shuffles(got) and not windows_before_shuffles(plain)
            assert rows_of(got, *got.columns) == rows_of(plain, *got.columns)
        spark.sql(f"DROP TABLE mesures_{len(by)}")


def test_folders_of_stations_are_found_while_the_query_runs(spark, tmp_path):
    path = str(tmp_path / "mesures")
    every = load_input(spark, SF, "mesures_longues")
    rd.write_by_station(every, path, 8)
    wanted = load_input(spark, SF, "automate").where("numero_automate < 103").select(STATION)
    got = rd.scan_readings(spark, path, stations=wanted, columns=(STATION, "seq"), station_groups=8)
    assert "dynamicpruningexpression(groupe" in got._jdf.queryExecution().executedPlan().toString()
    from_plain_list = rd.scan_readings(spark, path, stations=spark.createDataFrame([("ST1",)], f"{STATION} string"), station_groups=8)
    assert "dynamicpruningexpression(groupe" in from_plain_list._jdf.queryExecution().executedPlan().toString()
    plain = every.join(wanted, STATION, "left_semi")
    assert rows_of(got, STATION, "seq") == rows_of(plain, STATION, "seq") and got.count() > 0
    listed = rd.scan_readings(spark, path, stations=["ST1", "ST2"], columns=(STATION, "seq"), station_groups=8)
    assert rows_of(listed, STATION, "seq") == rows_of(every.where("nom_automate in ('ST1', 'ST2')"), STATION, "seq")
    assert re.search(r"PartitionFilters: \[[^\]]*groupe", listed._jdf.queryExecution().executedPlan().toString())


def test_interned_sets_answer_for_every_user(spark):
    t = {n: load_input(spark, SF, n) for n in ("automate", "user_roles", "roles", "organization_users", "organizations")}
    # Organizations that have stations, so that sets of several rules see some.
    clients = t["automate"].select(F.col("client").alias("name")).distinct().where("client is not null")
    orgs = t["organizations"].unionByName(clients.withColumn("id", (F.hash("name") % 1000 + 2000).cast("int")))
    extra = orgs.where("id > 100").select((F.col("id") % 20 + 1).cast("long").alias("user_id"), F.col("id").alias("organization_id"), F.lit("employee").alias("org_role"))
    scope = entitlements.station_scope(t["user_roles"], t["roles"], t["organization_users"].unionByName(extra), orgs).cache()
    members, sets = entitlements.interned_scopes(scope)
    pairs = members.join(entitlements.stations_of_sets(t["automate"], sets), "set_id")
    got = {}
    for r in pairs.collect():
        got.setdefault(r["user_id"], []).append(r[STATION])
    assert members.count() == scope.select("user_id").distinct().count()
    counts = {r["user_id"]: r["nb_stations"] for r in entitlements.visible_station_counts(t["automate"], scope).collect()}
    for user in [r[0] for r in members.select("user_id").collect()]:
        assert len(got.get(user, [])) == counts[user]
    for user in (1, 2, 3, 5, 50, 75, 150, 11, 17):
        want = sorted(r[0] for r in entitlements.visible_stations(t["automate"], scope, user).select(STATION).collect())
        assert sorted(got.get(user, [])) == want
    plain = entitlements.station_scope(t["user_roles"], t["roles"], t["organization_users"], t["organizations"])
    plan = entitlements.visible_stations(t["automate"], plain, 3)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "s_suppkey" in line for line in plan.split("\n")) == 1


def test_export_file_has_the_bytes_of_a_csv_writer(spark, tmp_path):
    r = random.Random(1)
    values = [None, 0.0, -0.0, 0.1, 1e-3, 9.99e-4, 1e-4, 1.5e-5, 1e7, 12345678.9, 1e15, 1.5e16, 1e22, -2.5e-7, 123456789012.25, float("inf"), float("nan")]
    names = ["plain", 'with "quotes"', "semi;colon", "line\nbreak", "", None, " blank ", "é", "cr\rhere"]
    rows = [(date(2024, 1, 1 + k % 28), f"S{k:03d}", values[k % len(values)], r.randint(-5, 10**9) if k % 5 else None, names[k % len(names)]) for k in range(300)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "date date, nom_automate string, v double, n long, nom string")
    path = str(tmp_path / "export.csv")
    sinks.write_csv_file(df, path, ["date", STATION], parts=5)
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";")
    writer.writerow(df.columns)
    for row in sorted(rows, key=lambda x: (x[0], x[1])):
        writer.writerow([row[0].strftime("%Y-%m-%d"), row[1], *["" if v is None else str(v) for v in row[2:]]])
    with open(path, "rb") as f:
        assert f.read() == out.getvalue().encode()
    assert not [n for n in os.listdir(tmp_path) if "staged" in n]
    sinks.write_csv_file(df.limit(0), path, ["date"])
    with open(path, "rb") as f:
        assert f.read() == b"date;nom_automate;v;n;nom\r\n"


def test_case_is_folded_fully_and_blanks_of_any_kind_go(spark):
    log = spark.createDataFrame([(1, "Straße"), (2, "STRASSE "), (3, " "), (4, "fuite CUVE"), (5, "zz")], "id long, panne string")
    types = [r["type"] for r in incidents.incident_types(log, ("Fuite cuve", "Zèbre")).collect()]
    assert types == ["Fuite cuve", "STRASSE", "zz", "Zèbre"]
    raw = [(" Jo@X.example ",), ("　 ",), ("\x85a@b\x1f",)]
    mails = spark.createDataFrame(raw, "m string").select(norm_email(F.col("m")).alias("m"))
    assert [r["m"] for r in mails.collect()] == [x[0].strip().lower() or None for x in raw]
