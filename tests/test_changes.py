from datetime import date, datetime

from pyspark.sql import functions as F

from rivulet.operators import changes as ch
from rivulet.operators.numbering import running_offsets
from rivulet.schemas import MESSAGES, ORGANIZATION_USERS, ORGANIZATIONS, STATION_ACCESS, STATIONS, USERS
from tests.conftest import rows_of

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 2, 1)
SCHEMA = "k int, v double, w string, created_at timestamp_ntz, updated_at timestamp_ntz"


def now():
    return F.lit("2024-02-01").cast("timestamp_ntz")


def test_insert_absent(spark):
    target = spark.createDataFrame([(1, 1.0)], "k int, v double")
    new = spark.createDataFrame([(1, 9.0, 1), (2, 5.0, 2), (2, 4.0, 1)], "k int, v double, o int")
    got = ch.insert_absent(target, new, ["k"], order="o")
    assert rows_of(got, "k", "v") == [(1, 1.0), (2, 4.0)]
    again = ch.insert_absent(got, new, ["k"])
    assert rows_of(again, "k", "v") == rows_of(got, "k", "v")


def test_upsert_keeps_created_sets_updated_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, 1.0, "a", OLD, OLD), (2, 2.0, "b", OLD, OLD)], SCHEMA)
    source = spark.createDataFrame([(2, None), (3, 3.0)], "k int, v double")
    once = ch.upsert(target, source, ["k"], now())
    want = [(1, 1.0, "a", OLD, OLD), (2, None, "b", OLD, NEW), (3, 3.0, None, NEW, NEW)]
    columns = ("k", "v", "w", "created_at", "updated_at")
    assert rows_of(once, *columns) == want
    assert rows_of(ch.upsert(once, source, ["k"], now()), *columns) == want
    assert once.schema == target.schema


def test_window_retention_rebuild_and_deletes(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    target = spark.createDataFrame([(d, "A", 1) for d in days] + [(None, "A", 1)], "jour date, s string, v int")
    new = spark.createDataFrame([(days[1], "B", 2)], "jour date, s string, v long")
    replaced = ch.replace_window(target, new, "jour", days[1:])
    assert rows_of(replaced, "jour", "s") == [(None, "A"), (days[0], "A"), (days[1], "B")]
    assert rows_of(ch.retain_from(target, "jour", days[1]), "jour") == [(days[1],), (days[2],)]
    assert rows_of(ch.rebuild(target, new), "jour", "s", "v") == [(days[1], "B", 2)]
    assert ch.rebuild(target, new).schema == target.schema
    assert ch.delete_bucket(target, "jour", days[0]).count() == 3
    keys = spark.createDataFrame([(days[0], "A"), (days[1], "nope")], "jour date, s string")
    assert ch.delete_keys(target, keys).count() == 3


def test_partial_and_full_update(spark):
    target = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k int, x string, y string")
    edits = spark.createDataFrame([(1, "A", None), (9, "z", "z")], "k int, x string, y string")
    assert rows_of(ch.partial_update(target, edits, ["k"]), "k", "x", "y") == [(1, "A", "b"), (2, "c", "d")]
    upper = ch.partial_update(target, edits, ["k"], {"x": lambda c: F.nullif(c, F.lit("A"))})
    assert rows_of(upper, "k", "x", "y") == [(1, None, "b"), (2, "c", "d")]
    assert rows_of(ch.full_update(target, edits, ["k"]), "k", "x", "y") == [(1, "A", None), (2, "c", "d")]


def test_conditional_updates(spark):
    inbox = spark.createDataFrame(
        [(1, 1, "c", 0, "", None, OLD, False), (2, 1, "c", 1, "", None, OLD, False), (3, 1, "d", 0, "", None, OLD, False),
         (4, 1, None, 0, "", None, OLD, False), (5, 1, "c", 0, "", None, OLD, None)],
        MESSAGES,
    )
    clients = spark.createDataFrame([("c",), ("c",)], "client_id string")
    read = ch.mark_read(inbox, clients, (0, 677))
    assert rows_of(read, "id", "is_read") == [(1, True), (2, False), (3, False), (4, False), (5, None)]
    assert read.columns == inbox.columns

    members = spark.createDataFrame([(1, 1, "org_admin"), (2, 1, "employee"), (3, 2, "org_admin")], ORGANIZATION_USERS)
    appointed = spark.createDataFrame([(1, 2)], "organization_id int, user_id long")
    assert rows_of(ch.demote_other_admins(members, appointed), "user_id", "org_role") == [
        (1, "employee"), (2, "employee"), (3, "org_admin"),
    ]

    orgs = spark.createDataFrame([(5, "acme"), (6, "other")], ORGANIZATIONS)
    stations = spark.createDataFrame(
        [("S1", 1, "ACME", "l", None, None, None, None), ("S2", 2, "Acme", "l", None, None, None, 9), ("S3", 3, None, "l", None, None, None, None)],
        STATIONS,
    )
    assert rows_of(ch.link_stations(stations, orgs), "nom_automate", "organization_id") == [("S1", 5), ("S2", 9), ("S3", None)]

    users = spark.createDataFrame([(1, "a", True, "x"), (2, "b", True, "y")], USERS)
    moves = spark.createDataFrame([(1, None), (7, "q")], "user_id long, client_id string")
    assert rows_of(ch.set_client(users, moves), "id", "client_id") == [(1, None), (2, "y")]


def test_replace_set_keeps_roles(spark):
    members = spark.createDataFrame([(1, 1, "org_admin"), (1, 2, "employee"), (2, 1, "org_admin"), (3, 1, "employee")], ORGANIZATION_USERS)
    owners = spark.createDataFrame([(1,), (3,)], "user_id long")
    wanted = spark.createDataFrame([(1, 1), (1, 7), (1, 7)], "user_id long, organization_id int")
    got = ch.replace_set(members, owners, wanted, "user_id", "organization_id", {"org_role": "employee"})
    want = [(1, 1, "org_admin"), (1, 7, "employee"), (2, 1, "org_admin")]
    assert rows_of(got, "user_id", "organization_id", "org_role") == want
    again = ch.replace_set(got, owners, wanted, "user_id", "organization_id", {"org_role": "employee"})
    assert rows_of(again, "user_id", "organization_id", "org_role") == want


def test_replace_set_inside_a_scope(spark):
    access = spark.createDataFrame([("S1", 1), ("S2", 1), ("X", 1), ("S1", 2)], STATION_ACCESS)
    owners = spark.createDataFrame([(1,)], "user_id long")
    scope = spark.createDataFrame([("S1",), ("S2",), ("S3",)], "automate_nom string")
    wanted = spark.createDataFrame([("S3", 1), ("X", 1)], STATION_ACCESS)
    got = ch.replace_set(access, owners, wanted, "user_id", "automate_nom", scope=scope)
    assert rows_of(got, "automate_nom", "user_id") == [("S1", 2), ("S3", 1), ("X", 1)]


def test_append_rows_generates_unique_repeatable_ids(spark):
    target = spark.createDataFrame([(41, "a")], "id long, v string")
    new = spark.range(100).select((F.col("id") % 90).cast("string").alias("v"))  # ten rows are copies
    ids = [r["id"] for r in ch.append_rows(target, new).collect()]
    assert len(ids) == len(set(ids)) == 101 and min(ids) == 41
    again = ch.append_rows(target, new.repartition(7, F.rand(1)))
    assert sorted(r["id"] for r in again.collect()) == sorted(ids)
    assert sorted(r["v"] for r in again.collect())[-1] == "a"
    assert ch.append_rows(target.limit(0), new.limit(1)).first()["id"] >= 1


def test_the_last_change_of_a_repeated_key_counts_once(spark):
    target = spark.createDataFrame([(1, 1.0, "a", OLD, OLD), (2, 2.0, "b", OLD, OLD)], SCHEMA)
    twice = spark.createDataFrame([(1, 5.0, "x", 1), (1, 4.0, "y", 2), (1, 9.0, "w", 1)], "k int, v double, w string, o int")
    assert rows_of(ch.full_update(target, twice, ["k"], order="o"), "k", "v", "w") == [(1, 4.0, "y"), (2, 2.0, "b")]
    assert rows_of(ch.partial_update(target, twice, ["k"], order="o"), "k", "v", "w") == [(1, 4.0, "y"), (2, 2.0, "b")]
    assert rows_of(ch.upsert(target, twice.drop("o"), ["k"], now()), "k", "v", "w") == [(1, 9.0, "w"), (2, 2.0, "b")]
    two = spark.createDataFrame([(1, 7), (1, 8)], "organization_id int, user_id bigint")
    members = spark.createDataFrame([(7, 1, "org_admin"), (8, 1, "employee"), (9, 2, "employee")], ORGANIZATION_USERS)
    assert rows_of(ch.demote_other_admins(members, two), "user_id", "org_role") == [(7, "employee"), (8, "employee"), (9, "employee")]
    stations = spark.createDataFrame([("S1", 4), ("S1", 3), ("S2", 1)], "k string, v int")
    assert rows_of(ch.insert_absent(stations.where("v = 1"), stations, ["k"]), "k", "v") == [("S1", 3), ("S2", 1)]


def test_append_runs_nothing_early_and_spreads_equal_rows(spark):
    target = spark.createDataFrame([(5, "a")], "id bigint, w string")
    new = spark.range(300).selectExpr("'same' as w")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    out = ch.append_rows(target, new, groups=16)
    assert set(tracker.getJobIdsForGroup()) == before
    ids = [r["id"] for r in out.collect() if r["w"] == "same"]
    assert len(set(ids)) == 300 and min(ids) > 5 and len({(i - 6) % 16 for i in ids}) == 16


def test_dense_ids_have_no_gaps_and_need_no_sort_in_one_task(spark):
    target = spark.createDataFrame([(41, "a"), (7, "b")], "id long, v string")
    new = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("v"))
    out = ch.append_rows_dense(target, new)
    added = {r["id"]: r["v"] for r in out.collect() if r["id"] > 41}
    assert sorted(added) == list(range(42, 5042)) and list(added.values()).count("hot") == 1667
    assert list(added.values()).count(None) == 1666
    again = ch.append_rows_dense(target, new.repartition(5, F.rand(3)))
    assert {r["id"]: r["v"] for r in again.collect() if r["id"] > 41} == added
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan
    assert [r["id"] for r in ch.append_rows_dense(target.limit(0), new.limit(1)).collect()] == [1]
    assert ch.append_rows_dense(target, new.limit(0)).count() == 2


def test_running_offsets_over_blocks_and_groups(spark):
    rows = spark.range(1000).selectExpr("id % 3 as g", "id * 7 as p", "id as n")
    out = running_offsets(rows, "p", "n", "before", ["g"], block=64).collect()
    for r in out:
        assert r["before"] == sum(i for i in range(r["n"]) if i % 3 == r["g"])
    assert running_offsets(rows.limit(0), "p", "n").count() == 0
