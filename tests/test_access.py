import pytest
from pyspark.sql import functions as F

from rivulet.operators import access as ac
from rivulet.schemas import ORGANIZATION_USERS, ORGANIZATIONS, ROLES, STATION_ACCESS, STATIONS, USER_ROLES, USERS
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def world(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return {
        "users": make([(1, "a@x", True, "acme"), (2, "b@x", True, None), (3, "c@x", True, "old")], USERS),
        "orgs": make([(1, "acme"), (2, "beta")], ORGANIZATIONS),
        "org_users": make([(1, 1, "org_admin"), (1, 2, "employee"), (2, 1, "employee")], ORGANIZATION_USERS),
        "roles": make([(1, "admin"), (3, "client")], ROLES),
        "user_roles": make([(1, 1), (1, 3), (2, 3), (3, 3)], USER_ROLES),
        "stations": make(
            [("S1", 1, "Acme", "l", None, None, None, None), ("S2", 2, "Gamma", "l", None, None, None, None),
             ("S3", 3, "Acme", "l", None, None, None, 2)],
            STATIONS,
        ),
        "access": make([("S1", 1), ("S2", 1), ("S1", 2)], STATION_ACCESS),
    }


def members(df):
    return rows_of(df, "user_id", "organization_id", "org_role")


def test_assign_access(spark, world):
    requests = spark.createDataFrame(
        [
            (1, [" Admin", "nobody", ""], "ignored", ["acme ", " ", "missing"]),
            (2, ["client"], " beta ", None),
            (3, [], None, None),
        ],
        "user_id long, roles array<string>, client_id string, organization_names array<string>",
    )
    users, org_users, user_roles = ac.assign_access(
        world["users"], world["org_users"], world["user_roles"], world["orgs"], world["roles"], requests
    )
    assert rows_of(users, "id", "client_id") == [(1, "acme"), (2, "beta"), (3, "old")]
    assert members(org_users) == [(1, 1, "org_admin"), (2, 1, "employee"), (2, 2, "employee")]
    assert rows_of(user_roles, "user_id", "role_id") == [(1, 1), (2, 3)]


def test_an_empty_list_removes_every_membership(spark, world):
    requests = spark.createDataFrame(
        [(1, ["client"], None, [])], "user_id long, roles array<string>, client_id string, organization_names array<string>"
    )
    users, org_users, _ = ac.assign_access(
        world["users"], world["org_users"], world["user_roles"], world["orgs"], world["roles"], requests
    )
    assert members(org_users) == [(2, 1, "employee")]
    assert rows_of(users.where("id = 1"), "client_id") == [(None,)]


def test_create_organizations(spark, world):
    requests = spark.createDataFrame(
        [(" gamma ", " B@x "), ("acme", "c@x"), ("", "a@x"), ("delta", "nomail"), ("eps", "who@x")], "name string, admin_email string"
    )
    orgs, org_users, users, stations = ac.create_organizations(
        world["orgs"], world["org_users"], world["users"], world["stations"], requests
    )
    ids = {r["name"]: r["id"] for r in orgs.collect()}
    assert set(ids) == {"acme", "beta", "gamma"} and ids["gamma"] > 2
    assert (3, 1, "org_admin") in members(org_users) and (2, ids["gamma"], "org_admin") in members(org_users)
    assert (1, 1, "org_admin") in members(org_users)
    assert rows_of(users, "id", "client_id") == [(1, "acme"), (2, "gamma"), (3, "acme")]
    assert rows_of(stations, "nom_automate", "organization_id") == [("S1", 1), ("S2", ids["gamma"]), ("S3", 2)]


def test_add_and_remove_members(spark, world):
    requests = spark.createDataFrame(
        [(1, "B@X ", "Org_Admin"), (2, "c@x", "employee"), (2, "a@x", "boss"), (2, "who@x", "employee")],
        "organization_id int, email string, org_role string",
    )
    org_users, users = ac.add_members(world["org_users"], world["users"], world["orgs"], requests)
    assert members(org_users) == [(1, 1, "employee"), (1, 2, "employee"), (2, 1, "org_admin"), (3, 2, "employee")]
    assert rows_of(users, "id", "client_id") == [(1, "acme"), (2, "acme"), (3, "beta")]
    removed = spark.createDataFrame([(1, 1), (2, 1)], "user_id long, organization_id int")
    left, after = ac.remove_members(org_users, users, world["orgs"], removed)
    assert members(left) == [(1, 2, "employee"), (3, 2, "employee")]
    assert rows_of(after, "id", "client_id") == [(1, "beta"), (2, None), (3, "beta")]


def test_station_and_member_access(spark, world):
    requests = spark.createDataFrame(
        [("S1", [" C@x", "c@x", ""]), ("S2", ["a@x", "who@x"]), ("S3", [" "])], "automate_nom string, emails array<string>"
    )
    grants, unknown = ac.set_station_access(world["access"], world["users"], requests)
    assert rows_of(grants, "automate_nom", "user_id") == [("S1", 3), ("S2", 1)]
    assert rows_of(unknown, "automate_nom", "email") == [("S2", "who@x")]

    asked = spark.createDataFrame(
        [(1, ["S1", "S3"]), (2, []), (3, ["S1"])], "user_id long, automate_noms array<string>"
    )
    args = (world["org_users"], world["orgs"], world["stations"])
    grants, outside = ac.set_member_access(world["access"], *args, asked, 1)
    assert rows_of(grants, "automate_nom", "user_id") == [("S1", 1), ("S2", 1), ("S3", 1)]
    assert outside.count() == 0
    bad = asked.where("user_id = 1").withColumn("automate_noms", F.array(F.lit("S1"), F.lit("S2")))
    grants, outside = ac.set_member_access(world["access"], *args, bad, 1)
    assert rows_of(grants, "automate_nom", "user_id") == rows_of(world["access"], "automate_nom", "user_id")
    assert rows_of(outside, "automate_nom") == [("S2",)]


def test_a_user_added_to_two_organizations_stays_one_user(spark, world):
    requests = spark.createDataFrame(
        [(1, "\tc@x\n", "employee"), (2, "C@X ", "org_admin"), (2, "b@x", "org_admin"), (2, "c@x", "employee")],
        "organization_id int, email string, org_role string",
    )
    memberships, users = ac.add_members(world["org_users"], world["users"], world["orgs"], requests)
    assert rows_of(users, "id", "client_id") == [(1, "acme"), (2, "beta"), (3, "beta")]
    rows = members(memberships)
    assert len(rows) == len({r[:2] for r in rows}) and (3, 2, "org_admin") in rows and (1, 2, "employee") in rows
