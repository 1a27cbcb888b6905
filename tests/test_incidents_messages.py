from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rivulet.operators import incidents as inc
from rivulet.operators import messages as msg
from rivulet.schemas import CONVERSATIONS, INCIDENTS, MESSAGES, STATIONS
from tests.conftest import rows_of


def panne(i, label, client="Acme", lieu="Nord", station="S1", text="détail", start=datetime(2024, 1, 2), end=None):
    return (i, client, lieu, station, label, text, start, end, "me@x")


def test_incident_types_merge_case_insensitively(spark):
    recorded = ["pompe hs", " Fuite cuve ", "", None, "Zz", "zz", "capteur DÉRIVE", "   "]
    df = spark.createDataFrame([panne(i, p) for i, p in enumerate(recorded)], INCIDENTS)
    types = [r[0] for r in inc.incident_types(df).collect()]
    assert len(types) == 27 and len({t.lower() for t in types}) == 27
    assert types == sorted(types, key=str.lower)
    assert "Pompe HS" in types and "Zz" in types and "zz" not in types and "capteur DÉRIVE" in types
    empty = inc.incident_types(df.limit(0)).collect()
    assert len(empty) == 25


def test_list_incidents(spark):
    df = spark.createDataFrame([panne(1, "a"), panne(3, "b", end=datetime(2024, 1, 2, 3, 4, 5))], INCIDENTS)
    rows = inc.list_incidents(df).collect()
    assert [r["id"] for r in rows] == [3, 1]
    assert (rows[0]["date_fin"], rows[1]["date_debut"], rows[1]["date_fin"]) == ("2024-01-02T03:04:05", "2024-01-02T00:00:00", None)


def test_validation(spark):
    automate = spark.createDataFrame(
        [("S1", 1, "Acme", "Nord", None, None, None, None), ("S2", 2, "Acme", "Nord", None, None, None, None)], STATIONS
    )
    new = spark.createDataFrame(
        [
            panne(1, "ok", end=datetime(2024, 1, 2)),
            panne(2, ""),
            panne(3, "x", start=None),
            panne(4, "x", end=datetime(2024, 1, 1)),
            panne(5, "x", lieu="Sud"),
            panne(6, "x", station="S2"),
            panne(7, " "),
        ],
        INCIDENTS,
    )
    accepted, rejected = inc.validate_incidents(new, automate)
    assert rows_of(accepted, "id") == [(1,), (7,)] and accepted.columns == new.columns
    assert rows_of(rejected, "id", "reason") == [
        (2, "missing_field"), (3, "missing_field"), (4, "end_before_start"), (5, "unknown_site"), (6, "station_mismatch"),
    ]


@pytest.fixture(scope="module")
def inbox(spark):
    def m(i, client, sender, read, hour):
        return (i, i % 2, client, sender, f"text {i}", None, datetime(2024, 1, 1, hour), read)

    return spark.createDataFrame(
        [m(1, "c", 0, False, 9), m(2, "c", 677, False, 8), m(3, "c", 1, False, 7), m(4, "d", 6863, False, 6),
         m(5, None, 1, False, 5), m(6, "c", 0, True, 4), m(7, "d", 5, False, 3), m(8, "d", 1, None, 2)],
        MESSAGES,
    )


def test_threads(inbox):
    thread = msg.message_thread(inbox, "client_id", "c").collect()
    assert [r["id"] for r in thread] == [6, 3, 2, 1] and thread[0]["created_at"] == "2024-01-01T04:00:00"
    assert [r["id"] for r in msg.message_thread(inbox, "conversation_id", 0).collect()] == [8, 6, 4, 2]


def test_unread(inbox):
    assert msg.unread_count(inbox, "c", msg.ADMIN_SENDERS).first()[0] == 2
    assert msg.unread_count(inbox, "c", msg.CLIENT_SENDERS).first()[0] == 1
    assert msg.unread_count(inbox, "nobody", msg.CLIENT_SENDERS).first()[0] == 0
    assert rows_of(msg.unread_by_client(inbox), "client_id", "count") == [("c", 1), ("d", 1)]


def test_conversations(spark):
    convs = spark.createDataFrame(
        [(1, "a", "support", datetime(2024, 1, 1)), (2, "b", "vente", datetime(2024, 1, 2)), (3, "b", "vente", None)], CONVERSATIONS
    )
    assert [r["id"] for r in msg.list_conversations(convs).collect()] == [3, 2, 1]
    assert [r["id"] for r in msg.list_conversations(convs, "a").collect()] == [1]
    clients = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "client_id string")
    assert rows_of(msg.missing_conversations(clients, convs), "client_id", "type") == [("b", "support"), ("c", "support")]


def test_posting_and_opening(spark, inbox):
    now = F.expr("TIMESTAMP '2024-02-01 00:00:00'")
    new = spark.createDataFrame([("c", 1, "hello"), ("d", 0, None)], "client_id string, sender_id int, content string")
    posted = msg.post_messages(inbox, new, now)
    fresh = posted.where("id > 8").collect()
    assert posted.count() == 10 and {(r["client_id"], r["is_read"], r["created_at"]) for r in fresh} == {
        ("c", False, datetime(2024, 2, 1)), ("d", False, datetime(2024, 2, 1)),
    }
    convs = spark.createDataFrame([(1, "a", "support", datetime(2024, 1, 1))], CONVERSATIONS)
    clients = spark.createDataFrame([("a",), ("b",)], "client_id string")
    once = msg.ensure_conversations(convs, clients, now)
    assert rows_of(once, "client_id", "type") == [("a", "support"), ("b", "support")]
    assert msg.ensure_conversations(once, clients, now).count() == 2


def test_recording_and_amending(spark):
    automate = spark.createDataFrame([("S1", 1, "Acme", "Nord", None, None, None, None)], STATIONS)
    log = spark.createDataFrame([panne(5, "old", end=datetime(2024, 1, 3))], INCIDENTS)
    new = spark.createDataFrame([panne(0, "Fuite cuve"), panne(0, "x", lieu="Sud")], INCIDENTS).drop("id", "created_by")
    recorded, rejected = inc.record_incidents(log, new, automate, "me@site")
    assert rows_of(rejected, "reason") == [("unknown_site",)]
    (fresh,) = recorded.where("id <> 5").collect()
    assert (fresh["panne"], fresh["created_by"]) == ("Fuite cuve", "me@site") and fresh["id"] > 5
    edits = spark.createDataFrame([panne(5, "new"), panne(77, "z")], INCIDENTS).withColumn("created_by", F.lit("other"))
    amended, _ = inc.amend_incidents(log, edits, automate)
    assert rows_of(amended, "id", "panne", "date_fin", "created_by") == [(5, "new", None, "me@x")]
