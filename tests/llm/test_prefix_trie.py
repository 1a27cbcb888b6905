from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from rivulet.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    """Turns of every conversation in order; ties by the digest that the operator uses."""
    found: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found.setdefault(c, []).append((turn is not None, turn or 0, name, (role, text)))
    return {c: [t[3] for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    nodes: dict = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), set()).add(c)
    children: dict = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves: dict = {}
    saved: dict = {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[b] for b in below) if below else 1
        own = (len(nodes[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own + sum(saved[b] for b in below)
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), len(children.get(path, [])), leaves[path], saved[path], digest))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def long_rows():
    """Conversations that part at all depths, at the cuts of all heights and beside them; many that are equal."""
    r = random.Random(3)
    trunk = [("user" if k % 2 == 0 else "assistant", f"turn {k} " + "é" * (k % 3)) for k in range(150)]
    rows = []
    for c in range(60):
        shared = r.choice([0, 1, 5, 15, 16, 17, 31, 32, 33, 47, 48, 63, 64, 65, 95, 96, 97, 127, 128, 129, 150])
        own = r.choice([0, 0, 0, 1, 3, 20])
        turns = trunk[:shared] + [("user", f"own {c} {k}") for k in range(own)]
        rows += [(c * 7, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(1000 + c, k, role, text) for c in range(200) for k, (role, text) in enumerate(trunk[:40])]
    r.shuffle(rows)
    return rows


def test_long_conversations_match_plain_version(spark, long_rows, monkeypatch):
    monkeypatch.setattr(pt, "TURNS", 7)
    monkeypatch.setattr(pt, "IDS", 16)
    got = told(pt.prefix_trie(spark.createDataFrame(long_rows, SCHEMA)))
    assert got == brute(sequences(long_rows))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, "user", "hi"),
        (1, 0, "user", "hi"),  # a repeated row is a turn of its own
        (1, -5, None, None),
        (2, None, "user", "first"),
        (2, 3, "assistant", "x" * 50_000),
        (3, 0, "", ""),
        (4, 0, None, None),
        (-7, 2, "a", "b"),
        (-7, 2, "a", "a"),
        (None, 0, "user", "lost"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'n' as node", "1 as depth", "'c' as conv", "2 as at")
    assert told(pt.prefix_trie(df)) == brute(sequences(rows))
    assert pt.prefix_trie(df.where("false")).count() == 0
    renamed = df.selectExpr("conv_id as a", "turn as b", "role as c", "text as d")
    assert told(pt.prefix_trie(renamed, "a", "b", "c", "d")) == brute(sequences(rows))


def test_swapped_beginnings_match_plain_version(spark, long_rows):
    short = [row for row in long_rows if row[0] % 3 or row[1] < 9] + [(-205, 0, "user", "only"), (90_005, 0, "user", "base is absent")]
    turns = pt.staged(pt.digest_turns(spark.createDataFrame(short, SCHEMA)))
    convs = rebuilt(sequences(short))
    signed = {c: t for c, t in convs.items() if c >= 0}  # the remainder of a negative id has its sign
    assert told(pt.trie(pt.rebuilt_turns(turns.where("conv >= 0")), turns.where("conv >= 0").select("conv"))) == brute(signed)
    assert any(not t for t in signed.values())
