"""Prefix trie of conversations by van Emde Boas recursion, for what shared beginnings would save.

Depths are cut in halves, the halves again, and so on: a tree of height 2h with its root at depth d has an upper trie of
the depths d to d + h - 1, and a lower tree for every node at depth d + h, the cut prefixes. A cut prefix is named after its
tree's root and the turns between; the upper trie and all lower trees are dealt with side by side, so a level of the recursion is
one round for the whole table, and a conversation of n turns takes log n rounds. Trees of height 16 are done at once. On the way
back the totals of the lower trees are grafted on: each goes to the nodes of the upper trie above its root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import CRC32_STEPS, crc32_sql, read, staged
from rivulet.operators.numbering import running_offsets

HEIGHT = 16
TURNS = 1024  # turn numbers of one conversation that are ordered together
IDS = 4096
ROOT = ""
_FIRST = -(1 << 60)


def digest_turns(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv at name chars``: turns numbered from 1 in their order, with a digest of role and text and the text's code points.

    Turn numbers ascend, missing ones come first, ties go by digest. A long conversation is numbered in stretches
    of turn numbers, which counts and prefix sums put in their places; texts stay where they were read.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = convs.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)).alias("name"),
        F.length(text_).cast("long").alias("chars"),
    )
    rows = staged(rows.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / F.lit(TURNS)).cast("long"), F.lit(_FIRST))))
    stretches = running_offsets(rows.groupBy("conv", "stretch").agg(F.count("*").alias("n")), "stretch", "n", "before", ["conv"])
    inside = Window.partitionBy("conv", "stretch").orderBy(F.col("turn").asc_nulls_first(), "name")
    at = F.col("before") + F.row_number().over(inside)
    placed = rows.join(stretches.select("conv", "stretch", "before"), ["conv", "stretch"])
    return placed.select("conv", at.cast("long").alias("at"), "name", "chars")


def _chunks(turns: DataFrame) -> DataFrame:
    """``conv chunk names chars``: sixteen turns a row."""
    chunk = F.floor((F.col("at") - 1) / HEIGHT).cast("long").alias("chunk")
    rows = turns.groupBy("conv", chunk).agg(F.sort_array(F.collect_list(F.struct("at", "name", "chars"))).alias("turns"))
    return staged(rows.select("conv", "chunk", F.col("turns.name").alias("names"), F.col("turns.chars").alias("chars")))


def _name(root: Column, turns: Column) -> Column:
    return F.md5(F.concat(root, F.array_join(turns, "")))


def _cut_prefixes(chunks: DataFrame) -> DataFrame:
    """``conv cut node``: the name of every prefix of 16 times ``cut`` turns, ``cut`` from 1.

    Upwards, two halves make the digest of the whole between two cuts; downwards, the cut in the middle of a tree is
    named after the tree's root and the digest of the half above it.
    """
    full = chunks.where(F.size("names") == HEIGHT).select("conv", F.col("chunk").alias("k"), F.md5(F.array_join("names", "")).alias("digest"))
    halves = [staged(full)]
    most = halves[0].agg(F.max("k")).first()[0]
    if most is None:
        return full.select("conv", F.col("k").alias("cut"), F.col("digest").alias("node"))
    for _ in range(int(most + 1).bit_length() - 1):
        pairs = halves[-1].groupBy("conv", F.floor(F.col("k") / 2).cast("long").alias("k")).agg(
            F.max(F.when(F.col("k") % 2 == 0, F.col("digest"))).alias("a"), F.max(F.when(F.col("k") % 2 == 1, F.col("digest"))).alias("b")
        )
        halves.append(staged(pairs.where("a is not null and b is not null").select("conv", "k", F.md5(F.concat("a", "b")).alias("digest"))))
    named: list[DataFrame] = []
    for j in range(len(halves) - 1, -1, -1):
        upper = halves[j].where(F.col("k") % 2 == 0).select("conv", (F.col("k") * (1 << j)).alias("root"), "digest")
        first = upper.where("root = 0").withColumn("node", F.lit(ROOT))
        if named:
            roots = reduce(DataFrame.unionAll, named).select("conv", F.col("cut").alias("root"), "node")
            first = first.unionByName(upper.where("root > 0").join(roots, ["conv", "root"]))
        new = first.select("conv", (F.col("root") + (1 << j)).alias("cut"), _name(F.col("node"), F.array("digest")).alias("node"))
        named.append(staged(new))
    return reduce(DataFrame.unionAll, named)


def _paths(chunks: DataFrame) -> DataFrame:
    """``conv chunk nodes chars``: the node at the chunk's upper edge, then one for each of its turns."""
    cuts = _cut_prefixes(chunks)
    starts = cuts.select("conv", F.col("cut").alias("chunk"), F.col("node").alias("start"))
    nexts = cuts.select("conv", (F.col("cut") - 1).alias("chunk"), F.col("node").alias("next"))
    rows = chunks.join(starts, ["conv", "chunk"], "left").join(nexts, ["conv", "chunk"], "left")
    start = F.coalesce("start", F.lit(ROOT))
    inner = F.transform(
        F.sequence(F.lit(1), F.least(F.size("names"), F.lit(HEIGHT - 1))), lambda d: _name(start, F.slice("names", F.lit(1), d))
    )
    nodes = F.concat(F.array(start), inner, F.when(F.col("next").isNotNull(), F.array("next")).otherwise(F.array().cast("array<string>")))
    return staged(rows.select("conv", "chunk", nodes.alias("nodes"), "chars"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """``node ends_sha256`` over the ids of conversations that end at a node, in numeric order.

    Ids are joined in ranges of 4,096, and the digest runs over the ranges one after another, so no list is ever held whole.
    """
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy("node", F.floor(F.col("conv") / IDS).cast("long").alias("range")).agg(listed.alias("ids"))
    pieces = pieces.repartition("node").sortWithinPartitions("node", "range")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            nodes, digests = [], []
            for n, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if n != node:
                    if node is not None:
                        nodes.append(node)
                        digests.append(state.hexdigest())
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.record_batch([pa.array(nodes, pa.string()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.record_batch([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    return pieces.mapInArrow(digest, "node string, ends_sha256 string")


def _totals(nodes: DataFrame, paths: DataFrame, most: int) -> DataFrame:
    """``node leaves saved``: own values and those of all nodes below, grafted on from tree to tree."""
    kept = ["node", "depth", "conv_id", "leaves", "saved"]

    def grafted(totals: DataFrame, above: DataFrame) -> DataFrame:
        added = above.select("node", F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("conv_id"), "leaves", "saved")
        sums = [F.max("depth").alias("depth"), F.max("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
        return staged(totals.select(*kept).unionAll(added).groupBy("node").agg(*sums))

    # Trees of height 16: every node to those above it, as far as its tree's root.
    steps = nodes.where(F.col("depth") % HEIGHT > 0).select(
        F.col("conv_id").alias("conv"), F.floor(F.col("depth") / HEIGHT).cast("long").alias("chunk"), (F.col("depth") % HEIGHT).cast("int").alias("d"), "leaves", "saved"
    )
    above = F.explode(F.slice("nodes", F.lit(1), F.col("d"))).alias("node")
    totals = grafted(nodes, steps.join(paths.select("conv", "chunk", "nodes"), ["conv", "chunk"]).select(above, "leaves", "saved"))
    half = 1
    while half <= most:
        # Trees of twice the height: the root of each lower tree to all nodes of the upper trie that it hangs on.
        cut = (F.col("depth") / HEIGHT).cast("long")
        lower = totals.where((F.col("depth") % HEIGHT == 0) & (cut % (2 * half) == half))
        lower = lower.select(F.col("conv_id").alias("conv"), F.floor(cut / (2 * half)).cast("long").alias("tree"), "leaves", "saved")
        upper = paths.where(F.col("chunk") % (2 * half) < half)
        upper = upper.select("conv", F.floor(F.col("chunk") / (2 * half)).cast("long").alias("tree"), F.slice("nodes", 1, HEIGHT).alias("nodes"))
        totals = grafted(totals, lower.join(upper, ["conv", "tree"]).select(F.explode("nodes").alias("node"), "leaves", "saved"))
        half *= 2
    return totals.select("node", "leaves", "saved")


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (``conv at name chars``, ``at`` from 1 without gaps) of the conversations in ``members`` (``conv``).

    ``conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256``. Equal conversations are one
    path with a weight before any turn is looked at, and all sums are made in part before rows move.
    """
    members = staged(members.select("conv").distinct())
    chunks = _chunks(turns)
    paths = _paths(chunks)
    last = paths.groupBy("conv").agg(F.max_by(F.element_at("nodes", -1), "chunk").alias("node"))
    ends = staged(members.join(last, "conv", "left").select("conv", F.coalesce("node", F.lit(ROOT)).alias("node")))
    alike = ends.groupBy("node").agg(F.min("conv").alias("conv"), F.count("*").alias("n"))
    kept = staged(paths.join(alike.select("conv", "n"), "conv"))  # one of each set of equal conversations

    step = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.size("nodes") - 1),
            lambda d: F.struct(
                F.get("nodes", d).alias("node"),
                F.get("nodes", d - 1).alias("parent"),
                (F.col("chunk") * HEIGHT + d).alias("depth"),
                F.get("chars", d - 1).alias("chars"),
            ),
        )
    ).alias("s")
    found = kept.select("conv", "n", step).select("conv", "n", "s.*")
    nodes = found.groupBy("node", "parent", "depth", "chars").agg(F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"))
    root = members.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    none = F.lit(None).cast("string").alias("parent")
    nodes = staged(nodes.unionByName(root.select(F.lit(ROOT).alias("node"), none, F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), "n_convs", "conv_id")))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}
    nodes = staged(nodes.withColumns(own).drop("chars"))

    most = kept.agg(F.max("chunk")).first()[0] or 0
    totals = _totals(nodes, kept, most + 1).select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    told = nodes.drop("leaves", "saved").join(totals, "node").join(_end_digests(ends), "node", "left")
    told = told.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return told.join(parents, "parent", "left").select(*columns)


def prefix_trie(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of all conversations, a row per node: a distinct sequence of first turns (role, text), from the root without any.

    A node is known by its depth and its smallest conversation ``conv_id``; ``parent_conv_id`` is that of its parent (root: null),
    ``n_convs`` its conversations, ``n_children`` its children, ``n_leaves`` the childless nodes in its subtree (itself included), ``saved_tokens`` the sum over
    its subtree of (n_convs - 1) times the code points of a node's last text, ``ends_sha256`` a digest of the conversations that end there.

    Null roles and texts are empty, null turn numbers come first, rows that repeat a turn are turns of their own, rows
    without a conversation id and other columns are ignored; an empty table has no nodes. A conversation may be of any length:
    what is held together is sixteen turns. Turns are compared by MD5.
    """
    turns = staged(digest_turns(convs, conv, turn, role, text))
    return trie(turns, turns.select("conv"))


def rebuilt_turns(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Turns of conversations whose beginnings are swapped: c starts with h turns of c - c % ``group``, then has its own after its first h.

    h is crc32(c) % ``most``; a conversation that is shorter or absent gives what it has.
    """
    swapped = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    base = F.col("conv") - F.col("conv") % group
    heads = turns.where((F.col("conv") % group == 0) & (F.col("at") < most)).withColumnRenamed("conv", "base")
    convs = turns.select("conv").distinct().select("conv", base.alias("base"), swapped.alias("h"))
    taken = convs.join(heads, "base").where("at <= h").select("conv", "at", "name", "chars")
    lengths = heads.groupBy("base").agg(F.max("at").alias("n"))
    own = turns.withColumns({"h": swapped, "base": base}).where("at > h").join(lengths, "base", "left")
    at = F.col("at") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))
    return taken.unionByName(own.select("conv", at.cast("long").alias("at"), "name", "chars"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each starting with turns of the first one of its hundred."""
    turns = staged(digest_turns(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
    return trie(rebuilt_turns(turns), turns.select("conv"))


OP12_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS pos, name, chars FROM (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name, length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (SELECT c, c - c % 100 AS base, {crc32_sql("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM t), {CRC32_STEPS} z),
r AS (
  SELECT convs.c, t.pos, name, chars FROM convs JOIN t ON t.c = base AND t.pos <= h
  UNION ALL
  SELECT t.c, t.pos - h + least(h, coalesce(n, 0)), name, chars
  FROM t JOIN convs ON convs.c = t.c LEFT JOIN (SELECT c AS b, count(*) AS n FROM t GROUP BY c) l ON b = base WHERE t.pos > h
), p AS (
  SELECT c, pos, chars, string_agg(name, '' ORDER BY pos) OVER (PARTITION BY c ORDER BY pos) AS node FROM r
  UNION ALL SELECT c, 0, 0, '' FROM convs
), q AS (SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS is_end FROM p WINDOW w AS (PARTITION BY c ORDER BY pos)),
n AS (
  SELECT node, pos AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(chars) AS chars,
         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE is_end) AS ends FROM q GROUP BY node, pos
), k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.node = k.node),
pairs AS (SELECT DISTINCT a.node AS top, b.node AS below FROM p a JOIN p b ON a.c = b.c AND a.pos <= b.pos),
s AS (
  SELECT top, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM pairs JOIN m ON below = node GROUP BY top
)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s ON m.node = top LEFT JOIN m u ON u.node = m.parent AND m.depth > 0
"""
