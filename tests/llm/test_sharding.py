from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivulet.llm import sharding
from rivulet.llm.sharding import plan_shards, shard_rows, write_shards


def told(plan):
    return sorted((repr(r["doc_id"]), r["size"], r["text_crc32"], r["copy"], r["shard"], r["slot"]) for r in plan.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one source holds half of them, some sources hold a row only."""
    i = F.col("id")
    source = F.when(i % 2 == 0, "big").when(i % 7 == 0, None).when(i > 2990, F.concat(F.lit("s"), i)).otherwise(F.concat(F.lit("t"), i % 5))
    return spark.range(3000).select(i.alias("doc_id"), F.concat(F.lit("text "), i % 100).alias("text"), source.alias("source"))


def test_counts_are_one_apart_and_slots_have_no_gaps(skewed):
    rows = plan_shards(skewed, 24, range_rows=50).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert sorted(sizes) == list(range(24)) and set(sizes.values()) == {125}
    for k in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(125))
    assert all(r["text_crc32"] == zlib.crc32(f"text {r['doc_id'] % 100}".encode()) for r in rows)


def test_every_shard_and_every_stretch_has_the_mixture(skewed):
    rows = plan_shards(skewed, 24, range_rows=50).collect()
    total = Counter(r["source"] for r in rows)
    for k in range(24):
        mine = Counter(r["source"] for r in rows if r["shard"] == k)
        assert all(abs(mine[s] - n / 24) <= 3 for s, n in total.items())
        first = Counter(r["source"] for r in rows if r["shard"] == k and r["slot"] < 40)
        assert abs(first["big"] - 20) <= 3


def test_ranges_change_no_result_and_seeds_do(skewed):
    whole = told(plan_shards(skewed, 7, range_rows=10_000))
    assert told(plan_shards(skewed.repartition(9, "text"), 7, range_rows=20)) == whole
    assert told(plan_shards(skewed, 7, seed=12)) != whole


def test_rows_repeated_very_often_are_whole_and_spread(spark, skewed, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 100)
    same = spark.range(1500).selectExpr("cast(null as bigint) as doc_id", "'same' as text", "'src' as source")
    rows = plan_shards(skewed.unionAll(same), 24, range_rows=100).collect()
    copies = [r for r in rows if r["doc_id"] is None]
    assert sorted(r["copy"] for r in copies) == list(range(1500)) and len(rows) == 4500
    spread = Counter(r["shard"] for r in copies)
    assert len(spread) == 24 and max(spread.values()) <= 66


def test_odd_rows_keep_their_columns(odd_docs, no_docs):
    out = shard_rows(odd_docs, 5, range_rows=4)
    assert out.columns == [c for c in odd_docs.columns if c != "shard"] + ["shard", "slot"]
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in odd_docs.collect())
    assert sorted(Counter(r["shard"] for r in rows).values()) == [3, 4, 4, 4, 4]
    assert shard_rows(no_docs, 5).count() == 0
    assert sorted(Counter(r["shard"] for r in plan_shards(odd_docs.limit(2), 5).collect()).values()) == [1, 1]


def test_files_read_back_in_order(spark, skewed, tmp_path):
    write_shards(skewed, str(tmp_path / "out"), 4, file_rows=300)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 3000 and back.select("shard", "part").distinct().count() == 12
    plan = {(r["doc_id"], r["shard"], r["slot"]) for r in plan_shards(skewed, 4).collect()}
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == plan
    one = spark.read.parquet(str(tmp_path / "out" / "shard=2" / "part=1"))
    assert [r["slot"] for r in one.collect()] == list(range(300, 600))


def test_plan_stays_in_the_jvm(spark, skewed):
    plan = plan_shards(skewed, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
