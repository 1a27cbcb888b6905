"""Shards that all have the mixture of the whole: proportional stratified interleaving, in DataFrame functions."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import CRC32_STEPS, crc32_sql, read, staged, text_of
from rivulet.operators.numbering import running_offsets

SHARDS = 24
SEED = 11
RANGE_ROWS = 1000  # rows of a range of hashes or fractions, which is what one task orders at once
CHUNK = 100_000
_BITS = 48
_SAME = ["doc_id", "source", "size", "text_crc32"]
PLAN = [*_SAME, "copy", "shard", "slot"]


def _described(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    text = text_of(text_col)
    return [
        docs[id_col].alias("doc_id"),
        docs[source_col].cast("string").alias("source"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ]


def _copies(rows: DataFrame) -> DataFrame:
    """Rows that are alike are counted, then written out with a number each; a row with very many copies by several tasks."""
    counted = staged(rows.groupBy(*_SAME).agg(F.count("*").alias("n")))

    def numbers(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(first, last)).alias("copy")

    few = counted.where(F.col("n") <= CHUNK).select(*_SAME, numbers(F.lit(0).cast("long"), F.col("n") - 1))
    many = counted.where(F.col("n") > CHUNK).select(*_SAME, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK).cast("long"))).alias("first"))
    many = many.repartition("doc_id", "first").select(*_SAME, numbers(F.col("first"), F.least("n", F.col("first") + CHUNK) - 1))
    return few.unionAll(many)


def plan_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Where every row goes, without the texts: ``doc_id source size text_crc32 copy shard slot``.

    Rows are put in the order of a seeded hash within their source. The r-th of n rows has the
    fraction (r - 1/2) / n; all rows are sorted by it, so any stretch of them holds each source in proportion, and the
    stretch is cut into ``shards`` whose row counts differ by one at most. A shard has ``n / shards`` rows of a
    source, give or take a few.

    Neither order is made in one task. Hashes are even, so their upper bits cut a source into ranges of about
    ``range_rows``, whose places follow from counts and prefix sums; fractions are even too, as
    all sources together have about as many rows in any one stretch. ``range_rows`` changes no result. A null source is one of its own,
    null texts are empty, a null id is an id, rows alike in id, source, size and checksum are told apart by ``copy``
    (0, 1, ...) and spread over the shards like others, fewer rows than shards leave some empty; other columns
    are ignored, an empty table gives no rows.
    """
    rows = _copies(docs.select(*_described(docs, id_col, text_col, source_col)))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "size", "text_crc32", "copy")]
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, _BITS // 4), 16, 10).cast("long")
    stratum = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = staged(rows.withColumns({"place": place, "stratum": stratum}))
    n = rows.count()
    bits = min(_BITS, max(0, ceil(log2(max(1, n) / range_rows))))

    rows = rows.withColumn("range", F.shiftright("place", _BITS - bits))
    ranges = running_offsets(rows.groupBy("stratum", "range").agg(F.count("*").alias("n")), "range", "n", "before", ["stratum"])
    totals = ranges.groupBy("stratum").agg(F.sum("n").alias("total"))
    ranges = ranges.join(totals, "stratum").select("stratum", "range", "before", "total")
    within = Window.partitionBy("stratum", "range").orderBy("place", "doc_id", "size", "text_crc32", "copy")
    ranked = rows.join(ranges, ["stratum", "range"]).withColumn("rank", F.col("before") + F.row_number().over(within))
    fraction = (2 * F.col("rank") - 1).cast("double") / (2 * F.col("total")).cast("double")
    ranked = ranked.select(*_SAME, "copy", "stratum", fraction.alias("fraction"))
    ranked = staged(ranked.withColumn("cell", F.floor(F.col("fraction") * F.lit(float(1 << bits))).cast("long")))

    cells = running_offsets(ranked.groupBy("cell").agg(F.count("*").alias("n")), "cell", "n").select("cell", "before")
    order = Window.partitionBy("cell").orderBy("fraction", "stratum")
    placed = ranked.join(cells, "cell").withColumn("at", F.col("before") + F.row_number().over(order) - 1)
    placed = placed.withColumn("shard", F.expr(f"at * {shards} div {max(1, n)}"))
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return placed.select(*_SAME, "copy", F.col("shard").cast("int").alias("shard"), (F.col("at") - first).alias("slot"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``docs`` with the columns ``shard`` and ``slot``, which replace any of these names; texts are moved once."""
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    plan = plan_shards(docs, shards, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    plan = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in PLAN])
    # Rows that look alike to the plan are numbered in an order that a repeated task finds again.
    hashed = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    named = docs.select(*columns, *[c.alias(f"_doc_{n}") for c, n in zip(_described(docs, id_col, text_col, source_col), _SAME)], hashed.alias("_hash"))
    alike = Window.partitionBy(*[f"_doc_{c}" for c in _SAME]).orderBy("_hash")
    named = named.withColumn("_doc_copy", F.row_number().over(alike) - 1)
    same = F.lit(True)
    for c in (*_SAME, "copy"):
        same &= F.col(f"_doc_{c}").eqNullSafe(F.col(f"_plan_{c}"))
    return named.join(plan, same).select(*columns, F.col("_plan_shard").alias("shard"), F.col("_plan_slot").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, file_rows: int = 100_000, **how) -> None:
    """One folder ``shard=k/part=j`` per ``file_rows`` slots, rows in the order of their slots; no shard is one task's work."""
    placed = shard_rows(docs, shards, **how).withColumn("part", F.floor(F.col("slot") / F.lit(file_rows)).cast("int"))
    dealt = placed.repartition("shard", "part").sortWithinPartitions("shard", "part", "slot")
    dealt.write.mode("overwrite").partitionBy("shard", "part").parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts (one apart at most), each with the mixture of sources."""
    plan = plan_shards(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    none = F.lit(None).cast("int").alias("grown_shard")
    return plan.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none, "source")


OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32
  FROM documents, {CRC32_STEPS} z
), c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, text_crc32) - 1 AS copy FROM d),
p AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), size, text_crc32, copy)), 1, 12))::BIGINT AS place,
         coalesce('=' || source, '') AS stratum FROM c
), r AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY place, doc_id NULLS FIRST, size, text_crc32, copy) AS rank,
         count(*) OVER (PARTITION BY stratum) AS total, count(*) OVER () AS n FROM p
), o AS (SELECT *, row_number() OVER (ORDER BY (2 * rank - 1)::DOUBLE / (2 * total)::DOUBLE, stratum) - 1 AS place_at FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place_at * {SHARDS} // n)::INT AS shard,
       (place_at - (place_at * {SHARDS} // n * n + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM o
"""
