"""Temperature mixing of sources, realised as budgeted block permutations; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import doc_key, read, staged, text_of

STEPS = 50
ENTROPY = 0.97
REPEATS = 2.0
BLOCK_TOKENS = 200_000


def n_tokens(text_col: str = "text") -> Column:
    return F.regexp_count(text_of(text_col), F.lit(r"[^ \t-\r]+")).cast("long")


def _chance(*parts: Column | str) -> Column:
    """A repeatable number in [0, 2^48) from the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("long")


def exponent(totals: DataFrame, target_entropy: float, max_repeats: float) -> DataFrame:
    """One row ``tau``: source weights are shares to the power of tau.

    ``totals`` has one row per source with its ``total`` of tokens. Bisection finds the largest tau in [0, 1]
    whose entropy is at least ``target_entropy`` times the greatest possible one, and the smallest
    whose repetition (biggest share over a share, to the power of 1 - tau) is at most ``max_repeats``
    when the biggest source is read once; the larger of both is taken, so the limit goes first.
    """
    shares = totals.agg(F.collect_list(F.col("total").cast("double")).alias("t")).select(
        F.transform("t", lambda x: F.log(x / F.array_max("t"))).alias("logs")
    )

    def total(f) -> Column:
        return F.aggregate("logs", F.lit(0.0), lambda acc, x: acc + f(x))

    def entropy(tau: Column) -> Column:
        weight = total(lambda x: F.exp(tau * x))
        return F.log(weight) - total(lambda x: F.exp(tau * x) * tau * x) / weight

    def bisect(low_side) -> Column:
        """low_side(tau) holds for small tau only; the border between."""
        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

        def halve(acc: Column, _: Column) -> Column:
            mid = (acc["lo"] + acc["hi"]) / 2
            low = low_side(mid)
            return F.struct(F.when(low, mid).otherwise(acc["lo"]).alias("lo"), F.when(low, acc["hi"]).otherwise(mid).alias("hi"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve, lambda acc: acc["hi"])

    wanted = F.lit(target_entropy) * F.log(F.size("logs").cast("double"))
    by_entropy = bisect(lambda tau: entropy(tau) >= wanted)
    by_repeats = bisect(lambda tau: F.exp(-(1 - tau) * F.array_min("logs")) > F.lit(float(max_repeats)))
    return shares.select(F.coalesce(F.greatest(by_entropy, by_repeats), F.lit(1.0)).alias("tau"))


def plan_mix(
    docs: DataFrame,
    budget_tokens: int | None = None,
    target_entropy: float = ENTROPY,
    max_repeats: float = REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """What ``mix_sources`` decides, without the texts: a row for each time a document is read.

    Columns ``doc_id source key hash`` (of the document) and ``mix_tokens mix_epoch mix_block mix_order``.
    """
    key = doc_key(id_col, text_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            key.alias("key"),
            F.xxhash64(text_of(text_col)).alias("hash"),
            F.greatest(n_tokens(text_col), F.lit(1)).alias("tokens"),
            _chance(F.lit(str(seed)), key.cast("string")).alias("place"),
        )
    )
    name = F.coalesce("source", F.lit(""))
    sums = rows.groupBy("source").agg(F.sum("tokens").alias("total"))
    biggest, tau = sums.agg(F.max("total")).scalar(), exponent(sums, target_entropy, max_repeats).scalar()
    plan = sums.withColumn("biggest", biggest).withColumn("power", F.pow(F.col("total") / F.col("biggest"), tau))
    quota = F.col("biggest") * F.col("power")
    if budget_tokens is not None:
        quota = F.lit(int(budget_tokens)) * F.col("power") / plan.agg(F.sum("power")).scalar()
    plan = plan.select(
        F.col("source").alias("source_"),
        "total",
        F.round(quota).cast("long").alias("quota"),
        F.ceil(F.col("total") / F.lit(block_tokens)).cast("long").alias("blocks"),
    )
    plan = plan.withColumn("whole", F.floor(F.col("quota") / F.col("total")))
    plan = plan.withColumn("left", F.col("quota") - F.col("whole") * F.col("total")).drop("total", "quota")
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    rows = rows.withColumn("block", F.col("place") % F.col("blocks"))

    # One small row per block: its turn in the last, partial epoch and what the quota leaves for it.
    sums_of_blocks = rows.groupBy("source", "block", "whole", "left").agg(F.sum("tokens").alias("block_sum"))
    turn = Window.partitionBy("source").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, 0)
    turns = sums_of_blocks.withColumn("turn", _chance(F.lit(str(seed)), name, F.col("whole"), F.col("block")))
    room = F.col("left") - F.sum("block_sum").over(turn) + F.col("block_sum")
    last = turns.withColumn("room", room).where("room > 0")
    last = last.select(F.col("source").alias("source_"), F.col("block").alias("block_"), "room", "block_sum")
    same_block = F.col("source").eqNullSafe(F.col("source_")) & (F.col("block") == F.col("block_"))
    rows = rows.join(last, same_block, "left").drop("source_", "block_")

    # In the block that crosses the quota: documents in the order of a hash while they fit.
    crossing = F.col("block_sum") > F.col("room")
    fit = Window.partitionBy("source", "block").orderBy("place", "key", "hash")
    until = rows.where(crossing).withColumn("so_far", F.sum("tokens").over(fit)).where("so_far <= room")
    until = until.groupBy("source", "block").agg(F.max(F.struct("place", "key", "hash")).alias("until"))
    until = until.select(F.col("source").alias("source_"), F.col("block").alias("block_"), "until")
    rows = rows.join(until, same_block, "left")
    fits = F.coalesce(F.struct("place", "key", "hash") <= F.col("until"), F.lit(False))
    again = F.when(F.col("room").isNull(), False).when(crossing, fits).otherwise(True)
    epochs = F.col("whole") + again.cast("long")
    rows = rows.where(epochs > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    return rows.select(
        "doc_id",
        "source",
        "key",
        "hash",
        F.col("tokens").alias("mix_tokens"),
        F.col("epoch").alias("mix_epoch"),
        F.col("block").alias("mix_block"),
        _chance(F.lit(str(seed)), name, F.col("epoch"), F.col("block")).alias("mix_order"),
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix: a row of ``docs`` for each time it is read, with ``mix_tokens``, ``mix_epoch``, ``mix_block`` and ``mix_order``.

    The default budget reads the biggest source once, so nothing is lost and smaller ones repeat.
    A source's quota is its weight times the budget. Its documents fall into blocks of about
    ``block_tokens`` by a hash of their key; every epoch permutes the blocks anew. Whole epochs are
    read while the quota lasts, then whole blocks, then, in the block that crosses the quota,
    the documents that still fit, in the order of a hash. Reading by ``mix_epoch, mix_order`` mingles the blocks
    of all sources.

    Only sums per block are ever ordered for a whole source, so a source with a third of all rows
    is spread over its blocks, and texts are moved once. A document counts one token at least; null texts
    are empty, a null source is one of its own, rows without id are keyed by their text, repeated rows are all
    kept and fall into the same place; columns named ``mix_*`` are replaced. An empty table gives no rows.
    """
    mixed = ["mix_tokens", "mix_epoch", "mix_block", "mix_order"]
    plan = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    plan = plan.select(F.col("source").alias("_source"), F.col("key").alias("_key"), F.col("hash").alias("_hash"), *mixed).distinct()
    same = (F.col("_key") == doc_key(id_col, text_col)) & (F.col("_hash") == F.xxhash64(text_of(text_col)))
    same &= F.col("_source").eqNullSafe(F.col(source_col).cast("string"))
    return docs.drop(*mixed).join(plan, same).drop("_source", "_key", "_hash")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by source: which document is read in which epoch and block."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_block", "mix_order")


def _sql() -> str:
    chance = "('0x' || substr(md5({}), 1, 12))::BIGINT"
    place = chance.format("'7:' || doc_id")
    turn = chance.format("concat_ws(':', '7', coalesce(source, ''), whole, block)")
    order = chance.format("concat_ws(':', '7', coalesce(source, ''), mix_epoch, block)")
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, greatest(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')), 1)::BIGINT AS tokens, {place} AS place
  FROM documents
), s AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM d GROUP BY source),
logs AS (SELECT list(ln(tokens::DOUBLE / (SELECT max(tokens) FROM s))) AS l FROM s),
h AS (
  SELECT 0 AS n, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT n + 1, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END FROM (
    SELECT n, lo, hi, (lo + hi) / 2 AS mid,
           ln(list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x))))
           - list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x) * (lo + hi) / 2 * x))
             / list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x))) >= {ENTROPY} * ln(len(l)::DOUBLE) AS low
    FROM h, logs WHERE n < {STEPS}) x
), r AS (
  SELECT 0 AS n, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT n + 1, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END FROM (
    SELECT n, lo, hi, (lo + hi) / 2 AS mid, exp(-(1 - (lo + hi) / 2) * list_min(l)) > {REPEATS} AS low
    FROM r, logs WHERE n < {STEPS}) x
), tau AS (SELECT greatest((SELECT hi FROM h WHERE n = {STEPS}), (SELECT hi FROM r WHERE n = {STEPS})) AS tau),
p AS (
  SELECT source, tokens, ceil(tokens / {BLOCK_TOKENS}.0)::BIGINT AS blocks,
         round((SELECT max(tokens) FROM s) * pow(tokens::DOUBLE / (SELECT max(tokens) FROM s), tau))::BIGINT AS quota
  FROM s, tau
), q AS (SELECT *, quota // tokens AS whole, quota % tokens AS remaining FROM p),
e AS (SELECT d.*, q.whole, q.remaining, d.place % q.blocks AS block FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
b AS (SELECT source, block, whole, remaining, sum(tokens)::BIGINT AS block_sum FROM e GROUP BY ALL),
c AS (
  SELECT source, block, block_sum, remaining + block_sum - sum(block_sum) OVER (PARTITION BY source ORDER BY {turn}, block ROWS UNBOUNDED PRECEDING) AS room
  FROM b
), f AS (
  SELECT e.*, c.room, c.block_sum, sum(tokens) OVER (PARTITION BY e.source, e.block ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS so_far
  FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source AND e.block = c.block
), g AS (SELECT *, whole + CASE WHEN room > 0 AND (block_sum <= room OR so_far <= room) THEN 1 ELSE 0 END AS epochs FROM f),
m AS (SELECT *, unnest(range(epochs)) AS mix_epoch FROM g)
SELECT doc_id, source, tokens AS mix_tokens, mix_epoch, block AS mix_block, {order} AS mix_order FROM m
"""


OP4_SQL = _sql()
