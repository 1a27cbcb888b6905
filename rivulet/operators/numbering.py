"""Running totals and dense numbers without a sort of everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def running_offsets(
    counts: DataFrame, position: str, n: str, name: str = "before", groups: Sequence[str] = (), block: int = BLOCK
) -> DataFrame:
    """Adds ``name``: the sum of ``n`` over the rows of the same group with a smaller ``position``.

    A prefix sum in two levels: positions (whole numbers, each once in a group) fall into blocks, blocks are summed,
    the sums of the blocks before are added up over one small row per block, and only rows of one block
    are ever ordered together. Columns of ``groups`` must not be null.
    """
    rows = counts.withColumn("_block", F.floor(F.col(position) / F.lit(block)).cast("long"))
    before = Window.unboundedPreceding
    blocks = rows.groupBy(*groups, "_block").agg(F.sum(n).alias("_sum"))
    across = Window.partitionBy(*groups).orderBy("_block").rowsBetween(before, -1)
    blocks = blocks.select(*groups, "_block", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, "_block").orderBy(position).rowsBetween(before, -1)
    total = F.col("_start") + F.coalesce(F.sum(n).over(inside), F.lit(0))
    return rows.join(blocks, [*groups, "_block"]).select(*counts.columns, total.cast("long").alias(name))


def content_digest(columns: Sequence[str]) -> Column:
    """MD5 over the columns as text, missing ones as a mark of their own: an even, repeatable order of rows."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in columns]))


def dense_numbers(rows: DataFrame, columns: Sequence[str], name: str = "number", digits: int = 3) -> DataFrame:
    """Rows numbered 1..n without gaps, in the order of the digest of ``columns``; equal rows follow each other.

    The first ``digits`` hexadecimal digits of the digest cut the rows into ranges that are even whatever the data:
    counts per range, the prefix sum of them, then numbers inside a range. Equal rows are counted before
    anything is ordered and written out last, so that a row repeated very often is one row until then. Evaluating the
    result again gives the same numbers.
    """
    equal = rows.groupBy(*columns).agg(F.count("*").alias("_copies")).withColumn("_digest", content_digest(columns))
    equal = equal.withColumn("_range", F.conv(F.substring("_digest", 1, digits), 16, 10).cast("long"))
    ranges = running_offsets(equal.groupBy("_range").agg(F.sum("_copies").alias("_rows")), "_range", "_rows", "_before")
    # A digest shared by different rows leaves their order to their columns.
    inside = Window.partitionBy("_range").orderBy("_digest", *columns).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    placed = equal.join(ranges.select("_range", "_before"), "_range").withColumn("_first", first)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return placed.select(*columns, "_first", copies.alias("_copy")).select(
        *columns, (F.col("_first") + F.col("_copy")).cast("long").alias(name)
    )
