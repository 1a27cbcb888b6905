"""Rollup and dimension tables on Parquet: reading, creating, keyed writing, purging."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.timegrain import GRAINS
from rivulet.schemas import TABLES


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the application with its declared schema, whatever folders it is laid out in."""
    return spark.read.schema(TABLES[name]).parquet(table_path(base, name)).select(*TABLES[name].names)


def read_rollup(spark: SparkSession, base: str, grain: str) -> DataFrame:
    """Rollup table of a grain, columns in declared order."""
    name = GRAINS[grain].table
    return read_table(spark, base, name).select(*TABLES[name].names)


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def drop_path(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.delete(target, True) if fs.exists(target) else False


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table when there is none yet."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def staging_path(target: str) -> str:
    """A fresh folder beside the target, so that finished rows are renamed into place, not copied."""
    return f"{target.rstrip('/')}.staged-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or a local one in a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/rivulet-scratch"
    return f"{base.rstrip('/')}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, path = hadoop_path(spark, target)
    fs.mkdirs(path.getParent())
    if not fs.rename(hadoop_path(spark, source)[1], path):
        raise OSError(f"could not rename {source} to {target}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, target = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _put_aside(path: str) -> tuple[str, str]:
    """Where a swap keeps the old table, and old buckets, until the new ones are in place."""
    return f"{path.rstrip('/')}.old", f"{path.rstrip('/')}.old-buckets"


def restore(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that was interrupted: what is missing comes back, the rest of the old rows goes."""
    table, buckets = _put_aside(path)
    if path_exists(spark, table) and not path_exists(spark, path):
        _rename(spark, table, path)
    for name in names_in(spark, buckets):
        if not path_exists(spark, f"{path.rstrip('/')}/{name}"):
            _rename(spark, f"{buckets}/{name}", f"{path.rstrip('/')}/{name}")
    drop_path(spark, table)
    drop_path(spark, buckets)


def write_rollup(df: DataFrame, path: str, bucket: str, emptied: Sequence[date] = ()) -> None:
    """Replace exactly the buckets present in ``df``; ``emptied`` buckets go even if it has no rows for them (``replace_parts``)."""
    replace_parts(df, path, bucket, [d.isoformat() for d in emptied])


def replace_parts(df: DataFrame, path: str, bucket: str, emptied: Sequence[str] = ()) -> None:
    """Replace exactly the buckets present in ``df``; ``emptied`` buckets go even if it has no rows for them.

    ``df`` may read the table it replaces: it is written aside first, and each finished bucket is
    then renamed into the old one's place. After a failure in between, ``restore`` (called here at the
    start, and before a job reads the table) brings back what is missing, and the run may be repeated. Rows are
    rebalanced by bucket; adaptive execution splits a bucket that is too large for one file.
    """
    spark = df.sparkSession
    restore(spark, path)
    stage, aside = staging_path(path), _put_aside(path)[1]
    try:
        df.hint("rebalance", bucket).write.partitionBy(bucket).parquet(stage)
        fresh = [n for n in names_in(spark, stage) if n.startswith(f"{bucket}=")]
        for name in dict.fromkeys([*(f"{bucket}={d}" for d in emptied), *fresh]):
            if path_exists(spark, f"{path.rstrip('/')}/{name}"):
                _rename(spark, f"{path.rstrip('/')}/{name}", f"{aside}/{name}")
            if name in fresh:
                _rename(spark, f"{stage}/{name}", f"{path.rstrip('/')}/{name}")
        drop_path(spark, aside)
    finally:
        drop_path(spark, stage)


def replace_table(df: DataFrame, path: str, bucket: str | None = None) -> None:
    """Replace the whole table by ``df``, which may read it: written aside, then swapped by two renames."""
    spark = df.sparkSession
    restore(spark, path)
    stage, aside = staging_path(path), _put_aside(path)[0]
    try:
        (df.hint("rebalance", bucket).write.partitionBy(bucket) if bucket else df.write).parquet(stage)
        if path_exists(spark, path):
            _rename(spark, path, aside)
        _rename(spark, stage, path)
        drop_path(spark, aside)
    finally:
        drop_path(spark, stage)


def drop_buckets(spark: SparkSession, path: str, bucket: str, days: list[date]) -> int:
    """Remove the partition directories of given buckets; returns how many there were."""
    return sum(drop_path(spark, f"{path.rstrip('/')}/{bucket}={d.isoformat()}") for d in days)


def stored_buckets(spark: SparkSession, path: str, bucket: str) -> list[date]:
    """Buckets present as partition directories (at most the retention window)."""
    fs, target = hadoop_path(spark, path)
    prefix = f"{bucket}="
    names = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(date.fromisoformat(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix)].isdigit())


def purge_buckets(spark: SparkSession, path: str, bucket: str, cutoff: date) -> int:
    """Retention: remove buckets before ``cutoff`` without rewriting the others."""
    return drop_buckets(spark, path, bucket, [d for d in stored_buckets(spark, path, bucket) if d < cutoff])


# --- tables laid out by a hash of their key --------------------------------------------------

PART = "partie"
LAYOUT = "_layout"  # a name that Spark's file listing leaves out


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The folder of a row: a hash of its key, so that equal keys meet and a busy value of one column is spread by the others."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], parts: int = 64) -> None:
    """(Re)write a whole table in ``parts`` folders by a hash of its key; the layout is stored with it."""
    spark = df.sparkSession
    replace_table(df.withColumn(PART, part_of(keys, parts)), path, PART)
    layout = spark.createDataFrame([(",".join(keys), parts)], "keys string, parts int")
    layout.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{LAYOUT}")


def keyed_layout(spark: SparkSession, path: str) -> tuple[list[str], int]:
    row = spark.read.schema("keys string, parts int").json(f"{path.rstrip('/')}/{LAYOUT}").first()
    return row["keys"].split(","), row["parts"]


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[int] | None = None) -> DataFrame:
    """The table, or the rows of some of its folders; others are not opened."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])).parquet(path)
    df = df if parts is None else df.where(F.col(PART).isin(list(parts)))
    return df.select(*schema.names)


def change_keyed(
    spark: SparkSession, path: str, schema: T.StructType, changes: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]
) -> list[int]:
    """Apply ``change(target, changes)`` to the folders that hold a key of ``changes``; the others are neither read nor written.

    ``changes`` has the key columns; ``change`` is any operator that looks at rows of equal keys only (insert, upsert, delete,
    update, replacing the set of an owner where the owner is the key). Returns the numbers of the folders written. Their list, as long
    as the layout has folders at most, is all that the driver sees. A run that died in between is undone by ``restore``.
    """
    restore(spark, path)
    keys, parts = keyed_layout(spark, path)
    stage = staging_path(path)
    try:  # changes may be the outcome of a long job; they are computed once
        changes.write.parquet(stage)
        changes = spark.read.schema(changes.schema).parquet(stage)
        touched = sorted(r[0] for r in changes.select(part_of(keys, parts).alias(PART)).distinct().collect())
        if touched:
            fresh = change(read_keyed(spark, path, schema, touched), changes)
            replace_parts(fresh.withColumn(PART, part_of(keys, parts)), path, PART, [str(p) for p in touched])
    finally:
        drop_path(spark, stage)
    return touched


def is_keyed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/{LAYOUT}")
