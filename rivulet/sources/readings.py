"""Telemetry scans and the station universe."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.timegrain import local_time, time_between, utc_naive
from rivulet.schemas import SEQ, STATION, TIME

Stations = Sequence[str] | DataFrame | None


GROUP = "groupe"


def station_group(groups: int, column: str = STATION) -> Column:
    """Folder of a station in readings that are partitioned by groups of stations."""
    return F.pmod(F.xxhash64(column), F.lit(groups)).cast("int")


def keep_stations(df: DataFrame, stations: Stations, column: str = STATION, groups: int | None = None) -> DataFrame:
    """Restrict to a literal list (pushed to the scan) or to the keys of a DataFrame (semi join).

    ``groups`` says that ``df`` is partitioned by that many groups of stations (``write_by_station``). A list then names its
    folders; for a DataFrame Spark finds out while the query runs which folders hold any of the stations, and
    opens no other (dynamic partition pruning).
    """
    if stations is None:
        return df
    if isinstance(stations, DataFrame):
        keys = stations.select(F.col(STATION).alias(column))
        if groups:
            # At most as many rows as there are folders, so they may be broadcast; Spark prunes by a filtered side only.
            wanted = keys.where(F.col(column) >= F.lit("")).select(station_group(groups, column).alias(GROUP)).distinct()
            df = df.join(F.broadcast(wanted), GROUP, "left_semi")
        return df.join(keys, column, "left_semi")
    if groups:
        named = df.sparkSession.createDataFrame([(s,) for s in stations], f"{column} string").select(station_group(groups, column))
        df = df.where(F.col(GROUP).isin([r[0] for r in named.distinct().collect()]))
    return df.where(F.col(column).isin(list(stations)))


def write_by_station(readings: DataFrame, path: str, groups: int = 64) -> None:
    """Readings in folders by groups of stations, in the order of station and time inside a file; a busy group has several files."""
    rows = readings.withColumn(GROUP, station_group(groups)).hint("rebalance", GROUP)
    rows.sortWithinPartitions(GROUP, STATION, *reading_order(readings)).write.mode("overwrite").partitionBy(GROUP).parquet(path)


def with_day(readings: DataFrame) -> DataFrame:
    """Readings with their UTC day (``jour``), by which a busy station is spread over the buckets of a table."""
    return readings.withColumn("jour", local_time(readings, TIME).cast("date"))


def write_bucketed(readings: DataFrame, table: str, path: str, buckets: int = 64, by: Sequence[str] = (STATION,)) -> DataFrame:
    """A table of readings in buckets by station (and day), sorted by station and time; returns it as a DataFrame.

    Steps between readings and hourly or daily sums of it need no shuffle of the readings. Buckets by station alone leave a
    station with a third of all readings in one task; ``by=(STATION, "jour")`` (``with_day``) spreads it over its days.
    """
    spark = readings.sparkSession
    dealt = readings.repartition(buckets, *by)  # the hash of buckets is that of a shuffle, so each bucket is one file
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    order = [*by, *[c for c in (STATION, *reading_order(readings)) if c not in by]]
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(*order).saveAsTable(table)
    return spark.table(table)


def scan_readings(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    stations: Stations = None,
    columns: Sequence[str] | None = None,
    time_col: str = TIME,
    station_col: str = STATION,
    date_partition: str | None = None,
    station_groups: int | None = None,
) -> DataFrame:
    """Column-pruned readings in [start, end).

    ``date_partition`` names the directory column of a date-partitioned table (UTC days);
    its own range filter then prunes whole directories. ``station_groups`` is the number of groups of a table
    partitioned by station (``write_by_station``): only folders of the wanted stations are read.
    """
    df = spark.read.parquet(path)
    df = keep_stations(time_between(df, time_col, start, end), stations, station_col, station_groups)
    if date_partition:
        if start is not None:
            df = df.where(F.col(date_partition) >= F.lit(utc_naive(start).date()))
        if end is not None:
            df = df.where(F.col(date_partition) <= F.lit(utc_naive(end).date()))
    return df.select(*columns) if columns else df


def scan_pressure_avg(
    spark: SparkSession, path: str, start: datetime | None = None, stations: Stations = None
) -> DataFrame:
    """Pre-averaged pressure series from ``start`` on."""
    return scan_readings(
        spark, path, start, None, stations, (STATION, "rounded_timestamp", "avg_pression5"), "rounded_timestamp"
    )


def station_universe(
    aggregated: DataFrame | None, readings: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """Distinct station names seen in either table.

    A maintained list of ``known`` stations lets a job pass only the new readings
    instead of the whole history.
    """
    names = readings.select(STATION)
    for others in (aggregated, known):
        if others is not None:
            names = names.union(others.select(STATION))
    return names.distinct()


def reading_order(df: DataFrame) -> list[str]:
    """Time, then the tie-breaker where the table has one."""
    return [TIME, SEQ] if SEQ in df.columns else [TIME]
