"""Batch jobs: compute a rollup or the counter cache and bring its table up to date."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.timegrain import GRAINS, PARIS, buckets, current_bucket, day_bounds, instant, local_time, retention_cutoff, time_between
from rivulet.operators.changes import upsert
from rivulet.operators.counters import SLICE, TRANCHE, slice_seconds
from rivulet.operators.latest import latest_counters
from rivulet.operators.rollup import daily_of_summaries, daily_summaries, rollup_daily, rollup_monthly, rollup_of_states, rollup_weekly
from rivulet.operators.states import DAY, MONTH, day_states
from rivulet.schemas import COUNTER_CACHE, STATION, TABLES, TIME
from rivulet.sources.readings import station_universe
from rivulet.sources.tables import (
    change_keyed,
    drop_buckets,
    drop_path,
    ensure_table,
    is_keyed,
    path_exists,
    purge_buckets,
    read_rollup,
    read_table,
    replace_table,
    restore,
    staging_path,
    table_path,
    write_keyed,
    write_rollup,
)


def _stamped(df: DataFrame, schema, now) -> DataFrame:
    stamped = df.withColumn("created_at", now).withColumn("updated_at", now)
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def run_rollup(
    spark: SparkSession,
    grain: str,
    readings: DataFrame | None,
    aggregated: DataFrame | None,
    base: str,
    as_of: datetime,
    tz: str = PARIS,
    rebuild: bool = False,
    stations: DataFrame | None = None,
    slice_width: str = SLICE,
    stored: bool = False,
) -> str:
    """Bring one rollup table under ``base`` up to date; returns its path.

    Daily and weekly runs merge into the run's buckets (daily also drops the current day),
    monthly runs delete their window and insert it anew; then buckets past retention go.
    Only the affected bucket directories are rewritten. A run may be repeated. ``slice_width``
    is that of ``counter_slices``. With ``stored`` no reading is read: the rollup comes from the slices or day states
    under ``base`` (``refresh_summaries``, ``refresh_states``).
    """
    slice_seconds(slice_width)  # only daily runs cut slices, but a wrong width is refused by all
    g = GRAINS[grain]
    schema = TABLES[g.table]
    path = table_path(base, g.table)
    now = instant(as_of, schema["created_at"].dataType)
    days = [b.day for b in buckets(as_of, grain, tz)]
    if stored:
        kept = read_summaries(spark, base, slice_width) if grain == "daily" else read_states(spark, base, tz)
        known = stations if stations is not None else station_universe(aggregated, kept)
        fresh = daily_of_summaries(kept, known, as_of, tz) if grain == "daily" else rollup_of_states(kept, grain, as_of, tz, known)
    elif grain == "monthly":
        fresh = rollup_monthly(readings, as_of, tz)
    elif grain == "daily":
        fresh = rollup_daily(readings, aggregated, as_of, tz, stations=stations, slice_width=slice_width)
    else:
        fresh = rollup_weekly(readings, aggregated, as_of, tz, stations=stations)

    restore(spark, path)
    ensure_table(spark, path, schema)
    if rebuild:
        replace_table(_stamped(fresh, schema, now), path, g.bucket)
    elif grain == "monthly":
        write_rollup(_stamped(fresh, schema, now), path, g.bucket, emptied=days)
    else:
        if grain == "daily":
            drop_buckets(spark, path, g.bucket, [current_bucket(as_of, grain, tz)])
        current = read_rollup(spark, base, grain).where(F.col(g.bucket).isin(days))
        write_rollup(upsert(current, fresh, [g.bucket, STATION], now, unique=True), path, g.bucket)
    purge_buckets(spark, path, g.bucket, retention_cutoff(as_of, grain, tz))
    return path


def summaries_path(base: str, slice_width: str = SLICE) -> str:
    """Where slices of a width are kept; each width has a table of its own."""
    return table_path(base, f"tranches_{slice_seconds(slice_width)}s")


def states_path(base: str, tz: str = PARIS) -> str:
    """Where the states of a time zone's days are kept."""
    return table_path(base, "etats_jour_" + tz.replace("/", "_"))


def read_summaries(spark: SparkSession, base: str, slice_width: str = SLICE) -> DataFrame:
    return spark.read.parquet(summaries_path(base, slice_width)).drop(DAY)


def read_states(spark: SparkSession, base: str, tz: str = PARIS) -> DataFrame:
    return spark.read.parquet(states_path(base, tz))


def refresh_summaries(spark: SparkSession, readings: DataFrame, arrivals: DataFrame, base: str, slice_width: str = SLICE) -> str:
    """Bring the stored slices up to date with readings that arrived (station and time), early or late; returns their path.

    Only slices that got a reading are summed up again, from all of their ``readings``; the others stay as they are. Read are the
    readings between the first and the last arrival, written the days that have one.
    """
    path, width = summaries_path(base, slice_width), timedelta(seconds=slice_seconds(slice_width))
    slice_of = F.window(F.col(TIME), f"{slice_seconds(slice_width)} seconds")["start"].alias(TRANCHE)
    touched = arrivals.select(STATION, slice_of).distinct()
    span = arrivals.agg(F.min(local_time(arrivals, TIME)), F.max(local_time(arrivals, TIME))).first()
    if span[0] is None:
        return path
    days = [r[0] for r in arrivals.select(local_time(arrivals, TIME).cast("date")).distinct().collect()]
    rows = time_between(readings, TIME, span[0] - width, span[1] + width)
    rows = rows.withColumn(TRANCHE, slice_of).join(touched, [STATION, TRANCHE], "left_semi").drop(TRANCHE)
    fresh = daily_summaries(rows, slice_width)
    fresh = fresh.withColumn(DAY, local_time(fresh, TRANCHE).cast("date"))
    restore(spark, path)
    if path_exists(spark, path):
        kept = spark.read.schema(fresh.schema).parquet(path).where(F.col(DAY).isin(days))
        fresh = kept.join(touched, [STATION, TRANCHE], "left_anti").unionByName(fresh)
    write_rollup(fresh, path, DAY)
    return path


def refresh_states(spark: SparkSession, readings: DataFrame, arrivals: DataFrame, base: str, tz: str = PARIS) -> str:
    """Bring the stored day states up to date with readings that arrived: only days that got one are read and computed again.

    States lie in folders by month; those of the other days in a month are carried over.
    """
    path = states_path(base, tz)
    days = sorted(r[0] for r in arrivals.select(local_time(arrivals, TIME, tz).cast("date")).distinct().collect())
    if not days:
        return path
    rows = time_between(readings, TIME, day_bounds(days[0], tz)[0], day_bounds(days[-1], tz)[1])
    rows = rows.where(local_time(rows, TIME, tz).cast("date").isin(days))
    fresh = day_states(rows, tz).withColumn(MONTH, F.trunc(DAY, "month"))
    restore(spark, path)
    months = sorted({d.replace(day=1) for d in days})
    if path_exists(spark, path):
        kept = spark.read.schema(fresh.schema).parquet(path).where(F.col(MONTH).isin(months) & ~F.col(DAY).isin(days))
        fresh = kept.unionByName(fresh)
    write_rollup(fresh, path, MONTH, emptied=months)
    return path


def refresh_stations(spark: SparkSession, readings: DataFrame, base: str, margin: timedelta = timedelta(days=1)) -> DataFrame:
    """The list of all stations ever seen, brought up to date; only readings since the last run are looked at.

    The list is kept beside the time of the newest reading seen (the high-water mark). A run reads from ``margin`` before
    it, for readings that come late, adds the names that are new, then moves the mark; a run that died in between is repeated
    without harm.
    """
    path, mark_path = table_path(base, "automates_connus"), table_path(base, "automates_connus_repere")
    for p in (path, mark_path):
        restore(spark, p)
    ensure_table(spark, path, TABLES["mesures_aggregate"])
    known = spark.read.schema(TABLES["mesures_aggregate"]).parquet(path)
    mark = spark.read.parquet(mark_path).agg(F.max("vu_jusqua")).first()[0] if path_exists(spark, mark_path) else None
    rows = time_between(readings, TIME, mark - margin, None) if mark is not None else readings
    found = rows.groupBy(STATION).agg(F.max(local_time(rows, TIME)).alias("vu_jusqua"))
    stage = staging_path(path)
    try:
        found.write.parquet(stage)
        found = spark.read.schema(found.schema).parquet(stage)
        newest = found.agg(F.max("vu_jusqua")).first()[0]
        found.select(STATION).join(known, STATION, "left_anti").where(F.col(STATION).isNotNull()).write.mode("append").parquet(path)
        if newest is not None and (mark is None or newest > mark):
            replace_table(spark.createDataFrame([(newest,)], "vu_jusqua timestamp_ntz").coalesce(1), mark_path)
    finally:
        drop_path(spark, stage)
    return spark.read.schema(TABLES["mesures_aggregate"]).parquet(path)


def refresh_latest_counters(spark: SparkSession, readings: DataFrame, base: str, as_of: datetime, rebuild: bool = False, parts: int = 64) -> str:
    """Upsert the newest counters of every station; stations without new readings stay.

    The cache lies in ``parts`` folders by a hash of the station; a run with few stations rewrites only theirs.
    """
    path = table_path(base, "cache_volumes_total")
    now = instant(as_of, COUNTER_CACHE["updated_at"].dataType)
    fresh = latest_counters(readings, as_of).withColumn("updated_at", now)
    restore(spark, path)
    if rebuild or not path_exists(spark, path):
        write_keyed(fresh.select(*COUNTER_CACHE.names), path, [STATION], parts)
    elif is_keyed(spark, path):
        change_keyed(spark, path, COUNTER_CACHE, fresh, lambda cache, new: upsert(cache, new, [STATION], now, unique=True))
    else:  # a cache from before it was laid out by station
        cache = read_table(spark, base, "cache_volumes_total")
        write_keyed(upsert(cache, fresh, [STATION], now, unique=True), path, [STATION], parts)
    return path
