"""Mergeable states of a day's readings, from which weeks and months follow without reading the readings again."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.numeric import to_micro
from rivulet.functions.timegrain import Bucket, bucket_of, local_time, time_between
from rivulet.schemas import ENERGY_COUNTER, PRESSURES, ROLLUP_PRESSURES, STATION, TIME, VOLUMES, WATER_COUNTERS

COUNTERS = {**dict(zip(WATER_COUNTERS, VOLUMES)), ENERGY_COUNTER: "conso_kwh"}
SENSORS = ("chlore_mv", "ph", "temperature_deg")
DAY, MONTH, SENSOR, VALUE, READINGS = "jour", "mois", "capteur", "valeur", "n"


def spans_of_readings(readings: DataFrame, span: Sequence[Bucket], bucket: str) -> DataFrame:
    """Per (station, bucket): counter maxima in millionths, pressure means, mean and median of the sensors.

    One aggregation over one scan. The exact percentile keeps a count per value, which is merged like a sum: what
    an input split sends is at most the sensor's value range per station and bucket, however many readings it has.
    """
    rows = time_between(readings, TIME, span[0].start, span[-1].end)
    return rows.groupBy(STATION, bucket_of(rows, TIME, list(span)).alias(bucket)).agg(
        *[F.max(to_micro(F.col(c))).alias(name) for c, name in COUNTERS.items()],
        *[F.avg(c).alias(p) for c, p in zip(PRESSURES, ROLLUP_PRESSURES)],
        *[F.avg(c).alias(f"{c}_avg") for c in SENSORS],
        *[F.percentile(c, F.lit(0.5)).alias(f"{c}_med") for c in SENSORS],
    )


def day_states(readings: DataFrame, tz: str) -> DataFrame:
    """States of each station's local days, in rows that merge by sums and maxima.

    A row without a sensor (``capteur`` null) holds the number of readings ``n``, the counter maxima in millionths and
    sum and count of each pressure; the others hold how often (``n``) a sensor read a value (``valeur``).

    Sensor values seldom repeat inside an input split, so counting them there would send a row per reading and sensor. Instead
    a reading goes to its station's day once, with its sensor values only, and is counted there; the totals, which do shrink
    inside a split, are an aggregation of their own. Each of the two scans reads its own columns.
    """
    rows = readings.withColumn(DAY, local_time(readings, TIME, tz).cast("date"))
    totals = [F.max(to_micro(F.col(c))).alias(name) for c, name in COUNTERS.items()]
    totals += [f(c).alias(f"{p}_{part}") for c, p in zip(PRESSURES, ROLLUP_PRESSURES) for part, f in (("sum", F.sum), ("n", F.count))]
    days = rows.groupBy(DAY, STATION).agg(F.count("*").alias(READINGS), *totals)
    no_sensor = [F.lit(None).cast("string").alias(SENSOR), F.lit(None).cast("long").alias(VALUE)]
    names = [c for c in days.columns if c not in (DAY, STATION, READINGS)]
    parts = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # all of them: joined ones hold too many values for a task
    read = rows.select(DAY, STATION, *SENSORS).repartition(parts, STATION, DAY)
    pairs = [F.struct(F.lit(s).alias(SENSOR), F.col(s).cast("long").alias(VALUE)) for s in SENSORS]
    values = read.select(DAY, STATION, F.inline(F.array(*pairs))).where(F.col(VALUE).isNotNull())
    counts = values.groupBy(DAY, STATION, SENSOR, VALUE).agg(F.count("*").alias(READINGS))
    return days.select(DAY, STATION, *no_sensor, READINGS, *names).unionByName(counts, allowMissingColumns=True)


def merged_states(states: DataFrame, span: Sequence[Bucket], end: date, bucket: str) -> DataFrame:
    """What ``spans_of_readings`` gives for the readings, from the states of their days; ``end`` is the day after the last bucket."""
    rows = states.where((F.col(DAY) >= F.lit(span[0].day)) & (F.col(DAY) < F.lit(end)))
    if MONTH in states.columns:  # stored in folders by month
        rows = rows.where((F.col(MONTH) >= F.lit(span[0].day.replace(day=1))) & (F.col(MONTH) < F.lit(end)))
    ends = [b.day for b in span[1:]] + [end]
    chain = F.when(F.col(DAY) < F.lit(ends[0]), F.lit(span[0].day))
    for b, until in zip(span[1:], ends[1:], strict=True):
        chain = chain.when(F.col(DAY) < F.lit(until), F.lit(b.day))
    return rows.groupBy(STATION, chain.alias(bucket)).agg(
        *[F.max(name).alias(name) for name in COUNTERS.values()],
        *[_mean(F.sum(f"{p}_sum"), F.sum(f"{p}_n")).alias(p) for p in ROLLUP_PRESSURES],
        *[_mean(F.sum(_of(s) * F.col(READINGS)), F.sum(F.when(F.col(SENSOR) == s, F.col(READINGS)))).alias(f"{s}_avg") for s in SENSORS],
        *[F.percentile(_of(s), F.lit(0.5), F.col(READINGS)).alias(f"{s}_med") for s in SENSORS],
    )


def _of(sensor: str) -> Column:
    return F.when(F.col(SENSOR) == sensor, F.col(VALUE))


def _mean(total: Column, n: Column) -> Column:
    return total.cast("double") / F.nullif(n, F.lit(0))
