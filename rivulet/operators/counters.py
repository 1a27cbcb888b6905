"""Consumption from cumulative counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rivulet.functions.numeric import floor_zero, from_micro, to_micro
from rivulet.schemas import STATION, TIME
from rivulet.sources.readings import reading_order

# Divides every bucket in every time zone (offsets are multiples of a quarter of an hour).
SLICE = "15 minutes"
TRANCHE = "tranche"
DAY = "jour"
_QUARTER = 900
_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60}


def slice_seconds(width: str) -> int:
    """Seconds of a slice width such as ``5 minutes``.

    Only whole seconds that divide a quarter of an hour are slices of every bucket; any other
    width would book steps in the wrong one, so it is refused.
    """
    number, _, unit = width.strip().partition(" ")
    seconds = int(number) * _UNITS.get(unit.strip().lower(), 0) if number.isdigit() else 0
    if not seconds or _QUARTER % seconds:
        raise ValueError(f"a slice must be whole seconds dividing {_QUARTER}, like '15 minutes' or '30 seconds', not {width!r}")
    return seconds


def slice_summaries(
    readings: DataFrame,
    counters: Mapping[str, str],
    extra: Mapping[str, Column] | None = None,
    width: str = SLICE,
) -> DataFrame:
    """What has to be known of each station's short time slices, whatever comes before and after them.

    One row per (station, slice) with its number of readings ``n`` and, for every ``counters`` item source -> name, the
    first and last counter (``name_open``, ``name_close``) and the sum of the positive steps between
    (``name_steps``), in millionths; ``extra`` adds sum and count of further columns. Summaries of neighbouring slices
    combine to that of both (``combine_slices``), so they can be stored and only new readings be read.

    The previous reading is looked up inside (station, slice), so a station holding a large
    share of all readings is spread over as many groups as it has slices. Readings that are bucketed by
    station, or by station and day (``jour``), are not shuffled for it.
    """
    order = reading_order(readings)
    day = [DAY] if DAY in readings.columns else []
    rows = readings.withColumn(TRANCHE, F.window(F.col(TIME), f"{slice_seconds(width)} seconds")["start"])
    rows = rows.select(
        STATION,
        *day,
        TRANCHE,
        *order,
        *[to_micro(F.col(c)).alias(f"_{n}") for c, n in counters.items()],
        *[e.alias(f"_x_{n}") for n, e in (extra or {}).items()],
    )
    keys = [STATION, *day, TRANCHE]
    within = Window.partitionBy(*keys).orderBy(*order)
    names = list(counters.values())
    rows = rows.select(
        *keys,
        F.lag(F.lit(1)).over(within).isNull().alias("_first"),
        F.lead(F.lit(1)).over(within).isNull().alias("_last"),
        *[f"_{n}" for n in names],
        *[floor_zero(F.col(f"_{n}") - F.lag(f"_{n}").over(within)).alias(f"_d_{n}") for n in names],
        *[f"_x_{n}" for n in extra or {}],
    )
    aggs: list[Column] = [F.count("*").alias("n")]
    for n in names:
        aggs += [
            F.max(F.when(F.col("_first"), F.col(f"_{n}"))).alias(f"{n}_open"),
            F.max(F.when(F.col("_last"), F.col(f"_{n}"))).alias(f"{n}_close"),
            F.sum(f"_d_{n}").alias(f"{n}_steps"),
        ]
    for n in extra or {}:
        aggs += [F.sum(f"_x_{n}").alias(f"{n}_sum"), F.count(f"_x_{n}").alias(f"{n}_n")]
    return rows.groupBy(*keys).agg(*aggs).drop(*day)


def combine_slices(summaries: DataFrame, names: Sequence[str], start: Column, extra: Sequence[str] = ()) -> DataFrame:
    """Summaries of longer stretches from those of the slices in them; ``start`` gives the stretch of a slice.

    First of the first, last of the last, the sums and the steps from one slice into the next: the same as summing up the
    readings themselves, in whatever portions (the operation is associative).
    """
    rows = summaries.withColumn("_stretch", start)
    inside = Window.partitionBy(STATION, "_stretch").orderBy(TRANCHE)
    first, last = F.lag(F.lit(1)).over(inside).isNull(), F.lead(F.lit(1)).over(inside).isNull()
    steps = [(F.col(f"{n}_steps") + _step_into(n, inside)).alias(f"{n}_steps") for n in names]
    others = [c for n in names for c in (f"{n}_open", f"{n}_close")] + [c for x in extra for c in (f"{x}_sum", f"{x}_n")]
    rows = rows.select(STATION, "_stretch", "n", first.alias("_first"), last.alias("_last"), *others, *steps)
    aggs: list[Column] = [F.sum("n").alias("n")]
    for n in names:
        aggs += [
            F.max(F.when(F.col("_first"), F.col(f"{n}_open"))).alias(f"{n}_open"),
            F.max(F.when(F.col("_last"), F.col(f"{n}_close"))).alias(f"{n}_close"),
            F.sum(f"{n}_steps").alias(f"{n}_steps"),
        ]
    aggs += [F.sum(c).alias(c) for x in extra for c in (f"{x}_sum", f"{x}_n")]
    return rows.groupBy(STATION, F.col("_stretch").alias(TRANCHE)).agg(*aggs)


def _step_into(name: str, order: WindowSpec) -> Column:
    return floor_zero(F.col(f"{name}_open") - F.lag(f"{name}_close").over(order))


def summed_steps(summaries: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per (station, slice) the positive steps in it, the one into it included; further columns stay.

    The window over a station sees one small row per slice (at most 96 a day by default).
    """
    across = Window.partitionBy(STATION).orderBy(TRANCHE)
    used = {f"{n}_{part}" for n in names for part in ("open", "close", "steps")} | {"n"}
    carried = [c for c in summaries.columns if c not in used and c not in (STATION, TRANCHE)]
    steps = [(F.col(f"{n}_steps") + _step_into(n, across)).alias(n) for n in names]
    return summaries.select(STATION, TRANCHE, *steps, *carried)


def counter_slices(
    readings: DataFrame,
    counters: Mapping[str, str],
    extra: Mapping[str, Column] | None = None,
    width: str = SLICE,
) -> DataFrame:
    """Positive reading-to-reading steps, summed per station and short time slice.

    One row per (station, slice) with, for every ``counters`` item source -> name, the sum of
    ``max(reading - previous reading, 0)`` in millionths. The step into a slice is counted in
    that slice. ``extra`` adds further aggregates of the same rows. A shorter ``width`` spreads very dense
    readings further and never changes a result.
    """
    return summed_steps(slice_summaries(readings, counters, extra, width), list(counters.values()))


def counter_max_steps(buckets: DataFrame, bucket: str, maxima: Mapping[str, str]) -> list[Column]:
    """Step of each bucket's counter maximum over the previous present bucket, never negative.

    Works on bucketed rows (a few per station) whose maxima are in millionths.
    """
    previous = Window.partitionBy(STATION).orderBy(bucket)
    return [floor_zero(F.col(c) - F.lag(c).over(previous)).alias(name) for c, name in maxima.items()]


def counter_max_delta(readings: DataFrame, bucket_name: str, bucket: Column, counters: Mapping[str, str]) -> DataFrame:
    """Consumption per bucket as the difference of bucket maxima."""
    maxima = readings.groupBy(STATION, bucket.alias(bucket_name)).agg(
        *[F.max(to_micro(F.col(c))).alias(name) for c, name in counters.items()]
    )
    steps = counter_max_steps(maxima, bucket_name, {n: n for n in counters.values()})
    stepped = maxima.select(STATION, bucket_name, *steps)
    return stepped.select(STATION, bucket_name, *[from_micro(F.col(n)).alias(n) for n in counters.values()])


def counter_delta_sum(
    readings: DataFrame, counters: Mapping[str, str], bucket: Column, slice_width: str = SLICE
) -> DataFrame:
    """Sum of positive steps per station and bucket, in counter units.

    ``bucket`` is computed from the slice start ``tranche``, e.g. its day.
    """
    slices = counter_slices(readings, counters, width=slice_width)
    sums = slices.groupBy(STATION, bucket).agg(*[F.sum(n).alias(n) for n in counters.values()])
    return sums.select(*[from_micro(F.col(c)).alias(c) if c in counters.values() else F.col(c) for c in sums.columns])


def interval_consumption(series: DataFrame, order: str, value: str, keys: Sequence[str] = (STATION,)) -> DataFrame:
    """Non-negative difference to the previous row of a bucketed series; the first row is dropped."""
    w = Window.partitionBy(*keys).orderBy(order)
    steps = series.withColumn("_seen", F.lag(F.lit(1)).over(w)).withColumn("_prev", F.lag(value).over(w))
    return steps.where(F.col("_seen").isNotNull()).select(
        *keys, order, F.greatest(F.col(value) - F.col("_prev"), F.lit(0)).alias("consommation")
    )
