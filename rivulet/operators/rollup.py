"""Daily, weekly and monthly rollups."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.numeric import floor_zero, from_micro, recycling_rate, round_half_up, round_to_int, to_micro
from rivulet.functions.timegrain import GRAINS, PARIS, bounds, bucket_of, buckets, day_after, grid, time_between
from rivulet.operators.counters import SLICE, TRANCHE, counter_max_steps, slice_summaries, summed_steps
from rivulet.operators.states import COUNTERS, merged_states, spans_of_readings
from rivulet.schemas import (
    DAILY_ROLLUP,
    ENERGY_COUNTER,
    MONTHLY_ROLLUP,
    PRESSURES,
    ROLLUP_PRESSURES,
    STATION,
    TIME,
    VOLUMES,
    WATER_COUNTERS,
    WEEKLY_ROLLUP,
)
from rivulet.sources.readings import station_universe

_RENVOI, _ADOUCIE = VOLUMES[0], VOLUMES[1]
_STAMPS = ("created_at", "updated_at")


def _published(df: DataFrame, schema: T.StructType, shown: Mapping[str, Column] | None = None) -> DataFrame:
    """The rollup's columns in declared order and type; ``shown`` replaces some of them."""
    shown = shown or {}
    fields = [f for f in schema if f.name not in _STAMPS]
    return df.select(*[shown.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def daily_summaries(readings: DataFrame, slice_width: str = SLICE) -> DataFrame:
    """Slices as the daily rollup needs them: counters with their edges and steps, sums and counts of the means."""
    means = {"chlore": F.col("chlore_mv"), "ph": F.col("ph"), "temp": F.col("temperature_deg")}
    means |= {f"p{i}": F.col(c) for i, c in enumerate(PRESSURES, 1)}
    return slice_summaries(readings, COUNTERS, means, slice_width)


def daily_of_summaries(
    summaries: DataFrame, stations: DataFrame, as_of: datetime, tz: str = PARIS, lookback_buckets: int = 0
) -> DataFrame:
    """The daily rollup of stored slices (``daily_summaries``), without reading a single reading again."""
    bucket = GRAINS["daily"].bucket
    span = buckets(as_of, "daily", tz, lookback_buckets)
    rows = time_between(summaries, TRANCHE, *bounds(as_of, "daily", tz, lookback_buckets))
    slices = summed_steps(rows, list(COUNTERS.values()))
    sums = [F.sum(c).alias(c) for c in slices.columns if c not in (STATION, TRANCHE)]
    days = slices.groupBy(STATION, bucket_of(slices, TRANCHE, span).alias(bucket)).agg(*sums)

    def mean(name: str) -> Column:
        return F.col(f"{name}_sum").cast("double") / F.nullif(F.col(f"{name}_n"), F.lit(0))

    shaped = days.select(
        STATION,
        bucket,
        *[round_half_up(from_micro(F.col(v)), 2).alias(v) for v in (*VOLUMES, "conso_kwh")],
        round_half_up(mean("chlore") / F.lit(3.0), 2).alias("taux_desinfection"),
        *[round_to_int(mean(f"p{i}")).alias(p) for i, p in enumerate(ROLLUP_PRESSURES, 1)],
        round_half_up(mean("temp") / F.lit(10.0), 1).alias("temp_moy_c"),
        round_half_up(mean("chlore"), 2).alias("chlore_moy_mg_l"),
        round_half_up(mean("ph") / F.lit(100.0), 2).alias("ph_moyen"),
    )
    dense = grid(stations, as_of, "daily", tz).join(shaped, [STATION, bucket], "left")
    # Two-decimal volumes as whole hundredths, so that the rate has no representation noise.
    cents = {v: F.rint(F.col(v) * F.lit(100)).cast("long") for v in (_RENVOI, _ADOUCIE)}
    shown = {c: floor_zero(F.col(c)) for c in (*VOLUMES, "conso_kwh", "taux_desinfection", "chlore_moy_mg_l")}
    shown["taux_recyclage"] = recycling_rate(cents[_RENVOI], cents[_ADOUCIE])
    return _published(dense, DAILY_ROLLUP, shown)


def rollup_daily(
    readings: DataFrame,
    aggregated: DataFrame | None,
    as_of: datetime,
    tz: str = PARIS,
    lookback_buckets: int = 0,
    stations: DataFrame | None = None,
    slice_width: str = SLICE,
) -> DataFrame:
    """The seven full days before ``as_of``, one row per station and day.

    Volumes and energy are sums of positive steps between consecutive readings, the other
    columns daily means. Days without readings are present with zero consumption.
    ``lookback_buckets`` = 1 also counts the step into the first day. ``stations`` replaces
    the search for station names in the whole history.
    """
    rows = time_between(readings, TIME, *bounds(as_of, "daily", tz, lookback_buckets))
    universe = stations if stations is not None else station_universe(aggregated, readings)
    return daily_of_summaries(daily_summaries(rows, slice_width), universe, as_of, tz, lookback_buckets)


def _long_span(source: DataFrame, as_of: datetime, grain: str, tz: str, lookback: int, stored: bool = False) -> DataFrame:
    """Weekly and monthly metrics of the buckets that have readings, from readings or from stored day states.

    Either is read once: maxima, means and the value counts that medians come from are one aggregation.
    """
    bucket = GRAINS[grain].bucket
    span = buckets(as_of, grain, tz, lookback)
    per_bucket = merged_states(source, span, day_after(span, grain), bucket) if stored else spans_of_readings(source, span, bucket)
    steps = counter_max_steps(per_bucket, bucket, {n: n for n in COUNTERS.values()})
    others = [F.col(c) for c in per_bucket.columns if c not in COUNTERS.values()]
    stepped = per_bucket.select(*others, *steps)
    if lookback:
        stepped = stepped.where(F.col(bucket) >= F.lit(span[lookback].day))
    return stepped.select(
        STATION,
        bucket,
        *[from_micro(F.col(v)).alias(v) for v in (*VOLUMES, "conso_kwh")],
        recycling_rate(F.col(_RENVOI), F.col(_ADOUCIE)).alias("taux_recyclage"),
        round_half_up(F.col("chlore_mv_avg") / F.lit(3.0), 2).alias("taux_desinfection_avg"),
        round_half_up(F.col("chlore_mv_med") / F.lit(3.0), 2).alias("taux_desinfection_med"),
        *[round_to_int(F.col(p)).alias(p) for p in ROLLUP_PRESSURES],
        round_half_up(F.col("temperature_deg_avg") / F.lit(10.0), 1).alias("temp_moy_c"),
        round_half_up(F.col("temperature_deg_med") / F.lit(10.0), 1).alias("temp_med_c"),
        round_half_up(F.col("chlore_mv_avg"), 2).alias("chlore_moy_mg_l"),
        round_half_up(F.col("chlore_mv_med"), 2).alias("chlore_med_mg_l"),
        round_half_up(F.col("ph_avg") / F.lit(100.0), 2).alias("ph_moyen"),
        round_half_up(F.col("ph_med") / F.lit(100.0), 2).alias("ph_med"),
    )


def rollup_weekly(
    readings: DataFrame,
    aggregated: DataFrame | None,
    as_of: datetime,
    tz: str = PARIS,
    lookback_buckets: int = 0,
    stations: DataFrame | None = None,
) -> DataFrame:
    """The current ISO week and the three before it, one row per station and week.

    Consumption is the step of the weekly counter maximum over the previous present week.
    With ``lookback_buckets`` = 0 the oldest week has no predecessor and reads 0.
    """
    universe = stations if stations is not None else station_universe(aggregated, readings)
    return _dense_weeks(_long_span(readings, as_of, "weekly", tz, lookback_buckets), universe, as_of, tz)


def _dense_weeks(weeks: DataFrame, stations: DataFrame, as_of: datetime, tz: str) -> DataFrame:
    dense = grid(stations, as_of, "weekly", tz).join(weeks, [STATION, GRAINS["weekly"].bucket], "left")
    shown = {c: floor_zero(F.col(c)) for c in (*VOLUMES, "conso_kwh", "taux_recyclage")}
    return _published(dense, WEEKLY_ROLLUP, shown)


def rollup_monthly(readings: DataFrame, as_of: datetime, tz: str = PARIS, lookback_buckets: int = 1) -> DataFrame:
    """The current month and the five before it; only months with readings."""
    return _published(_long_span(readings, as_of, "monthly", tz, lookback_buckets), MONTHLY_ROLLUP)


def rollup_of_states(
    states: DataFrame,
    grain: str,
    as_of: datetime,
    tz: str = PARIS,
    stations: DataFrame | None = None,
    lookback_buckets: int | None = None,
) -> DataFrame:
    """The weekly or monthly rollup from stored day states (``states.day_states`` of the same ``tz``).

    Equal to ``rollup_weekly`` or ``rollup_monthly`` of the readings, which are not read. ``stations`` are
    those of a weekly rollup; by default the ones that have states.
    """
    if grain == "monthly":
        lookback = 1 if lookback_buckets is None else lookback_buckets
        return _published(_long_span(states, as_of, grain, tz, lookback, stored=True), MONTHLY_ROLLUP)
    weeks = _long_span(states, as_of, grain, tz, lookback_buckets or 0, stored=True)
    return _dense_weeks(weeks, stations if stations is not None else states.select(STATION).distinct(), as_of, tz)
