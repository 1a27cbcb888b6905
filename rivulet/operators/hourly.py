"""Hourly series over the last hours before ``as_of``, for all stations at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.numeric import from_micro, round_half_up, to_micro, wrap_delta
from rivulet.functions.timegrain import HOUR_START, local_time, time_between, utc_naive, with_hour
from rivulet.operators.counters import SLICE, TRANCHE, counter_slices
from rivulet.schemas import ENERGY_COUNTER, PERCENT_COUNTERS, PRESSURES, STATION, TIME, VOLUMES
from rivulet.sources.readings import Stations, keep_stations

HOUR = "heure"
RENVOI, ADOUCIE = "compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3"


def recent(
    readings: DataFrame,
    as_of: datetime,
    hours: int = 24,
    stations: Stations = None,
    open_end: bool = False,
    column: str = TIME,
) -> DataFrame:
    """Readings of the last ``hours``; ``open_end`` leaves the upper side unbounded."""
    now = utc_naive(as_of)
    end = None if open_end else now
    return keep_stations(time_between(readings, column, now - timedelta(hours=hours), end), stations)


def _hours(rows: DataFrame, column: str, tz: str, *aggs: Column) -> DataFrame:
    """One row per real hour: the hour that autumn repeats gives two rows with one label, in order of their instants."""
    return with_hour(rows, column, tz).groupBy(STATION, HOUR, HOUR_START).agg(*aggs)


def _per_hour(readings: DataFrame, tz: str, *aggs: Column) -> DataFrame:
    return _hours(readings, TIME, tz, *aggs).drop(HOUR_START)


def hourly_wrap_delta_all(
    readings: DataFrame,
    as_of: datetime,
    hours: int = 24,
    stations: Stations = None,
    tz: str = "UTC",
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """m3 per hour from 0-100 % counters that wrap at 100 (1 % = 0.01 m3).

    The hourly mean, rounded to 0.1 %, is compared with the previous hour that has readings;
    the first hour has none and is dropped.
    """
    columns = columns or dict(zip(PERCENT_COUNTERS, VOLUMES))
    means = _hours(
        recent(readings, as_of, hours, stations),
        TIME,
        tz,
        *[round_half_up(F.avg(c), 1).alias(out) for c, out in columns.items()],
    )
    w = Window.partitionBy(STATION).orderBy(HOUR_START)
    previous = [F.lag(o).over(w).alias(f"_prev_{o}") for o in columns.values()]
    steps = means.select(STATION, HOUR, *columns.values(), *previous, F.lag(F.lit(1)).over(w).alias("_seen"))
    deltas = [
        round_half_up(wrap_delta(F.col(o), F.col(f"_prev_{o}")) / F.lit(100), 3).alias(o) for o in columns.values()
    ]
    return steps.where(F.col("_seen").isNotNull()).select(STATION, HOUR, *deltas)


def hourly_wrap_delta(
    readings: DataFrame, as_of: datetime, column: str, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """As above for a single counter."""
    return hourly_wrap_delta_all(readings, as_of, hours, stations, tz, {column: "delta_m3"})


def hour_of_day_mean(
    series: DataFrame,
    as_of: datetime,
    hours: int = 24,
    stations: Stations = None,
    tz: str = "UTC",
    time_col: str = "rounded_timestamp",
    value: str = "avg_pression5",
) -> DataFrame:
    """Mean per hour number 0-23; the two ends of the window share their hour."""
    rows = recent(series, as_of, hours, stations, open_end=True, column=time_col)
    hour = F.hour(local_time(rows, time_col, tz)).alias("heure_num")
    # Whole millionths, so that the mean does not depend on the order of partial sums.
    mean = F.sum(to_micro(F.col(value))).cast("double") / F.count(value) / F.lit(1e6)
    means = rows.groupBy(STATION, hour).agg(F.when(F.count(value) > 0, mean).alias("moyenne_pression"))
    return means.select(
        STATION, "heure_num", F.format_string("%02d:00", "heure_num").alias("label"), "moyenne_pression"
    )


def _both_counters(readings: DataFrame, as_of: datetime, hours: int, stations: Stations) -> DataFrame:
    rows = recent(readings, as_of, hours, stations, open_end=True)
    return rows.where(F.col(RENVOI).isNotNull() & F.col(ADOUCIE).isNotNull())


def _spread(column: str) -> Column:
    return F.max(to_micro(F.col(column))) - F.min(to_micro(F.col(column)))


def _spread_rate(renvoi: Column, adoucie: Column) -> Column:
    ratio = (renvoi - adoucie).cast("double") / F.nullif(renvoi, F.lit(0)).cast("double")
    return F.coalesce(round_half_up(ratio, 4), F.lit(0.0))


def hourly_recycling_rate(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """(renvoi - adoucie) / renvoi of the hour's counter spreads, not clamped."""
    spreads = _per_hour(
        _both_counters(readings, as_of, hours, stations), tz, _spread(RENVOI).alias("r"), _spread(ADOUCIE).alias("a")
    )
    return spreads.select(STATION, HOUR, _spread_rate(F.col("r"), F.col("a")).alias("taux_recyclage"))


def recycling_rate_24h(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """One rate per station over the whole window, with the time of its latest usable reading."""
    rows = _both_counters(readings, as_of, hours, stations)
    rows = rows.withColumn(TIME, local_time(rows, TIME, tz))
    spreads = rows.groupBy(STATION).agg(
        F.max(TIME).alias(TIME), _spread(RENVOI).alias("r"), _spread(ADOUCIE).alias("a")
    )
    return spreads.select(STATION, TIME, _spread_rate(F.col("r"), F.col("a")).alias("valeur"))


def hourly_disinfection_rate(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    mean = round_half_up(F.avg("chlore_mv") / F.lit(3.0), 2).alias("taux_desinfection")
    return _per_hour(recent(readings, as_of, hours, stations), tz, mean)


def hourly_pressure_medians(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """Median of each pressure per hour.

    An hour of one station is a small group, so Spark's own exact median is used: every input
    split ships value counts, bounded by the sensor's integer range.
    """
    medians = [F.median(c).alias(f"p{i}_med_mbar") for i, c in enumerate(PRESSURES, 1)]
    return _per_hour(recent(readings, as_of, hours, stations), tz, *medians)


def _median_in_range(
    readings: DataFrame,
    as_of: datetime,
    hours: int,
    stations: Stations,
    tz: str,
    column: str,
    allowed: tuple[int, int],
    name: str,
    scale: float | None,
) -> DataFrame:
    rows = recent(readings, as_of, hours, stations).where(F.col(column).between(*allowed))
    median = F.median(column)
    if scale:
        median = F.coalesce(median, F.lit(0.0)) / F.lit(scale)
    return _per_hour(rows, tz, median.alias(name))


def hourly_temperature_median(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """Median temperature of the readings within 0..60 degrees (stored in tenths)."""
    return _median_in_range(readings, as_of, hours, stations, tz, "temperature_deg", (0, 600), "temp_med_c", 10.0)


def hourly_chlorine_median(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """Median chlorine of the readings within 0..2000."""
    return _median_in_range(readings, as_of, hours, stations, tz, "chlore_mv", (0, 2000), "chlore_med_mv", None)


def hourly_ph_median(
    readings: DataFrame, as_of: datetime, hours: int = 24, stations: Stations = None, tz: str = "UTC"
) -> DataFrame:
    """Median pH of the readings within 2..12 (stored in hundredths)."""
    return _median_in_range(readings, as_of, hours, stations, tz, "ph", (200, 1200), "ph_mediane", 100.0)


def _hourly_steps(
    readings: DataFrame,
    as_of: datetime,
    hours: int,
    stations: Stations,
    tz: str,
    counters: Mapping[str, str],
    slice_width: str,
) -> DataFrame:
    slices = counter_slices(recent(readings, as_of, hours, stations), counters, width=slice_width)
    sums: Sequence[Column] = [F.sum(n).alias(n) for n in counters.values()]
    return _hours(slices, TRANCHE, tz, *sums)


def hourly_energy(
    readings: DataFrame,
    as_of: datetime,
    hours: int = 24,
    stations: Stations = None,
    tz: str = "UTC",
    slice_width: str = SLICE,
) -> DataFrame:
    """kWh per hour: positive counter steps, booked in the hour of the later reading."""
    steps = _hourly_steps(readings, as_of, hours, stations, tz, {ENERGY_COUNTER: "kwh"}, slice_width)
    return steps.select(STATION, HOUR, round_half_up(from_micro(F.col("kwh")), 2).alias("conso_kwh"))


def hourly_energy_ratio(
    readings: DataFrame,
    as_of: datetime,
    hours: int = 24,
    stations: Stations = None,
    tz: str = "UTC",
    slice_width: str = SLICE,
) -> DataFrame:
    """kWh per m3 lifted, averaged over the hour and the two before it; null without any lifting."""
    counters = {ENERGY_COUNTER: "kwh", "compteur_eau_relevage_m3": "m3"}
    steps = _hourly_steps(readings, as_of, hours, stations, tz, counters, slice_width)
    raw = F.when(F.col("m3") > 0, F.col("kwh").cast("double") / F.col("m3").cast("double"))
    trailing = Window.partitionBy(STATION).orderBy(HOUR_START).rowsBetween(-2, Window.currentRow)
    ratios = steps.select(STATION, HOUR, HOUR_START, raw.alias("brut"))
    return ratios.select(STATION, HOUR, round_half_up(F.avg("brut").over(trailing), 3).alias("ratio"))
