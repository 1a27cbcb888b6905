"""Latest value per station."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.numeric import clamp
from rivulet.functions.timegrain import epoch_micros, instant, local_time
from rivulet.schemas import STATION, TIME
from rivulet.sources.readings import Stations, keep_stations, reading_order


# Beyond every 64-bit tie-breaker, so that the time always counts more.
_SHIFT = "10000000000000000000BD"
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _recency(readings: DataFrame) -> Column:
    """One number per reading, greater for newer ones; a missing time or tie-breaker comes last."""
    order = reading_order(readings)
    micros = epoch_micros(readings, TIME)
    if len(order) == 1:
        return F.coalesce(micros, F.expr("-9223372036854775808L"))
    time = F.coalesce(micros.cast("decimal(38,0)"), F.expr("-9300000000000000000BD").cast("decimal(38,0)"))
    tie = F.coalesce(F.col(order[1]).cast("long").cast("decimal(38,0)"), F.expr("-9300000000000000000BD").cast("decimal(38,0)"))
    return (time * F.expr(_SHIFT)).cast("decimal(38,0)") + tie


def latest_rows(readings: DataFrame) -> DataFrame:
    """Newest reading of each station.

    Columns of fixed width are aggregated by hash, so nothing is sorted and every input split
    sends one row per station. Other columns (text) need a rank within each split instead.
    """
    values = [c for c in readings.columns if c != STATION]
    if all(isinstance(readings.schema[c].dataType, _FIXED) for c in values):
        keyed = readings.withColumn("_recency", _recency(readings))
        newest = keyed.groupBy(STATION).agg(*[F.max_by(c, "_recency").alias(c) for c in values])
        return newest.select(*readings.columns)
    order = [F.col(c).desc_nulls_last() for c in reading_order(readings)]
    ranked = readings.withColumn("_rank", F.row_number().over(Window.partitionBy(STATION).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest(
    readings: DataFrame,
    value: str,
    predicate: Column | None = None,
    limits: tuple[float, float] | None = None,
    default: float = 0.0,
    stations: Stations = None,
    tz: str = "UTC",
) -> DataFrame:
    """(station, time, value) of the newest reading that satisfies ``predicate``."""
    rows = keep_stations(readings, stations)
    if predicate is not None:
        rows = rows.where(predicate)
    rows = latest_rows(rows.select(STATION, *reading_order(rows), value))
    result = F.coalesce(F.col(value).cast("double"), F.lit(float(default)))
    if limits:
        result = clamp(result, float(limits[0]), float(limits[1]))
    return rows.select(STATION, local_time(rows, TIME, tz).alias(TIME), result.alias("valeur"))


def latest_value(readings: DataFrame, value: str, stations: Stations = None) -> DataFrame:
    """Newest reading whatever its value; a missing value reads 0 (tank percentages, water counter)."""
    return latest(readings, value, stations=stations)


def latest_clamped(readings: DataFrame, value: str, stations: Stations = None) -> DataFrame:
    """Newest non-null tank height, kept within 0..100 %."""
    return latest(readings, value, F.col(value).isNotNull(), (0, 100), stations=stations)


def latest_positive(
    readings: DataFrame, value: str = "compteur_electrique_kwh", stations: Stations = None
) -> DataFrame:
    """Newest strictly positive counter."""
    return latest(readings, value, F.col(value) > 0, stations=stations)


def latest_counters(readings: DataFrame, as_of: datetime) -> DataFrame:
    """Newest reading with both water counters, stamped with the run time: the counter cache."""
    counters = ("compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3")
    both = readings.where(F.col(counters[0]).isNotNull() & F.col(counters[1]).isNotNull())
    rows = latest_rows(both.select(STATION, *reading_order(readings), *counters))
    return rows.select(
        STATION,
        *[F.col(c).cast("double").alias(c) for c in counters],
        instant(as_of, readings.schema[TIME].dataType).alias("updated_at"),
    )
