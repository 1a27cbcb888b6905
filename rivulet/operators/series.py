"""Chart series read from the rollup tables, and their packing into arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.numeric import clamp, round_half_up
from rivulet.functions.timegrain import GRAINS, bucket_label
from rivulet.operators.fill import outlier_repair
from rivulet.schemas import ROLLUP_PRESSURES, STATION, VOLUMES
from rivulet.sources.readings import Stations, keep_stations


def _series(rollup: DataFrame, grain: str, values: dict[str, Column], stations: Stations) -> DataFrame:
    bucket = GRAINS[grain].bucket
    rows = keep_stations(rollup, stations)
    picked = rows.select(
        STATION,
        F.col(bucket).alias("bucket"),
        bucket_label(F.col(bucket), grain).alias("label"),
        *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(n) for n, v in values.items()],
    )
    return picked.orderBy(STATION, "bucket")


def rollup_series(rollup: DataFrame, grain: str, columns: Sequence[str], stations: Stations = None) -> DataFrame:
    """Chosen rollup columns as labelled series; missing values read 0."""
    return _series(rollup, grain, {c: F.col(c) for c in columns}, stations)


def renvoi_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return rollup_series(rollup, grain, [VOLUMES[0]], stations)


def adoucie_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return rollup_series(rollup, grain, [VOLUMES[1]], stations)


def relevage_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return rollup_series(rollup, grain, [VOLUMES[2]], stations)


def pressure5_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return rollup_series(rollup, grain, ["p5_mbar"], stations)


def disinfection_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    column = "taux_desinfection" if grain == "daily" else "taux_desinfection_avg"
    return rollup_series(rollup, grain, [column], stations)


def energy_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return rollup_series(rollup, grain, ["conso_kwh"], stations)


def pressure_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    """The five pressures, named as in the hourly medians."""
    values = {f"p{i}_med_mbar": F.col(p) for i, p in enumerate(ROLLUP_PRESSURES, 1)}
    return _series(rollup, grain, values, stations)


def volume_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return rollup_series(rollup, grain, VOLUMES, stations)


def rate_from_volumes(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    """Recycling rate recomputed from stored volumes, within 0..1; 0 unless renvoi is positive."""
    renvoi, adoucie = F.col(VOLUMES[0]), F.coalesce(F.col(VOLUMES[1]), F.lit(0.0))
    rate = F.when(renvoi > 0, clamp((renvoi - adoucie) / F.nullif(renvoi, F.lit(0.0)), 0.0, 1.0))
    return _series(rollup, grain, {"taux_recyclage": rate}, stations)


def ratio_from_rollup(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    """kWh per m3 lifted; 0 without lifting or without an energy value."""
    lifted = F.col(VOLUMES[2])
    ratio = F.when(lifted > 0, round_half_up(F.col("conso_kwh") / F.nullif(lifted, F.lit(0.0)), 3))
    return _series(rollup, grain, {"ratio": ratio}, stations)


def temperature_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return outlier_repair(rollup_series(rollup, grain, ["temp_moy_c"], stations), "temp_moy_c", 0, 60)


def chlorine_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return outlier_repair(rollup_series(rollup, grain, ["chlore_moy_mg_l"], stations), "chlore_moy_mg_l", 0, 2000)


def ph_series(rollup: DataFrame, grain: str, stations: Stations = None) -> DataFrame:
    return outlier_repair(rollup_series(rollup, grain, ["ph_moyen"], stations), "ph_moyen", 2, 12)


def pack_series(series: DataFrame, order: str, label: str, values: Sequence[str], zero_fill: bool = True) -> DataFrame:
    """One row per station with parallel arrays ``labels`` and one per value, in time order.

    Meant for bucketed series: 24 hours, or the few buckets a rollup table retains.
    """
    entry = F.struct(order, F.col(label).alias("_label"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    packed = series.groupBy(STATION).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))

    def array_of(i: int) -> Column:
        field = F.col(f"_rows._v{i}")
        return F.transform(field, lambda x: F.coalesce(x, F.lit(0.0))) if zero_fill else field

    return packed.select(
        STATION, F.col("_rows._label").alias("labels"), *[array_of(i).alias(v) for i, v in enumerate(values)]
    )
