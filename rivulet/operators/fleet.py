"""Fleet total and rollup export."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.numeric import from_micro, round_half_up, to_micro
from rivulet.functions.timegrain import GRAINS
from rivulet.operators.fill import bfill_leading_zero, ffill_zero
from rivulet.schemas import DAILY_ROLLUP, MONTHLY_ROLLUP, STATION, WEEKLY_ROLLUP
from rivulet.sources.readings import Stations, keep_stations

# All metrics of the three rollups.
EXPORT_COLUMNS = frozenset(
    f.name
    for schema in (DAILY_ROLLUP, WEEKLY_ROLLUP, MONTHLY_ROLLUP)
    for f in schema
    if f.name not in {STATION, "created_at", "updated_at", *(g.bucket for g in GRAINS.values())}
)


def fleet_recycled_total(
    cache: DataFrame, stations: DataFrame, org_names: DataFrame | Sequence[str] | None = None
) -> DataFrame:
    """Recycled m3 and number of counted stations; stations with a negative difference are left out.

    ``org_names`` restricts to stations whose client is one of the names, ignoring case:
    a list, or a DataFrame with a ``name`` column. An empty one gives (0, 0).
    """
    clients = F.lower(F.col("client"))
    if isinstance(org_names, DataFrame):
        names = org_names.select(F.lower("name").alias("_client")).distinct()
        stations = stations.withColumn("_client", clients).join(names, "_client", "left_semi")
    elif org_names is not None:
        stations = stations.where(clients.isin([n.lower() for n in org_names]))
    gain = to_micro(F.col("compteur_eau_renvoi_m3")) - to_micro(F.col("compteur_eau_adoucie_m3"))
    gains = cache.join(stations.select(STATION), STATION).select(gain.alias("gain")).where(F.col("gain") >= 0)
    total = F.coalesce(round_half_up(from_micro(F.sum("gain")), 1), F.lit(0.0))
    return gains.agg(total.alias("total_recycle_m3"), F.count("*").alias("nb_stations"))


def export_rollup(
    rollup: DataFrame,
    grain: str,
    columns: Sequence[str],
    stations: Stations,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Whitelisted rollup columns of the chosen stations, both dates inclusive, sorted by date and station.

    Zero recycling rates are filled from the neighbouring days of the same station.
    """
    chosen = [c for c in dict.fromkeys(columns) if c in EXPORT_COLUMNS]
    if not chosen:
        raise ValueError("no exportable column requested")
    if stations is not None and not isinstance(stations, DataFrame) and not list(stations):
        raise ValueError("no station requested")
    bucket = GRAINS[grain].bucket
    rows = keep_stations(rollup, stations)
    if start is not None:
        rows = rows.where(F.col(bucket) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(bucket) <= F.lit(end))
    rows = rows.select(F.col(bucket).alias("date"), STATION, *chosen)
    if "taux_recyclage" in chosen:
        rows = bfill_leading_zero(ffill_zero(rows, "taux_recyclage", "date"), "taux_recyclage", "date")
    return rows.orderBy("date", STATION)
