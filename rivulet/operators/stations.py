"""Station registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import filled_values, norm_email
from rivulet.operators.changes import delete_keys, insert_absent, partial_update
from rivulet.schemas import STATION

_EMAILS = ("email", "email2", "email3")


def with_emails(stations: DataFrame) -> DataFrame:
    return stations.withColumn("emails", filled_values(*[F.col(c) for c in _EMAILS]))


def list_stations(stations: DataFrame) -> DataFrame:
    """All stations by client (unassigned last) and name, with their usable e-mails."""
    listed = with_emails(stations).select("client", "numero_automate", STATION, "lieu", *_EMAILS, "emails")
    return listed.orderBy(F.col("client").asc_nulls_last(), STATION)


def lookup_station(stations: DataFrame, name: str | None = None) -> DataFrame:
    """One station by name, or all of them."""
    rows = stations if name is None else stations.where(F.col(STATION) == F.lit(name))
    return with_emails(rows).select(STATION, "client", "lieu", *_EMAILS, "emails")


def distinct_clients(stations: DataFrame) -> DataFrame:
    return stations.where(F.col("client").isNotNull()).select("client").distinct().orderBy("client")


def distinct_sites(stations: DataFrame, client: str | None = None) -> DataFrame:
    """Sites of one client, or of every client."""
    rows = stations.where(F.col("lieu").isNotNull() & F.col("client").isNotNull())
    if client is not None:
        rows = rows.where(F.col("client") == F.lit(client))
    return rows.select("client", "lieu").distinct().orderBy("client", "lieu")


def site_stations(stations: DataFrame) -> DataFrame:
    """One station per (client, site): the first by name where there are several."""
    return stations.groupBy("client", "lieu").agg(F.min(STATION).alias(STATION))


def resolve_station(stations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Station of each requested (client, lieu); unknown pairs are dropped."""
    return pairs.select("client", "lieu").join(site_stations(stations), ["client", "lieu"])


def orphan_clients(stations: DataFrame, orgs: DataFrame) -> DataFrame:
    """Clients without an organization of the same name, ignoring case."""
    names = orgs.select(F.lower("name").alias("_key"))
    clients = stations.where(F.col("client").isNotNull()).select("client").distinct()
    return clients.withColumn("_key", F.lower("client")).join(names, "_key", "left_anti").select("client").orderBy("client")


def org_stations(stations: DataFrame, orgs: DataFrame) -> DataFrame:
    """Stations of each organization: linked by id, or by client name ignoring case.

    Two equi-joins whose results cannot overlap replace the OR condition.
    """
    keyed = orgs.select(F.col("id").alias("_org"), F.lower("name").alias("_name"))
    by_id = stations.join(keyed, stations["organization_id"] == keyed["_org"])
    by_name = stations.join(keyed, F.lower(stations["client"]) == keyed["_name"]).where(
        ~F.col("organization_id").eqNullSafe(F.col("_org"))
    )
    found = with_emails(by_id.unionByName(by_name))
    return found.select(F.col("_org").alias("org_id"), STATION, "numero_automate", "lieu", "emails").orderBy(
        "org_id", STATION
    )


def _normalized(stations: DataFrame) -> DataFrame:
    for c in _EMAILS:
        if c in stations.columns:
            stations = stations.withColumn(c, norm_email(F.col(c)))
    return stations


def add_stations(stations: DataFrame, new: DataFrame) -> DataFrame:
    """Register new stations with cleaned e-mails; known names are left alone."""
    return insert_absent(stations, _normalized(new), [STATION])


def update_stations(stations: DataFrame, changes: DataFrame) -> DataFrame:
    """Change only supplied fields; a supplied blank e-mail clears it."""
    cleaners: dict[str, object] = {c: norm_email for c in _EMAILS}
    return partial_update(stations, changes, [STATION], cleaners)


def remove_stations(stations: DataFrame, names: DataFrame) -> DataFrame:
    return delete_keys(stations, names.select(STATION))


def station_key(column: str = "client") -> Column:
    """Case-insensitive client key."""
    return F.lower(F.col(column))
