"""Incident log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import folded, iso_timestamp, strip
from rivulet.operators.changes import append_rows, full_update
from rivulet.operators.stations import site_stations
from rivulet.schemas import STATION

# The built-in incident types.
INCIDENT_TYPES = (
    "Pompe HS",
    "Pompe désamorcée",
    "Filtre colmaté",
    "Filtre saturé",
    "Électrovanne HS",
    "Vanne bloquée",
    "Pressostat défectueux",
    "Capteur niveau HS",
    "Sonde conductivité HS",
    "Fuite hydraulique",
    "Fuite cuve",
    "Cuve pleine",
    "Cuve vide",
    "Débordement",
    "Manque produit chimique",
    "Surdosage produit",
    "Qualité eau insuffisante",
    "Odeur anormale",
    "Carte électronique HS",
    "Erreur automate",
    "Problème électrique",
    "Disjonction",
    "Air dans le circuit",
    "Bobine eV HS",
    "VAR 3 en défaut",
)

_REQUIRED = ("client", "lieu", STATION, "panne", "probleme")


def incident_types(incidents: DataFrame, defaults: tuple[str, ...] = INCIDENT_TYPES) -> DataFrame:
    """Built-in and recorded incident types, one spelling per case-insensitive name, sorted.

    The built-in spelling wins, then the first recorded one in binary order. Case is folded fully: ``Straße`` and
    ``STRASSE`` are one name; rows are sorted by the folded name.
    """
    builtin = F.array(*[F.lit(t) for t in defaults])
    recorded = incidents.select(strip(F.col("panne")).alias("type")).where(F.col("type") != F.lit("")).distinct()
    found = recorded.groupBy(folded(F.col("type")).alias("cle")).agg(F.min("type").alias("saisi"))
    known = incidents.sparkSession.range(1).select(F.explode(builtin).alias("officiel"))
    known = known.withColumn("cle", folded(F.col("officiel")))
    merged = found.join(known, "cle", "full_outer")
    return merged.select("cle", F.coalesce("officiel", "saisi").alias("type")).orderBy("cle").select("type")


def list_incidents(incidents: DataFrame) -> DataFrame:
    """Newest id first, dates in ISO form."""
    listed = incidents.select(
        "id",
        "client",
        "lieu",
        STATION,
        "panne",
        "probleme",
        iso_timestamp(F.col("date_debut")).alias("date_debut"),
        iso_timestamp(F.col("date_fin")).alias("date_fin"),
        "created_by",
    )
    return listed.orderBy(F.col("id").desc())


def check_incidents(new: DataFrame, stations: DataFrame) -> DataFrame:
    """Add ``reason``: null for an acceptable incident, else the first rule it breaks."""
    known = site_stations(stations).withColumnRenamed(STATION, "_station")
    joined = new.join(known, ["client", "lieu"], "left")
    blank: Column = F.col("date_debut").isNull()
    for c in _REQUIRED:
        blank = blank | F.col(c).isNull() | (F.col(c) == F.lit(""))
    reason = (
        F.when(blank, F.lit("missing_field"))
        .when(F.col("date_fin") < F.col("date_debut"), F.lit("end_before_start"))
        .when(F.col("_station").isNull(), F.lit("unknown_site"))
        .when(F.col("_station") != F.col(STATION), F.lit("station_mismatch"))
    )
    return joined.select(*new.columns, reason.alias("reason"))


def validate_incidents(new: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason)."""
    checked = check_incidents(new, stations)
    return checked.where(F.col("reason").isNull()).drop("reason"), checked.where(F.col("reason").isNotNull())


def record_incidents(
    incidents: DataFrame, new: DataFrame, stations: DataFrame, author: str
) -> tuple[DataFrame, DataFrame]:
    """(log with the accepted incidents appended under ``author``, rejected with reason)."""
    accepted, rejected = validate_incidents(new, stations)
    return append_rows(incidents, accepted.withColumn("created_by", F.lit(author))), rejected


def amend_incidents(incidents: DataFrame, edits: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(log with the accepted edits put over the incidents of the same id, rejected with reason).

    All fields but the author are replaced, an empty end date included; unknown ids are ignored.
    """
    accepted, rejected = validate_incidents(edits, stations)
    return full_update(incidents, accepted.drop("created_by"), ["id"]), rejected
