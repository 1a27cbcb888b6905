"""Column names and explicit schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

STATION = "nom_automate"
TIME = "horodatage"
SEQ = "seq"

WATER_COUNTERS = ("compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3", "compteur_eau_relevage_m3")
ENERGY_COUNTER = "compteur_electrique_kwh"
PERCENT_COUNTERS = (
    "compteur_eau_inst_renvoi_pc",
    "compteur_eau_inst_adoucie_pc",
    "compteur_eau_inst_relevage_pc",
)
PRESSURES = tuple(f"pression{i}_mbar" for i in range(1, 6))
ROLLUP_PRESSURES = tuple(f"p{i}_mbar" for i in range(1, 6))
VOLUMES = ("vol_renvoi_m3", "vol_adoucie_m3", "vol_relevage_m3")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_STR, _INT, _LONG, _DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TS, _BOOL = T.DateType(), T.TimestampType(), T.BooleanType()

READINGS = _struct(
    (STATION, _STR),
    (TIME, _TS),
    (SEQ, _LONG),
    *((c, _DBL) for c in WATER_COUNTERS),
    (ENERGY_COUNTER, _DBL),
    *((c, _INT) for c in PERCENT_COUNTERS),
    *((c, _INT) for c in PRESSURES),
    ("temperature_deg", _INT),
    ("chlore_mv", _INT),
    ("ph", _INT),
    ("hauteur_cuve_traitement_pc", _INT),
    ("hauteur_cuve_disconnection_pc", _INT),
)

PRESSURE_AVG = _struct((STATION, _STR), ("rounded_timestamp", _TS), ("avg_pression5", _DBL))

_STAMPS = (("created_at", _TS), ("updated_at", _TS))
_LONG_SPAN_METRICS = (
    *((c, _DBL) for c in VOLUMES),
    ("taux_recyclage", _DBL),
    ("taux_desinfection_avg", _DBL),
    ("taux_desinfection_med", _DBL),
    *((c, _INT) for c in ROLLUP_PRESSURES),
    ("temp_moy_c", _DBL),
    ("temp_med_c", _DBL),
    ("chlore_moy_mg_l", _DBL),
    ("chlore_med_mg_l", _DBL),
    ("ph_moyen", _DBL),
    ("ph_med", _DBL),
    ("conso_kwh", _DBL),
)

DAILY_ROLLUP = _struct(
    ("jour", _DATE),
    (STATION, _STR),
    *((c, _DBL) for c in VOLUMES),
    ("taux_recyclage", _DBL),
    ("taux_desinfection", _DBL),
    *((c, _INT) for c in ROLLUP_PRESSURES),
    ("temp_moy_c", _DBL),
    ("chlore_moy_mg_l", _DBL),
    ("ph_moyen", _DBL),
    ("conso_kwh", _DBL),
    *_STAMPS,
)
WEEKLY_ROLLUP = _struct(("semaine_debut", _DATE), (STATION, _STR), *_LONG_SPAN_METRICS, *_STAMPS)
MONTHLY_ROLLUP = _struct(("mois_debut", _DATE), (STATION, _STR), *_LONG_SPAN_METRICS, *_STAMPS)

COUNTER_CACHE = _struct(
    (STATION, _STR),
    ("compteur_eau_renvoi_m3", _DBL),
    ("compteur_eau_adoucie_m3", _DBL),
    ("updated_at", _TS),
)

STATIONS = _struct(
    (STATION, _STR),
    ("numero_automate", _INT),
    ("client", _STR),
    ("lieu", _STR),
    ("email", _STR),
    ("email2", _STR),
    ("email3", _STR),
    ("organization_id", _INT),
)
ORGANIZATIONS = _struct(("id", _INT), ("name", _STR))
USERS = _struct(("id", _LONG), ("email", _STR), ("is_active", _BOOL), ("client_id", _STR))
ROLES = _struct(("id", _INT), ("name", _STR))
USER_ROLES = _struct(("user_id", _LONG), ("role_id", _INT))
ORGANIZATION_USERS = _struct(("user_id", _LONG), ("organization_id", _INT), ("org_role", _STR))
STATION_ACCESS = _struct(("automate_nom", _STR), ("user_id", _LONG))
MESSAGES = _struct(
    ("id", _LONG),
    ("conversation_id", _LONG),
    ("client_id", _STR),
    ("sender_id", _INT),
    ("content", _STR),
    ("file_url", _STR),
    ("created_at", _TS),
    ("is_read", _BOOL),
)
CONVERSATIONS = _struct(("id", _LONG), ("client_id", _STR), ("type", _STR), ("created_at", _TS))
INCIDENTS = _struct(
    ("id", _LONG),
    ("client", _STR),
    ("lieu", _STR),
    (STATION, _STR),
    ("panne", _STR),
    ("probleme", _STR),
    ("date_debut", _TS),
    ("date_fin", _TS),
    ("created_by", _STR),
)

TABLES: dict[str, T.StructType] = {
    "mesures": READINGS,
    "moyenne": PRESSURE_AVG,
    "mesures_aggregate": _struct((STATION, _STR)),
    "donnees_semaine": DAILY_ROLLUP,
    "donnees_mois": WEEKLY_ROLLUP,
    "donnees_annees": MONTHLY_ROLLUP,
    "cache_volumes_total": COUNTER_CACHE,
    "automate": STATIONS,
    "organizations": ORGANIZATIONS,
    "users": USERS,
    "roles": ROLES,
    "user_roles": USER_ROLES,
    "organization_users": ORGANIZATION_USERS,
    "automate_access": STATION_ACCESS,
    "messages": MESSAGES,
    "conversations": CONVERSATIONS,
    "pannes": INCIDENTS,
}
