"""Every operator as a runnable query over the test tables: ``name -> f(spark, sf_dir)``.

All queries read their tables whole. Batches of changes touch only some keys, as real batches do,
but the result is always the whole next state of the table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.numeric import round_half_up
from rivulet.functions.text import emails_csv, normalize_emails
from rivulet.functions.timegrain import GRAINS, buckets, grid, retention_cutoff
from rivulet.operators import access, changes, counters, entitlements, fill, fleet, hourly, incidents, latest, messages, rollup
from rivulet.operators import series, stations
from rivulet.functions.timegrain import PARIS, local_time
from rivulet.plans import jobs
from rivulet.plans.inputs import AS_OF, AS_OF_LONG, load_input
from rivulet.schemas import COUNTER_CACHE, ENERGY_COUNTER, INCIDENTS, PERCENT_COUNTERS, SEQ, STATION, TIME, VOLUMES, WATER_COUNTERS
from rivulet.sources.readings import (
    scan_pressure_avg,
    scan_readings,
    station_universe,
    with_day,
    write_bucketed,
    write_by_station,
)
from rivulet.sources.sinks import csv_columns, json_rows, write_csv_file
from rivulet.sources.tables import change_keyed, read_keyed, read_rollup, read_table, scratch_path, table_path, write_keyed

Query = Callable[[SparkSession, str], DataFrame]

EARLIER = AS_OF - timedelta(days=2)
EARLIER_LONG = datetime(2001, 6, 15)
NOW = "TIMESTAMP_NTZ '2024-01-31 00:00:00'"
BEFORE = "TIMESTAMP_NTZ '2024-01-29 00:00:00'"

_QUERIES: dict[str, Query] = {}


class Tables:
    """Lazy access to the derived inputs and the rollups computed from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load_input(self.spark, self.sf_dir, name)

    def folder(self) -> str:
        """A new folder for tables that a query keeps and reads again."""
        return scratch_path(self.spark)

    def rollup(self, grain: str, as_of: datetime | None = None) -> DataFrame:
        if grain == "daily":
            return rollup.rollup_daily(self.mesures, self.mesures_aggregate, as_of or AS_OF)
        if grain == "weekly":
            return rollup.rollup_weekly(self.mesures, self.mesures_aggregate, as_of or AS_OF)
        return rollup.rollup_monthly(self.mesures_longues, as_of or AS_OF_LONG)

    def cache(self, as_of: datetime = AS_OF) -> DataFrame:
        return latest.latest_counters(self.mesures, as_of)

    def stored_daily(self) -> DataFrame:
        """The daily table as an earlier run left it."""
        stamped = self.rollup("daily", EARLIER)
        return stamped.withColumn("created_at", F.expr(BEFORE)).withColumn("updated_at", F.expr(BEFORE))


def query(name: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _joined(df: DataFrame, **separators: str) -> DataFrame:
    """Array columns as text, so that results are flat."""
    for column, separator in separators.items():
        df = df.withColumn(column, F.array_join(column, separator))
    return df


# --- scans -------------------------------------------------------------------------------


@query("scan_readings")
def _(t: Tables) -> DataFrame:
    columns = ("user_id", "ts", "event_id", "value")
    return scan_readings(
        t.spark, f"{t.sf_dir}/events.parquet", AS_OF - timedelta(days=7), AS_OF, None, columns, "ts", "user_id"
    )


@query("scan_readings_of_stations")
def _(t: Tables) -> DataFrame:
    keys = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").where("c_mktsegment = 'BUILDING'")
    return scan_readings(
        t.spark,
        f"{t.sf_dir}/events.parquet",
        AS_OF - timedelta(days=7),
        AS_OF,
        keys.select(F.col("c_custkey").alias(STATION)),
        ("user_id", "ts", "event_id", "value"),
        "ts",
        "user_id",
    )


@query("station_universe")
def _(t: Tables) -> DataFrame:
    return station_universe(t.mesures_aggregate, t.mesures_longues)


@query("station_grid")
def _(t: Tables) -> DataFrame:
    return grid(station_universe(t.mesures_aggregate, t.mesures), AS_OF, "weekly")


# --- hourly series ------------------------------------------------------------------------

_HOURLY = {
    "hourly_wrap_delta_all": hourly.hourly_wrap_delta_all,
    "hourly_recycling_rate": hourly.hourly_recycling_rate,
    "hourly_disinfection_rate": hourly.hourly_disinfection_rate,
    "hourly_pressure_medians": hourly.hourly_pressure_medians,
    "hourly_temperature_median": hourly.hourly_temperature_median,
    "hourly_chlorine_median": hourly.hourly_chlorine_median,
    "hourly_ph_median": hourly.hourly_ph_median,
    "hourly_energy": hourly.hourly_energy,
    "hourly_energy_ratio": hourly.hourly_energy_ratio,
    "recycling_rate_24h": hourly.recycling_rate_24h,
}
for _name, _op in _HOURLY.items():
    query(_name)(lambda t, op=_op: op(t.mesures, AS_OF))

for _column in PERCENT_COUNTERS:
    query("hourly_wrap_delta_" + _column.split("_")[3])(
        lambda t, c=_column: hourly.hourly_wrap_delta(t.mesures, AS_OF, c)
    )


@query("hour_of_day_mean")
def _(t: Tables) -> DataFrame:
    return hourly.hour_of_day_mean(t.moyenne, AS_OF)


@query("hourly_energy_month")
def _(t: Tables) -> DataFrame:
    """The hourly operator over the whole month of readings, in Paris hours."""
    return hourly.hourly_energy(t.mesures, AS_OF, hours=24 * 31, tz="Europe/Paris")


@query("hourly_energy_autumn")
def _(t: Tables) -> DataFrame:
    """Readings moved to the weekend on which clocks go back: one label stands for two hours."""
    moved = t.mesures.withColumn("horodatage", F.expr("horodatage + INTERVAL 271 DAYS"))
    return hourly.hourly_energy(moved, AS_OF + timedelta(days=271), hours=48, tz="Europe/Paris")


# --- latest values ------------------------------------------------------------------------

for _kind, _column in (
    ("relevage", "compteur_eau_inst_relevage_pc"),
    ("renvoi", "compteur_eau_inst_renvoi_pc"),
    ("adoucie", "compteur_eau_inst_adoucie_pc"),
):
    query(f"latest_tank_{_kind}")(lambda t, c=_column: latest.latest_value(t.mesures, c))

for _kind in ("traitement", "disconnection"):
    query(f"latest_height_{_kind}")(
        lambda t, k=_kind: latest.latest_clamped(t.mesures, f"hauteur_cuve_{k}_pc")
    )


@query("latest_volume_renvoi")
def _(t: Tables) -> DataFrame:
    return latest.latest_value(t.mesures, "compteur_eau_renvoi_m3")


@query("latest_energy_positive")
def _(t: Tables) -> DataFrame:
    return latest.latest_positive(t.mesures)


@query("latest_counters")
def _(t: Tables) -> DataFrame:
    return t.cache()


@query("refresh_latest_counters")
def _(t: Tables) -> DataFrame:
    """Cache left by an earlier run over the long history, refreshed from the recent readings."""
    cache = latest.latest_counters(t.mesures_longues, EARLIER_LONG)
    return changes.upsert(cache, t.cache(), [STATION], F.expr(NOW))


# --- rollups ------------------------------------------------------------------------------

for _grain in GRAINS:
    query(f"rollup_{_grain}")(lambda t, g=_grain: t.rollup(g))


@query("rollup_weekly_lookback")
def _(t: Tables) -> DataFrame:
    return rollup.rollup_weekly(t.mesures, t.mesures_aggregate, AS_OF, lookback_buckets=1)


@query("rollup_daily_lookback")
def _(t: Tables) -> DataFrame:
    return rollup.rollup_daily(t.mesures, t.mesures_aggregate, AS_OF, lookback_buckets=1)


@query("counter_delta_sum_daily")
def _(t: Tables) -> DataFrame:
    named = {**dict(zip(WATER_COUNTERS, VOLUMES)), ENERGY_COUNTER: "conso_kwh"}
    return counters.counter_delta_sum(t.mesures, named, F.col(counters.TRANCHE).cast("date").alias("jour"))


@query("counter_max_delta_monthly")
def _(t: Tables) -> DataFrame:
    named = {**dict(zip(WATER_COUNTERS, VOLUMES)), ENERGY_COUNTER: "conso_kwh"}
    return counters.counter_max_delta(t.mesures_longues, "mois_debut", F.trunc("horodatage", "month"), named)


# --- rollup reads -------------------------------------------------------------------------

_SERIES = {
    "renvoi_series": series.renvoi_series,
    "adoucie_series": series.adoucie_series,
    "relevage_series": series.relevage_series,
    "pressure5_series": series.pressure5_series,
    "disinfection_series": series.disinfection_series,
    "energy_series": series.energy_series,
    "pressure_series": series.pressure_series,
    "volume_series": series.volume_series,
    "rate_from_volumes": series.rate_from_volumes,
    "ratio_from_rollup": series.ratio_from_rollup,
    "temperature_series": series.temperature_series,
    "chlorine_series": series.chlorine_series,
    "ph_series": series.ph_series,
}
for _name, _op in _SERIES.items():
    for _grain in GRAINS:
        query(f"{_name}_{_grain}")(lambda t, op=_op, g=_grain: op(t.rollup(g), g))


@query("pack_series")
def _(t: Tables) -> DataFrame:
    packed = series.pack_series(series.volume_series(t.rollup("daily"), "daily"), "bucket", "label", VOLUMES)
    return _joined(packed, labels="|", **{v: "|" for v in VOLUMES})


@query("pack_series_hourly")
def _(t: Tables) -> DataFrame:
    hours = hourly.hourly_energy(t.mesures, AS_OF).withColumn("label", F.date_format("heure", "HH:mm"))
    return _joined(series.pack_series(hours, "heure", "label", ["conso_kwh"]), labels="|", conso_kwh="|")


@query("series_json")
def _(t: Tables) -> DataFrame:
    picked = series.pressure_series(t.rollup("weekly"), "weekly").select(
        STATION, "label", *[F.col(f"p{i}_med_mbar").cast("int").alias(f"p{i}_med_mbar") for i in range(1, 6)]
    )
    return json_rows(picked)


@query("interval_consumption")
def _(t: Tables) -> DataFrame:
    named = {"compteur_eau_renvoi_m3": "m"}
    daily = t.mesures.groupBy(STATION, F.to_date("horodatage").alias("jour")).agg(
        *[F.max(c).alias(n) for c, n in named.items()]
    )
    steps = counters.interval_consumption(daily, "jour", "m")
    return steps.withColumn("consommation", round_half_up(F.col("consommation"), 3))


# --- fills, fleet total, export -----------------------------------------------------------


def _with_zero_runs(t: Tables) -> DataFrame:
    """Monthly rates in which some months read 0 or null."""
    month = F.month("mois_debut")
    number = F.regexp_extract(STATION, "([0-9]+)", 1).cast("int")
    rate = (
        F.when((number % 4 == 0) & (month <= 4), F.lit(0.0))
        .when((number % 4 == 1) & month.isin(5, 7), F.lit(0.0))
        .when((number % 4 == 2) & (month == 4), F.lit(None))
        .when((number % 4 == 2) & month.isin(3, 5, 6), F.lit(0.0))
        .when(number == 3, F.lit(0.0))
        .otherwise(F.col("taux_recyclage"))
    )
    return t.rollup("monthly").withColumn("taux_recyclage", rate)


@query("ffill_zero")
def _(t: Tables) -> DataFrame:
    rates = _with_zero_runs(t).select("mois_debut", STATION, "taux_recyclage")
    return fill.ffill_zero(rates, "taux_recyclage", "mois_debut")


@query("bfill_leading_zero")
def _(t: Tables) -> DataFrame:
    rates = _with_zero_runs(t).select("mois_debut", STATION, "taux_recyclage")
    return fill.bfill_leading_zero(rates, "taux_recyclage", "mois_debut")


@query("export_rollup")
def _(t: Tables) -> DataFrame:
    columns = ["taux_recyclage", "conso_kwh", "not_a_column", "ph_med"]
    return fleet.export_rollup(_with_zero_runs(t), "monthly", columns, None, date(2001, 3, 1), date(2001, 7, 1))


@query("export_csv_rows")
def _(t: Tables) -> DataFrame:
    columns = ["vol_renvoi_m3", "taux_recyclage", "temp_moy_c"]
    chosen = t.mesures.select(STATION).distinct()
    return csv_columns(fleet.export_rollup(t.rollup("daily"), "daily", columns, chosen))


@query("fleet_recycled_total")
def _(t: Tables) -> DataFrame:
    return fleet.fleet_recycled_total(t.cache(), t.automate)


@query("fleet_recycled_total_of_orgs")
def _(t: Tables) -> DataFrame:
    return fleet.fleet_recycled_total(latest.latest_counters(t.mesures_longues, AS_OF_LONG), t.automate, t.organizations)


# --- station registry ---------------------------------------------------------------------


@query("list_stations")
def _(t: Tables) -> DataFrame:
    return _joined(stations.list_stations(t.automate), emails=",")


@query("lookup_stations")
def _(t: Tables) -> DataFrame:
    return _joined(stations.lookup_station(t.automate), emails=",")


@query("distinct_clients")
def _(t: Tables) -> DataFrame:
    return stations.distinct_clients(t.automate)


@query("distinct_sites")
def _(t: Tables) -> DataFrame:
    return stations.distinct_sites(t.automate)


@query("resolve_station")
def _(t: Tables) -> DataFrame:
    return stations.resolve_station(t.automate, t.automate.select("client", "lieu").distinct())


@query("orphan_clients")
def _(t: Tables) -> DataFrame:
    return stations.orphan_clients(t.automate, t.organizations)


@query("org_stations")
def _(t: Tables) -> DataFrame:
    return _joined(stations.org_stations(t.automate, t.organizations), emails=",")


@query("normalize_emails")
def _(t: Tables) -> DataFrame:
    raw = F.concat(
        F.lit(" "), F.upper("email"), F.lit(" ;"), F.coalesce("email3", F.lit("")), F.lit(",, "), F.col("email"),
        F.lit(";"), F.coalesce("email2", F.lit("x@y.example")),
    )
    cleaned = t.automate.select(STATION, normalize_emails(raw).alias("liste"))
    return cleaned.select(STATION, F.size("liste").alias("n"), emails_csv(F.col("liste")).alias("csv"))


@query("add_stations")
def _(t: Tables) -> DataFrame:
    new = t.users.select(
        F.concat(F.lit("ST"), F.col("id").cast("string")).alias(STATION),
        F.col("client_id").alias("client"),
        F.lit("nouveau").alias("lieu"),
        F.concat(F.lit("  "), F.upper("email")).alias("email"),
        F.lit("  ").alias("email2"),
    )
    return stations.add_stations(t.automate, new)


@query("update_stations")
def _(t: Tables) -> DataFrame:
    number = F.col("numero_automate")
    edits = t.automate.where(number % 3 != 0).select(
        STATION,
        F.when(number % 2 == 0, F.lit("Nouveau client")).alias("client"),
        F.when(number % 5 == 0, F.lit(" ")).when(number % 7 == 0, F.lit(" New@Site.Example ")).alias("email"),
    )
    return stations.update_stations(t.automate, edits)


@query("remove_stations")
def _(t: Tables) -> DataFrame:
    return stations.remove_stations(t.automate, t.mesures)


# --- entitlements -------------------------------------------------------------------------


@query("user_roles")
def _(t: Tables) -> DataFrame:
    return entitlements.user_roles(t.user_roles, t.roles)


@query("user_orgs")
def _(t: Tables) -> DataFrame:
    return entitlements.user_orgs(t.organization_users, t.organizations)


def _scope(t: Tables, view_as: bool = False) -> DataFrame:
    return entitlements.station_scope(t.user_roles, t.roles, t.organization_users, t.organizations, view_as)


@query("station_scope")
def _(t: Tables) -> DataFrame:
    return _scope(t)


@query("visible_stations_member")
def _(t: Tables) -> DataFrame:
    return _joined(entitlements.visible_stations(t.automate, _scope(t), 3), emails=",")


@query("visible_stations_admin")
def _(t: Tables) -> DataFrame:
    return _joined(entitlements.visible_stations(t.automate, _scope(t), 50), emails=",")


@query("visible_stations_view_as")
def _(t: Tables) -> DataFrame:
    return _joined(entitlements.visible_stations(t.automate, _scope(t, view_as=True), 150), emails=",")


@query("visible_station_counts")
def _(t: Tables) -> DataFrame:
    return entitlements.visible_station_counts(t.automate, _scope(t))


@query("user_directory")
def _(t: Tables) -> DataFrame:
    listed = entitlements.user_directory(t.users, t.user_roles, t.roles, t.organization_users, t.organizations)
    pairs = F.transform("organizations", lambda o: F.concat_ws(":", o["org_name"], o["org_role"]))
    return _joined(listed.withColumn("organizations", pairs), roles=",", organizations="|")


@query("users_with_role")
def _(t: Tables) -> DataFrame:
    return entitlements.users_with_role(t.users, t.user_roles, t.roles, "admin")


@query("client_accounts")
def _(t: Tables) -> DataFrame:
    return entitlements.client_accounts(t.users)


@query("account_clients")
def _(t: Tables) -> DataFrame:
    return entitlements.account_clients(t.users)


@query("org_members")
def _(t: Tables) -> DataFrame:
    return entitlements.org_members(t.users, t.organization_users)


@query("org_members_by_role")
def _(t: Tables) -> DataFrame:
    return entitlements.org_members(t.users, t.organization_users, by_role=True)


@query("admin_orgs")
def _(t: Tables) -> DataFrame:
    return entitlements.admin_orgs(t.organization_users, t.organizations)


@query("first_admin_org")
def _(t: Tables) -> DataFrame:
    return entitlements.first_admin_org(t.organization_users, t.organizations)


@query("station_users")
def _(t: Tables) -> DataFrame:
    return entitlements.station_users(t.automate_access, t.users)


@query("member_stations")
def _(t: Tables) -> DataFrame:
    return entitlements.member_stations(t.automate_access, t.organization_users)


@query("invalid_grants")
def _(t: Tables) -> DataFrame:
    """Grants for stations that belong to no organization."""
    requested = t.automate_access.select(F.col("automate_nom").alias(STATION), "user_id")
    return entitlements.invalid_grants(requested, stations.org_stations(t.automate, t.organizations), STATION)


@query("unknown_accounts")
def _(t: Tables) -> DataFrame:
    """Registered contact addresses without a user account."""
    requested = t.automate.select(F.regexp_replace("email", "supplier#", "customer#").alias("email"))
    requested = requested.select(F.regexp_replace("email", "site", "user").alias("email"))
    return entitlements.invalid_grants(requested, t.users.where("is_active"), "email")


@query("fallback_org")
def _(t: Tables) -> DataFrame:
    removed = t.organization_users.where(F.col("user_id") % 9 == 0).groupBy("user_id").agg(
        F.min("organization_id").alias("organization_id")
    )
    return entitlements.fallback_org(removed, t.organization_users, t.organizations)


@query("list_roles")
def _(t: Tables) -> DataFrame:
    return entitlements.list_roles(t.roles)


@query("list_orgs")
def _(t: Tables) -> DataFrame:
    return entitlements.list_orgs(t.organizations)


# --- incidents and messages ---------------------------------------------------------------


@query("incident_types")
def _(t: Tables) -> DataFrame:
    return incidents.incident_types(t.pannes)


@query("list_incidents")
def _(t: Tables) -> DataFrame:
    return incidents.list_incidents(t.pannes)


@query("check_incidents")
def _(t: Tables) -> DataFrame:
    number, day = F.col("numero_automate"), F.expr(BEFORE)
    new = t.automate.select(
        F.when(number % 10 == 0, F.lit("inconnu")).otherwise(F.col("client")).alias("client"),
        "lieu",
        F.when(number % 10 == 1, F.lit("ST-autre")).otherwise(F.col(STATION)).alias(STATION),
        F.when(number % 10 == 2, F.lit("")).otherwise(F.lit("Fuite cuve")).alias("panne"),
        F.lit("signalé").alias("probleme"),
        day.alias("date_debut"),
        F.when(number % 10 == 3, day - F.expr("INTERVAL 1 DAY")).alias("date_fin"),
    )
    checked = incidents.check_incidents(new, t.automate)
    return checked.select(STATION, "client", "lieu", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query("message_thread")
def _(t: Tables) -> DataFrame:
    return messages.message_thread(t.messages, "client_id")


@query("message_thread_by_conversation")
def _(t: Tables) -> DataFrame:
    return messages.message_thread(t.messages, "conversation_id")


@query("unread_count_client_side")
def _(t: Tables) -> DataFrame:
    return messages.unread_count(t.messages, "4", messages.ADMIN_SENDERS)


@query("unread_count_admin_side")
def _(t: Tables) -> DataFrame:
    return messages.unread_count(t.messages, "4", messages.CLIENT_SENDERS)


@query("unread_by_client")
def _(t: Tables) -> DataFrame:
    return messages.unread_by_client(t.messages)


@query("list_conversations")
def _(t: Tables) -> DataFrame:
    return messages.list_conversations(t.fils)


@query("missing_conversations")
def _(t: Tables) -> DataFrame:
    clients = t.automate.select(F.col("numero_automate").cast("string").alias("client_id"))
    clients = clients.unionByName(t.messages.select("client_id"))
    return messages.missing_conversations(clients, t.fils)


# --- table changes ------------------------------------------------------------------------


@query("insert_absent")
def _(t: Tables) -> DataFrame:
    return changes.insert_absent(t.automate_access, t.acces_demandes, ["automate_nom", "user_id"])


@query("upsert_daily")
def _(t: Tables) -> DataFrame:
    return changes.upsert(t.stored_daily(), t.rollup("daily"), ["jour", STATION], F.expr(NOW), unique=True)


@query("replace_window_monthly")
def _(t: Tables) -> DataFrame:
    days = [b.day for b in buckets(AS_OF_LONG, "monthly")]
    return changes.replace_window(t.rollup("monthly", EARLIER_LONG), t.rollup("monthly"), "mois_debut", days)


@query("retain_from")
def _(t: Tables) -> DataFrame:
    return changes.retain_from(t.rollup("daily", EARLIER), "jour", retention_cutoff(AS_OF, "daily"))


@query("rebuild_daily")
def _(t: Tables) -> DataFrame:
    return changes.rebuild(t.stored_daily(), t.rollup("daily")).drop("created_at", "updated_at")


@query("delete_keys")
def _(t: Tables) -> DataFrame:
    return changes.delete_keys(t.pannes, t.pannes.where("date_fin is null").select("id"))


@query("delete_bucket")
def _(t: Tables) -> DataFrame:
    return changes.delete_bucket(t.rollup("daily"), "jour", date(2024, 1, 30))


@query("full_update")
def _(t: Tables) -> DataFrame:
    edits = t.pannes.where(F.col("id") % 2 == 0).select(
        "id", F.lit("Fuite cuve").alias("panne"), F.lit(None).cast("timestamp_ntz").alias("date_fin")
    )
    return changes.full_update(t.pannes, edits, ["id"])


@query("mark_read")
def _(t: Tables) -> DataFrame:
    clients = t.messages.where(F.length("client_id") == 1).select("client_id")
    return changes.mark_read(t.messages, clients, messages.ADMIN_SENDERS).select("id", "client_id", "is_read")


@query("demote_other_admins")
def _(t: Tables) -> DataFrame:
    appointed = t.organization_users.groupBy("organization_id").agg(F.min("user_id").alias("user_id"))
    return changes.demote_other_admins(t.organization_users, appointed)


@query("link_stations")
def _(t: Tables) -> DataFrame:
    return changes.link_stations(t.automate, t.organizations)


@query("set_client")
def _(t: Tables) -> DataFrame:
    assignments = t.organization_users.groupBy("user_id").agg(F.min("organization_id").cast("string").alias("client_id"))
    return changes.set_client(t.users, assignments)


@query("replace_set_orgs")
def _(t: Tables) -> DataFrame:
    """Every third user moves to two organizations; roles already held there are kept."""
    owners = t.users.where(F.col("id") % 3 == 0).select(F.col("id").alias("user_id"))
    wanted = owners.withColumn("organization_id", (F.col("user_id") % 25).cast("int")).unionByName(
        owners.withColumn("organization_id", ((F.col("user_id") + 1) % 25).cast("int"))
    )
    return changes.replace_set(
        t.organization_users, owners, wanted, "user_id", "organization_id", {"org_role": "employee"}
    )


@query("replace_set_scoped")
def _(t: Tables) -> DataFrame:
    """Grants of even users are renewed, some with station 1 besides, but only for stations linked to an organization."""
    owners = t.users.where(F.col("id") % 2 == 0).select(F.col("id").alias("user_id"))
    scope = t.automate.where("organization_id is not null").select(F.col(STATION).alias("automate_nom"))
    wanted = t.automate_access.where(F.col("user_id") % 4 == 0).join(scope, "automate_nom", "left_semi")
    wanted = wanted.unionByName(owners.where(F.col("user_id") % 4 == 0).withColumn("automate_nom", F.lit("ST1")))
    return changes.replace_set(t.automate_access, owners, wanted, "user_id", "automate_nom", scope=scope)


@query("append_rows")
def _(t: Tables) -> DataFrame:
    """Support conversations created for clients without one: all rows, whether above the old ids, and how many bear their id."""
    clients = t.automate.select(F.col("numero_automate").cast("string").alias("client_id"))
    missing = messages.missing_conversations(clients, t.fils)
    rows = changes.append_rows(t.fils, missing.withColumn("created_at", F.expr(NOW)))
    bearers = rows.groupBy("id").agg(F.count("*").alias("porteurs"))
    old = t.fils.agg(F.max("id")).scalar()
    return rows.join(bearers, "id").select("client_id", "type", "created_at", (F.col("id") > old).alias("nouveau"), "porteurs")


@query("append_rows_dense")
def _(t: Tables) -> DataFrame:
    """Every event becomes a notice among the messages, many of them alike; ids follow the greatest old one without gaps."""
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    notices = events.select(F.col("event_type").alias("content"), (F.col("user_id") % 8).cast("string").alias("client_id"))
    return changes.append_rows_dense(t.messages, notices)


# --- access changes -----------------------------------------------------------------------


def _assigned(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users of two residue classes get new roles, and organizations by list or by single client."""
    user, nation = F.col("id"), F.concat(F.lit("nation_"), (F.col("id") % 25).cast("string"))
    neighbour = F.concat(F.lit(" nation_"), ((user + 1) % 25).cast("string"), F.lit(" "))
    requests = t.users.where(user % 3 != 2).select(
        user.alias("user_id"),
        F.when(user % 2 == 0, F.array(F.lit(" Admin"), F.lit("client"))).otherwise(F.array(F.lit("client"), F.lit("?"))).alias("roles"),
        F.when(user % 2 == 0, nation).alias("client_id"),
        F.when(user % 3 == 0, F.array(nation, neighbour, F.lit("missing"))).alias("organization_names"),
    )
    return access.assign_access(t.users, t.organization_users, t.user_roles, t.organizations, t.roles, requests)


@query("assign_access_users")
def _(t: Tables) -> DataFrame:
    return _assigned(t)[0]


@query("assign_access_members")
def _(t: Tables) -> DataFrame:
    return _assigned(t)[1]


@query("assign_access_roles")
def _(t: Tables) -> DataFrame:
    return _assigned(t)[2]


@query("create_organizations")
def _(t: Tables) -> DataFrame:
    """Memberships by organization name after some accounts found, or take over, an organization."""
    user = F.col("id")
    name = F.when(user % 4 == 0, F.concat(F.lit("nation_"), (user % 25).cast("string"))).otherwise(
        F.concat(F.lit(" ville_"), user.cast("string"))
    )
    requests = t.users.where(user % 10 == 0).select(name.alias("name"), F.upper("email").alias("admin_email"))
    orgs, members, _, _ = access.create_organizations(t.organizations, t.organization_users, t.users, t.automate, requests)
    return entitlements.user_orgs(members, orgs).select("user_id", "name", "org_role")


@query("add_members")
def _(t: Tables) -> DataFrame:
    """Every organization gets a new administrator and some employees."""
    user, org = F.col("id"), (F.col("id") % 25).cast("int")
    requests = t.users.where(user % 2 == 1).select(
        org.alias("organization_id"),
        F.concat(F.lit(" "), F.upper("email")).alias("email"),
        F.when(user < 50, F.lit("Org_Admin")).when(user % 7 == 0, F.lit("chief")).otherwise(F.lit("employee")).alias("org_role"),
    )
    return access.add_members(t.organization_users, t.users, t.organizations, requests)[0]


@query("add_members_users")
def _(t: Tables) -> DataFrame:
    """A user added to two organizations at once stays one row, with the greater name as client."""
    user = F.col("id")
    email = F.concat(F.lit("\t"), F.col("email"), F.lit("\n"))
    first = t.users.select((user % 25).cast("int").alias("organization_id"), email.alias("email"), F.lit("employee").alias("org_role"))
    second = t.users.select(((user + 3) % 25).cast("int").alias("organization_id"), email.alias("email"), F.lit("employee").alias("org_role"))
    return access.add_members(t.organization_users, t.users, t.organizations, first.unionByName(second))[1]


def _removed(t: Tables) -> tuple[DataFrame, DataFrame]:
    removed = t.organization_users.where((F.col("user_id") + F.col("organization_id")) % 5 == 0)
    return access.remove_members(t.organization_users, t.users, t.organizations, removed)


@query("remove_members")
def _(t: Tables) -> DataFrame:
    return _removed(t)[1]


@query("remove_members_left")
def _(t: Tables) -> DataFrame:
    return _removed(t)[0]


def _station_access(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Every registered station is granted to two accounts, one of which may not exist."""
    number = F.col("numero_automate") - 100

    def address(n):
        return F.concat(F.lit("Customer#"), F.lpad(n.cast("string"), 9, "0"), F.lit("@user.example "))

    second = F.when(number % 5 == 0, F.lit("nobody@user.example")).otherwise(address(number + 1))
    requests = t.automate.select(F.col(STATION).alias("automate_nom"), F.array(address(number), second).alias("emails"))
    return access.set_station_access(t.automate_access, t.users, requests)


@query("set_station_access")
def _(t: Tables) -> DataFrame:
    return _station_access(t)[0]


@query("set_station_access_unknown")
def _(t: Tables) -> DataFrame:
    return _station_access(t)[1]


def _member_access(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Members of one organization renew their grants; a third of them name a foreign station."""
    own = F.array(F.lit("ST1"), F.when(F.col("user_id") % 3 == 0, F.lit("elsewhere")).otherwise(F.lit("ST1")))
    requests = t.organization_users.where("organization_id = 1").select("user_id", own.alias("automate_noms"))
    return access.set_member_access(t.automate_access, t.organization_users, t.organizations, t.automate, requests, 1)


@query("set_member_access")
def _(t: Tables) -> DataFrame:
    return _member_access(t)[0]


@query("set_member_access_foreign")
def _(t: Tables) -> DataFrame:
    return _member_access(t)[1]


@query("lookup_station_one")
def _(t: Tables) -> DataFrame:
    return stations.lookup_station(t.automate, "ST3").withColumn("emails", F.array_join("emails", ","))


# --- stored tables ------------------------------------------------------------------------


def _utc(df: DataFrame, *columns: str) -> DataFrame:
    """Stored instants as UTC wall clock, whatever the session zone."""
    return df.withColumns({c: local_time(df, c) for c in columns})


@query("hour_of_day_mean_stored")
def _(t: Tables) -> DataFrame:
    """The averaged-pressure table read from Parquet, restricted by time in the scan."""
    path = table_path(t.folder(), "moyenne")
    t.moyenne.write.parquet(path)
    return hourly.hour_of_day_mean(scan_pressure_avg(t.spark, path, AS_OF - timedelta(hours=24)), AS_OF)


@query("run_rollup_daily")
def _(t: Tables) -> DataFrame:
    """The daily job run twice, two days apart: tables created, buckets merged, old ones purged."""
    base = t.folder()
    for moment in (EARLIER, AS_OF):
        jobs.run_rollup(t.spark, "daily", t.mesures, t.mesures_aggregate, base, moment)
    return _utc(read_rollup(t.spark, base, "daily"), "created_at", "updated_at")


@query("run_rollup_weekly")
def _(t: Tables) -> DataFrame:
    base = t.folder()
    jobs.run_rollup(t.spark, "weekly", t.mesures, t.mesures_aggregate, base, AS_OF)
    return _utc(read_rollup(t.spark, base, "weekly"), "created_at", "updated_at")


@query("run_rollup_monthly")
def _(t: Tables) -> DataFrame:
    """The monthly job run twice, two months apart: the second run replaces its window, older months stay."""
    base = t.folder()
    for moment in (EARLIER_LONG, AS_OF_LONG):
        jobs.run_rollup(t.spark, "monthly", t.mesures_longues, None, base, moment)
    return _utc(read_rollup(t.spark, base, "monthly"), "created_at", "updated_at")


@query("read_dimension")
def _(t: Tables) -> DataFrame:
    base = t.folder()
    t.automate.write.parquet(table_path(base, "automate"))
    return read_table(t.spark, base, "automate")


@query("run_latest_counters")
def _(t: Tables) -> DataFrame:
    """The cache job over the long history, then over the recent readings: only folders of their stations are rewritten."""
    base = t.folder()
    jobs.refresh_latest_counters(t.spark, t.mesures_longues, base, EARLIER_LONG)
    path = jobs.refresh_latest_counters(t.spark, t.mesures, base, AS_OF)
    return _utc(read_keyed(t.spark, path, COUNTER_CACHE), "updated_at")


def _late(readings: DataFrame) -> DataFrame:
    """Readings that reach the table after the others of their time: single ones, and the last day whole."""
    return readings.where((F.col(SEQ) % 97 == 0) | (F.col(TIME) >= F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00'")))


@query("rollup_daily_from_slices")
def _(t: Tables) -> DataFrame:
    """Stored slices of the days before, brought up to date with a new day and late readings; no older reading is read again."""
    base = t.folder()
    early = t.mesures.join(_late(t.mesures).select(SEQ), SEQ, "left_anti")
    jobs.refresh_summaries(t.spark, early, early, base)
    jobs.refresh_summaries(t.spark, t.mesures, _late(t.mesures), base)
    universe = station_universe(t.mesures_aggregate, t.mesures)
    return rollup.daily_of_summaries(jobs.read_summaries(t.spark, base), universe, AS_OF)


@query("rollup_weekly_from_states")
def _(t: Tables) -> DataFrame:
    base = t.folder()
    early = t.mesures.join(_late(t.mesures).select(SEQ), SEQ, "left_anti")
    jobs.refresh_states(t.spark, early, early, base)
    jobs.refresh_states(t.spark, t.mesures, _late(t.mesures), base)
    universe = station_universe(t.mesures_aggregate, t.mesures)
    return rollup.rollup_of_states(jobs.read_states(t.spark, base), "weekly", AS_OF, PARIS, universe)


@query("rollup_monthly_from_states")
def _(t: Tables) -> DataFrame:
    base = t.folder()
    jobs.refresh_states(t.spark, t.mesures_longues, t.mesures_longues, base)
    return rollup.rollup_of_states(jobs.read_states(t.spark, base), "monthly", AS_OF_LONG)


@query("known_stations")
def _(t: Tables) -> DataFrame:
    """The kept station list after a run over the first half of the month and one that reads on from there."""
    base = t.folder()
    first = t.mesures.where(F.col(TIME) < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'"))
    jobs.refresh_stations(t.spark, first.where(F.col(STATION) != "ST1"), base)
    return jobs.refresh_stations(t.spark, t.mesures, base)


@query("full_update_keyed")
def _(t: Tables) -> DataFrame:
    """A table laid out by a hash of its key, of which a change of few keys rewrites only their folders."""
    path = table_path(t.folder(), "pannes")
    write_keyed(t.pannes, path, ["id"], 32)
    edits = t.pannes.where(F.col("id") % 500 == 0).select("id", F.lit("Fuite cuve").alias("panne"), F.lit(None).cast("timestamp_ntz").alias("date_fin"))
    schema = t.pannes.schema
    change_keyed(t.spark, path, schema, edits, lambda target, new: changes.full_update(target, new, ["id"]))
    return read_keyed(t.spark, path, schema)


@query("replace_set_keyed")
def _(t: Tables) -> DataFrame:
    """The grants of a few users replaced in a table laid out by user."""
    path = table_path(t.folder(), "automate_access")
    write_keyed(t.automate_access, path, ["user_id"], 32)
    wanted = t.users.where(F.col("id") % 50 == 0).select(F.col("id").alias("user_id"), F.lit("ST1").alias("automate_nom"))

    def change(target: DataFrame, new: DataFrame) -> DataFrame:
        return changes.replace_set(target, new, new, "user_id", "automate_nom")

    change_keyed(t.spark, path, t.automate_access.schema, wanted, change)
    return read_keyed(t.spark, path, t.automate_access.schema)


@query("scan_day_partitions")
def _(t: Tables) -> DataFrame:
    """Readings in folders by day; only the folders of the last week are opened."""
    path = table_path(t.folder(), "mesures")
    with_day(t.mesures).write.partitionBy("jour").parquet(path)
    columns = (STATION, TIME, SEQ, ENERGY_COUNTER)
    return scan_readings(t.spark, path, AS_OF - timedelta(days=7), AS_OF, None, columns, date_partition="jour")


@query("scan_readings_of_client")
def _(t: Tables) -> DataFrame:
    """Readings in folders by groups of stations; those of a client's stations are found while the query runs."""
    path = table_path(t.folder(), "mesures")
    write_by_station(t.mesures_longues, path, 16)
    wanted = t.automate.where("client = 'ASIA'").select(STATION)
    return scan_readings(t.spark, path, None, None, wanted, (STATION, TIME, SEQ, ENERGY_COUNTER), station_groups=16)


def _bucketed(t: Tables, by: tuple[str, ...]) -> DataFrame:
    path = t.folder()
    return write_bucketed(with_day(t.mesures), f"mesures_{path[-12:]}", path, 16, by)


@query("hourly_energy_bucketed")
def _(t: Tables) -> DataFrame:
    """The hourly operator on readings in buckets by station: no shuffle of readings."""
    return hourly.hourly_energy(_bucketed(t, (STATION,)), AS_OF)


@query("rollup_daily_bucketed")
def _(t: Tables) -> DataFrame:
    """The daily rollup on readings in buckets by station and day, which spreads a busy station."""
    universe = station_universe(t.mesures_aggregate, t.mesures)
    return rollup.rollup_daily(_bucketed(t, (STATION, "jour")), None, AS_OF, stations=universe)


@query("export_file")
def _(t: Tables) -> DataFrame:
    """The export as one ordered CSV file, read back line by line."""
    path = f"{t.folder()}/export.csv"
    exported = fleet.export_rollup(t.rollup("daily"), "daily", ["vol_renvoi_m3", "p1_mbar", "ph_moyen"], t.mesures.select(STATION).distinct())
    write_csv_file(exported, path, ["date", STATION], parts=4)
    return t.spark.read.option("lineSep", "\r\n").text(path)


# --- visibility of all users, logs, single keys --------------------------------------------


@query("interned_users")
def _(t: Tables) -> DataFrame:
    return entitlements.interned_scopes(_scope(t))[0]


@query("interned_set_stations")
def _(t: Tables) -> DataFrame:
    return entitlements.stations_of_sets(t.automate, entitlements.interned_scopes(_scope(t))[1])


def _reports(t: Tables) -> DataFrame:
    """A report of every registered station, some of them with a mistake."""
    number, day = F.col("numero_automate"), F.expr(BEFORE)
    return t.automate.select(
        number.cast("long").alias("id"),
        F.when(number % 10 == 0, F.lit("inconnu")).otherwise(F.col("client")).alias("client"),
        "lieu",
        STATION,
        F.when(number % 10 == 2, F.lit("")).otherwise(F.lit("Fuite cuve")).alias("panne"),
        F.concat(F.lit("signalé "), number.cast("string")).alias("probleme"),
        day.alias("date_debut"),
        F.when(number % 10 == 3, day - F.expr("INTERVAL 1 DAY")).alias("date_fin"),
    )


@query("record_incidents")
def _(t: Tables) -> DataFrame:
    """The log with accepted reports appended; new rows by their place above the old ids instead of their generated id."""
    log, _ = incidents.record_incidents(t.pannes, _reports(t).drop("id"), t.automate, "chef@site.example")
    top = t.pannes.agg(F.max("id")).scalar()
    return log.withColumn("nouveau", F.col("id") > top).withColumn("id", F.when(~F.col("nouveau"), F.col("id")))


@query("amend_incidents")
def _(t: Tables) -> DataFrame:
    """Incidents whose id is a station number get that station's report."""
    return incidents.amend_incidents(t.pannes, _reports(t), t.automate)[0].select(*INCIDENTS.names)


@query("post_messages")
def _(t: Tables) -> DataFrame:
    new = t.users.select(F.col("client_id"), F.col("id").cast("int").alias("sender_id"), F.col("email").alias("content"))
    rows = messages.post_messages(t.messages, new, F.expr(NOW))
    top = t.messages.agg(F.max("id")).scalar()
    return rows.withColumn("id", F.when(F.col("id") <= top, F.col("id")))


@query("ensure_conversations")
def _(t: Tables) -> DataFrame:
    clients = t.automate.select("client").distinct().select(F.col("client").alias("client_id"))
    rows = messages.ensure_conversations(t.fils, clients, F.expr(NOW))
    top = t.fils.agg(F.max("id")).scalar()
    return rows.withColumn("id", F.when(F.col("id") <= top, F.col("id")))


def _founded(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Every station's client becomes an organization run by some user."""
    clients = t.automate.where("client is not null").groupBy(F.col("client").alias("name")).agg(F.min("numero_automate").alias("n"))
    users = t.users.select(F.col("id").cast("int").alias("n"), F.col("email").alias("admin_email"))
    requests = clients.join(users, "n").select("name", "admin_email")
    return access.create_organizations(t.organizations, t.organization_users, t.users, t.automate, requests)


@query("create_organizations_users")
def _(t: Tables) -> DataFrame:
    return _founded(t)[2]


@query("create_organizations_stations")
def _(t: Tables) -> DataFrame:
    """Which organization, by name, each station belongs to afterwards."""
    orgs, _, _, linked = _founded(t)
    names = orgs.select(F.col("id").alias("organization_id"), F.col("name").alias("organisation"))
    return linked.join(names, "organization_id", "left").select(STATION, "client", "organisation")


@query("org_members_of_one")
def _(t: Tables) -> DataFrame:
    return entitlements.org_members(t.users, t.organization_users, 3)


@query("message_thread_of_one")
def _(t: Tables) -> DataFrame:
    return messages.message_thread(t.messages, "conversation_id", 2)


@query("distinct_sites_of_one")
def _(t: Tables) -> DataFrame:
    return stations.distinct_sites(t.automate, "ASIA")
