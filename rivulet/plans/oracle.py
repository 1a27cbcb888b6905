"""Expected results as SQL over the test tables.

Written directly against the input definitions, one window per station and no slicing, so
that it checks the operators rather than repeating them.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from rivulet.operators.incidents import INCIDENT_TYPES
from rivulet.plans.inputs import AS_OF, AS_OF_LONG, INPUTS

EARLIER = AS_OF - timedelta(days=2)
EARLIER_LONG = datetime(2001, 6, 15)
VOLS = ("vol_renvoi_m3", "vol_adoucie_m3", "vol_relevage_m3")
COUNTERS = {
    "vol_renvoi_m3": "compteur_eau_renvoi_m3",
    "vol_adoucie_m3": "compteur_eau_adoucie_m3",
    "vol_relevage_m3": "compteur_eau_relevage_m3",
    "conso_kwh": "compteur_electrique_kwh",
}
# Paris wall clock; the readings fall in the winter of 2024 and in the years up to 2001.
PARIS = """(horodatage + case when horodatage >= timestamp '2001-03-25 01:00:00'
  and horodatage < timestamp '2001-10-28 01:00:00' then interval 2 hour else interval 1 hour end)"""

Cte = tuple[str, str]


def rnd(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {n}) as double)"


def whole(x: str) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), 0) as int)"


def mic(x: str) -> str:
    return f"cast(round({x} * 1000000) as bigint)"


def inputs(*names: str) -> list[Cte]:
    return [(n, INPUTS[n]) for n in names]


def sql(ctes: list[Cte], body: str) -> str:
    seen: dict[str, str] = {}
    for name, text in ctes:
        seen.setdefault(name, text)
    head = ",\n".join(f"{n} as ({t.strip()})" for n, t in seen.items())
    return f"with {head}\n{body.strip()}" if seen else body.strip()


def ts(moment: datetime) -> str:
    return f"timestamp '{moment:%Y-%m-%d %H:%M:%S}'"


def day_window(hours: int = 24, closed: bool = True) -> str:
    start = f"horodatage >= {ts(AS_OF - timedelta(hours=hours))}"
    return f"{start} and horodatage < {ts(AS_OF)}" if closed else start


def rate(renvoi: str, adoucie: str) -> str:
    """Clamped rate of whole-number volumes."""
    ratio = f"(({renvoi}) - ({adoucie})) / nullif(cast(({renvoi}) as double), 0)"
    return f"coalesce(least(greatest({ratio}, 0.0), 1.0), 0.0)"


_UNITS = {
    "daily": ("jour", "day"),
    "weekly": ("semaine_debut", "week"),
    "monthly": ("mois_debut", "month"),
}


def rollup(grain: str, as_of: datetime | None = None, name: str | None = None, lookback: int | None = None) -> list[Cte]:
    """CTEs ending in the rollup table ``name`` (default: the grain)."""
    name = name or grain
    bucket, unit = _UNITS[grain]
    as_of = as_of or (AS_OF_LONG if grain == "monthly" else AS_OF)
    lookback = (1 if grain == "monthly" else 0) if lookback is None else lookback
    today = f"date_trunc('{unit}', {ts(as_of)})"
    first, last = {"daily": (7, 0), "weekly": (3, -1), "monthly": (5, -1)}[grain]
    source = "mesures_longues" if grain == "monthly" else "mesures"
    start = f"{today} - interval {first} {unit}"
    scan = f"{today} - interval {first + lookback} {unit}"
    stop = f"{today} - interval {last} {unit}" if last >= 0 else f"{today} + interval {-last} {unit}"
    micros = ", ".join(f"{mic(c)} as {v}_u" for v, c in COUNTERS.items())
    ctes = inputs(source)
    ctes.append(
        (
            f"{name}_base",
            f"select *, cast(date_trunc('{unit}', {PARIS}) as date) as {bucket}, {micros} from {source} "
            f"where {PARIS} >= {scan} and {PARIS} < {stop}",
        )
    )
    pressures = ", ".join(f"{whole(f'avg(pression{i}_mbar)')} as p{i}_mbar" for i in range(1, 6))
    if grain == "daily":
        steps = ", ".join(
            f"greatest({v}_u - lag({v}_u) over (partition by nom_automate order by horodatage, seq), 0) as {v}_d"
            for v in COUNTERS
        )
        ctes.append((f"{name}_steps", f"select *, {steps} from {name}_base"))
        sums = ", ".join(f"{rnd(f'sum({v}_d) / 1000000.0', 2)} as {v}" for v in COUNTERS)
        ctes.append(
            (
                f"{name}_seen",
                f"select nom_automate, {bucket}, {sums}, {rnd('avg(chlore_mv) / 3.0', 2)} as taux_desinfection, "
                f"{pressures}, {rnd('avg(temperature_deg) / 10.0', 1)} as temp_moy_c, "
                f"{rnd('avg(chlore_mv)', 2)} as chlore_moy_mg_l, {rnd('avg(ph) / 100.0', 2)} as ph_moyen "
                f"from {name}_steps group by 1, 2",
            )
        )
        columns = "taux_desinfection chlore_moy_mg_l conso_kwh".split()
        plain = [f"p{i}_mbar" for i in range(1, 6)] + ["temp_moy_c", "ph_moyen"]
        ratio = rate("cast(round(vol_renvoi_m3 * 100) as bigint)", "cast(round(vol_adoucie_m3 * 100) as bigint)")
    else:
        maxima = ", ".join(f"max({v}_u) as {v}_m" for v in COUNTERS)
        ctes.append(
            (
                f"{name}_peaks",
                f"select nom_automate, {bucket}, {maxima}, {rnd('avg(chlore_mv) / 3.0', 2)} as taux_desinfection_avg, "
                f"{rnd('quantile_cont(chlore_mv, 0.5) / 3.0', 2)} as taux_desinfection_med, {pressures}, "
                f"{rnd('avg(temperature_deg) / 10.0', 1)} as temp_moy_c, "
                f"{rnd('quantile_cont(temperature_deg, 0.5) / 10.0', 1)} as temp_med_c, "
                f"{rnd('avg(chlore_mv)', 2)} as chlore_moy_mg_l, "
                f"{rnd('quantile_cont(chlore_mv, 0.5)', 2)} as chlore_med_mg_l, "
                f"{rnd('avg(ph) / 100.0', 2)} as ph_moyen, {rnd('quantile_cont(ph, 0.5) / 100.0', 2)} as ph_med "
                f"from {name}_base group by 1, 2",
            )
        )
        steps = ", ".join(
            f"greatest({v}_m - lag({v}_m) over (partition by nom_automate order by {bucket}), 0) as {v}_d"
            for v in COUNTERS
        )
        volumes = ", ".join(f"{v}_d / 1000000.0 as {v}" for v in COUNTERS)
        ctes.append((f"{name}_steps", f"select *, {steps} from {name}_peaks"))
        ctes.append(
            (
                f"{name}_seen",
                f"select *, {volumes}, {rate('vol_renvoi_m3_d', 'vol_adoucie_m3_d')} as brut from {name}_steps "
                f"where {bucket} >= cast({start} as date)",
            )
        )
        columns = ["conso_kwh"]
        plain = ["taux_desinfection_avg", "taux_desinfection_med"] + [f"p{i}_mbar" for i in range(1, 6)]
        plain += "temp_moy_c temp_med_c chlore_moy_mg_l chlore_med_mg_l ph_moyen ph_med".split()
        ratio = "coalesce(brut, 0.0)"
    if grain == "monthly":
        listed = ", ".join([*VOLS, f"{ratio} as taux_recyclage", *plain, "conso_kwh"])
        return [*ctes, (name, f"select {bucket}, nom_automate, {listed} from {name}_seen")]
    ctes += inputs("mesures_aggregate")
    ctes.append(
        (
            f"{name}_grid",
            f"select nom_automate, cast(g as date) as {bucket} from (select nom_automate from mesures_aggregate union "
            f"select nom_automate from {source}) s, generate_series({start}, {stop} - interval 1 {unit}, "
            f"interval 1 {unit}) t(g)",
        )
    )
    floored = ", ".join(f"greatest({c}, 0.0) as {c}" for c in [*VOLS, *columns])
    body = (
        f"select {bucket}, nom_automate, {floored}, {ratio} as taux_recyclage, {', '.join(plain)} "
        f"from {name}_grid left join {name}_seen using (nom_automate, {bucket})"
    )
    return [*ctes, (name, body)]


def _hour_query(aggregate: str, where: str, ctes: list[Cte] | None = None) -> str:
    return sql(
        ctes or inputs("mesures"),
        f"select nom_automate, date_trunc('hour', horodatage) as heure, {aggregate} from mesures where {where} group by 1, 2",
    )


def _wrap(columns: dict[str, str]) -> str:
    means = ", ".join(f"{rnd(f'avg({c})', 1)} as {o}" for o, c in columns.items())
    w = "over (partition by nom_automate order by heure)"
    parts = [
        f"{rnd(f'(case when {o} >= lag({o}) {w} then {o} - lag({o}) {w} else {o} + 100 - lag({o}) {w} end) / 100', 3)} as {o}"
        for o in columns
    ]
    body = (
        f"select * exclude (rang) from (select nom_automate, heure, row_number() {w} as rang, {', '.join(parts)} "
        "from moyennes) where rang > 1"
    )
    means_sql = (
        f"select nom_automate, date_trunc('hour', horodatage) as heure, {means} from mesures "
        f"where {day_window()} group by 1, 2"
    )
    return sql([*inputs("mesures"), ("moyennes", means_sql)], body)


def _steps(counters: dict[str, str], where: str, hour: str = "horodatage") -> list[Cte]:
    w = "over (partition by nom_automate order by horodatage, seq)"
    parts = ", ".join(f"greatest({mic(c)} - lag({mic(c)}) {w}, 0) as {o}" for o, c in counters.items())
    text = f"select nom_automate, date_trunc('hour', {hour}) as heure, {parts} from mesures where {where}"
    return [*inputs("mesures"), ("pas", text)]


def _latest(value: str, where: str = "true", result: str | None = None) -> str:
    return sql(
        inputs("mesures"),
        f"select nom_automate, horodatage, cast({result or f'coalesce({value}, 0)'} as double) as valeur from mesures "
        f"where {where} qualify row_number() over (partition by nom_automate order by horodatage desc, seq desc) = 1",
    )


def _cache(name: str, source: str, as_of: datetime) -> list[Cte]:
    text = (
        f"select nom_automate, compteur_eau_renvoi_m3, compteur_eau_adoucie_m3, {ts(as_of)} as updated_at from {source} "
        "where compteur_eau_renvoi_m3 is not null and compteur_eau_adoucie_m3 is not null "
        "qualify row_number() over (partition by nom_automate order by horodatage desc, seq desc) = 1"
    )
    return [*inputs(source), (name, text)]


def _label(grain: str) -> str:
    bucket = _UNITS[grain][0]
    return {"daily": f"dayname({bucket})", "weekly": f"strftime({bucket}, '%Y-%m-%d')", "monthly": f"monthname({bucket})"}[
        grain
    ]


def _series(grain: str, columns: str) -> str:
    return f"select nom_automate, {_UNITS[grain][0]} as bucket, {_label(grain)} as label, {columns} from {grain}"


def _plain(grain: str, column: str, alias: str | None = None) -> str:
    return f"coalesce(cast({column} as double), 0.0) as {alias or column}"


def _repaired(grain: str, column: str, low: int, high: int) -> str:
    ctes = [*rollup(grain), ("lu", _series(grain, _plain(grain, column)))]
    inside = f"{column} between {low} and {high}"
    ctes.append(("typique", f"select nom_automate, quantile_cont({column}, 0.5) as mediane from lu where {inside} group by 1"))
    return sql(
        ctes,
        f"select nom_automate, bucket, label, case when {inside} then {column} else coalesce(mediane, {column}) end as "
        f"{column} from lu left join typique using (nom_automate)",
    )


def _series_oracles() -> dict[str, str]:
    out = {}
    for grain in _UNITS:
        disinfection = "taux_desinfection" if grain == "daily" else "taux_desinfection_avg"
        single = {
            "renvoi_series": "vol_renvoi_m3",
            "adoucie_series": "vol_adoucie_m3",
            "relevage_series": "vol_relevage_m3",
            "pressure5_series": "p5_mbar",
            "disinfection_series": disinfection,
            "energy_series": "conso_kwh",
        }
        for name, column in single.items():
            out[f"{name}_{grain}"] = sql(rollup(grain), _series(grain, _plain(grain, column)))
        several = ", ".join(_plain(grain, f"p{i}_mbar", f"p{i}_med_mbar") for i in range(1, 6))
        out[f"pressure_series_{grain}"] = sql(rollup(grain), _series(grain, several))
        out[f"volume_series_{grain}"] = sql(rollup(grain), _series(grain, ", ".join(_plain(grain, v) for v in VOLS)))
        recomputed = (
            "case when vol_renvoi_m3 > 0 then greatest(0.0, least(1.0, (vol_renvoi_m3 - coalesce(vol_adoucie_m3, 0)) "
            "/ vol_renvoi_m3)) else 0.0 end as taux_recyclage"
        )
        out[f"rate_from_volumes_{grain}"] = sql(rollup(grain), _series(grain, recomputed))
        per_m3 = f"case when vol_relevage_m3 > 0 then coalesce({rnd('conso_kwh / vol_relevage_m3', 3)}, 0.0) else 0.0 end as ratio"
        out[f"ratio_from_rollup_{grain}"] = sql(rollup(grain), _series(grain, per_m3))
        out[f"temperature_series_{grain}"] = _repaired(grain, "temp_moy_c", 0, 60)
        out[f"chlorine_series_{grain}"] = _repaired(grain, "chlore_moy_mg_l", 0, 2000)
        out[f"ph_series_{grain}"] = _repaired(grain, "ph_moyen", 2, 12)
    return out


_ZERO_RUNS = """
select * exclude (taux_recyclage), case
  when n % 4 = 0 and month(mois_debut) <= 4 then 0.0
  when n % 4 = 1 and month(mois_debut) in (5, 7) then 0.0
  when n % 4 = 2 and month(mois_debut) = 4 then null
  when n % 4 = 2 and month(mois_debut) in (3, 5, 6) then 0.0
  when n = 3 then 0.0 else taux_recyclage end as taux_recyclage
from (select *, cast(substr(nom_automate, 3) as int) as n from monthly) z
"""


def _fill_oracles() -> dict[str, str]:
    base = [*rollup("monthly"), ("zeros", _ZERO_RUNS)]
    # The last positive value at or before a row, found by a join instead of a window.
    before = (
        "(select p.taux_recyclage from zeros p where p.nom_automate = z.nom_automate and p.mois_debut < z.mois_debut "
        "and p.taux_recyclage > 0 order by p.mois_debut desc limit 1)"
    )
    forward = (
        f"select mois_debut, nom_automate, conso_kwh, ph_med, case when taux_recyclage = 0 then coalesce({before}, "
        "taux_recyclage) else taux_recyclage end as taux_recyclage from zeros z"
    )

    def backward(table: str) -> str:
        first = (
            f"(select p.taux_recyclage from {table} p where p.nom_automate = z.nom_automate and p.taux_recyclage > 0 "
            "order by p.mois_debut limit 1)"
        )
        earlier = (
            f"exists (select 1 from {table} p where p.nom_automate = z.nom_automate and p.mois_debut < z.mois_debut "
            "and (p.taux_recyclage is null or p.taux_recyclage <> 0))"
        )
        return (
            f"select mois_debut, nom_automate, conso_kwh, ph_med, case when taux_recyclage = 0 and not {earlier} "
            f"then coalesce({first}, taux_recyclage) else taux_recyclage end as taux_recyclage from {table} z"
        )

    picked = "select mois_debut, nom_automate, taux_recyclage from"
    ranged = ("plage", "select * from zeros where mois_debut between date '2001-03-01' and date '2001-07-01'")
    within = forward.replace("from zeros", "from plage")
    return {
        "ffill_zero": sql(base, f"{picked} ({forward}) f"),
        "bfill_leading_zero": sql(base, f"{picked} ({backward('zeros')}) f"),
        "export_rollup": sql(
            [*base, ranged, ("avance", within), ("recul", backward("avance"))],
            'select mois_debut as "date", nom_automate, taux_recyclage, conso_kwh, ph_med from recul',
        ),
    }


_EMAILS = "list_filter([email, email2, email3], lambda x: x is not null and x <> '')"
_EMAIL_TEXT = f"array_to_string({_EMAILS}, ',')"
_STATION_COLUMNS = f"nom_automate, client, lieu, email, email2, email3, {_EMAIL_TEXT} as emails"

_SCOPE: list[Cte] = [
    *inputs("user_roles", "roles", "organization_users", "organizations", "automate"),
    ("admins", "select distinct user_id from user_roles join roles on id = role_id where name in ('admin', 'super_admin')"),
    (
        "par_org",
        "select distinct user_id, lower(name) as client_key from organization_users join organizations "
        "on id = organization_id",
    ),
    (
        "portee",
        "select user_id, '*' as client_key from admins union all "
        "select * from par_org where user_id not in (select user_id from admins)",
    ),
]


def _visible(user: int, scope: str) -> str:
    return sql(
        _SCOPE,
        f"select {_STATION_COLUMNS} from automate where exists (select 1 from {scope} p where p.user_id = {user} "
        "and (p.client_key = '*' or p.client_key = lower(client)))",
    )


def _org_station_ctes() -> list[Cte]:
    text = (
        f"select o.id as org_id, nom_automate, numero_automate, lieu, {_EMAIL_TEXT} as emails from automate a join "
        "organizations o on a.organization_id = o.id or lower(a.client) = lower(o.name)"
    )
    return [*inputs("automate", "organizations"), ("stations_org", text)]


def _upserted() -> list[Cte]:
    """Daily table of the earlier run merged with the later one."""
    old, new = rollup("daily", EARLIER, "ancien"), rollup("daily", AS_OF, "nouveau")
    values = "vol_renvoi_m3 vol_adoucie_m3 vol_relevage_m3 taux_recyclage taux_desinfection p1_mbar p2_mbar p3_mbar p4_mbar "
    values += "p5_mbar temp_moy_c chlore_moy_mg_l ph_moyen conso_kwh"
    keys = "jour, nom_automate"
    listed = ", ".join(values.split())
    in_new = "exists (select 1 from nouveau n where n.jour = a.jour and n.nom_automate = a.nom_automate)"
    in_old = "exists (select 1 from ancien a where n.jour = a.jour and n.nom_automate = a.nom_automate)"
    text = (
        f"select {keys}, {listed}, {ts(EARLIER)} as created_at, {ts(EARLIER)} as updated_at from ancien a where not {in_new} "
        f"union all select {keys}, {listed}, case when {in_old} then {ts(EARLIER)} else {ts(AS_OF)} end, {ts(AS_OF)} "
        "from nouveau n"
    )
    return [*old, *new, ("fusion", text)]


def _interned() -> list[Cte]:
    """Rules of every user, and each user's rules as one text."""
    admin = "select user_id from user_roles join roles on id = role_id where lower(name) in ('admin', 'super_admin')"
    scope = (
        f"select distinct user_id, '*' as client_key from ({admin}) a union select user_id, lower(name) from organization_users join "
        f"organizations on id = organization_id where user_id not in ({admin})"
    )
    together = "select user_id, string_agg(client_key, '|' order by client_key) as regles from portee group by 1"
    return [*inputs("user_roles", "roles", "organization_users", "organizations"), ("portee", scope), ("ensembles", together)]


def _reports() -> list[Cte]:
    """Reports that pass the checks."""
    text = (
        "select cast(numero_automate as bigint) as id, a.client, a.lieu, nom_automate, 'Fuite cuve' as panne, 'signalé ' || "
        f"cast(numero_automate as varchar) as probleme, {ts(EARLIER)} as date_debut, cast(null as timestamp) as date_fin "
        "from automate a join (select client, lieu, min(nom_automate) as s from automate group by 1, 2) x on x.client = a.client "
        "and x.lieu = a.lieu where numero_automate % 10 not in (0, 2, 3) and s = nom_automate"
    )
    return [*inputs("pannes", "automate"), ("rapports", text)]


def _founders() -> list[Cte]:
    text = (
        "select id as user_id, client as name from (select client, min(numero_automate) as n from automate where client is not null "
        "group by 1) c join users on id = n"
    )
    return [*inputs("automate", "users", "organization_users"), ("fondees", text)]


def _types() -> str:
    values = ", ".join("('" + t.replace("'", "''") + "')" for t in INCIDENT_TYPES)
    ctes = inputs("pannes")
    ctes.append(("officiels", f"select * from (values {values}) v(type)"))
    ctes.append(("saisis", "select min(trim(panne)) as type from pannes where trim(panne) <> '' group by lower(trim(panne))"))
    return sql(
        ctes,
        "select type from officiels union all select type from saisis s where not exists "
        "(select 1 from officiels o where lower(o.type) = lower(s.type))",
    )


def all_oracles() -> dict[str, str]:
    week = f"ts >= {ts(AS_OF - timedelta(days=7))} and ts < {ts(AS_OF)}"
    both = "compteur_eau_renvoi_m3 is not null and compteur_eau_adoucie_m3 is not null"
    spread = [f"max({mic(c)}) - min({mic(c)})" for c in ("compteur_eau_renvoi_m3", "compteur_eau_adoucie_m3")]
    unclamped = rnd(f"(({spread[0]}) - ({spread[1]})) / nullif(cast({spread[0]} as double), 0)", 4)
    medians = ", ".join(f"quantile_cont(pression{i}_mbar, 0.5) as p{i}_med_mbar" for i in range(1, 6))
    inst = {v: f"compteur_eau_inst_{v.split('_')[1]}_pc" for v in VOLS}
    named_ids = "select id, client_id, type, created_at from fils"
    members = "organization_users join organizations o on o.id = organization_id"
    directory_orgs = (
        "select user_id, string_agg(name || ':' || org_role, '|' order by name, org_role) as organizations, "
        f"arg_min(name, name) as org_name, arg_min(org_role, name) as org_role from {members} group by 1"
    )
    directory_roles = (
        "select user_id, string_agg(distinct name, ',' order by name) as roles from user_roles join roles on id = role_id group by 1"
    )
    packed = ", ".join(f"string_agg(cast({v} as varchar), '|' order by jour) as {v}" for v in VOLS)
    delta_parts = ", ".join(f"sum({v}_d) / 1000000.0 as {v}" for v in COUNTERS)
    w_seq = "over (partition by nom_automate order by horodatage, seq)"
    delta_steps = ", ".join(f"greatest({mic(c)} - lag({mic(c)}) {w_seq}, 0) as {v}_d" for v, c in COUNTERS.items())
    peaks = ", ".join(f"max({mic(c)}) as {v}_m" for v, c in COUNTERS.items())
    peak_steps = ", ".join(
        f"greatest({v}_m - lag({v}_m) over (partition by nom_automate order by mois_debut), 0) / 1000000.0 as {v}"
        for v in COUNTERS
    )
    new_station = (
        "select distinct on (nom_automate) 'ST' || cast(id as string) as nom_automate, client_id as client, 'nouveau' as lieu, "
        "lower(email) as email from users"
    )
    changed = "numero_automate % 3 <> 0"
    json_fields = ", ".join(f"p{i}_med_mbar := cast(coalesce(p{i}_mbar, 0) as int)" for i in range(1, 6))

    out = {
        "scan_readings": f"select user_id, ts, event_id, value from events where {week}",
        "scan_readings_of_stations": f"select user_id, ts, event_id, value from events where {week} and user_id in "
        "(select c_custkey from customer where c_mktsegment = 'BUILDING')",
        "station_universe": sql(
            inputs("mesures_aggregate", "mesures_longues"),
            "select nom_automate from mesures_aggregate union select nom_automate from mesures_longues",
        ),
        "station_grid": sql(rollup("weekly"), "select nom_automate, semaine_debut from weekly_grid"),
        # hourly
        "hourly_wrap_delta_all": _wrap(inst),
        **{f"hourly_wrap_delta_{v.split('_')[1]}": _wrap({"delta_m3": c}) for v, c in inst.items()},
        "hour_of_day_mean": sql(
            inputs("mesures", "moyenne"),
            "select nom_automate, cast(hour(rounded_timestamp) as int) as heure_num, "
            "lpad(cast(hour(rounded_timestamp) as varchar), 2, '0') || ':00' as label, avg(avg_pression5) as moyenne_pression "
            f"from moyenne where rounded_timestamp >= {ts(AS_OF - timedelta(hours=24))} group by 1, 2, 3",
        ),
        "hourly_recycling_rate": _hour_query(
            f"coalesce({unclamped}, 0.0) as taux_recyclage", f"{day_window(closed=False)} and {both}"
        ),
        "recycling_rate_24h": sql(
            inputs("mesures"),
            f"select nom_automate, max(horodatage) as horodatage, coalesce({unclamped}, 0.0) as valeur from mesures "
            f"where {day_window(closed=False)} and {both} group by 1",
        ),
        "hourly_disinfection_rate": _hour_query(f"{rnd('avg(chlore_mv / 3.0)', 2)} as taux_desinfection", day_window()),
        "hourly_pressure_medians": _hour_query(medians, day_window()),
        "hourly_temperature_median": _hour_query(
            "coalesce(quantile_cont(temperature_deg, 0.5), 0) / 10.0 as temp_med_c",
            f"{day_window()} and temperature_deg / 10.0 between 0 and 60",
        ),
        "hourly_chlorine_median": _hour_query(
            "quantile_cont(chlore_mv, 0.5) as chlore_med_mv", f"{day_window()} and chlore_mv between 0 and 2000"
        ),
        "hourly_ph_median": _hour_query(
            "coalesce(quantile_cont(ph, 0.5), 0) / 100.0 as ph_mediane", f"{day_window()} and ph / 100.0 between 2 and 12"
        ),
        "hourly_energy": sql(
            _steps({"kwh": COUNTERS["conso_kwh"]}, day_window()),
            f"select nom_automate, heure, {rnd('sum(kwh) / 1000000.0', 2)} as conso_kwh from pas group by 1, 2",
        ),
        "hourly_energy_month": sql(
            _steps({"kwh": COUNTERS["conso_kwh"]}, day_window(24 * 31), PARIS),
            f"select nom_automate, heure, {rnd('sum(kwh) / 1000000.0', 2)} as conso_kwh from pas group by 1, 2",
        ),
        "hourly_energy_autumn": sql(
            _steps({"kwh": COUNTERS["conso_kwh"]}, day_window(48), "horodatage + interval 271 day"),
            "select nom_automate, pas.heure + case when pas.heure < timestamp '2024-10-27 01:00:00' then interval 2 hour else interval 1 "
            f"hour end as heure, {rnd('sum(kwh) / 1000000.0', 2)} as conso_kwh from pas group by nom_automate, pas.heure",
        ),
        "hourly_energy_ratio": sql(
            [
                *_steps({"kwh": COUNTERS["conso_kwh"], "m3": COUNTERS["vol_relevage_m3"]}, day_window()),
                (
                    "heures",
                    "select nom_automate, heure, case when sum(m3) > 0 then sum(kwh) / cast(sum(m3) as double) end as brut "
                    "from pas group by 1, 2",
                ),
            ],
            f"select nom_automate, heure, {rnd('avg(brut) over (partition by nom_automate order by heure rows 2 preceding)', 3)} "
            "as ratio from heures",
        ),
        # latest
        **{f"latest_tank_{k}": _latest(f"compteur_eau_inst_{k}_pc") for k in ("relevage", "renvoi", "adoucie")},
        **{
            f"latest_height_{k}": _latest(
                "", f"hauteur_cuve_{k}_pc is not null", f"least(100, greatest(0, hauteur_cuve_{k}_pc))"
            )
            for k in ("traitement", "disconnection")
        },
        "latest_volume_renvoi": _latest("compteur_eau_renvoi_m3"),
        "latest_energy_positive": _latest("compteur_electrique_kwh", "compteur_electrique_kwh > 0"),
        "latest_counters": sql(_cache("cache", "mesures", AS_OF), "select * from cache"),
        "refresh_latest_counters": sql(
            [*_cache("avant", "mesures_longues", EARLIER_LONG), *_cache("cache", "mesures", AS_OF)],
            "select * from cache union all select * from avant where nom_automate not in (select nom_automate from cache)",
        ),
        # rollups
        **{f"rollup_{g}": sql(rollup(g), f"select * from {g}") for g in _UNITS},
        "rollup_weekly_lookback": sql(rollup("weekly", lookback=1), "select * from weekly"),
        "rollup_daily_lookback": sql(rollup("daily", lookback=1), "select * from daily"),
        "counter_delta_sum_daily": sql(
            [
                *inputs("mesures"),
                ("pas", f"select nom_automate, cast(horodatage as date) as jour, {delta_steps} from mesures"),
            ],
            f"select nom_automate, jour, {delta_parts} from pas group by 1, 2",
        ),
        "counter_max_delta_monthly": sql(
            [
                *inputs("mesures_longues"),
                (
                    "maxima",
                    f"select nom_automate, cast(date_trunc('month', horodatage) as date) as mois_debut, {peaks} "
                    "from mesures_longues group by 1, 2",
                ),
            ],
            f"select nom_automate, mois_debut, {peak_steps} from maxima",
        ),
        # reads
        **_series_oracles(),
        "pack_series": sql(
            rollup("daily"),
            f"select nom_automate, string_agg(dayname(jour), '|' order by jour) as labels, {packed} from daily group by 1",
        ),
        "pack_series_hourly": sql(
            [
                *_steps({"kwh": COUNTERS["conso_kwh"]}, day_window()),
                (
                    "heures",
                    f"select nom_automate, heure, {rnd('sum(kwh) / 1000000.0', 2)} as conso_kwh from pas group by 1, 2",
                ),
            ],
            "select nom_automate, string_agg(strftime(heure, '%H:%M'), '|' order by heure) as labels, "
            "string_agg(cast(conso_kwh as varchar), '|' order by heure) as conso_kwh from heures group by 1",
        ),
        "series_json": sql(
            rollup("weekly"),
            "select cast(to_json(struct_pack(nom_automate := nom_automate, label := strftime(semaine_debut, '%Y-%m-%d'), "
            f"{json_fields})) as varchar) as json from weekly",
        ),
        "interval_consumption": sql(
            [
                *inputs("mesures"),
                (
                    "jours",
                    "select nom_automate, cast(horodatage as date) as jour, max(compteur_eau_renvoi_m3) as m from mesures "
                    "group by 1, 2",
                ),
            ],
            f"select nom_automate, jour, {rnd('greatest(m - p, 0)', 3)} as consommation from (select *, lag(m) over w as p, "
            "row_number() over w as n from jours window w as (partition by nom_automate order by jour)) q where n > 1",
        ),
        # fills, fleet, export
        **_fill_oracles(),
        "export_csv_rows": sql(
            rollup("daily"),
            "select strftime(jour, '%Y-%m-%d') as \"date\", nom_automate, vol_renvoi_m3, "
            "case when taux_recyclage > 0 then taux_recyclage else coalesce(last_value(case when taux_recyclage > 0 then "
            "taux_recyclage end ignore nulls) over (partition by nom_automate order by jour), first_value(case when "
            "taux_recyclage > 0 then taux_recyclage end ignore nulls) over (partition by nom_automate order by jour rows "
            "between unbounded preceding and unbounded following), taux_recyclage) end as taux_recyclage, temp_moy_c "
            "from daily where nom_automate in (select nom_automate from mesures)",
        ),
        "fleet_recycled_total": sql(
            [*_cache("cache", "mesures", AS_OF), *inputs("automate")],
            f"select coalesce({rnd('sum(d)', 1)}, 0.0) as total_recycle_m3, count(*) as nb_stations from (select "
            "compteur_eau_renvoi_m3 - compteur_eau_adoucie_m3 as d from cache join automate using (nom_automate)) q where d >= 0",
        ),
        "fleet_recycled_total_of_orgs": sql(
            [*_cache("cache", "mesures_longues", AS_OF_LONG), *inputs("automate", "organizations")],
            f"select coalesce({rnd('sum(d)', 1)}, 0.0) as total_recycle_m3, count(*) as nb_stations from (select "
            "compteur_eau_renvoi_m3 - compteur_eau_adoucie_m3 as d from cache join automate using (nom_automate) "
            "where lower(client) in (select lower(name) from organizations)) q where d >= 0",
        ),
        # registry
        "list_stations": sql(
            inputs("automate"),
            f"select client, numero_automate, nom_automate, lieu, email, email2, email3, {_EMAIL_TEXT} as emails from automate",
        ),
        "lookup_stations": sql(inputs("automate"), f"select {_STATION_COLUMNS} from automate"),
        "lookup_station_one": sql(inputs("automate"), f"select {_STATION_COLUMNS} from automate where nom_automate = 'ST3'"),
        "distinct_clients": sql(inputs("automate"), "select distinct client from automate where client is not null"),
        "distinct_sites": sql(
            inputs("automate"),
            "select distinct client, lieu from automate where client is not null and lieu is not null",
        ),
        "resolve_station": sql(
            inputs("automate"),
            "select client, lieu, min(nom_automate) as nom_automate from automate where client is not null group by 1, 2",
        ),
        "orphan_clients": sql(
            inputs("automate", "organizations"),
            "select distinct client from automate where client is not null and lower(client) not in "
            "(select lower(name) from organizations)",
        ),
        "org_stations": sql(_org_station_ctes(), "select * from stations_org"),
        "normalize_emails": sql(
            inputs("automate"),
            "select nom_automate, cast(len(liste) as int) as n, nullif(array_to_string(liste, ','), '') as csv from (select "
            "nom_automate, list_filter([lower(email), email3, case when lower(email) = email3 then '' end, "
            "coalesce(email2, 'x@y.example')], lambda x: x is not null and x <> '') as liste from automate) q",
        ),
        "add_stations": sql(
            [*inputs("automate", "users"), ("nouveaux", new_station)],
            "select * from automate union all select nom_automate, null, client, lieu, email, null, null, null from nouveaux "
            "where nom_automate not in (select nom_automate from automate)",
        ),
        "update_stations": sql(
            inputs("automate"),
            "select nom_automate, numero_automate, "
            f"case when {changed} and numero_automate % 2 = 0 then 'Nouveau client' else client end as client, lieu, "
            f"case when {changed} and numero_automate % 5 = 0 then null when {changed} and numero_automate % 7 = 0 "
            "then 'new@site.example' else email end as email, email2, email3, organization_id from automate",
        ),
        "remove_stations": sql(
            inputs("automate", "mesures"),
            "select * from automate where nom_automate not in (select nom_automate from mesures)",
        ),
        # entitlements
        "user_roles": sql(
            inputs("user_roles", "roles"), "select user_id, name as role from user_roles join roles on id = role_id"
        ),
        "user_orgs": sql(
            inputs("organization_users", "organizations"),
            f"select user_id, organization_id, name, org_role from {members}",
        ),
        "station_scope": sql(_SCOPE, "select * from portee"),
        "visible_stations_member": _visible(3, "portee"),
        "visible_stations_admin": _visible(50, "portee"),
        "visible_stations_view_as": _visible(150, "par_org"),
        "visible_station_counts": sql(
            _SCOPE,
            "select user_id, bool_or(client_key = '*') as sees_all, count(nom_automate) as nb_stations from portee left join "
            "automate on client_key = '*' or client_key = lower(client) group by 1",
        ),
        "user_directory": sql(
            [
                *inputs("users", "user_roles", "roles", "organization_users", "organizations"),
                ("r", directory_roles),
                ("g", directory_orgs),
            ],
            "select id, email, client_id, coalesce(roles, '') as roles, coalesce(organizations, '') as organizations, "
            "org_role, org_name from users left join r on r.user_id = id left join g on g.user_id = id",
        ),
        "users_with_role": sql(
            inputs("users", "user_roles", "roles"),
            "select u.id, email, client_id from users u join user_roles on user_id = u.id join roles r on r.id = role_id "
            "where r.name = 'admin'",
        ),
        "client_accounts": sql(inputs("users"), "select id, email, client_id from users where client_id is not null"),
        "account_clients": sql(inputs("users"), "select distinct client_id from users where client_id is not null"),
        **{
            name: sql(
                inputs("users", "organization_users"),
                "select organization_id, id, email, org_role from organization_users join users on id = user_id",
            )
            for name in ("org_members", "org_members_by_role")
        },
        "admin_orgs": sql(
            inputs("organization_users", "organizations"),
            f"select user_id, organization_id, name from {members} where org_role = 'org_admin'",
        ),
        "first_admin_org": sql(
            inputs("organization_users", "organizations"),
            f"select user_id, organization_id, name, org_role from {members} where org_role = 'org_admin' "
            "qualify row_number() over (partition by user_id order by name) = 1",
        ),
        "station_users": sql(
            inputs("automate_access", "users"),
            "select automate_nom, user_id, email from automate_access join users on id = user_id",
        ),
        "member_stations": sql(
            inputs("automate_access", "organization_users"),
            "select user_id, automate_nom from automate_access where user_id in (select user_id from organization_users)",
        ),
        "invalid_grants": sql(
            [*_org_station_ctes(), *inputs("automate_access")],
            "select automate_nom as nom_automate, user_id from automate_access where automate_nom not in "
            "(select nom_automate from stations_org)",
        ),
        "unknown_accounts": sql(
            inputs("automate", "users"),
            "select e as email from (select replace(replace(email, 'supplier#', 'customer#'), 'site', 'user') as e from automate) q "
            "where e not in (select email from users where is_active)",
        ),
        "fallback_org": sql(
            [
                *inputs("organization_users", "organizations"),
                (
                    "retraits",
                    "select user_id, min(organization_id) as organization_id from organization_users where user_id % 9 = 0 group by 1",
                ),
            ],
            "select r.user_id, min(o.name) as client_id from retraits r left join organization_users m on m.user_id = r.user_id "
            "and m.organization_id <> r.organization_id left join organizations o on o.id = m.organization_id group by 1",
        ),
        "list_roles": sql(inputs("roles"), "select name from roles"),
        "list_orgs": sql(inputs("organizations"), "select id, name from organizations"),
        # incidents, messages
        "incident_types": _types(),
        "list_incidents": sql(
            inputs("pannes"),
            "select id, client, lieu, nom_automate, panne, probleme, strftime(date_debut, '%Y-%m-%dT%H:%M:%S') as date_debut, "
            "strftime(date_fin, '%Y-%m-%dT%H:%M:%S') as date_fin, created_by from pannes",
        ),
        "check_incidents": sql(
            [
                *inputs("automate"),
                ("sites", "select client, lieu, min(nom_automate) as s from automate group by 1, 2"),
                (
                    "essais",
                    "select numero_automate % 10 as k, case when numero_automate % 10 = 0 then 'inconnu' else client end as client, "
                    "lieu, case when numero_automate % 10 = 1 then 'ST-autre' else nom_automate end as nom_automate from automate",
                ),
            ],
            "select nom_automate, client, lieu, case when client is null or k = 2 then 'missing_field' when k = 3 then "
            "'end_before_start' when s is null then 'unknown_site' when s <> nom_automate then 'station_mismatch' else 'ok' "
            "end as reason from essais left join sites using (client, lieu)",
        ),
        "message_thread": sql(
            inputs("messages"),
            "select * replace (strftime(created_at, '%Y-%m-%dT%H:%M:%S') as created_at) from messages",
        ),
        "message_thread_by_conversation": sql(
            inputs("messages"),
            "select * replace (strftime(created_at, '%Y-%m-%dT%H:%M:%S') as created_at) from messages",
        ),
        "unread_count_client_side": sql(
            inputs("messages"),
            'select count(*) as "count" from messages where client_id = \'4\' and not is_read and sender_id in (0, 677)',
        ),
        "unread_count_admin_side": sql(
            inputs("messages"),
            'select count(*) as "count" from messages where client_id = \'4\' and not is_read and sender_id in (1, 6863)',
        ),
        "unread_by_client": sql(
            inputs("messages"),
            'select client_id, count(*) as "count" from messages where client_id is not null and not is_read '
            "and sender_id in (1, 6863) group by 1",
        ),
        "list_conversations": sql(inputs("fils"), named_ids),
        "missing_conversations": sql(
            inputs("automate", "messages", "fils"),
            "select client_id, 'support' as type from (select cast(numero_automate as string) as client_id from automate union "
            "select client_id from messages) c where client_id is not null and not exists (select 1 from fils f where "
            "f.client_id = c.client_id and f.type = 'support')",
        ),
        # changes
        "insert_absent": sql(
            inputs("automate_access", "acces_demandes"), "select * from automate_access union select * from acces_demandes"
        ),
        "upsert_daily": sql(_upserted(), "select * from fusion"),
        "replace_window_monthly": sql(
            [*rollup("monthly", EARLIER_LONG, "ancien"), *rollup("monthly", AS_OF_LONG, "nouveau")],
            "select * from nouveau union all by name select * from ancien where mois_debut < date '2001-03-01'",
        ),
        "retain_from": sql(rollup("daily", EARLIER), "select * from daily where jour >= date '2024-01-24'"),
        "rebuild_daily": sql(rollup("daily"), "select * from daily"),
        "delete_keys": sql(inputs("pannes"), "select * from pannes where date_fin is not null"),
        "delete_bucket": sql(rollup("daily"), "select * from daily where jour <> date '2024-01-30'"),
        "full_update": sql(
            inputs("pannes"),
            "select * replace (case when id % 2 = 0 then 'Fuite cuve' else panne end as panne, "
            "case when id % 2 = 0 then null else date_fin end as date_fin) from pannes",
        ),
        "mark_read": sql(
            inputs("messages"),
            "select id, client_id, case when length(client_id) = 1 and not is_read and sender_id in (0, 677) then true "
            "else is_read end as is_read from messages",
        ),
        "demote_other_admins": sql(
            inputs("organization_users"),
            "select user_id, organization_id, case when user_id <> min(user_id) over (partition by organization_id) "
            "then 'employee' else org_role end as org_role from organization_users",
        ),
        "link_stations": sql(
            inputs("automate", "organizations"),
            "select * replace (coalesce(organization_id, (select min(id) from organizations o where lower(o.name) = "
            "lower(client))) as organization_id) from automate",
        ),
        "set_client": sql(
            inputs("users", "organization_users"),
            "select id, email, is_active, case when k is not null then cast(k as varchar) else client_id end as client_id from "
            "users left join (select user_id, min(organization_id) as k from organization_users group by 1) m on user_id = id",
        ),
        "replace_set_orgs": sql(
            [
                *inputs("users", "organization_users"),
                (
                    "voulus",
                    "select id as user_id, cast(id % 25 as int) as organization_id from users where id % 3 = 0 union "
                    "select id, cast((id + 1) % 25 as int) from users where id % 3 = 0",
                ),
            ],
            "select * from organization_users where user_id % 3 <> 0 union all select v.user_id, v.organization_id, "
            "coalesce(o.org_role, 'employee') from voulus v left join organization_users o using (user_id, organization_id)",
        ),
        "replace_set_scoped": sql(
            [
                *inputs("automate", "automate_access", "users"),
                (
                    "liees",
                    "select nom_automate from automate where organization_id is not null",
                ),
            ],
            "select * from automate_access where user_id % 2 <> 0 or user_id % 4 = 0 "
            "or automate_nom not in (select nom_automate from liees) union select 'ST1', id from users where id % 4 = 0",
        ),
        "append_rows": sql(
            [
                *inputs("automate", "fils"),
                (
                    "manquants",
                    "select distinct cast(numero_automate as varchar) as client_id from automate where not exists (select 1 from "
                    "fils f where f.client_id = cast(numero_automate as varchar) and f.type = 'support')",
                ),
            ],
            "select client_id, type, created_at, false as nouveau, cast(1 as bigint) as porteurs from fils union all "
            "select client_id, 'support', timestamp '2024-01-31', true, 1 from manquants",
        ),
        "append_rows_dense": sql(
            inputs("messages"),
            "select * from messages union all by name select (select max(id) from messages) + row_number() over "
            "(order by md5(event_type || chr(31) || cast(user_id % 8 as varchar))) as id, event_type as content, "
            "cast(user_id % 8 as varchar) as client_id from events",
        ),
        # access
        "assign_access_users": sql(
            inputs("users"),
            "select * replace (case when id % 3 = 0 or (id % 3 = 1 and id % 2 = 0) then 'nation_' || cast(id % 25 as varchar) "
            "else client_id end as client_id) from users",
        ),
        "assign_access_members": sql(
            [
                *inputs("users", "organization_users"),
                (
                    "voulus",
                    "select id as user_id, cast(id % 25 as int) as organization_id from users where id % 3 = 0 union "
                    "select id, cast((id + 1) % 25 as int) from users where id % 3 = 0",
                ),
                ("seuls", "select id as user_id, cast(id % 25 as int) as organization_id from users where id % 6 = 4"),
            ],
            "select * from organization_users o where user_id % 3 <> 0 and not exists (select 1 from seuls s where "
            "s.user_id = o.user_id and s.organization_id = o.organization_id) "
            "union all select user_id, organization_id, 'employee' from seuls "
            "union all select v.user_id, v.organization_id, coalesce(o.org_role, 'employee') from voulus v left join "
            "organization_users o using (user_id, organization_id)",
        ),
        "assign_access_roles": sql(
            inputs("users", "user_roles"),
            "select * from user_roles where user_id % 3 = 2 union all select id, cast(3 as int) from users where id % 3 <> 2 "
            "union all select id, cast(1 as int) from users where id % 3 <> 2 and id % 2 = 0",
        ),
        "create_organizations": sql(
            [
                *inputs("users", "organization_users", "organizations"),
                (
                    "fondees",
                    "select id as user_id, case when id % 4 = 0 then 'nation_' || cast(id % 25 as varchar) else 'ville_' || "
                    "cast(id as varchar) end as name from users where id % 10 = 0",
                ),
            ],
            f"select user_id, name, org_role from {members} where not exists (select 1 from fondees f where f.user_id = "
            "organization_users.user_id and f.name = o.name) union all select user_id, name, 'org_admin' from fondees",
        ),
        "add_members": sql(
            [
                *inputs("users", "organization_users"),
                (
                    "ajouts",
                    "select id as user_id, cast(id % 25 as int) as organization_id, case when id < 50 then 'org_admin' else "
                    "'employee' end as org_role from users where id % 2 = 1 and (id < 50 or id % 7 <> 0)",
                ),
            ],
            "select user_id, organization_id, case when exists (select 1 from ajouts a where a.org_role = 'org_admin' and "
            "a.organization_id = o.organization_id and a.user_id <> o.user_id) then 'employee' else org_role end as org_role "
            "from organization_users o where not exists (select 1 from ajouts a where a.user_id = o.user_id and "
            "a.organization_id = o.organization_id) union all select user_id, organization_id, org_role from ajouts",
        ),
        "add_members_users": sql(
            [
                *inputs("users", "organizations"),
                (
                    "noms",
                    "select u.id as user_id, max(o.name) as name from users u join organizations o on o.id = u.id % 25 or "
                    "o.id = (u.id + 3) % 25 group by 1",
                ),
            ],
            "select id, email, is_active, name as client_id from users join noms on user_id = id",
        ),
        "remove_members_left": sql(
            inputs("organization_users"), "select * from organization_users where (user_id + organization_id) % 5 <> 0"
        ),
        "set_station_access_unknown": sql(
            [
                *inputs("automate", "users"),
                (
                    "demandes",
                    "select nom_automate, numero_automate - 100 as n from automate union "
                    "select nom_automate, numero_automate - 99 from automate where (numero_automate - 100) % 5 <> 0",
                ),
            ],
            "select nom_automate as automate_nom, 'customer#' || lpad(cast(n as varchar), 9, '0') || '@user.example' as email "
            "from demandes where n not in (select id from users) union all "
            "select nom_automate, 'nobody@user.example' from automate where (numero_automate - 100) % 5 = 0",
        ),
        "set_member_access_foreign": sql(
            inputs("organization_users"),
            "select user_id, 'elsewhere' as automate_nom from organization_users where organization_id = 1 and user_id % 3 = 0",
        ),
        "remove_members": sql(
            [
                *inputs("users", "organization_users", "organizations"),
                ("partis", "select * from organization_users where (user_id + organization_id) % 5 = 0"),
                (
                    "reste",
                    "select user_id, min(name) as name from organization_users m join organizations on id = organization_id "
                    "where (user_id + organization_id) % 5 <> 0 group by 1",
                ),
            ],
            "select * replace (case when id in (select user_id from partis) then (select name from reste where user_id = id) "
            "else client_id end as client_id) from users",
        ),
        "set_station_access": sql(
            [
                *inputs("automate", "automate_access", "users"),
                ("demandes", "select nom_automate, numero_automate - 100 as n from automate"),
                (
                    "valides",
                    "select * from demandes where n % 5 <> 0 and n in (select id from users) and n + 1 in (select id from users)",
                ),
            ],
            "select * from automate_access where automate_nom not in (select nom_automate from valides) union all "
            "select nom_automate, n from valides union all select nom_automate, n + 1 from valides",
        ),
        "set_member_access": sql(
            [
                *_org_station_ctes(),
                *inputs("automate_access", "organization_users"),
                ("propres", "select nom_automate from stations_org where org_id = 1"),
                (
                    "valides",
                    "select user_id from organization_users where organization_id = 1 and user_id % 3 <> 0 "
                    "and 'ST1' in (select nom_automate from propres)",
                ),
            ],
            "select * from automate_access where not (user_id in (select user_id from valides) and automate_nom in "
            "(select nom_automate from propres)) union all select 'ST1', user_id from valides",
        ),
    }
    out |= {
        # stored tables
        "hour_of_day_mean_stored": out["hour_of_day_mean"],
        "run_rollup_daily": sql(_upserted(), "select * from fusion where jour >= date '2024-01-24'"),
        "run_rollup_weekly": sql(rollup("weekly"), f"select *, {ts(AS_OF)} as created_at, {ts(AS_OF)} as updated_at from weekly"),
        "run_rollup_monthly": sql(
            [*rollup("monthly", EARLIER_LONG, "ancien"), *rollup("monthly", AS_OF_LONG, "nouveau")],
            f"select *, {ts(AS_OF_LONG)} as created_at, {ts(AS_OF_LONG)} as updated_at from nouveau union all by name "
            f"select *, {ts(EARLIER_LONG)} as created_at, {ts(EARLIER_LONG)} as updated_at from ancien where mois_debut < date '2001-03-01'",
        ),
        "read_dimension": sql(inputs("automate"), "select * from automate"),
        "run_latest_counters": out["refresh_latest_counters"],
        "rollup_daily_from_slices": out["rollup_daily"],
        "rollup_weekly_from_states": out["rollup_weekly"],
        "rollup_monthly_from_states": out["rollup_monthly"],
        "known_stations": sql(inputs("mesures"), "select distinct nom_automate from mesures"),
        "full_update_keyed": sql(
            inputs("pannes"),
            "select * replace (case when id % 500 = 0 then 'Fuite cuve' else panne end as panne, "
            "case when id % 500 = 0 then null else date_fin end as date_fin) from pannes",
        ),
        "replace_set_keyed": sql(
            inputs("automate_access", "users"),
            "select * from automate_access where user_id not in (select id from users where id % 50 = 0) "
            "union all select 'ST1', id from users where id % 50 = 0",
        ),
        "scan_day_partitions": sql(
            inputs("mesures"),
            f"select nom_automate, horodatage, seq, compteur_electrique_kwh from mesures where {day_window(24 * 7)}",
        ),
        "scan_readings_of_client": sql(
            inputs("mesures_longues", "automate"),
            "select nom_automate, horodatage, seq, compteur_electrique_kwh from mesures_longues where nom_automate in "
            "(select nom_automate from automate where client = 'ASIA')",
        ),
        "hourly_energy_bucketed": out["hourly_energy"],
        "rollup_daily_bucketed": out["rollup_daily"],
        "export_file": sql(
            [*rollup("daily"), ("choix", "select distinct nom_automate from mesures")],
            "select 'date;nom_automate;vol_renvoi_m3;p1_mbar;ph_moyen' as value union all select concat_ws(';', jour, nom_automate, "
            "vol_renvoi_m3, coalesce(cast(p1_mbar as varchar), ''), coalesce(cast(ph_moyen as varchar), '')) "
            "from daily where nom_automate in (select nom_automate from choix)",
        ),
        # visibility of all users, logs, single keys
        "interned_users": sql(
            _interned(), "select user_id, min(user_id) over (partition by regles) as set_id from ensembles"
        ),
        "interned_set_stations": sql(
            [*_interned(), *inputs("automate")],
            "select distinct set_id, nom_automate from (select min(user_id) over (partition by regles) as set_id, user_id from ensembles) e "
            "join portee using (user_id) join automate on client_key = '*' or lower(client) = client_key where e.user_id = set_id",
        ),
        "record_incidents": sql(
            _reports(),
            "select *, false as nouveau from pannes union all by name select null as id, * exclude (id), 'chef@site.example' as created_by, "
            "true as nouveau from rapports",
        ),
        "amend_incidents": sql(
            _reports(),
            "select p.id, coalesce(r.client, p.client) as client, coalesce(r.lieu, p.lieu) as lieu, coalesce(r.nom_automate, p.nom_automate) "
            "as nom_automate, coalesce(r.panne, p.panne) as panne, coalesce(r.probleme, p.probleme) as probleme, "
            "coalesce(r.date_debut, p.date_debut) as date_debut, case when r.id is null then p.date_fin else r.date_fin end as date_fin, "
            "p.created_by from pannes p left join rapports r on r.id = p.id",
        ),
        "post_messages": sql(
            inputs("messages", "users"),
            "select * from messages union all by name select null as id, client_id, cast(id as int) as sender_id, email as content, "
            f"false as is_read, {ts(AS_OF)} as created_at from users",
        ),
        "ensure_conversations": sql(
            inputs("automate", "fils"),
            "select * from fils union all select null, client, 'support', "
            f"{ts(AS_OF)} from (select distinct client from automate where client is not null) c where not exists "
            "(select 1 from fils f where f.client_id = client and f.type = 'support')",
        ),
        "create_organizations_users": sql(
            _founders(), "select * replace (coalesce((select max(name) from fondees f where f.user_id = id), client_id) as client_id) from users"
        ),
        "create_organizations_stations": sql(
            [*_founders(), *inputs("organizations")],
            "select nom_automate, client, coalesce((select name from organizations o where o.id = organization_id), (select min(name) "
            "from fondees where lower(name) = lower(client))) as organisation from automate",
        ),
        "org_members_of_one": sql(
            inputs("users", "organization_users"),
            "select organization_id, id, email, org_role from organization_users join users on id = user_id where organization_id = 3",
        ),
        "message_thread_of_one": sql(
            inputs("messages"),
            "select * replace (strftime(created_at, '%Y-%m-%dT%H:%M:%S') as created_at) from messages where conversation_id = 2",
        ),
        "distinct_sites_of_one": sql(
            inputs("automate"), "select distinct client, lieu from automate where client = 'ASIA' and lieu is not null"
        ),
    }
    return out
