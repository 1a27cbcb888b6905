"""Application tables derived from the given test tables.

Every statement runs unchanged in Spark and DuckDB and reads its source tables whole. No
statement needs a window, so each one scales with a plain scan (or one join on keys).
"""

from __future__ import annotations

import re
import zlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AS_OF = datetime(2024, 1, 31)
AS_OF_LONG = datetime(2001, 8, 15)

SOURCES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events", "conversations")

# Readings: h is a running total in hundredths that grows with the event number; counters are
# multiples of it in thousandths and restart at a modulus. A large event value makes the next
# step negative. Some values are null; station 3, 5 and 6 have outlier days.
_READINGS = """
select 'ST' || cast(station as string) as nom_automate, ts as horodatage, event_id as seq,
  case when event_id % 53 = 0 then null else cast(h * 10 % 15000000 as double) / 1e3 end as compteur_eau_renvoi_m3,
  case when event_id % 59 = 0 then null else cast(h * 6 % 9000000 as double) / 1e3 end as compteur_eau_adoucie_m3,
  cast(h * 8 % 12000000 as double) / 1e3 as compteur_eau_relevage_m3,
  cast(h * 15 % 40000000 as double) / 1e3 as compteur_electrique_kwh,
  case when event_id % 61 = 0 then null else cast((c + event_id) % 101 as int) end as compteur_eau_inst_renvoi_pc,
  cast((c * 3 + event_id) % 101 as int) as compteur_eau_inst_adoucie_pc,
  cast((c * 7 + event_id) % 101 as int) as compteur_eau_inst_relevage_pc,
  cast(c % 4000 as int) as pression1_mbar, cast((c + 500) % 4000 as int) as pression2_mbar,
  cast((c + 900) % 4000 as int) as pression3_mbar, cast((c + 1300) % 4000 as int) as pression4_mbar,
  case when event_id % 17 = 0 then null else cast((c + 1700) % 4000 as int) end as pression5_mbar,
  case when (station = 3 and day(ts) = 26) or (station = 6 and day(ts) between 8 and 14)
    then cast(900 + c % 100 as int) else cast(c % 700 as int) end as temperature_deg,
  case when event_id % 67 = 0 then null when station = 5 and day(ts) = 25 then cast(3000 + c % 100 as int)
    else cast(c % 2100 as int) end as chlore_mv,
  case when station = 5 and day(ts) = 27 then cast(1500 + c % 100 as int) else cast(100 + c % 1200 as int) end as ph,
  case when event_id % 7 = 0 then null else cast(c % 130 - 15 as int) end as hauteur_cuve_traitement_pc,
  case when event_id % 11 = 0 then null else cast((c + 40) % 130 - 15 as int) end as hauteur_cuve_disconnection_pc
from (select {station} as station, ts, event_id, event_id * 400 + cast(round(value * 100) as bigint) as h,
        cast(round(value * 100) as bigint) as c from events) b
"""

INPUTS: dict[str, str] = {
    "mesures": _READINGS.format(station="user_id % 8"),
    "moyenne": """
select nom_automate, horodatage as rounded_timestamp, cast(pression5_mbar as double) as avg_pression5 from mesures
""",
    "mesures_aggregate": "select 'ST' || cast(s_suppkey as string) as nom_automate from supplier",
    # Six years of readings; station 7 has none in June 2001, since station 8 takes them over.
    "mesures_longues": """
select 'ST' || cast(station as string) as nom_automate, l_shipdate as horodatage, seq,
  case when seq % 53 = 0 then null else cast(h * 10 % 20000000 as double) / 1e3 end as compteur_eau_renvoi_m3,
  cast(h * 6 % 13000000 as double) / 1e3 as compteur_eau_adoucie_m3,
  cast(h * 8 % 20000000 as double) / 1e3 as compteur_eau_relevage_m3,
  cast(h * 15 % 20000000 as double) / 1e3 as compteur_electrique_kwh,
  cast(c % 4000 as int) as pression1_mbar, cast((c + 500) % 4000 as int) as pression2_mbar,
  cast((c + 900) % 4000 as int) as pression3_mbar, cast((c + 1300) % 4000 as int) as pression4_mbar,
  cast((c + 1700) % 4000 as int) as pression5_mbar,
  cast(c % 700 as int) as temperature_deg,
  case when seq % 67 = 0 then null else cast(c % 2100 as int) end as chlore_mv,
  cast(100 + c % 1200 as int) as ph
from (select case when l_suppkey % 20 = 7 and year(l_shipdate) = 2001 and month(l_shipdate) = 6 then 8
          else l_suppkey % 20 end as station, l_shipdate, l_orderkey * 10 + l_linenumber as seq,
        ((year(l_shipdate) - 1995) * 372 + month(l_shipdate) * 31 + day(l_shipdate)) * 1000
          + cast(round(l_quantity * 100) as bigint) as h,
        cast(round(l_extendedprice) as bigint) as c from lineitem) b
""",
    "automate": """
select 'ST' || cast(s_suppkey as string) as nom_automate, cast(s_suppkey + 100 as int) as numero_automate,
  case when s_suppkey % 13 = 7 then null when s_suppkey % 3 = 0 then r_name else n_name end as client,
  n_name || ' ' || cast(s_suppkey % 4 as string) as lieu,
  lower(s_name) || '@site.example' as email, case when s_suppkey % 2 = 0 then '' end as email2,
  case when s_suppkey % 3 = 0 then 'ops@site.example' end as email3,
  case when s_suppkey % 4 = 1 then cast(s_suppkey % 25 as int) end as organization_id
from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
""",
    "organizations": "select n_nationkey as id, lower(n_name) as name from nation",
    "users": """
select c_custkey as id, lower(c_name) || '@user.example' as email, c_custkey % 11 <> 0 as is_active,
  case when c_custkey % 5 = 0 then c_mktsegment end as client_id from customer
""",
    "roles": """
select distinct cast(1 + c_custkey % 3 as int) as id,
  case c_custkey % 3 when 0 then 'admin' when 1 then 'super_admin' else 'client' end as name from customer
""",
    # Every customer is in users. Multiples of 7 have no client role, and mostly none at all (empty role lists);
    # multiples of 50 and 75 are administrators, of 150 both (several roles of one user).
    "user_roles": """
select c_custkey as user_id, cast(case when c_custkey % 7 > 0 then 3 end as int) as role_id from customer where c_custkey % 7 <> 0
union all select c_custkey, cast(case c_custkey % 50 when 0 then 1 end as int) from customer where c_custkey % 50 = 0
union all select c_custkey, cast(case c_custkey % 75 when 0 then 2 end as int) from customer where c_custkey % 75 = 0
""",
    # Multiples of 4 are in no first organization, so some users have none; multiples of 3 are in a second one.
    "organization_users": """
select c_custkey as user_id, n_nationkey as organization_id,
  case when c_custkey % 10 = 0 then 'org_admin' else 'employee' end as org_role
from customer join nation on n_nationkey = c_nationkey where c_custkey % 4 <> 0
union all select c_custkey, cast((n_nationkey + 7) % 25 as int),
  case when c_custkey % 6 = 0 then 'org_admin' else 'employee' end
from customer join nation on n_nationkey = c_nationkey where c_custkey % 3 = 0
""",
    # Grants that other orders ask for: partly there already, partly new.
    "acces_demandes": """
select 'ST' || cast(o_orderkey % 97 as string) as automate_nom, o_custkey as user_id
from orders group by 1, 2
""",
    "automate_access": """
select 'ST' || cast(o_orderkey % 100 as string) as automate_nom, o_custkey as user_id
from orders group by 1, 2
""",
    "messages": """
select conv_id * 1000 + turn as id, conv_id as conversation_id,
  case when conv_id % 9 = 0 then null else cast(conv_id % 20 as string) end as client_id,
  cast(case when role = 'user' then 1 else 0 end as int) as sender_id, text as content,
  case when turn % 5 = 0 then 'file' || cast(conv_id as string) end as file_url,
  cast('2024-01-' || lpad(cast(1 + conv_id % 28 as string), 2, '0') || ' ' || lpad(cast(turn % 24 as string), 2, '0')
    || ':15:00' as timestamp) as created_at,
  turn % 2 = 1 as is_read from conversations
""",
    "fils": """
select conv_id as id, case when conv_id % 9 = 0 then null else cast(conv_id % 20 as string) end as client_id,
  case when conv_id % 4 = 0 then 'vente' else 'support' end as type,
  cast('2024-01-' || lpad(cast(1 + conv_id % 28 as string), 2, '0') || ' 08:00:00' as timestamp) as created_at
from conversations group by conv_id
""",
    "pannes": """
select event_id as id, cast(user_id % 8 as string) as client, 'site ' || cast(user_id % 3 as string) as lieu,
  'ST' || cast(user_id % 8 as string) as nom_automate,
  case event_id % 6 when 0 then 'pompe hs' when 1 then ' Fuite cuve ' when 2 then '' when 3 then 'Capteur dérive'
    when 4 then null else 'CAPTEUR DÉRIVE' end as panne,
  'voir ' || event_type as probleme, ts as date_debut,
  case when event_id % 4 = 0 then ts end as date_fin, 'admin@site.example' as created_by
from events
""",
}


def needed(name: str) -> list[str]:
    """Derived inputs that ``name`` is built on, itself included, in dependency order."""
    return ["mesures", "moyenne"] if name == "moyenne" else [name]


def _source(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Name of a temporary view of one Parquet table, created on first use in the session."""
    view = f"source_{zlib.crc32(sf_dir.encode()):08x}_{table}"
    if not spark.catalog.tableExists(view):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(view)
    return view


def _run(spark: SparkSession, sf_dir: str, body: str, extra: dict[str, str] | None = None) -> DataFrame:
    statements = " ".join([*(extra or {}).values(), body])
    tables = [t for t in SOURCES if re.search(rf"\b(?:from|join) {t}\b", statements)]
    ctes = [f"{t} as (select * from {_source(spark, sf_dir, t)})" for t in tables]
    ctes += [f"{n} as ({text})" for n, text in (extra or {}).items()]
    return spark.sql(f"with {', '.join(ctes)} {body}" if ctes else body)


def load_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a lazy DataFrame over the Parquet files."""
    df = _run(spark, sf_dir, INPUTS[name], {n: INPUTS[n] for n in needed(name)[:-1]})
    # Times written as text in the statements are wall clock, whatever the session zone.
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def bench_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with one station per user, for timing runs with many stations."""
    return _run(spark, sf_dir, _READINGS.format(station="user_id"))
