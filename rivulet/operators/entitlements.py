"""Who may see and manage what, for all users at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.stations import station_key, with_emails
from rivulet.schemas import STATION

ADMIN_ROLES = ("admin", "super_admin")
EVERYTHING = "*"
_COPIES = 16  # of the total that administrators join


def user_roles(memberships: DataFrame, roles: DataFrame) -> DataFrame:
    """(user_id, role), ordered by role within the user."""
    named = roles.select(F.col("id").alias("role_id"), F.col("name").alias("role"))
    return memberships.join(named, "role_id").select("user_id", "role").orderBy("user_id", "role")


def user_orgs(org_users: DataFrame, orgs: DataFrame) -> DataFrame:
    """(user_id, organization_id, name, org_role), ordered by name within the user."""
    return _memberships(org_users, orgs).orderBy("user_id", "name")


def _memberships(org_users: DataFrame, orgs: DataFrame) -> DataFrame:
    named = orgs.select(F.col("id").alias("organization_id"), "name")
    return org_users.join(named, "organization_id").select("user_id", "organization_id", "name", "org_role")


def station_scope(
    memberships: DataFrame, roles: DataFrame, org_users: DataFrame, orgs: DataFrame, view_as: bool = False
) -> DataFrame:
    """Visibility rules as (user_id, client_key): ``*`` for admins, else the user's organization names.

    Linear in the number of memberships. ``view_as`` applies the organization rule to everyone.
    """
    by_org = _memberships(org_users, orgs).select("user_id", F.lower("name").alias("client_key")).distinct()
    if view_as:
        return by_org
    admin_ids = roles.where(F.lower("name").isin(*ADMIN_ROLES)).select(F.col("id").alias("role_id"))
    admins = memberships.join(admin_ids, "role_id", "left_semi").select("user_id").distinct()
    everyone_else = by_org.join(admins, "user_id", "left_anti")
    return admins.withColumn("client_key", F.lit(EVERYTHING)).unionByName(everyone_else)


def visible_stations(stations: DataFrame, scope: DataFrame, user_id: int) -> DataFrame:
    """Stations a user may see; none without a matching rule.

    An administrator's rule is one value that decides for all stations at once; the others join by client. Stations
    are read once.
    """
    mine = scope.where(F.col("user_id") == F.lit(user_id)).select(F.col("client_key").alias("_rule")).distinct()
    sees_all = mine.agg(F.coalesce(F.max(F.col("_rule") == F.lit(EVERYTHING)), F.lit(False))).scalar()
    rows = stations.join(mine, station_key() == F.col("_rule"), "left").where(sees_all | F.col("_rule").isNotNull())
    seen = with_emails(rows)
    return seen.select(STATION, "client", "lieu", "email", "email2", "email3", "emails")


def visible_station_counts(stations: DataFrame, scope: DataFrame) -> DataFrame:
    """Number of visible stations per user with a rule, without listing user-station pairs.

    One aggregation counts the stations of each client and of all; administrators share one rule, which is dealt over
    several copies of the total so that they don't meet in one task.
    """
    sizes = stations.select(station_key().alias("client_key")).groupingSets([["client_key"], []], "client_key")
    sizes = sizes.agg(F.count("*").alias("n"), F.grouping_id().alias("_all"))
    is_total = F.col("_all") == 1
    copies = F.when(is_total, F.sequence(F.lit(0), F.lit(_COPIES - 1))).otherwise(F.array(F.lit(0)))
    sizes = sizes.select(F.when(is_total, F.lit(EVERYTHING)).otherwise(F.col("client_key")).alias("client_key"), "n", F.explode(copies).alias("_copy"))
    everyone = F.col("client_key") == F.lit(EVERYTHING)
    copy = F.when(everyone, F.pmod(F.xxhash64("user_id"), F.lit(_COPIES)).cast("int")).otherwise(F.lit(0))
    counted = scope.withColumn("_copy", copy).join(sizes, ["client_key", "_copy"], "left").groupBy("user_id")
    total = F.max(F.when(everyone, F.col("n")))
    counted = counted.agg(F.max(everyone).alias("sees_all"), F.coalesce(total, F.sum("n"), F.lit(0)).alias("nb_stations"))
    return counted.select("user_id", "sees_all", "nb_stations")


def interned_scopes(scope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal sets of rules once: (user_id, set_id) and (set_id, client_key); a set bears its smallest user's id.

    Sets are compared by their size and two sums of hashes over their rules, so nothing is collected. All administrators
    share one set. Together with ``stations_of_sets`` it is the complete answer to who sees what, without a row per user and
    station.
    """
    rules = scope.select("user_id", "client_key").distinct()
    salted = F.xxhash64(F.lit("rule"), "client_key").cast("decimal(38,0)")
    sums = [F.count("*").alias("_n"), F.sum(F.xxhash64("client_key").cast("decimal(38,0)")).alias("_a"), F.sum(salted).alias("_b")]
    users = rules.groupBy("user_id").agg(*sums)
    sets = users.groupBy("_n", "_a", "_b").agg(F.min("user_id").alias("set_id"))
    members = users.join(sets, ["_n", "_a", "_b"]).select("user_id", "set_id")
    rules_of = rules.join(sets.select(F.col("set_id").alias("user_id")), "user_id", "left_semi")
    return members, rules_of.select(F.col("user_id").alias("set_id"), "client_key")


def stations_of_sets(stations: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, station) for every set of rules; the set of administrators has all stations."""
    admins = sets.where(F.col("client_key") == F.lit(EVERYTHING)).agg(F.min("set_id")).scalar()
    everything = stations.select(admins.alias("set_id"), STATION).where("set_id is not null")
    clients = stations.where(F.col("client").isNotNull()).select(station_key().alias("client_key"), STATION)
    return sets.join(clients, "client_key").select("set_id", STATION).unionByName(everything)


def user_directory(
    users: DataFrame, memberships: DataFrame, roles: DataFrame, org_users: DataFrame, orgs: DataFrame
) -> DataFrame:
    """Every user with sorted role names, organizations by name, and the first organization repeated."""
    named = roles.select(F.col("id").alias("role_id"), "name")
    role_sets = memberships.join(named, "role_id").groupBy("user_id").agg(
        F.array_sort(F.collect_set("name")).alias("roles")
    )
    entry = F.struct(F.col("name").alias("org_name"), "org_role")
    org_lists = _memberships(org_users, orgs).groupBy("user_id").agg(
        F.sort_array(F.collect_list(entry)).alias("organizations")
    )
    people = users.withColumnRenamed("id", "user_id").join(role_sets, "user_id", "left").join(org_lists, "user_id", "left")
    first = F.get(F.col("organizations"), F.lit(0))
    return people.select(
        F.col("user_id").alias("id"),
        "email",
        "client_id",
        F.coalesce("roles", F.array().cast("array<string>")).alias("roles"),
        F.coalesce("organizations", F.array().cast("array<struct<org_name:string,org_role:string>>")).alias(
            "organizations"
        ),
        first["org_role"].alias("org_role"),
        first["org_name"].alias("org_name"),
    ).orderBy("email")


def users_with_role(users: DataFrame, memberships: DataFrame, roles: DataFrame, role: str) -> DataFrame:
    wanted = roles.where(F.col("name") == F.lit(role)).select(F.col("id").alias("role_id"))
    holders = memberships.join(wanted, "role_id").select(F.col("user_id").alias("id"))
    return users.join(holders, "id").select("id", "email", "client_id").orderBy("email")


def client_accounts(users: DataFrame) -> DataFrame:
    """Users that belong to a client."""
    return users.where(F.col("client_id").isNotNull()).select("id", "email", "client_id").orderBy("email")


def account_clients(users: DataFrame) -> DataFrame:
    return users.where(F.col("client_id").isNotNull()).select("client_id").distinct().orderBy("client_id")


def org_members(users: DataFrame, org_users: DataFrame, org_id: int | None = None, by_role: bool = False) -> DataFrame:
    """Members of one or every organization, by e-mail or by descending role then e-mail."""
    rows = org_users if org_id is None else org_users.where(F.col("organization_id") == F.lit(org_id))
    people = users.select(F.col("id").alias("user_id"), "email")
    members = rows.join(people, "user_id").select(
        "organization_id", F.col("user_id").alias("id"), "email", "org_role"
    )
    if by_role:
        return members.orderBy("organization_id", F.col("org_role").desc_nulls_first(), "email")
    return members.orderBy("organization_id", "email")


def admin_orgs(org_users: DataFrame, orgs: DataFrame) -> DataFrame:
    """Organizations each user administers."""
    rows = _memberships(org_users, orgs).where(F.col("org_role") == F.lit("org_admin"))
    return rows.select("user_id", "organization_id", "name").orderBy("user_id", "name")


def first_admin_org(org_users: DataFrame, orgs: DataFrame) -> DataFrame:
    """The first of them by name: the default when no organization is chosen."""
    w = Window.partitionBy("user_id").orderBy("name", "organization_id")
    rows = _memberships(org_users, orgs).where(F.col("org_role") == F.lit("org_admin"))
    ranked = rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1)
    return ranked.select("user_id", "organization_id", "name", "org_role")


def station_users(access: DataFrame, users: DataFrame) -> DataFrame:
    """Users granted each station, by e-mail."""
    people = users.select(F.col("id").alias("user_id"), "email")
    return access.join(people, "user_id").select("automate_nom", "user_id", "email").orderBy("automate_nom", "email")


def member_stations(access: DataFrame, org_users: DataFrame, org_id: int | None = None) -> DataFrame:
    """Stations granted to each member of one organization, or of any."""
    members = org_users if org_id is None else org_users.where(F.col("organization_id") == F.lit(org_id))
    granted = access.join(members.select("user_id"), "user_id", "left_semi")
    return granted.select("user_id", "automate_nom").orderBy("user_id", "automate_nom")


def invalid_grants(requested: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """Requests that name nothing known: stations outside the organization, e-mails without account."""
    return requested.join(valid.select(key), key, "left_anti")


def fallback_org(removed: DataFrame, org_users: DataFrame, orgs: DataFrame) -> DataFrame:
    """After removals (user_id, organization_id): each user's next organization by name, else null."""
    left = org_users.join(removed, ["user_id", "organization_id"], "left_anti")
    touched = removed.select("user_id").distinct()
    names = _memberships(left.join(touched, "user_id", "left_semi"), orgs)
    return touched.join(names.groupBy("user_id").agg(F.min("name").alias("client_id")), "user_id", "left")


def list_roles(roles: DataFrame) -> DataFrame:
    return roles.select("name").orderBy("name")


def list_orgs(orgs: DataFrame) -> DataFrame:
    return orgs.select("id", "name").orderBy("name")
