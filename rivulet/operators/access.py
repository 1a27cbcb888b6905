"""Batches of access-right changes: each returns the next state of the tables it touches.

Requests carry arrays the way a form submits them. Where a batch names a user or a membership
several times, the greatest role and client name count, so results don't depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import norm_email, normalize_email_items, strip
from rivulet.operators.changes import (
    append_rows,
    delete_keys,
    last_per_key,
    demote_other_admins,
    link_stations,
    replace_set,
    set_client,
)
from rivulet.operators.entitlements import fallback_org
from rivulet.operators.stations import org_stations
from rivulet.schemas import STATION

ORG_ROLES = ("org_admin", "employee")
_MEMBER = ["user_id", "organization_id"]


def _trimmed(names: Column) -> Column:
    return F.filter(F.transform(names, strip), lambda x: x.isNotNull() & (x != F.lit("")))


def _set_roles(org_users: DataFrame, given: DataFrame) -> DataFrame:
    """Memberships with the roles of ``given`` (user_id, organization_id, org_role) put in or over."""
    new = last_per_key(given.select(*_MEMBER, "org_role"), _MEMBER)
    return delete_keys(org_users, new.select(*_MEMBER)).unionByName(
        new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in org_users.schema])
    )


def _org_keys(orgs: DataFrame) -> DataFrame:
    return orgs.select(F.col("id").alias("organization_id"), F.col("name").alias("org_name"))


def assign_access(
    users: DataFrame,
    org_users: DataFrame,
    user_roles: DataFrame,
    orgs: DataFrame,
    roles: DataFrame,
    requests: DataFrame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Next (users, organization_users, user_roles) after requests
    (user_id, roles array, client_id, organization_names array).

    A list of organization names replaces the user's memberships, keeping the role held in an
    organization that stays, and its first name becomes the client. Without a list, a
    ``client_id`` is set and, where an organization has that name, makes the user an employee
    of it. The role set is replaced in either case; unknown names are ignored.
    """
    asked = requests.select(
        "user_id",
        _trimmed(F.col("organization_names")).alias("names"),
        F.col("client_id").isNotNull().alias("has_client"),
        F.nullif(strip(F.col("client_id")), F.lit("")).alias("client_id"),
        F.transform(_trimmed(F.col("roles")), lambda x: F.lower(x)).alias("roles"),
    )
    listed = asked.where(F.col("names").isNotNull())
    single = asked.where(F.col("names").isNull() & F.col("has_client"))
    keys = _org_keys(orgs)

    wanted = listed.select("user_id", F.explode("names").alias("org_name")).join(keys, "org_name")
    memberships = replace_set(org_users, listed, wanted, "user_id", "organization_id", {"org_role": "employee"})
    employed = single.withColumnRenamed("client_id", "org_name").join(keys, "org_name")
    memberships = _set_roles(memberships, employed.withColumn("org_role", F.lit("employee")))

    clients = listed.select("user_id", F.get("names", F.lit(0)).alias("client_id"))
    people = set_client(users, clients.unionByName(single.select("user_id", "client_id")))

    role_keys = roles.select(F.col("id").alias("role_id"), F.col("name").alias("role"))
    held = asked.select("user_id", F.explode("roles").alias("role")).join(role_keys, "role")
    return people, memberships, replace_set(user_roles, asked, held, "user_id", "role_id")


def create_organizations(
    orgs: DataFrame, org_users: DataFrame, users: DataFrame, stations: DataFrame, requests: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Next (organizations, organization_users, users, stations) after requests (name, admin_email).

    Requests with a blank name, an address without ``@`` or no account are ignored. An existing
    name is reused. The account becomes administrator and belongs to the organization as its
    client; unlinked stations whose client has that name are linked.
    """
    asked = requests.select(strip(F.col("name")).alias("name"), norm_email(F.col("admin_email")).alias("email"))
    accounts = users.select(F.col("id").alias("user_id"), "email")
    valid = asked.where((F.col("name") != F.lit("")) & F.contains("email", F.lit("@"))).join(accounts, "email")
    fresh = valid.select("name").distinct().join(orgs.select("name"), "name", "left_anti")
    next_orgs = append_rows(orgs, fresh)
    named = valid.join(next_orgs.select(F.col("id").alias("organization_id"), "name"), "name")
    admins = named.select(*_MEMBER, F.lit("org_admin").alias("org_role"))
    clients = named.select("user_id", F.col("name").alias("client_id"))
    touched = next_orgs.join(named.select(F.col("organization_id").alias("id")), "id", "left_semi")
    return next_orgs, _set_roles(org_users, admins), set_client(users, clients), link_stations(stations, touched)


def add_members(
    org_users: DataFrame, users: DataFrame, orgs: DataFrame, requests: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Next (organization_users, users) after requests (organization_id, email, org_role).

    A new administrator (one per organization and batch) makes everyone else an employee.
    Requests with an unknown role or address are ignored.
    """
    asked = requests.select(
        "organization_id", norm_email(F.col("email")).alias("email"), F.lower(strip(F.col("org_role"))).alias("org_role")
    )
    accounts = users.select(F.col("id").alias("user_id"), "email")
    valid = asked.where(F.col("org_role").isin(*ORG_ROLES)).join(accounts, "email")
    demoted = demote_other_admins(org_users, valid.where(F.col("org_role") == F.lit("org_admin")))
    clients = valid.join(_org_keys(orgs), "organization_id").select("user_id", F.col("org_name").alias("client_id"))
    return _set_roles(demoted, valid), set_client(users, clients)


def remove_members(
    org_users: DataFrame, users: DataFrame, orgs: DataFrame, removed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Next (organization_users, users) after removals (user_id, organization_id).

    The user's client becomes the next remaining organization by name, or null.
    """
    keys = removed.select(*_MEMBER)
    return delete_keys(org_users, keys), set_client(users, fallback_org(keys, org_users, orgs))


def set_station_access(access: DataFrame, users: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next grants after requests (automate_nom, emails array), and the unknown addresses.

    A request naming an unknown address, or none at all, changes nothing.
    """
    asked = requests.select("automate_nom", normalize_email_items(F.col("emails")).alias("emails"))
    asked = asked.where(F.size("emails") > 0)
    accounts = users.select(F.col("id").alias("user_id"), "email")
    each = asked.select("automate_nom", F.explode("emails").alias("email")).join(accounts, "email", "left")
    unknown = each.where(F.col("user_id").isNull()).select("automate_nom", "email")
    valid = each.join(unknown.select("automate_nom"), "automate_nom", "left_anti")
    return replace_set(access, valid, valid, "automate_nom", "user_id"), unknown


def set_member_access(
    access: DataFrame, org_users: DataFrame, orgs: DataFrame, stations: DataFrame, requests: DataFrame, org_id: int
) -> tuple[DataFrame, DataFrame]:
    """Next grants after an organization's requests (user_id, automate_noms array), and the
    stations outside it.

    Only grants for the organization's own stations are replaced. Requests for non-members or
    with a station outside the organization change nothing.
    """
    own = org_stations(stations, orgs.where(F.col("id") == F.lit(org_id))).select(F.col(STATION).alias("automate_nom"))
    members = org_users.where(F.col("organization_id") == F.lit(org_id)).select("user_id")
    asked = requests.join(members, "user_id", "left_semi")
    each = asked.select("user_id", F.explode("automate_noms").alias("automate_nom"))
    outside = each.join(own, "automate_nom", "left_anti").select("user_id", "automate_nom")
    valid = asked.join(outside.select("user_id"), "user_id", "left_anti")
    wanted = each.join(valid.select("user_id"), "user_id", "left_semi")
    return replace_set(access, valid, wanted, "user_id", "automate_nom", scope=own), outside
