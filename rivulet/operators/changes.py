"""Set-level table changes: each operator returns the next state of its target.

Keys of a target are unique; batches of changes are joined to it, never looped over. A batch may
name a key several times: the last change by ``order`` counts, or, without an order, the greatest by
all of its columns, so that a result never depends on how rows arrive.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.numbering import dense_numbers
from rivulet.schemas import STATION

CREATED, UPDATED = "created_at", "updated_at"


def _aligned(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the target's columns and types; absent ones are null."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def _ranked(order: str | None, others: Sequence[str]) -> Column:
    return F.struct(*([order] if order else []), *[c for c in others if c != order])


def last_per_key(changes: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the last change."""
    others = [c for c in changes.columns if c not in keys]
    if not others:
        return changes.distinct()
    last = changes.groupBy(*keys).agg(F.max(_ranked(order, others)).alias("_row"))
    return last.select(*keys, "_row.*").select(*changes.columns)


def insert_absent(target: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Add rows whose key is not there yet; among equal new keys the first by ``order``, then by all columns, wins."""
    others = [c for c in new.columns if c not in keys]
    if others:
        first = new.groupBy(*keys).agg(F.min(_ranked(order, others)).alias("_row"))
        new = first.select(*keys, "_row.*")
    else:
        new = new.distinct()
    return target.unionByName(_aligned(target, new.join(target.select(*keys), list(keys), "left_anti")))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], now: Column, order: str | None = None, unique: bool = False
) -> DataFrame:
    """Insert or overwrite by key; ``created_at`` is kept, ``updated_at`` set on every source row.

    Target columns missing from ``source`` keep their value. ``unique`` says that no key occurs
    twice in ``source``, as in an aggregate, and saves looking for the last change.
    """
    values = [c for c in source.columns if c not in keys and c not in (CREATED, UPDATED)]
    source = source if unique else last_per_key(source, keys, order)
    fresh = source.select(*keys, F.struct(*values, F.lit(True).alias("_hit")).alias("_new"))
    both = target.withColumn("_known", F.lit(True)).join(fresh, list(keys), "full_outer")
    hit, known = F.col("_new._hit").isNotNull(), F.col("_known").isNotNull()

    def column(f) -> Column:
        old = F.col(f.name)
        if f.name in keys:
            return old
        if f.name == CREATED:
            old = F.when(known, old).otherwise(now)
        elif f.name == UPDATED:
            old = F.when(hit, now).otherwise(old)
        elif f.name in values:
            old = F.when(hit, F.col(f"_new.{f.name}")).otherwise(old)
        return old.cast(f.dataType).alias(f.name)

    return both.select(*[column(f) for f in target.schema])


def replace_window(target: DataFrame, new: DataFrame, bucket: str, days: Sequence[date]) -> DataFrame:
    """Delete every row of the given buckets, then insert ``new``."""
    kept = target.where(~F.coalesce(F.col(bucket).isin(list(days)), F.lit(False)))
    return kept.unionByName(_aligned(target, new))


def retain_from(target: DataFrame, bucket: str, cutoff: date) -> DataFrame:
    """Retention: drop buckets before ``cutoff``."""
    return target.where(F.col(bucket) >= F.lit(cutoff))


def rebuild(target: DataFrame, new: DataFrame) -> DataFrame:
    """Start over with ``new`` only."""
    return _aligned(target, new)


def delete_keys(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove the rows whose key appears in ``keys`` (joined on all of its columns)."""
    return target.join(keys, keys.columns, "left_anti")


def delete_bucket(target: DataFrame, bucket: str, day: date) -> DataFrame:
    return target.where(~F.col(bucket).eqNullSafe(F.lit(day)))


def partial_update(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    clean: Mapping[str, Callable[[Column], Column]] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Overwrite only the fields that a change supplies; a null field is not supplied.

    Of several changes of a key only the last one counts, as a whole.
    ``clean`` maps a column to the function applied to a supplied value, whose result may be null.
    """
    clean = clean or {}
    fields = [c for c in changes.columns if c not in keys]
    new = last_per_key(changes, keys, order).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = target.join(new, list(keys), "left")

    def column(name: str) -> Column:
        if name not in fields:
            return F.col(name)
        value = F.col(f"_new_{name}")
        cleaned = clean[name](value) if name in clean else value
        return F.when(value.isNotNull(), cleaned).otherwise(F.col(name)).alias(name)

    return joined.select(*[column(c) for c in target.columns])


def full_update(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Overwrite all supplied columns of matching rows, nulls included; unknown keys are ignored."""
    fields = [c for c in changes.columns if c not in keys]
    new = last_per_key(changes, keys, order).select(*keys, F.struct(*fields, F.lit(True).alias("_hit")).alias("_new"))
    joined = target.join(new, list(keys), "left")
    hit = F.col("_new._hit").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
            for c in target.columns
        ]
    )


def _spread(key: Column, row: str) -> Column:
    """The join key; where it is null, a value that matches nothing and differs from row to row.

    So rows without a key stay spread over all tasks instead of meeting in one.
    """
    return F.coalesce(key, F.concat(F.lit("\0"), F.col(row).cast("string")))


def mark_read(messages: DataFrame, clients: DataFrame, senders: Sequence[int]) -> DataFrame:
    """Set ``is_read`` on unread messages of the given clients that the sender group wrote."""
    wanted = clients.where(F.col("client_id").isNotNull()).select(F.col("client_id").alias("_asked")).distinct()
    joined = messages.join(wanted, _spread(F.col("client_id"), "id") == F.col("_asked"), "left")
    hit = F.col("_asked").isNotNull() & (F.col("is_read") == F.lit(False)) & F.col("sender_id").isin(list(senders))
    return joined.withColumn("is_read", F.when(hit, F.lit(True)).otherwise(F.col("is_read"))).select(
        *messages.columns
    )


def demote_other_admins(org_users: DataFrame, appointed: DataFrame) -> DataFrame:
    """Where an organization got a new admin, everyone else in it becomes an employee.

    ``appointed`` holds (organization_id, user_id); of several for one organization the greatest
    ``user_id`` counts.
    """
    new = appointed.groupBy("organization_id").agg(F.max("user_id").alias("_admin"))
    joined = org_users.join(new, "organization_id", "left")
    other = F.col("_admin").isNotNull() & (F.col("user_id") != F.col("_admin"))
    role = F.when(other, F.lit("employee")).otherwise(F.col("org_role"))
    return joined.withColumn("org_role", role).select(*org_users.columns)


def link_stations(stations: DataFrame, orgs: DataFrame) -> DataFrame:
    """Give stations without an organization the one named like their client, ignoring case."""
    named = orgs.groupBy(F.lower("name").alias("_client")).agg(F.min("id").alias("_org"))
    joined = stations.join(named, _spread(F.lower("client"), STATION) == F.col("_client"), "left")
    return joined.withColumn("organization_id", F.coalesce("organization_id", "_org")).select(*stations.columns)


def set_client(users: DataFrame, assignments: DataFrame) -> DataFrame:
    """Set ``client_id`` (possibly to null) of the users listed in (user_id, client_id)."""
    changes = assignments.select(F.col("user_id").alias("id"), "client_id")
    return full_update(users, changes, ["id"])


def replace_set(
    target: DataFrame,
    owners: DataFrame,
    new: DataFrame,
    owner: str,
    member: str,
    kept: Mapping[str, str] | None = None,
    scope: DataFrame | None = None,
) -> DataFrame:
    """Replace the members of each owner listed in ``owners`` by those in ``new``.

    ``kept`` maps attributes to a default: a member already there keeps its value. With
    ``scope`` (a ``member`` column) only members inside it are removed.
    """
    kept = kept or {}
    pair = [owner, member]
    marked = target.join(owners.select(owner).distinct().withColumn("_owned", F.lit(True)), owner, "left")
    leaving = F.col("_owned").isNotNull()
    if scope is not None:
        marked = marked.join(scope.select(member).distinct().withColumn("_scoped", F.lit(True)), member, "left")
        leaving = leaving & F.col("_scoped").isNotNull()
    staying = marked.where(~leaving).select(*target.columns)
    wanted = new.select(*pair).distinct()
    if scope is not None:
        wanted = wanted.join(staying.select(*pair), pair, "left_anti")
    if kept:
        before = target.select(*pair, *[F.col(a).alias(f"_old_{a}") for a in kept])
        wanted = wanted.join(before, pair, "left").select(
            *pair, *[F.coalesce(F.col(f"_old_{a}"), F.lit(d)).alias(a) for a, d in kept.items()]
        )
    return staying.unionByName(_aligned(target, wanted))


def append_rows(target: DataFrame, new: DataFrame, key: str = "id", groups: int | None = None) -> DataFrame:
    """Append rows with generated ids above every existing one.

    Rows are numbered inside groups and the groups' numbers interleaved, so there is no global sort.
    A row's group comes from a hash of its content and of its number among equal rows, which are counted
    instead of sorted; evaluating the result again gives the same ids. Ids are unique but not
    dense, like a database sequence after rollbacks. ``groups`` defaults to 64 for each shuffle
    partition. Nothing runs before the result is read.
    """
    groups = groups or 64 * int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = target.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    content = [c for c in new.columns if c != key]
    counted = new.groupBy(*content).agg(F.count("*").alias("_copies"))
    each = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copies")
    each = each.withColumn("_group", F.pmod(F.xxhash64(*content, "_copy"), F.lit(groups)))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(*content, "_copy"))
    numbered = each.withColumn(key, top + (rank.cast("long") - 1) * F.lit(groups).cast("long") + F.col("_group") + 1)
    return target.unionByName(_aligned(target, numbered))


def append_rows_dense(target: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Append rows with the ids that follow the greatest existing one, without gaps: max + 1 to max + n.

    Numbers come from a distributed prefix sum (``dense_numbers``) in the order of a digest of the rows,
    so no task sorts them all; the same rows always get the same ids. Nothing runs before the result is read.
    """
    top = target.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    numbered = dense_numbers(new, [c for c in new.columns if c != key], "_number")
    return target.unionByName(_aligned(target, numbered.withColumn(key, top + F.col("_number"))))
