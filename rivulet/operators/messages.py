"""Client conversations and unread counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import iso_timestamp
from rivulet.operators.changes import append_rows

# Sender ids of the two sides of a conversation.
ADMIN_SENDERS = (0, 677)
CLIENT_SENDERS = (1, 6863)


def message_thread(messages: DataFrame, column: str, key: str | int | None = None) -> DataFrame:
    """Messages of one client or conversation (or of each), oldest first, ISO times."""
    rows = messages if key is None else messages.where(F.col(column) == F.lit(key))
    ordered = rows.orderBy(column, "created_at", "id")
    return ordered.withColumn("created_at", iso_timestamp(F.col("created_at")))


def _unread(senders: Sequence[int]) -> Column:
    return (F.col("is_read") == F.lit(False)) & F.col("sender_id").isin(list(senders))


def unread_count(messages: DataFrame, client: str, senders: Sequence[int]) -> DataFrame:
    """Number of unread messages of one client written by a sender group."""
    return messages.where((F.col("client_id") == F.lit(client)) & _unread(senders)).agg(F.count("*").alias("count"))


def unread_by_client(messages: DataFrame, senders: Sequence[int] = CLIENT_SENDERS) -> DataFrame:
    """The same for every client at once; messages without a client are left out."""
    rows = messages.where(F.col("client_id").isNotNull() & _unread(senders))
    return rows.groupBy("client_id").agg(F.count("*").alias("count"))


def list_conversations(conversations: DataFrame, client: str | None = None) -> DataFrame:
    """Newest first, all or one client's."""
    rows = conversations if client is None else conversations.where(F.col("client_id") == F.lit(client))
    return rows.select("id", "client_id", "type", "created_at").orderBy(F.col("created_at").desc_nulls_first(), "id")


def missing_conversations(clients: DataFrame, conversations: DataFrame, kind: str = "support") -> DataFrame:
    """Clients that still need a conversation of this kind."""
    have = conversations.where(F.col("type") == F.lit(kind)).select("client_id")
    wanted = clients.where(F.col("client_id").isNotNull()).select("client_id").distinct()
    return wanted.join(have, "client_id", "left_anti").withColumn("type", F.lit(kind))


def ensure_conversations(
    conversations: DataFrame, clients: DataFrame, now: Column, kind: str = "support"
) -> DataFrame:
    """Conversations with one of this kind for every client."""
    missing = missing_conversations(clients, conversations, kind)
    return append_rows(conversations, missing.withColumn("created_at", now))


def post_messages(messages: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Messages with the new ones appended, unread and stamped with the posting time."""
    return append_rows(messages, new.withColumn("is_read", F.lit(False)).withColumn("created_at", now))
