"""Reading the application tables straight from a JDBC database."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from rivulet.functions.timegrain import utc_naive
from rivulet.schemas import TIME


def time_slices(start: datetime, end: datetime, parts: int, column: str = TIME) -> list[str]:
    """Disjoint range predicates covering [start, end): one read task each."""
    start, end = utc_naive(start), utc_naive(end)
    step = (end - start) / parts
    edges = [start + step * i for i in range(parts)] + [end]
    edges = [e - timedelta(microseconds=e.microsecond) if 0 < i < parts else e for i, e in enumerate(edges)]
    return [f"{column} >= '{a.isoformat(sep=' ')}+00' AND {column} < '{b.isoformat(sep=' ')}+00'" for a, b in zip(edges, edges[1:])]


FETCH_ROWS = 10_000


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    predicates: list[str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A database table; connection details come from the caller only.

    ``predicates``, or ``split`` = (column, lower, upper, parts) on a numeric column, spread a large table
    over read tasks; without them one task reads it, which suits dimension tables only. Rows are fetched
    ``FETCH_ROWS`` at a time unless the properties say otherwise, since some drivers fetch all at once by default.
    """
    properties = {"fetchsize": str(FETCH_ROWS), **properties}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if split:
        column, lower, upper, parts = split
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
