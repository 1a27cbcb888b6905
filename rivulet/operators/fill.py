"""Repairs of bucketed series: outliers and zero runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.schemas import STATION


def outlier_repair(series: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Replace values outside [low, high] by the median of the station's values inside it.

    A station without any value in range stays as it is.
    """
    value = F.col(column)
    inside = value.between(low, high)
    typical = F.median(F.when(inside, value)).over(Window.partitionBy(STATION))
    return series.withColumn(column, F.when(inside, value).otherwise(F.coalesce(typical, value)))


def ffill_zero(df: DataFrame, column: str, order: str) -> DataFrame:
    """A zero takes the last positive value before it; nulls stay and do not interrupt."""
    value = F.col(column)
    so_far = Window.partitionBy(STATION).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_positive = F.last(F.when(value > 0, value), ignorenulls=True).over(so_far)
    return df.withColumn(column, F.when(value == 0, F.coalesce(last_positive, value)).otherwise(value))


def bfill_leading_zero(df: DataFrame, column: str, order: str) -> DataFrame:
    """Zeros before any other value (or null) take the first positive value."""
    value = F.col(column)
    ordered = Window.partitionBy(STATION).orderBy(order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_positive = F.first(F.when(value > 0, value), ignorenulls=True).over(whole)
    leading = F.bool_and(F.coalesce(value == 0, F.lit(False))).over(so_far)
    return df.withColumn(column, F.when(leading, F.coalesce(first_positive, value)).otherwise(value))
