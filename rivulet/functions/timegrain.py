"""Bucket calendars, time-zone handling and labels.

``as_of`` replaces the wall clock. A naive ``as_of`` is UTC. Readings may carry
``timestamp`` (an instant) or ``timestamp_ntz`` (taken as UTC wall clock).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARIS = "Europe/Paris"
HOUR_START = "debut_utc"


@dataclass(frozen=True)
class Grain:
    """One rollup grain: where it is stored and which buckets a run covers."""

    name: str
    table: str
    bucket: str
    unit: str
    first: int
    last: int
    keep_from: int
    label_format: str


GRAINS: dict[str, Grain] = {
    "daily": Grain("daily", "donnees_semaine", "jour", "day", -7, -1, -7, "EEEE"),
    "weekly": Grain("weekly", "donnees_mois", "semaine_debut", "week", -3, 0, -3, "yyyy-MM-dd"),
    "monthly": Grain("monthly", "donnees_annees", "mois_debut", "month", -5, 0, -11, "MMMM"),
}


@dataclass(frozen=True)
class Bucket:
    """A calendar bucket with its UTC edges, start included and end excluded."""

    day: date
    start: datetime
    end: datetime


def utc_naive(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def _current_bucket(as_of: datetime, unit: str, tz: str) -> date:
    local = utc_naive(as_of).replace(tzinfo=timezone.utc).astimezone(ZoneInfo(tz)).date()
    if unit == "week":
        return local - timedelta(days=local.weekday())
    if unit == "month":
        return local.replace(day=1)
    return local


def _shift(day: date, unit: str, n: int) -> date:
    if unit == "month":
        months = day.year * 12 + day.month - 1 + n
        return date(months // 12, months % 12 + 1, 1)
    return day + timedelta(days=n * (7 if unit == "week" else 1))


def _midnight_utc(day: date, tz: str) -> datetime:
    return utc_naive(datetime.combine(day, time.min, tzinfo=ZoneInfo(tz)))


def day_bounds(day: date, tz: str) -> tuple[datetime, datetime]:
    """UTC edges of a local day."""
    return _midnight_utc(day, tz), _midnight_utc(day + timedelta(days=1), tz)


def current_bucket(as_of: datetime, grain: str, tz: str = PARIS) -> date:
    return _current_bucket(as_of, GRAINS[grain].unit, tz)


def buckets(as_of: datetime, grain: str, tz: str = PARIS, lookback: int = 0) -> list[Bucket]:
    """Buckets a run emits, oldest first, preceded by ``lookback`` extra ones."""
    g = GRAINS[grain]
    now = _current_bucket(as_of, g.unit, tz)
    days = [_shift(now, g.unit, n) for n in range(g.first - lookback, g.last + 2)]
    edges = [_midnight_utc(d, tz) for d in days]
    return [Bucket(d, a, b) for d, a, b in zip(days, edges, edges[1:])]


def bounds(as_of: datetime, grain: str, tz: str = PARIS, lookback: int = 0) -> tuple[datetime, datetime]:
    """UTC range a rollup has to scan."""
    span = buckets(as_of, grain, tz, lookback)
    return span[0].start, span[-1].end


def day_after(span: list[Bucket], grain: str) -> date:
    """The first day after the buckets of a run."""
    return _shift(span[-1].day, GRAINS[grain].unit, 1)


def retention_cutoff(as_of: datetime, grain: str, tz: str = PARIS) -> date:
    g = GRAINS[grain]
    return _shift(_current_bucket(as_of, g.unit, tz), g.unit, g.keep_from)


def _date_sequence(span: list[Bucket], unit: str) -> Column:
    first, last = span[0].day, span[-1].day
    return F.sequence(F.lit(first), F.lit(last), F.expr(f"INTERVAL 1 {unit.upper()}"))


def bucket_calendar(as_of: datetime, grain: str, tz: str = PARIS) -> Column:
    """The run's buckets, one row each when selected."""
    g = GRAINS[grain]
    return F.explode(_date_sequence(buckets(as_of, grain, tz), g.unit)).alias(g.bucket)


def grid(stations: DataFrame, as_of: datetime, grain: str, tz: str = PARIS) -> DataFrame:
    """Every station with every bucket of the run, by expanding each station row in place."""
    return stations.select("nom_automate", bucket_calendar(as_of, grain, tz))


def instant(moment: datetime, dtype: T.DataType) -> Column:
    """Literal comparable with a time column of ``dtype``, so that the filter reaches the scan."""
    moment = utc_naive(moment)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'")
    micros = (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return F.expr(f"timestamp_micros({micros}L)")


def time_between(df: DataFrame, column: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with start <= column < end; either side may be open."""
    dtype = df.schema[column].dataType
    if start is not None:
        df = df.where(F.col(column) >= instant(start, dtype))
    if end is not None:
        df = df.where(F.col(column) < instant(end, dtype))
    return df


def local_time(df: DataFrame, column: str, tz: str = "UTC") -> Column:
    """Wall clock of ``column`` in ``tz``, independent of the session time zone."""
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        value = F.expr(f"timestampadd(MICROSECOND, unix_micros(`{column}`), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return value if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), value)


def epoch_micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 in UTC, independent of the session time zone."""
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.unix_micros(column)
    c = f"`{column}`"
    return F.expr(
        f"unix_date(cast({c} as date)) * 86400000000L + hour({c}) * 3600000000L + minute({c}) * 60000000L"
        f" + cast(extract(SECOND FROM {c}) * 1000000 as bigint)"
    )


def with_hour(df: DataFrame, column: str, tz: str = "UTC", name: str = "heure") -> DataFrame:
    """Add the start of the local hour, as a wall clock, and in ``debut_utc`` the instant at which it starts.

    When clocks go back, two hours bear the same local label; their instants keep them apart.
    """
    rows = df.withColumns({"_utc": local_time(df, column), "_local": local_time(df, column, tz)})
    inside = "minute(_local) * 60000000L + cast(extract(SECOND FROM _local) * 1000000 as bigint)"
    rows = rows.withColumn(HOUR_START, F.expr(f"timestampadd(MICROSECOND, -({inside}), _utc)"))
    return rows.withColumn(name, F.window("_local", "1 hour")["start"]).drop("_utc", "_local")


def bucket_of(df: DataFrame, column: str, span: list[Bucket]) -> Column:
    """Bucket date of an in-range time: a chain of comparisons against the known edges.

    The span has at most a handful of buckets, so no per-row time-zone arithmetic is needed.
    """
    dtype = df.schema[column].dataType
    chain = F.when(F.col(column) < instant(span[0].end, dtype), F.lit(span[0].day))
    for b in span[1:]:
        chain = chain.when(F.col(column) < instant(b.end, dtype), F.lit(b.day))
    return chain


def bucket_label(value: Column, grain: str) -> Column:
    """``HH:mm`` for hours, ``Monday`` for days, ``2024-01-29`` for weeks, ``March`` for months."""
    return F.date_format(value, "HH:mm" if grain == "hourly" else GRAINS[grain].label_format)
