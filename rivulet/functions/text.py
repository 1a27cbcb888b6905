"""E-mail and label normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters that count as white space, no-break and other Unicode blanks included.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Without white space at both ends (blanks of any kind, tabs, line breaks)."""
    return F.trim(value, F.lit(WHITE))


def folded(value: Column) -> Column:
    """A key under which spellings that differ in case only are equal, also where upper case has more letters (``ß``)."""
    return F.lower(F.concat(F.upper(value), F.lit("")))  # Spark would simplify lower(upper(x)) to lower(x)


def norm_email(value: Column) -> Column:
    """Trimmed lower-case address; blank becomes null."""
    return F.nullif(F.lower(strip(value)), F.lit(""))


def normalize_email_items(items: Column) -> Column:
    """Clean an array of addresses: trim, lower, drop blanks, keep the first of each."""
    cleaned = F.transform(items, lambda x: F.lower(strip(F.coalesce(x, F.lit("")))))
    return F.array_distinct(F.filter(cleaned, lambda x: x != F.lit("")))


def normalize_emails(raw: Column) -> Column:
    """Split a ``,`` or ``;`` separated list into clean addresses; null gives an empty array."""
    return normalize_email_items(F.split(F.coalesce(raw, F.lit("")), "[,;]"))


def emails_csv(addresses: Column) -> Column:
    """Comma form of a cleaned list; null when it is empty."""
    return F.nullif(F.array_join(addresses, ","), F.lit(""))


def filled_values(*columns: Column) -> Column:
    """Array of the non-null, non-empty values, in column order."""
    return F.filter(F.array(*columns), lambda x: x.isNotNull() & (x != F.lit("")))


def iso_timestamp(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
