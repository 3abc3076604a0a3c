"""Instants: strict ISO-8601 parsing and fractional ages. The session is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's cast also takes a bare year or a bare time of day; the guards do not.
_ZONE = r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)"
_FULL = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?" + _ZONE + r"?)?$"
# Forms the cast does not take: seconds or minutes left out, no separators.
_SHORT = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2})(?::(\d{2}))?" + _ZONE + r"?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})[T ](\d{2})(\d{2})(\d{2})?" + _ZONE + r"?$"


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to an instant; text without an offset is UTC, bad text is null."""
    no_minutes = F.regexp_replace(F.regexp_replace(text, _SHORT, "$1T$2:$3:00$4"), "::", ":00:")
    no_seconds = F.regexp_replace(
        F.regexp_replace(text, _COMPACT, "$1-$2-$3T$4:$5:$6$7"), r":(?=$|Z|[+-])", ":00"
    )
    return (
        F.when(text.rlike(_FULL), text.try_cast("timestamp"))
        .when(text.rlike(_SHORT), no_minutes.try_cast("timestamp"))
        .when(text.rlike(_COMPACT), no_seconds.try_cast("timestamp"))
    )


def has_offset(text: Column) -> Column:
    """Whether ISO text carries a zone designator."""
    return text.rlike(r"[T ].*(Z|[+-]\d{2}(:?\d{2}){0,2})$")


def hours_between(later: Column, earlier: Column) -> Column:
    """Fractional hours; the built-in difference functions truncate to units."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def compact_stamp(ts: Column) -> Column:
    """File-name stamp such as ``20240105T070809Z``."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
