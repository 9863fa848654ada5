"""Moments written as text, and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(text: Column) -> Column:
    """The moment (microseconds of UTC, as bigint) that a text gives; null where it gives none.

    Understands ISO 8601 dates and date-times with ``T`` or a blank, fractions, ``Z`` or an offset, and whole
    numbers of seconds (9 or 10 digits) or milliseconds (13 digits) since 1970. A date-time without zone is
    UTC, a bare date its midnight. Impossible dates give null.
    """
    s = F.upper(F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", ""))
    date, clock, zone = r"\d{4}-\d{2}-\d{2}", r"\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?", r"(?:Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)"
    iso = F.regexp_replace(F.regexp_replace(s, r"^(\S{10})[T ]+", "$1T"), r"\s*(?:Z|UTC|GMT)$", "+00:00")
    iso = F.regexp_replace(iso, r"([+-]\d{2})(\d{2})$", "$1:$2")
    with_zone = (
        F.when(s.rlike(rf"^{date}$"), F.concat(s, F.lit("T00:00:00+00:00")))
        .when(s.rlike(rf"^{date}[T ]+{clock}$"), F.concat(iso, F.lit("+00:00")))
        .when(s.rlike(rf"^{date}[T ]+{clock}\s*{zone}$"), F.regexp_replace(iso, r"(T.*[+-]\d{2})$", "$1:00"))
    )
    return (
        F.when(s.rlike(r"^\d{9,10}$"), s.try_cast("bigint") * 1_000_000)
        .when(s.rlike(r"^\d{13}$"), s.try_cast("bigint") * 1_000)
        .otherwise(F.unix_micros(with_zone.try_cast("timestamp")))
    )
