"""Instants from strings in several spellings, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?)?\s*([Zz]|[+-]\d{2}:?\d{2}|[+-]\d{2})?$"
_COMPACT = r"^\d{8}T\d{6}(\.\d{1,6})?Z$"
_HTTP = r"(\d{1,2}) ([A-Z][a-z]{2}) (\d{4}) (\d{2}:\d{2}:\d{2})"


def instant_us(c: Column) -> Column:
    """Microseconds since 1970-01-01 UTC of a string instant, null if unreadable.

    Reads ISO dates and times with ``T`` or a blank, a fraction, ``Z`` or an offset
    (none: UTC), HTTP dates, and compact ``yyyyMMddTHHmmss[.ffffff]Z``. Empty,
    blank, impossible dates and words give null. The session's zone has no effect.
    """
    s = F.trim(c)
    iso = F.regexp_replace(F.regexp_replace(F.upper(s), ",", "."), r"\s+([Z+-])", "$1")
    zoned = F.when(iso.rlike(r"(Z|[+-]\d{2}:\d{2})$") & (F.length(iso) > 10), iso).when(iso.rlike(r":\d{2}(\.\d+)?[+-]\d{4}$"), F.regexp_replace(iso, r"(\d{2})$", ":$1")).when(iso.rlike(r":\d{2}(\.\d+)?[+-]\d{2}$"), F.concat(iso, F.lit(":00"))).when(F.length(iso) == 10, F.concat(iso, F.lit("T00:00:00Z"))).otherwise(F.concat(iso, F.lit("Z")))
    compact = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(\.\d+)?Z$", "$1-$2-$3T$4:$5:$6$7Z")
    http = F.concat(F.lpad(F.regexp_extract(s, _HTTP, 1), 2, "0"), F.lit(" "), F.regexp_extract(s, _HTTP, 2), F.lit(" "), F.regexp_extract(s, _HTTP, 3), F.lit(" "), F.regexp_extract(s, _HTTP, 4), F.lit(" +00:00"))
    when = (
        F.when(s.rlike(_ISO), zoned.try_cast("timestamp"))
        .when(s.rlike(_COMPACT), compact.try_cast("timestamp"))
        .when(s.rlike(_HTTP), F.try_to_timestamp(http, F.lit("dd MMM yyyy HH:mm:ss XXX")))
    )
    return F.unix_micros(when)
