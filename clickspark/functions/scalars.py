"""Scalar column functions (parsing, formatting, routing).

All are plain Column expressions: they stay in whole-stage codegen and
Catalyst can push filters through them.  Time zones are explicit
arguments; nothing depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's output formats) ------------
EVENT_PREFIX = "Event{user='"
URL_VIEW_PREFIX = "UrlViewCount{url='"
HOUR_PATTERN = "yyyyMMdd HH"
DAY_PATTERN = "yyyyMMdd"
FALLBACK_DAY = "19700101"
FUTURE_SLACK_MS = 3_600_000
# ---------------------------------------------------------------------------

# Java String.trim() removes every char <= U+0020 at both ends; Spark's trim
# only removes spaces.
_JTRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
_LONG_TEXT = r"^[+-]?[0-9]+$"
_EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_trim(s: Column | str) -> Column:
    return F.regexp_replace(_c(s), _JTRIM, "")


def parse_long(s: Column | str, strict: bool = True) -> Column:
    """``Long.valueOf`` semantics: optional sign and ASCII digits only.

    ``strict`` raises on bad text (the reference's job fails); otherwise
    the result is NULL.
    """
    s = _c(s)
    ok = F.coalesce(s.rlike(_LONG_TEXT), F.lit(False))
    val = s.try_cast("bigint")
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a long: "), F.coalesce(s, F.lit("null"))))
        return F.when(ok & val.isNotNull(), val).otherwise(bad.cast("bigint"))
    return F.when(ok, val)


def parse_click(line: Column | str, sep: str = ",", strict: bool = True) -> Column:
    """``user<sep>url<sep>ms`` -> struct(user, url, ms).

    ``sep`` is a regular expression like Java's ``String.split``.  Fields
    are Java-trimmed; extra fields are ignored; a missing field or a bad
    number fails (``strict``) or gives NULLs.
    """
    parts = F.split(_c(line), sep)
    n = F.size(parts)

    def field(i: int) -> Column:
        return F.when(n > i, java_trim(F.element_at(parts, i + 1)))

    ms_text = field(2)
    if strict:
        ms_text = F.when(n > 2, ms_text).otherwise(
            F.raise_error(F.concat(F.lit("missing field in: "), _c(line))).cast("string"))
    return F.struct(field(0).alias("user"), field(1).alias("url"),
                    parse_long(ms_text, strict).alias("ms"))


def local_time(ms: Column | str, zone: str) -> Column:
    """Wall-clock TIMESTAMP_NTZ of epoch ms in ``zone`` (tz rules applied)."""
    utc = F.timestamp_add("MILLISECOND", _c(ms), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def java_timestamp(ms: Column | str, zone: str = "UTC") -> Column:
    """``java.sql.Timestamp.toString`` of epoch ms in ``zone``:
    ``yyyy-MM-dd HH:mm:ss.f`` with 1-3 fraction digits, trailing zeros cut."""
    text = F.date_format(local_time(ms, zone), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, "0{1,2}$", "")


def _java_str(c: Column) -> Column:
    # String concatenation of a null reference prints "null" in Java.
    return F.coalesce(c.cast("string"), F.lit("null"))


def event_string(user: Column | str = "user", url: Column | str = "url",
                 ms: Column | str = "ms", zone: str = "UTC") -> Column:
    """``Event.toString``."""
    return F.concat(F.lit(EVENT_PREFIX), _java_str(_c(user)), F.lit("', url='"),
                    _java_str(_c(url)), F.lit("', ts="),
                    F.coalesce(java_timestamp(ms, zone), F.lit("null")), F.lit("}"))


def url_view_string(url: Column | str = "url", count: Column | str = "count",
                    start: Column | str = "windowStart", end: Column | str = "windowEnd",
                    zone: str = "UTC") -> Column:
    """``UrlViewCount.toString``."""
    return F.concat(F.lit(URL_VIEW_PREFIX), _java_str(_c(url)), F.lit("', count="),
                    _java_str(_c(count)), F.lit(", windowStart="),
                    F.coalesce(java_timestamp(start, zone), F.lit("null")),
                    F.lit(", windowEnd="), F.coalesce(java_timestamp(end, zone), F.lit("null")),
                    F.lit("}"))


def event_json(user: Column | str = "user", url: Column | str = "url",
               ms: Column | str = "ms") -> Column:
    """``Event.toJson``: keys user, url, ts (null fields omitted)."""
    return F.to_json(F.struct(_c(user).alias("user"), _c(url).alias("url"),
                              _c(ms).alias("ts")))


def hour_text(ms: Column | str, zone: str) -> Column:
    """``yyyyMMdd HH`` of epoch ms in ``zone``."""
    return F.date_format(local_time(ms, zone), HOUR_PATTERN)


def parse_hour(text: Column | str, zone: str) -> Column:
    """F7 inverse: epoch ms of the start of a ``yyyyMMdd HH`` hour in ``zone``."""
    local = F.to_timestamp_ntz(_c(text), F.lit(HOUR_PATTERN))
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), utc)


def day_of(ms: Column | str, zone: str) -> Column:
    """The day part of F7 (``yyyyMMdd``)."""
    return F.date_format(local_time(ms, zone), DAY_PATTERN)


def index_day(ms: Column | str, now_ms: int | Column, zone: str) -> Column:
    """F8: day suffix of the target index; ``19700101`` for a NULL time or
    one more than an hour in the future (strictly greater)."""
    ms = _c(ms)
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return (F.when(ms.isNull() | (ms > now + F.lit(FUTURE_SLACK_MS)), F.lit(FALLBACK_DAY))
             .otherwise(day_of(ms, zone)))


def index_name(prefix: str, ms: Column | str, now_ms: int | Column, zone: str) -> Column:
    return F.concat(F.lit(prefix + "-"), index_day(ms, now_ms, zone))
