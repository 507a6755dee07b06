"""Best-effort datetime parsing with built-in expressions only (no UDF).

The result is a ``timestamp_ntz`` holding the UTC wall-clock time truncated to whole
seconds, so it does not depend on the session time zone.

Accepted inputs (fixed list; anything else that is not NULL raises):

* ISO-8601 date or date-time without zone, ``T`` or space separated
  (``2026-08-01``, ``2026-08-01 10:00:00``, ``2026-08-01T10:00:00.123``) -- taken as UTC
* ISO-8601 date-time with ``Z`` or a numeric offset (``2026-08-01T10:00:00Z``,
  ``2026-08-01T12:00:00+02:00``) -- converted to UTC
* epoch seconds of nine or ten digits (``1754042400``)
* compact ``yyyyMMdd`` and ``yyyyMMddHHmmss``; digit strings of other lengths raise
* day-first ``dd/MM/yyyy HH:mm:ss``, ``dd/MM/yyyy HH:mm`` and ``dd/MM/yyyy``

Every route is free of the session time zone, including wall-clock times that fall
into a daylight-saving gap of that zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# Patterns accepted by the parser.
DAY_FIRST_PATTERN = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}))?)?$"
ZONED_PATTERN = r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|z|[+-]\d{2}(:?\d{2})?)$"
EPOCH_PATTERN = r"^-?\d{9,10}$"
COMPACT_PATTERN = r"^(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2}))?$"
DIGITS_PATTERN = r"^[+-]?\d+$"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _utc_wall_clock_from_micros(micros: Column) -> Column:
    # epoch + interval is evaluated on timestamp_ntz, so no session zone is involved
    seconds = micros.cast("decimal(24,6)") / F.lit(1_000_000)
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def _truncate_to_second(ts: Column) -> Column:
    # field extraction on timestamp_ntz is zone-free, unlike date_trunc
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts)
    )


def _day_first(s: Column) -> Column:
    """``dd/MM/yyyy[ HH:mm[:ss]]`` built from its fields (no session zone involved;
    invalid dates give NULL)."""

    return _from_fields(s, DAY_FIRST_PATTERN, (3, 2, 1, 4, 5, 6))


def _from_fields(s: Column, pattern: str, groups: tuple[int, ...]) -> Column:
    """The time whose year, month, ... second are the pattern's groups (a missing time is 0)."""
    found = [F.regexp_extract(s, pattern, g) for g in groups]
    numbers = [F.when(v != "", v).cast("int") for v in found]
    numbers[3:] = [F.coalesce(v, F.lit(0)) for v in numbers[3:]]
    return F.when(s.rlike(pattern), F.try_make_timestamp_ntz(*numbers))


def format_ntz(ts: Column | str, date_sep: str = "-", time_sep: str = " ", day_first: bool = False,
               seconds: bool = True) -> Column:
    """Render a ``timestamp_ntz`` from its fields, independent of the session zone
    (``date_format`` goes through the session zone and shifts wall-clock times that
    fall into a daylight-saving gap)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    if day_first:
        date_fmt, date_args = f"%02d{date_sep}%02d{date_sep}%04d", [F.dayofmonth(t), F.month(t), F.year(t)]
    else:
        date_fmt, date_args = f"%04d{date_sep}%02d{date_sep}%02d", [F.year(t), F.month(t), F.dayofmonth(t)]
    time_fmt, time_args = "%02d:%02d", [F.hour(t), F.minute(t)]
    if seconds:
        time_fmt, time_args = time_fmt + ":%02d", time_args + [F.second(t)]
    return F.format_string(f"{date_fmt}{time_sep}{time_fmt}", *date_args, *time_args)


def instant_to_utc_ntz(ts: Column) -> Column:
    """A ``timestamp`` (instant) as UTC wall-clock ``timestamp_ntz``."""
    return _utc_wall_clock_from_micros(F.unix_micros(ts))


def parse_datetime_best_effort(
    c: Column | str, input_type: DataType | None = None, strict: bool = True
) -> Column:
    """Parse ``c`` (string, or already a timestamp) into UTC ``timestamp_ntz``.

    ``input_type`` lets callers skip the string route for columns that are typed
    timestamps already (no string round trip per row).  With ``strict`` a non-NULL
    input that matches none of the accepted forms raises; otherwise it yields NULL.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(input_type, TimestampNTZType):
        return _truncate_to_second(col)
    if isinstance(input_type, TimestampType):
        return _truncate_to_second(instant_to_utc_ntz(col))

    s = F.trim(col.cast("string"))
    zoned = s.rlike(ZONED_PATTERN)
    epoch = s.rlike(EPOCH_PATTERN)
    iso_plain = F.when(~s.rlike(DIGITS_PATTERN), s.try_cast("timestamp_ntz"))
    compact = _from_fields(s, COMPACT_PATTERN, (1, 2, 3, 4, 5, 6))
    iso_zoned = instant_to_utc_ntz(s.try_cast("timestamp"))
    from_epoch = _utc_wall_clock_from_micros(s.try_cast("bigint") * F.lit(1_000_000))
    day_first = _day_first(s)
    parsed = (
        F.when(zoned, iso_zoned)
        .when(epoch, from_epoch)
        .otherwise(F.coalesce(iso_plain, compact, day_first))
    )
    result = _truncate_to_second(parsed)
    if not strict:
        return result
    return F.when(
        s.isNotNull() & result.isNull(),
        F.raise_error(F.concat(F.lit("Cannot parse datetime: "), s)),
    ).otherwise(result).cast("timestamp_ntz")
