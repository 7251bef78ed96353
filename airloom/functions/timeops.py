"""Time expressions. All instants are TIMESTAMP in a session pinned to UTC.

Stamps are time-ending: a value stamped 10:00 belongs to the hour 09-10, and a
value at midnight to the day before. Every label therefore looks at `ts - 1s`.
"Local" results are wall-clock times of a zone, carried in the same type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_US = 1_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zone(tz) -> Column:
    """A zone given as a Column, or as a literal zone name."""
    return F.lit(tz) if isinstance(tz, str) else tz


def shift(ts, seconds) -> Column:
    """ts moved by a number of seconds (Python number or integer Column)."""
    step = F.lit(int(seconds)) if isinstance(seconds, (int, float)) else seconds
    return F.timestamp_micros(F.unix_micros(_col(ts)) + step.cast("long") * _US)


def local_time(ts, tz) -> Column:
    return F.from_utc_timestamp(_col(ts), _zone(tz))


def as_utc(wall, tz) -> Column:
    """Wall-clock time of a zone to the UTC instant (earlier one when ambiguous)."""
    return F.to_utc_timestamp(_col(wall), _zone(tz))


def as_timestamptz(wall, tz) -> Column:
    """Attach a zone to a wall-clock timestamp or a date."""
    return as_utc(_col(wall).cast("timestamp"), tz)


def offset_seconds(ts, tz) -> Column:
    """UTC offset of a zone at an instant, in seconds."""
    return (F.unix_seconds(local_time(ts, tz)) - F.unix_seconds(_col(ts))).cast("int")


def offset_hours(ts, tz) -> Column:
    """Whole-hour part of the offset; minutes are dropped toward zero."""
    return (offset_seconds(ts, tz) / 3600).cast("int")


def local_hour(ts, tz) -> Column:
    """Instant truncated to the UTC hour, shown as wall-clock time of the zone."""
    return local_time(F.date_trunc("hour", _col(ts)), tz)


def local_hour_int(ts, tz) -> Column:
    return F.hour(local_time(ts, tz))


def _floor_hour(ts, offset_s) -> Column:
    local = F.unix_micros(_col(ts)) + (offset_s.cast("long") - 1) * _US
    return local - F.pmod(local, F.lit(3600 * _US)) - offset_s.cast("long") * _US


def hour_start(ts, offset_s) -> Column:
    """UTC instant at which the local hour of a time-ending stamp began.

    Works on the offset, not the zone name, so the two UTC hours of a fall-back
    stay apart and half-hour zones keep their own hour limits.
    """
    return F.timestamp_micros(_floor_hour(ts, offset_s))


def hour_end(ts, offset_s) -> Column:
    """UTC instant at which that local hour ends: the label of an hourly row."""
    return F.timestamp_micros(_floor_hour(ts, offset_s) + F.lit(3600 * _US))


def local_date(ts, tz) -> Column:
    return F.to_date(local_time(shift(ts, -1), tz))


def local_year(ts, tz) -> Column:
    return F.trunc(local_date(ts, tz), "year")


def utc_date(ts) -> Column:
    """UTC day of a time-ending stamp."""
    return F.to_date(shift(ts, -1))


def floor_minutes(ts, minutes: int) -> Column:
    ts = _col(ts)
    return shift(F.date_trunc("hour", ts), F.floor(F.minute(ts) / minutes) * minutes * 60)


def truncate(ts, period: str, tz=None, offset_s=None) -> Column:
    """Truncate a time-ending stamp, optionally in a zone and/or after an offset.

    With a zone the result is the UTC instant of the local boundary; with only
    an offset the truncated shifted value is returned as it is.
    """
    moved = shift(ts, -1) if offset_s is None else shift(ts, offset_s - 1)
    if tz is None:
        return F.date_trunc(period, moved)
    return as_utc(F.date_trunc(period, local_time(moved, tz)), tz)


def iso_local(ts, tz="UTC") -> Column:
    """`YYYY-MM-DDTHH:MM:SS+HH:MM` in the zone, a missing zone meaning UTC."""
    zone = F.coalesce(_zone(tz), F.lit("UTC"))
    offset = offset_seconds(ts, zone)
    minutes = F.floor(F.abs(offset) / 60)
    return F.concat(
        F.date_format(local_time(ts, zone), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(offset < 0, "-").otherwise("+"),
        F.lpad(F.floor(minutes / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((minutes % 60).cast("string"), 2, "0"),
    )


def datetime_object(ts, tz="UTC") -> Column:
    """{utc, local, timezone} of an instant; NULL in, NULL out."""
    return F.when(
        _col(ts).isNotNull(),
        F.struct(
            iso_local(ts, "UTC").alias("utc"),
            iso_local(ts, tz).alias("local"),
            _zone(tz).alias("timezone"),
        ),
    )


def wall_datetime_object(wall, tz="UTC") -> Column:
    """The same for a wall-clock timestamp or a date of the zone."""
    return datetime_object(as_timestamptz(wall, tz), tz)


def seconds_between(later, earlier) -> Column:
    """later - earlier in seconds, with fractions."""
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / _US


def instant(text: str) -> Column:
    """A clock parameter as a UTC timestamp literal."""
    return F.lit(text).cast("timestamp")
