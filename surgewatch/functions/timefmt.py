"""Time parsing and formatting expressions (session time zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# English weekday abbreviations that open an X created_at text.
_WEEKDAY_PREFIX = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) "


def parse_created_at(created) -> Column:
    """``Mon Aug 19 02:15:23 +0000 2025`` (or ISO text) to a UTC timestamp.

    Spark's parser rejects the weekday field, so the weekday is checked by
    pattern and cut off.  Unparseable text gives null.
    """
    s = _col(created)
    x_form = F.when(s.rlike(_WEEKDAY_PREFIX),
                    F.try_to_timestamp(F.substring(s, 5, 1 << 20),
                                       F.lit("MMM d HH:mm:ss Z yyyy")))
    return F.coalesce(x_form, iso_to_timestamp(s))


def iso_to_timestamp(iso) -> Column:
    """ISO-8601 text (``Z``/``z``, offset, or naive = UTC) to a timestamp; bad to null."""
    s = F.regexp_replace(F.trim(_col(iso)), "[Zz]$", "+00:00")
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s.try_cast("timestamp"))


def iso_to_epoch(iso) -> Column:
    """ISO-8601 text to epoch seconds; bad or empty text to null."""
    return F.unix_seconds(iso_to_timestamp(iso))


def epoch_to_iso(epoch) -> Column:
    """Epoch seconds to ``yyyy-MM-ddTHH:mm:ss+00:00``; null or 0 to ''."""
    e = _col(epoch)
    return F.when(e.isNull() | (e == 0), F.lit("")).otherwise(
        F.date_format(F.timestamp_seconds(e), "yyyy-MM-dd'T'HH:mm:ssxxx"))


def date_to_epoch(day) -> Column:
    """``YYYY-MM-DD`` to the epoch second of UTC midnight; bad to null."""
    s = F.trim(_col(day))
    return F.unix_seconds(F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
                                 F.try_to_timestamp(s, F.lit("yyyy-M-d"))))


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ (UTC wall clock)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def bucket_start(ts, width: str) -> Column:
    """Start of the tumbling ``width`` bucket (e.g. ``'30 minutes'``) holding ``ts``."""
    return F.window(_col(ts), width).start


def minus_seconds(ts, seconds: int) -> Column:
    return _col(ts) - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def interval_seconds(width: str) -> int:
    """Seconds in a width such as ``'30 minutes'``, ``'6 hours'``, ``'1 day'``."""
    n, unit = width.split()
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(n) * mult
