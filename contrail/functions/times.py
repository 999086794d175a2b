"""Time parsing and arithmetic on session-zone-free ``TIMESTAMP_NTZ`` values.

Why NTZ: the landed texts carry wall-clock times ("local") and UTC times with
a literal ``Z``. Parsing either into a session-zone ``TIMESTAMP`` makes the
result depend on ``spark.sql.session.timeZone`` (a delay across a DST switch
changes by an hour, a local time in a DST gap moves by an hour). NTZ values
and ``timestampdiff`` on them are independent of the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exact text shapes the landed pages use for times.
LOCAL_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}$"
UTC_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}Z$"
LOCAL_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
UTC_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm'Z'"



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_local_time(text: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm`` → TIMESTAMP_NTZ; anything else (or an impossible date) → NULL."""
    t = _col(text)
    return F.when(t.rlike(LOCAL_TIME_PATTERN), t.try_cast("timestamp_ntz"))


def parse_utc_time(text: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mmZ`` → TIMESTAMP_NTZ holding the UTC wall clock; else NULL."""
    t = _col(text)
    return F.when(t.rlike(UTC_TIME_PATTERN), F.substring(t, 1, 16).try_cast("timestamp_ntz"))


def format_local_time(ts: Column | str) -> Column:
    """Inverse of :func:`parse_local_time` (minute precision), zone free."""
    t = _col(ts)
    return F.concat(
        F.to_date(t).cast("string"), F.lit("T"),
        F.lpad(F.hour(t).cast("string"), 2, "0"), F.lit(":"),
        F.lpad(F.minute(t).cast("string"), 2, "0"),
    )


def format_utc_time(ts: Column | str) -> Column:
    return F.concat(format_local_time(ts), F.lit("Z"))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ value, fraction dropped (like ``unix_timestamp``).

    Built from the calendar fields of the NTZ value, all integer and free of
    the session zone (``timestamp_diff`` would cast NTZ to a zoned TIMESTAMP).
    """
    t = _col(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600
            + F.minute(t) * 60 + F.second(t))


def delay_seconds(actual: Column | str, scheduled: Column | str) -> Column:
    """``epoch_seconds(actual) - epoch_seconds(scheduled)``; NULL when either side is NULL."""
    return epoch_seconds(actual) - epoch_seconds(scheduled)


def _block(day: Column, hour: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("T"),
                    F.lpad((hour - hour % 4).cast("string"), 2, "0"), F.lit(":00"))


def time_block_4h(ts: Column | str) -> Column:
    """Start of the 4-hour block holding ``ts`` as ``yyyy-MM-ddTHH:00`` (HH in 00,04,...,20)."""
    t = _col(ts)
    return _block(F.to_date(t), F.hour(t))


def previous_day_block_4h(ts: Column | str) -> Column:
    """The same 4-hour block one day earlier (the block a run fetches)."""
    t = _col(ts)
    return _block(F.date_sub(F.to_date(t), 1), F.hour(t))


def block_date(block: Column | str) -> Column:
    """Date part of a ``yyyy-MM-ddTHH:00`` block (NULL when malformed)."""
    return F.try_to_date(F.try_element_at(F.split(_col(block), "T"), F.lit(1)))


def block_hour_text(block: Column | str) -> Column:
    """Hour text (``"04"``) of a ``yyyy-MM-ddTHH:00`` block (NULL when malformed)."""
    time_part = F.try_element_at(F.split(_col(block), "T"), F.lit(2))
    return F.try_element_at(F.split(time_part, ":"), F.lit(1))
