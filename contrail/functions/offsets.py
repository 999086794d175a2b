"""UTC offset text → hours as DOUBLE.

Accepted shapes: ``+01:00``, ``-03:30``, ``+2:30``, ``+0530``, ``+01``, ``1``,
``00:00`` and ``Z``. Anything else (including the empty string) is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign, one or two hour digits, optional colon and two minute digits.
UTC_OFFSET_PATTERN = r"^([+-]?)([0-9]{1,2})(:?([0-9]{2}))?$"
UTC_ZERO_TEXTS = ("Z", "z")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_offset_hours(text: Column | str) -> Column:
    t = F.trim(_col(text))
    sign = F.when(F.regexp_extract(t, UTC_OFFSET_PATTERN, 1) == "-", F.lit(-1.0)).otherwise(F.lit(1.0))
    hours = F.regexp_extract(t, UTC_OFFSET_PATTERN, 2).try_cast("double")
    minutes_text = F.regexp_extract(t, UTC_OFFSET_PATTERN, 4)
    minutes = F.when(minutes_text == "", F.lit(0.0)).otherwise(minutes_text.try_cast("double"))
    return (F.when(t.isin(*UTC_ZERO_TEXTS), F.lit(0.0))
            .when(t.rlike(UTC_OFFSET_PATTERN),
                  sign * (hours + minutes / F.lit(60.0)) + F.lit(0.0)))  # -00:00 → 0.0

