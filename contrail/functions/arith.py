"""Exact integer arithmetic and the two rounded gold metrics.

The gold table reports a mean delay and a delayed share rounded half-up to two
decimals. Computing ``round(avg(seconds / 60.0), 2)`` in floating point makes
the result depend on summation order at ties, so two engines (or two runs with
different partitioning) may disagree by 0.01. Here both metrics are computed
from integer sums with one final division, which is order independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(a: Column, b: Column) -> Column:
    """Integer floor division for positive ``b`` (exact: the dividend is a multiple of ``b``)."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def mean_minutes_2dp(sum_seconds: Column, n: Column) -> Column:
    """``round(sum_seconds / 60 / n, 2)`` half away from zero, exactly; NULL when ``n == 0``.

    For s >= 0: floor(100 * s / (60 n) + 1/2) = floor((10 s + 3 n) / (6 n)).
    """
    s = sum_seconds.cast("long")
    cnt = n.cast("long")
    magnitude = floor_div(F.abs(s) * 10 + cnt * 3, cnt * 6)
    # integer sign: a tiny negative mean rounds to 0.0, never to -0.0
    return F.when(cnt > 0, F.signum(s).cast("long") * magnitude / F.lit(100.0))


def percentage_2dp(part: Column, total: Column) -> Column:
    """``round(part / total * 100, 2)`` half up, exactly; 0.0 when ``total`` is 0 or NULL."""
    p = F.coalesce(part.cast("long"), F.lit(0))
    t = F.coalesce(total.cast("long"), F.lit(0))
    return (F.when(t > 0, floor_div(p * 20000 + t, t * 2) / F.lit(100.0))
            .otherwise(F.lit(0.0)))


def mean_minutes_reference(delay_minutes_avg: Column) -> Column:
    """The reference form ``round(avg(minutes), 2)`` (float, order dependent at ties)."""
    return F.round(delay_minutes_avg, 2)


def percentage_reference(part: Column, total: Column) -> Column:
    t = F.coalesce(total, F.lit(0))
    return F.when(t > 0, F.round(part / total * F.lit(100.0), 2)).otherwise(F.lit(0.0))
