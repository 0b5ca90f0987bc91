"""Dates, window grids, decay and life cycles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the profile arithmetic.
BOOST, DECAY, MAX_DAYS, PRUNE = 0.4, 0.98, 7, 0.01
INITIAL, INITIAL_MULTI = 0.6, 0.75


def parse_date(x: Column) -> Column:
    """``yyyyMMdd`` or ISO text; null where it is neither."""
    return F.coalesce(F.when(F.length(x) == 8, F.try_to_timestamp(x, F.lit("yyyyMMdd"))), F.try_to_timestamp(F.substring(x, 1, 10), F.lit("yyyy-MM-dd"))).cast("date")


def days_between(later: Column, earlier: Column) -> Column:
    return F.least(F.greatest(F.datediff(later, earlier), F.lit(0)), F.lit(MAX_DAYS))


def window_index(day: Column, anchor: Column, days: int = 7) -> Column:
    return F.floor(F.datediff(day, anchor) / days).cast("int")


def window_end(anchor: Column, index: Column, last: Column, days: int = 7) -> Column:
    """Last day of a window; the last window of the grid is cut at the last date."""
    return F.least(F.date_add(anchor, (index * days + days - 1).cast("int")), last)


def clamped(x: Column) -> Column:
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)), 4)


def decayed(confidence: Column, days: Column) -> Column:
    return clamped(confidence * F.pow(F.lit(DECAY), days))


def boosted(confidence: Column) -> Column:
    return clamped(F.lit(BOOST) * confidence + (1 - BOOST))


def lifecycle(first: Column, last: Column, now: Column) -> Column:
    idle = F.datediff(now, last)
    return (
        F.when((first == last) & (last < now), "Ephemeral").when(idle > 60, "Archived").when(idle > 30, "Dormant").when(idle > 7, "Declining")
        .when(F.datediff(last, first) > 30, "Stable").otherwise("Emerging")
    )


def evidence_strength(count: Column, mean: Column) -> Column:
    return F.bround(F.least(F.lit(1.0), F.log(1 + count) / F.log(F.lit(6.0)) * mean), 4)
