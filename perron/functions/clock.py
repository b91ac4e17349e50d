"""Clock text and calendar helpers (built-in expressions only).

Planned times are kept as ``HH24:MI:SS`` text plus a day offset, because a
run can pass midnight; everything is turned into whole minutes/seconds of
the run with integer arithmetic so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clock_minutes(t) -> Column:
    """'HH:MM[:SS]' -> minutes of the day (null stays null)."""
    t = _c(t)
    return F.substring(t, 1, 2).cast("int") * 60 + F.substring(t, 4, 2).cast("int")


def clock_seconds(t) -> Column:
    t = _c(t)
    return (F.substring(t, 1, 2).cast("int") * 3600 + F.substring(t, 4, 2).cast("int") * 60
            + F.coalesce(F.substring(t, 7, 2).cast("int"), F.lit(0)))


def run_minutes(t, day) -> Column:
    """Minutes since the start of the operating date: day offset * 1440 + clock."""
    return F.coalesce(_c(day), F.lit(0)) * 1440 + clock_minutes(t)


def date_key(d) -> Column:
    """DATE -> YYYYMMDD as BIGINT (the calendar dimension's natural key)."""
    return F.date_format(_c(d), "yyyyMMdd").cast("bigint")


def epoch_seconds(ts) -> Column:
    return F.unix_timestamp(_c(ts))


def date_epoch_seconds(d) -> Column:
    return F.unix_date(_c(d)).cast("bigint") * 86400


def planned_instant_seconds(op_date, t, day) -> Column:
    """Epoch seconds of a planned call: run date + day offset + clock."""
    return date_epoch_seconds(op_date) + F.coalesce(_c(day), F.lit(0)) * 86400 + clock_seconds(t)


def iso_dow(d) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(_c(d)) + 1
