"""Column functions over time (P1, P2, P3, P9, M8 and format helpers).

Every function returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P1 ------------------------------------------------------------------------
def to_local(ts: ColumnOrName, tz: str) -> Column:
    """UTC instant -> wall clock of ``tz``."""
    return F.from_utc_timestamp(_c(ts), tz)


def to_utc(ts: ColumnOrName, tz: str) -> Column:
    """Wall clock of ``tz`` -> UTC instant."""
    return F.to_utc_timestamp(_c(ts), tz)


# P2 ------------------------------------------------------------------------
def align_time(ts: ColumnOrName, minutes: int = 1) -> Column:
    """Align down to ``minutes`` *within the hour*; seconds are always zeroed.

    A step that does not divide 60 restarts at every full hour (10:56 with
    step 7 -> 10:56, 11:03 -> 11:00).
    """
    c = _c(ts)
    if minutes is None or minutes <= 1:
        return F.date_trunc("minute", c)
    mins = (F.floor(F.minute(c) / F.lit(minutes)) * F.lit(minutes)).cast("int")
    return F.date_trunc("hour", c) + F.make_dt_interval(F.lit(0), F.lit(0), mins, F.lit(0))


def floor_minutes(ts: ColumnOrName, minutes: int) -> Column:
    """Epoch-aligned floor to an N-minute bin (resample bin start)."""
    us = minutes * 60 * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(_c(ts)) / F.lit(us)).cast("long") * F.lit(us))


# P3 ------------------------------------------------------------------------
def hour_of_day(ts: ColumnOrName) -> Column:
    return F.hour(_c(ts)).cast("int")


def day_of_week(ts: ColumnOrName) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts)).cast("int")


def is_weekend(ts: ColumnOrName) -> Column:
    return F.when(F.weekday(_c(ts)) >= 5, F.lit(1)).otherwise(F.lit(0)).cast("int")


def calendar_columns(ts: ColumnOrName, tz: str | None = None) -> list[Column]:
    """hour, day_of_week, is_weekend (optionally in a local zone)."""
    c = _c(ts)
    if tz:
        c = to_local(c, tz)
    return [hour_of_day(c).alias("hour"), day_of_week(c).alias("day_of_week"), is_weekend(c).alias("is_weekend")]


# P9 ------------------------------------------------------------------------
_PERIOD = re.compile(r"^\s*(\d+)\s*([dw])\s*$")


def parse_period(text: str) -> _dt.timedelta:
    """'3d' -> 3 days, '2w' -> 14 days; any other unit is rejected."""
    m = _PERIOD.match(text or "")
    if not m:
        raise ValueError(f"unsupported period {text!r}; use <n>d or <n>w")
    n, unit = int(m.group(1)), m.group(2)
    return _dt.timedelta(days=n if unit == "d" else 7 * n)


def hours_between(a: ColumnOrName, b: ColumnOrName) -> Column:
    return (F.unix_micros(_c(b)) - F.unix_micros(_c(a))) / F.lit(3_600_000_000.0)


# M8 ------------------------------------------------------------------------
# Fixed values (forecast step by horizon): up to 1 h -> 5 min, up to 6 h -> 15,
# up to 24 h -> 30, up to 168 h -> 60, longer -> 60.
HORIZON_STEPS = [(1, 5), (6, 15), (24, 30), (168, 60)]
LONG_HORIZON_STEP = 60


def step_minutes(hours: ColumnOrName) -> Column:
    h = _c(hours)
    expr = None
    for max_h, step in HORIZON_STEPS:
        expr = F.when(h <= max_h, F.lit(step)) if expr is None else expr.when(h <= max_h, F.lit(step))
    return expr.otherwise(F.lit(LONG_HORIZON_STEP)).cast("int")


def step_minutes_py(hours: float) -> int:
    for max_h, step in HORIZON_STEPS:
        if hours <= max_h:
            return step
    return LONG_HORIZON_STEP


def version_stamp(ts: ColumnOrName) -> Column:
    """Model version / batch id text ``yyyyMMddHHmmss``."""
    return F.date_format(_c(ts), "yyyyMMddHHmmss")


def ts_lit(value: str | _dt.datetime) -> Column:
    """A UTC timestamp literal."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(value))
