"""Time column builders.

All are pure ``Column -> Column`` expressions, so they stay inside whole-stage
codegen and work the same on batch and streaming frames.  Timestamps are UTC
instants; batch inputs from parquet arrive as ``timestamp_ntz`` and stay so,
streams need ``timestamp`` (watermarks reject NTZ), see :func:`to_instant`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def one_micro() -> Column:
    return F.expr("INTERVAL 1 MICROSECOND")


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


# Fixed value: a numeric epoch above this is milliseconds, otherwise seconds.
MILLIS_THRESHOLD = 9999999999


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interval(step: str) -> Column:
    """``"1 minute"`` -> interval literal column."""
    return F.expr(f"INTERVAL {step}")


def micros_ntz(ts) -> Column:
    """Microseconds since epoch of a ``timestamp_ntz`` column (zone-free)."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), col(ts))


def ntz_from_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", col(us), epoch_ntz())


def ntz_from_millis(ms) -> Column:
    return F.timestamp_add("MILLISECOND", col(ms), epoch_ntz())


def millis_ntz(ts) -> Column:
    """Milliseconds since epoch, floored (as a millisecond clock would stamp it)."""
    return F.floor(micros_ntz(ts) / 1000).cast("long")


def to_instant(ts) -> Column:
    """``timestamp_ntz`` (UTC wall clock) -> ``timestamp``; needs a UTC session zone."""
    return col(ts).cast("timestamp")


def to_wall(ts) -> Column:
    """``timestamp`` -> ``timestamp_ntz`` in UTC (for sinks and oracle comparison)."""
    return col(ts).cast("timestamp_ntz")


def event_time_ms(tick_ts, envelope_ts) -> Column:
    """Event time = ``tick.ts`` if present else envelope ``ts``; both ms epoch."""
    return ntz_from_millis(F.coalesce(col(tick_ts), col(envelope_ts)))


def event_time_auto(*fields) -> Column:
    """First non-null of ``fields`` (priority order), unit inferred per value.

    A value above :data:`MILLIS_THRESHOLD` is milliseconds, otherwise seconds;
    fractional seconds are kept to the microsecond.  No field -> null (the
    source used year 1 as a sentinel; a null is what a table should hold).
    """
    v = F.coalesce(*[col(f).cast("double") for f in fields])
    us = F.when(v > MILLIS_THRESHOLD, F.round(v * 1000)).otherwise(F.round(v * 1000000)).cast("long")
    return ntz_from_micros(us)


def bar_ts(ts, closed: str = "right") -> Column:
    """Column to bin on.  Right-closed bins ``(t-step, t]`` bin ``ts - 1us``
    in Spark's left-closed windows, so the label is the window end."""
    return col(ts) - one_micro() if closed == "right" else col(ts)


def bar_close(ts, step: str = "1 minute") -> Column:
    """Right-closed bar label: ``ceil(ts, step)``."""
    return F.window(bar_ts(ts, "right"), step).end


def floor_time(ts, step: str = "1 minute") -> Column:
    """Left label: ``floor(ts, step)`` (aligned to the epoch)."""
    return F.window(col(ts), step).start
