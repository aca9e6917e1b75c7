"""Time chunks: the unit of parallelism for per-symbol time-series work.

A window ``partitionBy(symbol)`` puts a symbol's whole history in one task,
and one symbol may hold a third of all rows.  Operators here partition by
``(symbol, chunk)`` instead, where ``chunk = floor(ts / chunk_size)``, and
make each chunk self-contained:

- bounded look-back/ahead (as-of tolerance, rolling frames, finite-lookback
  smoothing): rows within the bound of a chunk edge are *copied* into the
  neighbouring chunk as halo rows (exact; overhead = bound / chunk size);
- unbounded carry (last non-null value before a gap): a per-chunk summary
  (one row per chunk) is propagated across chunks with a window over the
  small chunk table, then joined back on ``(symbol, chunk)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.time import col, micros_ntz


def parse_duration_us(d: str | int | float) -> int:
    """``"59 seconds"`` / ``"1 hour"`` / number of seconds -> microseconds."""
    if isinstance(d, (int, float)):
        return int(round(d * 1_000_000))
    n, unit = d.split()
    unit = unit.lower().rstrip("s")
    mult = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}[unit]
    return int(float(n) * mult)


def ts_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since epoch of a time column of either timestamp type."""
    dt = df.schema[ts].dataType
    if isinstance(dt, T.TimestampNTZType):
        return micros_ntz(ts)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(col(ts))
    return col(ts).cast("long")


def chunk_of(us: Column, chunk_us: int) -> Column:
    return F.floor(us / F.lit(chunk_us)).cast("long")


def chunks_reaching(us: Column, chunk_us: int, back_us: int, ahead_us: int) -> Column:
    """Array of the chunks whose rows may need this row: rows up to
    ``ahead_us`` later (they look back at it) and ``back_us`` earlier (they
    look ahead at it)."""
    lo = chunk_of(us - F.lit(back_us), chunk_us)
    hi = chunk_of(us + F.lit(ahead_us), chunk_us)
    return F.sequence(lo, hi)


def with_chunk(df: DataFrame, ts: str, chunk_us: int) -> DataFrame:
    return df.withColumn("_c", chunk_of(ts_micros(df, ts), chunk_us))


def with_halo(df: DataFrame, ts: str, chunk_us: int, halo_us: int) -> DataFrame:
    """Rows tagged with their chunk ``_c``; rows within ``halo_us`` before the
    end of a chunk are also copied into the following chunk(s) with
    ``_halo=True``, so a window over ``(symbol, _c)`` sees ``halo_us`` of
    history before its first own row.  Drop ``_halo`` rows after the window."""
    us = ts_micros(df, ts)
    own = chunk_of(us, chunk_us)
    reach = F.sequence(own, chunk_of(us + F.lit(halo_us), chunk_us))
    return (df.withColumn("_c", F.explode(reach))
            .withColumn("_halo", F.col("_c") != own))
