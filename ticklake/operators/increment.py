"""Incremental-output operators: stitching history with new data, retention,
high-water marks, time bounds and gaps.

All per-symbol work is expressed as aggregations with map-side partial
aggregation or as joins against per-symbol summaries (one row per symbol or
per (symbol, chunk)).  Those summaries are small at run time, and AQE turns
the joins against them into broadcast joins after measuring them; a hot
symbol is never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.bars import row_hash
from ticklake.operators.chunks import chunk_of, parse_duration_us, ts_micros


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def append_new(history: DataFrame, new: DataFrame, keys: str | Sequence[str] = ("symbol", "datetime"),
               watermark: str | None = None) -> DataFrame:
    """History plus the new rows whose key is not in history (the old row
    wins).  Columns are matched by name; missing ones become null.

    Batch: ``left_anti`` join + ``unionByName``.  Stream (``new`` streaming):
    the anti-join against the static history is a stream-static join, and
    duplicates inside the stream are dropped within the watermark.
    """
    ks = _keys(keys)
    fresh = new.join(history.select(*ks).distinct() if history.isStreaming else history.select(*ks), ks, "left_anti")
    if new.isStreaming and watermark:
        fresh = fresh.withWatermark(ks[-1], watermark).dropDuplicatesWithinWatermark(ks)
    return history.unionByName(fresh, allowMissingColumns=True)


def keep_last(df: DataFrame, n: int, *, symbol: str = "symbol", ts: str = "datetime",
              chunk: str = "1 day", seq: Sequence[str] = ()) -> DataFrame:
    """Last ``n`` rows of each symbol by time (retention).  Rows of equal time
    are ordered by ``seq`` columns, then by a hash of their content.

    Sorting a symbol's whole history to find its tail would put it in one
    task.  Instead: count rows per (symbol, chunk) (partial aggregation),
    keep for each symbol only the newest chunks whose counts reach ``n``
    (a window over the small chunk table), semi-join the rows to those
    chunks, and rank only that tail.
    """
    chunk_us = parse_duration_us(chunk)
    c = df.withColumn("_c", chunk_of(ts_micros(df, ts), chunk_us))
    counts = c.groupBy(symbol, "_c").agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy(symbol).orderBy(F.col("_c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
              .where(F.col("_before") < n).select(symbol, "_c"))
    tail = c.join(needed, [symbol, "_c"], "left_semi")
    rank = Window.partitionBy(symbol).orderBy(F.col(ts).desc(), *[F.col(s).desc() for s in seq], row_hash(df).desc())
    return tail.withColumn("_rn", F.row_number().over(rank)).where(F.col("_rn") <= n).drop("_rn", "_c")


def last_produced(df: DataFrame, *, symbol: str = "symbol", ts: str = "datetime") -> DataFrame:
    """High-water mark of an output: latest time per symbol."""
    return df.groupBy(symbol).agg(F.max(ts).alias("hwm"))


def only_new(df: DataFrame, hwm, *, symbol: str = "symbol", ts: str = "datetime") -> DataFrame:
    """Rows strictly newer than the high-water mark.

    ``hwm`` is ``None`` (keep everything: nothing produced yet), a scalar
    timestamp, or a DataFrame ``(symbol, hwm)``; a symbol without a mark
    keeps all its rows.
    """
    if hwm is None:
        return df
    if isinstance(hwm, DataFrame):
        j = df.join(hwm.select(symbol, F.col("hwm").alias("_hwm")), symbol, "left")
        return j.where(F.col("_hwm").isNull() | (F.col(ts) > F.col("_hwm"))).drop("_hwm")
    # the mark as text cast to the column's own type: no zone conversion
    text = hwm.isoformat(sep=" ") if hasattr(hwm, "isoformat") else str(hwm)
    return df.where(F.col(ts) > F.lit(text).cast(df.schema[ts].dataType))


def time_bounds(df: DataFrame, *, symbol: str = "symbol", ts: str = "datetime") -> DataFrame:
    return df.groupBy(symbol).agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def time_gap(history: DataFrame, stream: DataFrame, *, symbol: str = "symbol", ts: str = "datetime",
             max_gap: str = "1 minute") -> DataFrame:
    """Per symbol: last history time, first stream time, the gap between them
    (negative overlap counts as 0) and whether it is below ``max_gap``.  A
    symbol that has only one side has no gap (null) and is not good."""
    h = history.groupBy(symbol).agg(F.max(ts).alias("history_max"))
    s = stream.groupBy(symbol).agg(F.min(ts).alias("stream_min"))
    j = h.join(s, symbol, "full_outer")
    both = F.col("history_max").isNotNull() & F.col("stream_min").isNotNull()
    gap_s = F.when(both, F.greatest(F.lit(0.0), ts_diff_seconds(F.col("history_max"), F.col("stream_min"))))
    return (j.withColumn("gap_seconds", gap_s)
            .withColumn("is_good", F.coalesce(F.col("gap_seconds") < parse_duration_us(max_gap) / 1e6, F.lit(False))))


def ts_diff_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def stitch(history: DataFrame, stream: DataFrame, *, symbol: str = "symbol", ts: str = "datetime",
           max_gap: str = "1 minute") -> tuple[DataFrame, DataFrame]:
    """History + stream stitched (old rows win), and the per-symbol gap
    report saying whether the result may be published."""
    return append_new(history, stream, [symbol, ts]), time_gap(history, stream, symbol=symbol, ts=ts, max_gap=max_gap)
