"""Streaming as-of join of staged candles with staged level2 rows.

Plan: a stream-stream interval join (``|level2.datetime - close_time| <=
tolerance`` on the symbol), then the nearest level2 row per candle with
``min_by`` over ``(distance, level2 time)`` -- the earlier row on a tie, as
in the batch operator.  Watermarks on both inputs bound the join state and
finalize each candle's match: a row is emitted once the watermark passes
``close_time``, deterministically (the result does not depend on which side
arrived first).  Only one event-time column may remain after the join, so
the level2 time travels as microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.operators.chunks import chunk_of, chunks_reaching, parse_duration_us
from ticklake.schemas import L2_COLS

CANDLE = ["open", "high", "low", "close", "vol"]


def asof_join_stream(candles: DataFrame, level2: DataFrame, *, tolerance: str = "59 seconds",
                     watermark: str = "2 minutes", symbol: str = "symbol", chunk: str = "1 hour") -> DataFrame:
    """``candles``: ``symbol, close_time (timestamp), open..vol``;
    ``level2``: ``symbol, datetime (timestamp), l2_*``.

    The join key is ``(symbol, time chunk)``, not the symbol alone: a level2
    row is copied into each chunk holding candles within the tolerance of it
    (exact), so the join state of a hot symbol is spread over its chunks.
    """
    tol = F.expr(f"INTERVAL {tolerance}")
    tol_us, chunk_us = parse_duration_us(tolerance), parse_duration_us(chunk)
    c = (candles.withWatermark("close_time", watermark)
         .withColumn("_c", chunk_of(F.unix_micros("close_time"), chunk_us)).alias("c"))
    l2 = (level2.withWatermark("datetime", watermark)
          .select(F.col(symbol).alias("_l_sym"), F.col("datetime").alias("_l_dt"), *L2_COLS,
                  F.explode(chunks_reaching(F.unix_micros("datetime"), chunk_us, tol_us, tol_us)).alias("_l_c"))
          .alias("l"))
    j = c.join(l2, (F.col(f"c.{symbol}") == F.col("_l_sym")) & (F.col("c._c") == F.col("_l_c"))
               & (F.col("_l_dt") >= F.col("c.close_time") - tol)
               & (F.col("_l_dt") <= F.col("c.close_time") + tol), "inner")
    j = j.select(F.col(f"c.{symbol}").alias(symbol), "c.close_time", *[F.col(f"c.{x}") for x in CANDLE],
                 F.unix_micros("_l_dt").alias("_l_us"), *L2_COLS)
    # nearest, then earlier: (distance, time) as one fixed-width key so the
    # aggregation keeps primitive buffers
    dist = F.abs(F.col("_l_us") - F.unix_micros("close_time")).cast("decimal(38,0)")
    key = (dist * F.expr("CAST(18446744073709551616 AS DECIMAL(38,0))")
           + (F.col("_l_us").cast("decimal(38,0)") + F.expr("CAST(9223372036854775808 AS DECIMAL(38,0))"))).cast("decimal(38,0)")
    out = (j.groupBy(symbol, "close_time")
           .agg(F.min_by("_l_us", key).alias("_l_us"), *[F.min_by(x, key).alias(x) for x in L2_COLS],
                *[F.first(x).alias(x) for x in CANDLE]))
    l2_dt = F.timestamp_micros(F.col("_l_us"))
    return out.select(symbol, "close_time", *CANDLE, *L2_COLS,
                      F.greatest(l2_dt, F.col("close_time")).alias("datetime"))
