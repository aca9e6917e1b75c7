"""Time bars: last-state bars, OHLC bars, left-labelled resampling.

Every bar operator is one ``groupBy(symbol, window)`` aggregation, so Spark
runs a partial (map-side) aggregate before the shuffle: the shuffle carries
one row per (task, symbol, bar), never the raw rows, and a hot symbol is
spread over as many reducers as it has bars.  On a stream the same plan runs
as a stateful aggregation with a watermark (append mode emits a bar once the
watermark passes its end).

"Last" follows row order, not only time: ties on the timestamp are broken by
an ingest sequence (Kafka offset, file row id, event id), and each column
takes its own last non-null value, as a per-column ``last`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.time import bar_close as bar_close_col, bar_ts, col  # noqa: F401

CANDLE_COLS = ("open", "high", "low", "close", "vol")


def order_key(ts: str, seq: Sequence[str] = (), df: DataFrame | None = None) -> Column:
    """Ordering of rows for last/first: time, then ingest sequence.

    With one sequence column the pair is encoded as one ``decimal(38,0)``,
    ``micros * 2^64 + (seq + 2^63)``, which orders exactly like the tuple
    for any long ``seq``.  A fixed-width key keeps ``max_by``/``min_by`` in
    hash aggregation; a struct key would force Spark's sort-based
    aggregation (a sort of every row, map and reduce side).

    A null sequence sorts before every other one of the same time.  Without
    a sequence column, rows of equal time are ordered by a hash of their
    content (``df``'s columns), so that a rerun picks the same row.
    """
    if not seq and df is None:
        return col(ts)
    if len(seq) <= 1:
        # zone-free microseconds for either timestamp type
        from ticklake.operators.chunks import ts_micros
        raw = ts_micros(df, ts) if df is not None else F.unix_micros(col(ts).cast("timestamp"))
        us = raw.cast("decimal(38,0)")
        least = F.lit(-(2 ** 63)).cast("long")
        tie = F.coalesce(col(seq[0]).cast("long"), least) if seq else row_hash(df)
        shifted = tie.cast("decimal(38,0)") + F.expr("CAST(9223372036854775808 AS DECIMAL(38,0))")
        return (us * F.expr("CAST(18446744073709551616 AS DECIMAL(38,0))") + shifted).cast("decimal(38,0)")
    return F.struct(col(ts), *[col(s) for s in seq])


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row's content (columns that can be hashed)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                        if f.dataType.typeName() not in ("map", "variant")])


def last_value(c: str, ordering: Column) -> Column:
    """Last non-null value of ``c`` by ``ordering`` (rows where ``c`` is null
    get a null ordering, which ``max_by`` skips)."""
    return F.max_by(col(c), F.when(col(c).isNotNull(), ordering)).alias(c)


def first_value(c: str, ordering: Column) -> Column:
    return F.min_by(col(c), F.when(col(c).isNotNull(), ordering)).alias(c)


def _binned(df: DataFrame, ts: str, closed: str, lateness: str | None) -> DataFrame:
    df = df.withColumn("_bar_ts", bar_ts(ts, closed))
    if df.isStreaming:
        df = df.withWatermark("_bar_ts", lateness or "10 seconds")
    return df


def last_state_bars(df: DataFrame, step: str = "1 minute", *, symbol: str = "symbol", ts: str = "ts",
                    seq: Sequence[str] = (), cols: Sequence[str] = CANDLE_COLS,
                    closed: str = "right", lateness: str | None = None,
                    extra_aggs: Sequence[Column] = (), aggs: Sequence[Column] | None = None) -> DataFrame:
    """Bars that keep the last state of each column in the bin.

    ``closed="right"``: bin ``(t-step, t]`` labelled ``close_time=t``,
    ``open_time=t-step``.  The per-bar aggregation can be extended
    (``extra_aggs``) or replaced (``aggs``, instead of the last state of
    ``cols``) by the caller's aggregate columns.
    """
    ordering = order_key(ts, seq, df)
    if aggs is not None:
        cols, extra_aggs = (), (*aggs, *extra_aggs)
    b = _binned(df, ts, closed, lateness)
    out = (b.groupBy(col(symbol), F.window("_bar_ts", step).alias("_w"))
           .agg(*[last_value(c, ordering) for c in cols], *extra_aggs))
    return out.select(symbol, F.col("_w.start").alias("open_time"), F.col("_w.end").alias("close_time"),
                      *cols, *[a for a in out.columns if a not in (symbol, "_w", *cols)])


def stage_candles(df: DataFrame, step: str = "1 minute", **kw) -> DataFrame:
    """Staged candle per symbol and right-closed bar from cumulative raw
    candle states (open, high, low, close, vol so far in the minute)."""
    return last_state_bars(df, step, cols=CANDLE_COLS, **kw)


def ohlc_bars(df: DataFrame, step: str = "1 minute", *, symbol: str = "symbol", ts: str = "ts",
              price: str = "price", vol: str = "vol", seq: Sequence[str] = (), closed: str = "right",
              lateness: str | None = None) -> DataFrame:
    """OHLCV bars from trades/ticks: first, max, min, last price, summed volume."""
    ordering = order_key(ts, seq, df)
    b = _binned(df, ts, closed, lateness)
    out = (b.groupBy(col(symbol), F.window("_bar_ts", step).alias("_w"))
           .agg(F.min_by(col(price), F.when(col(price).isNotNull(), ordering)).alias("open"),
                F.max(price).alias("high"),
                F.min(price).alias("low"),
                F.max_by(col(price), F.when(col(price).isNotNull(), ordering)).alias("close"),
                F.sum(vol).alias("vol"),
                F.count(F.lit(1)).alias("n")))
    return out.select(symbol, F.col("_w.start").alias("open_time"), F.col("_w.end").alias("close_time"),
                      "open", "high", "low", "close", "vol", "n")


def resample_candles(candles: DataFrame, step: str, *, symbol: str = "symbol") -> DataFrame:
    """Coarser candles from finer staged candles (open of the first, close of
    the last, extremes, summed volume; earliest open_time, latest close_time)."""
    out = (candles.groupBy(col(symbol), F.window(bar_ts("close_time", "right"), step).alias("_w"))
           .agg(F.min_by("open", "open_time").alias("open"),
                F.max("high").alias("high"),
                F.min("low").alias("low"),
                F.max_by("close", "close_time").alias("close"),
                F.sum("vol").alias("vol"),
                F.min("open_time").alias("open_time"),
                F.max("close_time").alias("close_time")))
    return out.select(symbol, "open_time", "close_time", "open", "high", "low", "close", "vol")


def resample_last(df: DataFrame, step: str = "1 minute", *, symbol: str = "symbol", ts: str = "ts",
                  seq: Sequence[str] = (), cols: Sequence[str] | None = None,
                  out_ts: str = "datetime") -> DataFrame:
    """Left-closed, left-labelled resample keeping the last non-null value of
    each column (the grid-fill input, W4)."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in (symbol, ts, *seq)]
    ordering = order_key(ts, seq, df)
    out = (df.groupBy(col(symbol), F.window(col(ts), step).start.alias(out_ts))
           .agg(*[last_value(c, ordering) for c in cols]))
    return out
