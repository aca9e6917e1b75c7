"""Order-book operators: explode, per-snapshot expectation, bar means.

Expectation (our definition; the library that defined it is not public):
per snapshot and side, the best price (max bid / min ask), the total volume
and the volume-weighted mean price.  Means over a bar average the snapshot
values, each column skipping nulls.

Fast path: the per-snapshot summary is computed on the price-level arrays
with higher-order functions (``aggregate``), one output row per message, so
the ``explode`` of every level into rows (x levels) never reaches a shuffle.
Snapshots sharing a timestamp are then combined by a small partial-sum
aggregation, which keeps the exact snapshot semantics of the row form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.time import bar_ts, col
from ticklake.schemas import L2_COLS


def explode_book(df: DataFrame, *, symbol: str = "symbol", ts: str = "datetime", bids: str = "bids",
                 asks: str = "asks") -> DataFrame:
    """One row per price level; a bid row has null ask columns and vice versa.
    One ``explode`` over the concatenated sides (single pass, no union)."""
    lvl = "struct<bid:double,bid_vol:double,ask:double,ask_vol:double>"
    b = F.transform(col(bids), lambda x: F.struct(x[0].alias("bid"), x[1].alias("bid_vol"),
                                                  F.lit(None).cast("double").alias("ask"),
                                                  F.lit(None).cast("double").alias("ask_vol")))
    a = F.transform(col(asks), lambda x: F.struct(F.lit(None).cast("double").alias("bid"),
                                                  F.lit(None).cast("double").alias("bid_vol"),
                                                  x[0].alias("ask"), x[1].alias("ask_vol")))
    levels = F.concat(F.coalesce(b, F.array().cast(f"array<{lvl}>")), F.coalesce(a, F.array().cast(f"array<{lvl}>")))
    return (df.select(col(symbol).alias(symbol), col(ts).alias(ts), F.explode(levels).alias("_l"))
            .select(symbol, ts, "_l.bid", "_l.bid_vol", "_l.ask", "_l.ask_vol"))


def _side_sums(levels: Column) -> dict[str, Column]:
    """Price-weighted and plain volume sums plus extremes of one side's levels."""
    zero = F.lit(0.0)
    return {
        "pv": F.aggregate(levels, zero, lambda acc, x: acc + x[0] * x[1]),
        "v": F.aggregate(levels, zero, lambda acc, x: acc + x[1]),
        "n": F.size(levels),
        "max": F.array_max(F.transform(levels, lambda x: x[0])),
        "min": F.array_min(F.transform(levels, lambda x: x[0])),
    }


def book_summary(df: DataFrame, *, symbol: str = "symbol", ts: str = "datetime", bids: str = "bids",
                 asks: str = "asks") -> DataFrame:
    """Per-message partial sums of both sides (no explode)."""
    b, a = _side_sums(col(bids)), _side_sums(col(asks))
    return df.select(col(symbol).alias(symbol), col(ts).alias(ts),
                     b["max"].alias("bid_max"), b["pv"].alias("bid_pv"), b["v"].alias("bid_v"),
                     F.when(b["n"] > 0, 1).alias("bid_n"),
                     a["min"].alias("ask_min"), a["pv"].alias("ask_pv"), a["v"].alias("ask_v"),
                     F.when(a["n"] > 0, 1).alias("ask_n"))


def _expectation_from_sums(g: DataFrame, symbol: str, ts: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return g.select(symbol, ts, *carry,
                    F.col("bid_max").alias("l2_bid_max"),
                    (F.col("bid_pv") / F.col("bid_v")).alias("l2_bid_expect"),
                    F.col("bid_v").alias("l2_bid_vol"),
                    F.col("ask_min").alias("l2_ask_min"),
                    (F.col("ask_pv") / F.col("ask_v")).alias("l2_ask_expect"),
                    F.col("ask_v").alias("l2_ask_vol"))


def book_expectation(df: DataFrame, *, symbol: str = "symbol", ts: str = "datetime", bids: str = "bids",
                     asks: str = "asks") -> DataFrame:
    """Snapshot expectation from messages with level arrays (G2, fast path)."""
    s = book_summary(df, symbol=symbol, ts=ts, bids=bids, asks=asks)
    g = (s.groupBy(symbol, ts)
         .agg(F.max("bid_max").alias("bid_max"),
              F.sum(F.when(F.col("bid_n").isNotNull(), F.col("bid_pv"))).alias("bid_pv"),
              F.sum(F.when(F.col("bid_n").isNotNull(), F.col("bid_v"))).alias("bid_v"),
              F.min("ask_min").alias("ask_min"),
              F.sum(F.when(F.col("ask_n").isNotNull(), F.col("ask_pv"))).alias("ask_pv"),
              F.sum(F.when(F.col("ask_n").isNotNull(), F.col("ask_v"))).alias("ask_v")))
    return _expectation_from_sums(g, symbol, ts)


def book_expectation_rows(rows: DataFrame, *, symbol: str = "symbol", ts: str = "datetime",
                          carry: tuple[str, ...] = ()) -> DataFrame:
    """Snapshot expectation from exploded level rows (files already in row
    form); ``carry`` columns are kept per snapshot (max)."""
    g = (rows.groupBy(symbol, ts)
         .agg(F.max("bid").alias("bid_max"), F.sum(F.col("bid") * F.col("bid_vol")).alias("bid_pv"),
              F.sum("bid_vol").alias("bid_v"),
              F.min("ask").alias("ask_min"), F.sum(F.col("ask") * F.col("ask_vol")).alias("ask_pv"),
              F.sum("ask_vol").alias("ask_v"), *[F.max(c).alias(c) for c in carry]))
    return _expectation_from_sums(g, symbol, ts, carry)


def level2_bars(expect: DataFrame, step: str = "1 minute", *, symbol: str = "symbol", ts: str = "datetime",
                lateness: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Right-closed, right-labelled bar means of the snapshot expectation."""
    df = expect.withColumn("_bar_ts", bar_ts(ts, "right"))
    if df.isStreaming:
        df = df.withWatermark("_bar_ts", lateness or "10 seconds")
    out = df.groupBy(col(symbol), F.window("_bar_ts", step).alias("_w")).agg(
        *[F.avg(c).alias(c) for c in L2_COLS], *[F.max(c).alias(c) for c in carry])
    return out.select(symbol, F.col("_w.end").alias("datetime"), *L2_COLS, *carry)


def stage_level2(msgs: DataFrame, step: str = "1 minute", **kw) -> DataFrame:
    """Messages with level arrays -> staged level2 bars (G2 then G3).

    On a stream one message is one snapshot, so the snapshot step is the
    per-row summary and only one stateful aggregation runs.
    """
    symbol = kw.get("symbol", "symbol")
    ts = kw.get("ts", "datetime")
    if msgs.isStreaming:
        s = book_summary(msgs, symbol=symbol, ts=ts)
        snap = _expectation_from_sums(s, symbol, ts)
    else:
        snap = book_expectation(msgs, symbol=symbol, ts=ts)
    return level2_bars(snap, step, symbol=symbol, ts=ts, lateness=kw.get("lateness"))
