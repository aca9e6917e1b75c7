"""Batch feature job: staged candles + staged level2 -> feature rows.

Steps (one Spark job, no driver loop):

1. as-of merge, nearest level2 row for each candle within ``tolerance``
   (J1), event time = later of the two (P14);
2. regular grid with linear fill (W4); candle times follow the grid (W5);
3. one chunked window pass computing, per candle period, the rolling candle
   and its indicators (W1, W2) and, per level2 period, the level2 features
   (W3).  Both families come from the same grid rows, so the source's inner
   join of the two on time (J3) is a projection here, not a shuffle;
4. non-finite -> null, drop incomplete rows (P19, P15);
5. keep rows newer than the output's high-water mark (P17).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.operators.asof import asof_join
from ticklake.operators.increment import only_new
from ticklake.operators.indicators import (DEFAULT_PARAMS, add_indicators, add_level2_features, chunked, label,
                                           block_rows, lookback_rows, params_for, period_steps, rolling_candle_cols)
from ticklake.operators.timegrid import fill_grid
from ticklake.schemas import L2_COLS
from ticklake.session import checkpoint_dir, setting

CANDLE = ["open", "high", "low", "close", "vol"]


def merge_inputs(candles: DataFrame, level2: DataFrame, *, tolerance: str = "59 seconds",
                 chunk: str = "1 hour", symbol: str = "symbol") -> DataFrame:
    """Candles (``close_time``) with the nearest level2 row (``datetime``)."""
    m = asof_join(candles.select(symbol, "open_time", "close_time", *CANDLE),
                  level2.select(symbol, "datetime", *L2_COLS),
                  on=symbol, left_ts="close_time", right_ts="datetime", direction="nearest",
                  tolerance=tolerance, how="inner", chunk=chunk)
    return m.withColumn("datetime", F.greatest("datetime", "close_time"))


def feature_frame(filled: DataFrame, *, step: str, candle_periods: Sequence[str], level2_periods: Sequence[str],
                  params: Mapping | None = None, chunk: str = "1 day", symbol: str = "symbol",
                  ts: str = "datetime") -> DataFrame:
    params = params or DEFAULT_PARAMS
    cps = [period_steps(p, step) for p in candle_periods]
    lps = [period_steps(p, step) for p in level2_periods]
    halo = max([p - 1 + lookback_rows(params_for(params, lbl)) for p, lbl in zip(cps, candle_periods)]
               + [p for p in lps]) + 1
    block = max(block_rows(params_for(params, lbl)) for lbl in candle_periods)
    h, w = chunked(filled, step, halo, chunk, symbol=symbol, ts=ts, block=block)
    feats: list[str] = []
    for p, lbl in zip(cps, candle_periods):
        sfx = f"_{label(lbl)}"
        h = h.withColumns(rolling_candle_cols(w, p, f"_rc{sfx}"))
        before = set(h.columns)
        h = add_indicators(h, w, params_for(params, lbl), sfx, src=f"_rc{sfx}", block=block, by=(symbol, "_c"))
        feats += [c for c in h.columns if c not in before]
        h = h.drop(*[f"{c}_rc{sfx}" for c in CANDLE])
    for p, lbl in zip(lps, level2_periods):
        before = set(h.columns)
        h = add_level2_features(h, w, p, f"_{label(lbl)}")
        feats += [c for c in h.columns if c not in before]
    return h.where(~F.col("_halo")).select(symbol, ts, *feats)


def features(candles: DataFrame, level2: DataFrame, *, step: str = "1 minute",
             candle_periods: Sequence[str] = ("1 minute",), level2_periods: Sequence[str] = ("1 minute",),
             params: Mapping | None = None, tolerance: str = "59 seconds", chunk: str = "1 day",
             hwm=None, symbol: str = "symbol", materialize: bool = True) -> DataFrame:
    merged = merge_inputs(candles, level2, tolerance=tolerance, chunk=chunk, symbol=symbol)
    if materialize:
        # lineage cut: the grid fill reads the merged bars three times (data
        # rows, bounds, chunk edges); a reliable checkpoint in the shared
        # checkpoint folder runs the merge once and bounds recovery work
        checkpoint_dir(merged.sparkSession)
        merged = merged.checkpoint(eager=True)
    filled = fill_grid(merged.select(symbol, "datetime", *CANDLE, *L2_COLS), step, ts="datetime",
                       cols=CANDLE + L2_COLS, chunk=chunk)
    if materialize:
        # stage boundary: the indicator window pass reads a materialized grid
        # (the fill's plan has several branches over its input)
        filled = filled.checkpoint(eager=True)
    f = feature_frame(filled, step=step, candle_periods=candle_periods, level2_periods=level2_periods,
                      params=params, chunk=chunk, symbol=symbol)
    from ticklake.operators.indicators import clean_features
    f = clean_features(f, keep=[symbol, "datetime"])
    if materialize:
        # the plan derives ~100 columns through stacked windows, over which
        # the optimizer's constraint propagation grows combinatorially: run
        # it without (for this job only), and cut the plan before any join
        with setting(f.sparkSession, "spark.sql.constraintPropagation.enabled", "false"):
            f = f.checkpoint(eager=True)
    return only_new(f, hwm, symbol=symbol)
