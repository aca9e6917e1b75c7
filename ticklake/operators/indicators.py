"""Rolling candles and technical indicators over a regular time grid.

The library the source system used for these is not public, so the
formulas are textbook definitions (ours):

- typical price ``tp = (high + low + close) / 3``;
- ``EWM(x, alpha, n)``: exponentially weighted mean over all rows so far,
  weights ``(1 - alpha)^i`` (``i = 0`` newest) normalised to sum 1, null
  while fewer than ``n`` inputs exist.  It is evaluated as the recursion
  ``s_i = (1 - alpha) s_(i-1) + x_i`` in blocks of grid rows: a running sum
  of rescaled inputs inside the block, plus the state carried from the end
  of the block before (:func:`add_ewms`).  The blocks are so long that what
  an older block adds is far below the rounding of a double, so a halo of
  one block (per level of smoothing) makes every chunk exact.  Where a ratio
  of means is taken, a mean below ``VANISHED`` of the price is zero: after a
  long flat stretch it holds nothing but old, faded inputs;
- CCI(n) = (tp - mean_n tp) / (0.015 * mean_n |tp - mean_n tp|), null on
  zero deviation (Lambert 1980);
- Ichimoku(n1, n2, n3): conversion = mid(n1), base = mid(n2),
  span A = (conversion + base) / 2, span B = mid(n3), mid(n) =
  (max high + min low) / 2 over n rows, not shifted;
- RSI(n) = 100 - 100 / (1 + EWM(gain) / EWM(loss)), alpha = 1/n, 100 when
  there is no loss (Wilder 1978);
- ADX(n): true range and directional movement from the previous bar;
  DI+- = 100 EWM(DM+-) / EWM(TR); DX = 100 |DI+ - DI-| / (DI+ + DI-);
  ADX = EWM(DX); alpha = 1/n; zero denominators give 0 (Wilder 1978);
- Stochastic(n, s): %K = 100 (close - min low) / (max high - min low) over
  n rows (null on a flat range), %D = mean of s %K (Lane);
- MACD(slow, fast, sign=9): EWM(fast) - EWM(slow) with alpha = 2/(n+1),
  signal = EWM(sign) of it, diff = macd - signal (Appel);
- Bollinger(n=20, d=2): mean +- d population standard deviations;
- level2 features per period: rolling means of the six ``l2_*`` columns,
  spread ``ask_min - bid_max`` and imbalance
  ``(bid_vol - ask_vol) / (bid_vol + ask_vol)`` of those means.

Windows are row frames: the input must be on a regular grid (``fill_grid``).
A period (``"5 minutes"``) is a number of grid steps.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ticklake.operators.chunks import parse_duration_us, ts_micros, with_halo
from ticklake.schemas import L2_COLS

# Defaults (ours, textbook).
DEFAULT_PARAMS: dict[str, dict[str, int]] = {
    "cca": {"window": 20},
    "ichimoku": {"window1": 9, "window2": 26, "window3": 52},
    "adx": {"window": 14},
    "rsi": {"window": 14},
    "stoch": {"window": 14, "smooth_window": 3},
    "macd": {"slow": 26, "fast": 12, "sign": 9},
    "bb": {"window": 20, "window_dev": 2},
}
#: Inputs of a weight below exp(-EWM_DECAY) add nothing to a mean of at least VANISHED of them.
EWM_DECAY = 60.0
#: A smoothed range, movement, gain or loss below this share of the price is zero.
VANISHED = 1e-12
#: exp of this much is still a finite double, with room for the inputs.
EWM_RANGE = 600.0


def label(period: str) -> str:
    return period.replace(" ", "").replace(".", "_")


def frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def full(x: Column, w: WindowSpec, n: int, agg) -> Column:
    """``agg(x)`` over the last ``n`` rows, null unless all ``n`` are present."""
    f = frame(w, n)
    return F.when(F.count(x).over(f) == n, agg(x).over(f))


def ewm_rows(alpha: float) -> int:
    """Rows after which an input's weight has vanished."""
    return 1 if alpha >= 1 else math.ceil(EWM_DECAY / -math.log(1.0 - alpha))


def faded(mean: Column, price: Column) -> Column:
    """A smoothed mean for use in a ratio: zero once it has vanished."""
    return F.when(mean <= VANISHED * F.abs(price), F.lit(0.0)).otherwise(mean)


def ewm_alphas(params: Mapping) -> list[float]:
    """Smoothing factors that the indicators of ``params`` use."""
    out = [1.0 / _p(params, k, "window") for k in ("rsi", "adx") if k in params]
    if "macd" in params:
        m = params["macd"]
        out += [2.0 / (int(m.get(k, DEFAULT_PARAMS["macd"][k])) + 1) for k in ("slow", "fast", "sign")]
    return out


def block_rows(params: Mapping) -> int:
    """Block length that serves all smoothings of ``params``."""
    return max([ewm_rows(a) for a in ewm_alphas(params)], default=1)


def add_ewms(df: DataFrame, w: WindowSpec, specs: Mapping[str, tuple[str, float, int]], block: int,
             by: Sequence[str] = ("symbol", "_c")) -> DataFrame:
    """Add columns ``name: (input column, alpha, n)``: EWMs, O(1) a row.

    ``df`` and ``w`` come from :func:`chunked` with blocks of ``block`` rows:
    ``_i`` is the number of the grid row.  Inputs may be null before a series
    begins; a null inside it makes the later means null.
    """
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    blocks, scaled, local, carried, out, tmp = {}, {}, {}, {}, {}, []
    for name, (x, alpha, n) in specs.items():
        c = F.col(x)
        if alpha >= 1:
            out[name] = c
            continue
        ln = math.log(1.0 - alpha)
        # over a long block a fast decay would overflow: it gets blocks of its own
        length = min(block, int(EWM_RANGE / -ln))
        blk = "_blk" if length == block else f"_blk{length}"
        if length != block:
            blocks[blk] = F.floor(F.col("_i") / length)
        off = F.col("_i") - F.col(blk) * length
        in_block = Window.partitionBy(*by, blk).orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        scaled[f"_z_{name}"] = F.coalesce(c, F.lit(0.0)) * F.exp(off * -ln)
        local[f"_s_{name}"] = F.sum(f"_z_{name}").over(in_block) * F.exp(off * ln)
        carried[f"_e_{name}"] = F.last(F.when(off == length - 1, F.col(f"_s_{name}")), ignorenulls=True).over(before)
        carried[f"_m_{name}"] = F.count(c).over(so_far)
        carried[f"_f_{name}"] = F.min(F.when(c.isNotNull(), F.col("_i"))).over(so_far)
        tmp += [f"_{k}_{name}" for k in "zsemf"]
        m = F.col(f"_m_{name}")
        whole = (m >= n) & (m == F.col("_i") - F.col(f"_f_{name}") + 1)
        total = F.col(f"_s_{name}") + F.coalesce(F.col(f"_e_{name}") * F.exp((off + 1) * ln), F.lit(0.0))
        out[name] = F.when(whole, total * alpha / (1 - F.exp(m * ln)))
    for level in (blocks, scaled, local, carried, out):
        if level:
            df = df.withColumns(level)
    return df.drop(*tmp, *blocks)


# ------------------------------------------------------------------ rolling candles

def rolling_candle_cols(w: WindowSpec, p: int, suffix: str = "") -> dict[str, Column]:
    """Candle over the last ``p`` grid steps: first open, max high, min low,
    last close, summed volume; null until ``p`` rows exist."""
    n_ok = F.count(F.lit(1)).over(frame(w, p)) == p
    return {
        f"open{suffix}": F.when(n_ok, F.lag("open", p - 1).over(w)),
        f"high{suffix}": F.when(n_ok, F.max("high").over(frame(w, p))),
        f"low{suffix}": F.when(n_ok, F.min("low").over(frame(w, p))),
        f"close{suffix}": F.when(n_ok, F.col("close")),
        f"vol{suffix}": F.when(n_ok, F.sum("vol").over(frame(w, p))),
    }


# ------------------------------------------------------------------ indicators

def _p(params: Mapping, key: str, name: str) -> int:
    return int(params.get(key, {}).get(name, DEFAULT_PARAMS[key][name]))


def lookback_rows(params: Mapping) -> int:
    """Rows of history one output row depends on (halo size)."""
    lb = [1]
    if "cca" in params:
        lb.append(_p(params, "cca", "window"))
    if "ichimoku" in params:
        lb.append(max(_p(params, "ichimoku", k) for k in ("window1", "window2", "window3")))
    if "rsi" in params:
        lb.append(ewm_rows(1.0 / _p(params, "rsi", "window")) + 1)
    if "adx" in params:
        lb.append(2 * ewm_rows(1.0 / _p(params, "adx", "window")) + 1)
    if "stoch" in params:
        lb.append(_p(params, "stoch", "window") + _p(params, "stoch", "smooth_window"))
    if "macd" in params:
        slow, fast, sign = ewm_alphas({"macd": params["macd"]})
        lb.append(max(ewm_rows(slow), ewm_rows(fast)) + ewm_rows(sign))
    if "bb" in params:
        lb.append(_p(params, "bb", "window"))
    return max(lb)


def add_indicators(df: DataFrame, w: WindowSpec, params: Mapping, sfx: str, src: str = "", *, block: int,
                   by: Sequence[str] = ("symbol", "_c")) -> DataFrame:
    """Indicator columns (suffix ``sfx``) from candle columns
    ``open{src} high{src} low{src} close{src}``.

    Columns are added level by level with one ``withColumns`` per level (a
    level only reads columns of earlier levels), which keeps the analysed
    plan small; window expressions sharing the partitioning and order run in
    the same Window operator.  ``block`` is the block length that ``df`` was
    chunked with.
    """
    h, lo, c = F.col(f"high{src}"), F.col(f"low{src}"), F.col(f"close{src}")
    levels: list[dict[str, Column]] = [{} for _ in range(5)]
    smoothed: list[dict[str, tuple[str, float, int]]] = [{} for _ in range(5)]  # EWMs after each level
    tmp: list[str] = []

    if "cca" in params:
        n = _p(params, "cca", "window")
        tp = (h + lo + c) / 3
        lst = F.collect_list(tp).over(frame(w, n))
        mean = F.avg(tp).over(frame(w, n))
        mad = F.aggregate(F.transform(lst, lambda v: F.abs(v - mean)), F.lit(0.0), lambda a, b: a + b) / F.size(lst)
        levels[0][f"cci{sfx}"] = F.when((F.size(lst) == n) & (mad != 0), (tp - mean) / (0.015 * mad))

    if "ichimoku" in params:
        n1, n2, n3 = (_p(params, "ichimoku", k) for k in ("window1", "window2", "window3"))

        def mid(n):
            f = frame(w, n)
            return F.when(F.count(h).over(f) == n, (F.max(h).over(f) + F.min(lo).over(f)) / 2)
        levels[0].update({f"ichimoku_conv{sfx}": mid(n1), f"ichimoku_base{sfx}": mid(n2), f"ichimoku_b{sfx}": mid(n3)})
        levels[1][f"ichimoku_a{sfx}"] = (F.col(f"ichimoku_conv{sfx}") + F.col(f"ichimoku_base{sfx}")) / 2

    if "rsi" in params:
        n = _p(params, "rsi", "window")
        d = c - F.lag(c, 1).over(w)
        levels[0][f"_gain{sfx}"] = F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))
        levels[0][f"_loss{sfx}"] = F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))
        tmp += [f"_gain{sfx}", f"_loss{sfx}"]
        smoothed[0][f"_eg{sfx}"] = (f"_gain{sfx}", 1.0 / n, n)
        smoothed[0][f"_el{sfx}"] = (f"_loss{sfx}", 1.0 / n, n)
        tmp += [f"_eg{sfx}", f"_el{sfx}"]
        eg, el = faded(F.col(f"_eg{sfx}"), c), faded(F.col(f"_el{sfx}"), c)
        levels[1][f"rsi{sfx}"] = F.when(el == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + eg / el))

    if "adx" in params:
        n = _p(params, "adx", "window")
        pc, ph, pl = F.lag(c, 1).over(w), F.lag(h, 1).over(w), F.lag(lo, 1).over(w)
        up, dn = h - ph, pl - lo
        levels[0][f"_tr{sfx}"] = F.when(pc.isNotNull(), F.greatest(h - lo, F.abs(h - pc), F.abs(lo - pc)))
        levels[0][f"_pdm{sfx}"] = F.when(ph.isNotNull(), F.when((up > dn) & (up > 0), up).otherwise(F.lit(0.0)))
        levels[0][f"_mdm{sfx}"] = F.when(pl.isNotNull(), F.when((dn > up) & (dn > 0), dn).otherwise(F.lit(0.0)))
        a = 1.0 / n
        smoothed[0].update({f"_atr{sfx}": (f"_tr{sfx}", a, n), f"_pe{sfx}": (f"_pdm{sfx}", a, n), f"_me{sfx}": (f"_mdm{sfx}", a, n)})
        atr_c, pe, me = (faded(F.col(f"{x}{sfx}"), c) for x in ("_atr", "_pe", "_me"))
        pos = F.when(atr_c == 0, F.lit(0.0)).otherwise(100 * pe / atr_c)
        neg = F.when(atr_c == 0, F.lit(0.0)).otherwise(100 * me / atr_c)
        levels[1][f"adx_pos{sfx}"] = pos
        levels[1][f"adx_neg{sfx}"] = neg
        levels[1][f"_dx{sfx}"] = F.when(pos + neg == 0, F.lit(0.0)).otherwise(100 * F.abs(pos - neg) / (pos + neg))
        smoothed[1][f"adx{sfx}"] = (f"_dx{sfx}", a, n)
        tmp += [f"_tr{sfx}", f"_pdm{sfx}", f"_mdm{sfx}", f"_atr{sfx}", f"_pe{sfx}", f"_me{sfx}", f"_dx{sfx}"]

    if "stoch" in params:
        n, s = _p(params, "stoch", "window"), _p(params, "stoch", "smooth_window")
        f = frame(w, n)
        hh, ll = F.max(h).over(f), F.min(lo).over(f)
        levels[0][f"stoch{sfx}"] = F.when((F.count(c).over(f) == n) & (hh != ll), 100 * (c - ll) / (hh - ll))
        levels[1][f"stoch_signal{sfx}"] = full(F.col(f"stoch{sfx}"), w, s, F.avg)

    if "macd" in params:
        m = params["macd"]
        slow, fast, sign = int(m.get("slow", 26)), int(m.get("fast", 12)), int(m.get("sign", 9))
        smoothed[0][f"_ef{sfx}"] = (f"close{src}", 2.0 / (fast + 1), fast)
        smoothed[0][f"_es{sfx}"] = (f"close{src}", 2.0 / (slow + 1), slow)
        tmp += [f"_ef{sfx}", f"_es{sfx}"]
        levels[1][f"macd{sfx}"] = F.col(f"_ef{sfx}") - F.col(f"_es{sfx}")
        smoothed[1][f"macd_signal{sfx}"] = (f"macd{sfx}", 2.0 / (sign + 1), sign)
        levels[2][f"macd_diff{sfx}"] = F.col(f"macd{sfx}") - F.col(f"macd_signal{sfx}")

    if "bb" in params:
        n, dev = _p(params, "bb", "window"), _p(params, "bb", "window_dev")
        f = frame(w, n)
        ok = F.count(c).over(f) == n
        mavg, sd = F.avg(c).over(f), F.stddev_pop(c).over(f)
        levels[0].update({f"bb_mavg{sfx}": F.when(ok, mavg), f"bb_hband{sfx}": F.when(ok, mavg + dev * sd),
                          f"bb_lband{sfx}": F.when(ok, mavg - dev * sd)})

    for lvl, ewms in zip(levels, smoothed):
        if lvl:
            df = df.withColumns(lvl)
        if ewms:
            df = add_ewms(df, w, ewms, block, by)
    return df.drop(*tmp)


def add_level2_features(df: DataFrame, w: WindowSpec, p: int, sfx: str) -> DataFrame:
    df = df.withColumns({f"{c}{sfx}": full(F.col(c), w, p, F.avg) for c in L2_COLS})
    bv, av = F.col(f"l2_bid_vol{sfx}"), F.col(f"l2_ask_vol{sfx}")
    return df.withColumns({f"l2_spread{sfx}": F.col(f"l2_ask_min{sfx}") - F.col(f"l2_bid_max{sfx}"),
                           f"l2_imbalance{sfx}": F.when(bv + av != 0, (bv - av) / (bv + av))})


# ------------------------------------------------------------------ chunked drivers

def period_steps(period: str, step: str) -> int:
    n = parse_duration_us(period) // parse_duration_us(step)
    if n < 1 or parse_duration_us(period) % parse_duration_us(step):
        raise ValueError(f"period {period} is not a multiple of the grid step {step}")
    return int(n)


def params_for(params: Mapping, period: str) -> Mapping:
    """Params may be flat or keyed by period label (``{"5min": {...}}``)."""
    for k in (period, label(period)):
        if k in params:
            return params[k]
    return params


def chunked(df: DataFrame, step: str, halo_rows: int, chunk: str, *, symbol: str = "symbol",
            ts: str = "datetime", block: int = 1) -> tuple[DataFrame, WindowSpec]:
    """Tag rows with (chunk, halo), grid row ``_i`` and block ``_blk``, and
    return the window spec to use.  A chunk is at least four halos long, so
    that the copied rows stay a small share.  Windows by block sort the same
    way as the returned one, so that all share one sort."""
    step_us = parse_duration_us(step)
    halo_us = halo_rows * step_us
    h = with_halo(df, ts, max(parse_duration_us(chunk), 4 * halo_us), halo_us)
    h = h.withColumn("_i", F.floor(ts_micros(h, ts) / step_us)).withColumn("_blk", F.floor(F.col("_i") / block))
    return h, Window.partitionBy(symbol, "_c").orderBy("_blk", "_i")


TAGS = ("_c", "_halo", "_i", "_blk")


def rolling_candles(df: DataFrame, periods: Sequence[str], step: str, *, chunk: str = "1 day",
                    symbol: str = "symbol", ts: str = "datetime") -> DataFrame:
    """W1 as its own operator: one rolling candle per period, suffixed by
    the period label."""
    ps = [period_steps(p, step) for p in periods]
    h, w = chunked(df, step, max(ps), chunk, symbol=symbol, ts=ts)
    cols = {}
    for p, lbl in zip(ps, periods):
        cols.update(rolling_candle_cols(w, p, f"_{label(lbl)}"))
    h = h.withColumns(cols)
    return h.where(~F.col("_halo")).drop(*TAGS)


def candle_indicators(df: DataFrame, periods: Sequence[str], step: str, params: Mapping | None = None, *,
                      chunk: str = "1 day", symbol: str = "symbol", ts: str = "datetime") -> DataFrame:
    """W1 + W2: per period, the rolling candle and its indicators."""
    params = params or DEFAULT_PARAMS
    ps = [period_steps(p, step) for p in periods]
    halo = max(p - 1 + lookback_rows(params_for(params, lbl)) for p, lbl in zip(ps, periods)) + 1
    block = max(block_rows(params_for(params, lbl)) for lbl in periods)
    h, w = chunked(df, step, halo, chunk, symbol=symbol, ts=ts, block=block)
    for p, lbl in zip(ps, periods):
        sfx = f"_{label(lbl)}"
        h = h.withColumns(rolling_candle_cols(w, p, f"_rc{sfx}"))
        h = add_indicators(h, w, params_for(params, lbl), sfx, src=f"_rc{sfx}", block=block, by=(symbol, "_c"))
        h = h.drop(*[f"{c}_rc{sfx}" for c in ("open", "high", "low", "close", "vol")])
    return h.where(~F.col("_halo")).drop(*TAGS)


def level2_features(df: DataFrame, periods: Sequence[str], step: str, *, chunk: str = "1 day",
                    symbol: str = "symbol", ts: str = "datetime") -> DataFrame:
    ps = [period_steps(p, step) for p in periods]
    h, w = chunked(df, step, max(ps) + 1, chunk, symbol=symbol, ts=ts)
    for p, lbl in zip(ps, periods):
        h = add_level2_features(h, w, p, f"_{label(lbl)}")
    return h.where(~F.col("_halo")).drop(*TAGS)


def clean_features(features: DataFrame, feature_cols: Sequence[str] | None = None, keep: Sequence[str] = (),
                   inputs: DataFrame | None = None) -> DataFrame:
    """Non-finite values (NaN, +-inf) become null, then rows with any null
    feature are dropped.  With ``inputs`` only the rows whose ``keep`` columns
    (symbol and time) are in it stay: no features at grid rows that only the
    fill made."""
    cols = list(feature_cols) if feature_cols is not None else [c for c in features.columns if c not in keep]
    out = features
    out = out.withColumns({c: F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(F.col(c))
                           for c in cols})
    out = out.dropna(how="any", subset=cols)
    return out if inputs is None else out.join(inputs.select(*keep).distinct(), list(keep), "left_semi")
