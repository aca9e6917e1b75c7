"""Indicators against their definitions in numpy, and exactness of chunks and blocks."""
from datetime import datetime as dt, timedelta

import numpy as np
import pytest

from pyspark.sql import functions as F

from ticklake.operators import indicators as ind
from ticklake.operators.indicators import add_ewms, candle_indicators, chunked, rolling_candles
from ticklake.plans.features import feature_frame
from ticklake.schemas import L2_COLS

START = dt(2024, 3, 5, 7, 30)
PARAMS = {"cca": {"window": 6}, "ichimoku": {"window1": 3, "window2": 7, "window3": 11}, "adx": {"window": 4},
          "rsi": {"window": 5}, "stoch": {"window": 6, "smooth_window": 3}, "macd": {"slow": 9, "fast": 4, "sign": 3},
          "bb": {"window": 7, "window_dev": 2}}


def walk(n, seed=11):
    rnd = np.random.default_rng(seed)
    close = 50 + np.cumsum(rnd.normal(size=n))
    open_ = np.concatenate([[50.0], close[:-1]])
    high = np.maximum(open_, close) + rnd.uniform(0, 1, n)
    low = np.minimum(open_, close) - rnd.uniform(0, 1, n)
    return open_, high, low, close


def frame_of(spark, n, seed=11):
    o, h, lo, c = walk(n, seed)
    rows = [("X", START + timedelta(minutes=i), float(o[i]), float(h[i]), float(lo[i]), float(c[i]), 1.0 + i % 3,
             *[float(c[i]) + k for k in range(6)]) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, open double, high double, low double, "
                                       "close double, vol double, " + ", ".join(f"{x} double" for x in L2_COLS))


def mean_so_far(x, alpha, n):
    """The definition, term by term; x may begin with NaN."""
    out = np.full(len(x), np.nan)
    first = int(np.argmax(~np.isnan(x)))
    for t in range(first + n - 1, len(x)):
        w = (1 - alpha) ** np.arange(t - first, -1, -1)
        out[t] = (w * x[first:t + 1]).sum() / w.sum()
    return out


def rolled(x, n, f):
    return np.array([f(x[t - n + 1:t + 1]) if t >= n - 1 else np.nan for t in range(len(x))])


def by_definition(n_rows, seed=11):
    _, h, lo, c = walk(n_rows, seed)
    nan = np.nan
    tp = (h + lo + c) / 3
    out = {"cci": (tp - rolled(tp, 6, np.mean)) / (0.015 * rolled(tp, 6, lambda v: np.abs(v - v.mean()).mean()))}

    def mid(n):
        return (rolled(h, n, np.max) + rolled(lo, n, np.min)) / 2
    out |= {"ichimoku_conv": mid(3), "ichimoku_base": mid(7), "ichimoku_b": mid(11), "ichimoku_a": (mid(3) + mid(7)) / 2}
    d = np.concatenate([[nan], np.diff(c)])
    gain, loss = (np.where(np.isnan(d), nan, np.maximum(s * d, 0)) for s in (1, -1))
    out["rsi"] = 100 - 100 / (1 + mean_so_far(gain, 1 / 5, 5) / mean_so_far(loss, 1 / 5, 5))
    pc, ph, pl = (np.concatenate([[nan], v[:-1]]) for v in (c, h, lo))
    tr = np.maximum(h - lo, np.maximum(np.abs(h - pc), np.abs(lo - pc)))
    up, dn = h - ph, pl - lo
    pdm = np.where(np.isnan(up), nan, np.where((up > dn) & (up > 0), up, 0))
    mdm = np.where(np.isnan(dn), nan, np.where((dn > up) & (dn > 0), dn, 0))
    atr = mean_so_far(tr, 1 / 4, 4)
    pos, neg = (100 * mean_so_far(v, 1 / 4, 4) / atr for v in (pdm, mdm))
    dx = 100 * np.abs(pos - neg) / (pos + neg)
    out |= {"adx_pos": pos, "adx_neg": neg, "adx": mean_so_far(dx, 1 / 4, 4)}
    hh, ll = rolled(h, 6, np.max), rolled(lo, 6, np.min)
    stoch = 100 * (c - ll) / (hh - ll)
    out |= {"stoch": stoch, "stoch_signal": rolled(stoch, 3, np.mean)}
    macd = mean_so_far(c, 2 / 5, 4) - mean_so_far(c, 2 / 10, 9)
    out |= {"macd": macd, "macd_signal": mean_so_far(macd, 2 / 4, 3)}
    out["macd_diff"] = out["macd"] - out["macd_signal"]
    avg, sd = rolled(c, 7, np.mean), rolled(c, 7, np.std)
    return out | {"bb_mavg": avg, "bb_hband": avg + 2 * sd, "bb_lband": avg - 2 * sd}


def test_indicators_are_the_definitions(spark):
    n = 400
    got = candle_indicators(frame_of(spark, n), ["1 minute"], "1 minute", PARAMS, chunk="1 hour").orderBy("datetime").collect()
    assert len(got) == n
    for name, want in by_definition(n).items():
        have = np.array([np.nan if r[f"{name}_1minute"] is None else r[f"{name}_1minute"] for r in got])
        assert (np.isnan(have) == np.isnan(want)).all(), name
        assert np.nanmax(np.abs(have - want)) < 1e-8, name


def test_feature_frame_has_values(spark):
    from ticklake.operators.indicators import clean_features
    f = feature_frame(frame_of(spark, 200), step="1 minute", candle_periods=["2 minutes", "4 minutes"],
                      level2_periods=["2 minutes", "4 minutes"], params={"2minutes": PARAMS, "4minutes": PARAMS})
    rows = clean_features(f, keep=["symbol", "datetime"]).collect()
    assert len(rows) > 150 and all(v is not None for r in rows for v in r)
    _, _, _, c = walk(200)
    last = max(rows, key=lambda r: r.datetime)
    assert abs(last["l2_bid_max_2minutes"] - (c[-1] + c[-2]) / 2) < 1e-9 and abs(last["bb_mavg_2minutes"] - c[-7:].mean()) < 1e-9


@pytest.mark.parametrize("alpha,n,decay_range", [(1 / 14, 14, 600.0), (0.9, 3, 600.0), (0.5, 4, 40.0), (1.0, 1, 600.0)])
def test_ewm_is_the_recursion(spark, monkeypatch, alpha, n, decay_range):
    monkeypatch.setattr(ind, "EWM_RANGE", decay_range)
    rnd = np.random.default_rng(1)
    x = np.concatenate([[np.nan] * 3, 1e6 + rnd.normal(size=900)])
    df = spark.createDataFrame([("X", START + timedelta(minutes=i), None if np.isnan(v) else float(v)) for i, v in enumerate(x)],
                               "symbol string, datetime timestamp_ntz, x double")
    block = max(ind.ewm_rows(alpha), 150)
    h, w = chunked(df, "1 minute", block + 1, "1 hour", block=block)
    got = add_ewms(h, w, {"e": ("x", alpha, n)}, block).where(~F.col("_halo")).orderBy("datetime").collect()
    want = mean_so_far(x, alpha, n)
    assert all((r.e is None) == bool(np.isnan(v)) and (r.e is None or abs(r.e - v) < 1e-8) for r, v in zip(got, want))


def test_ewm_after_a_hole_is_null_and_not_wrong(spark):
    rows = [("X", START + timedelta(minutes=i), None if i == 5 else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, x double")
    h, w = chunked(df, "1 minute", 50, "1 hour", block=50)
    got = [r.e for r in add_ewms(h, w, {"e": ("x", 0.5, 2)}, 50).where(~F.col("_halo")).orderBy("datetime").collect()]
    assert got[4] is not None and got[5:] == [None] * 5


def test_no_list_per_row(spark):
    plan = candle_indicators(frame_of(spark, 5), ["1 minute"], "1 minute", {k: PARAMS[k] for k in ("rsi", "adx", "macd")})._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_chunking_is_exact(spark):
    rnd = np.random.default_rng(3)
    t0 = dt(2025, 1, 1)
    price = 100 + np.cumsum(rnd.normal(size=600))
    rows = [("X", t0 + timedelta(minutes=i), p, p + 1, p - 1, p + 0.5, 1.0) for i, p in enumerate(price.tolist())]
    df = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, open double, high double, low double, "
                                     "close double, vol double")
    params = {"adx": {"window": 5}, "macd": {"slow": 6, "fast": 3, "sign": 3}, "rsi": {"window": 4}}
    small = {r.datetime: r for r in candle_indicators(df, ["3 minutes"], "1 minute", params, chunk="1 hour").collect()}
    one = {r.datetime: r for r in candle_indicators(df, ["3 minutes"], "1 minute", params, chunk="30 days").collect()}
    assert small.keys() == one.keys()
    for k in one:
        for c in ("adx_3minutes", "macd_signal_3minutes", "rsi_3minutes"):
            a, b = small[k][c], one[k][c]
            assert (a is None and b is None) or abs(a - b) < 1e-9, (k, c)
    rc = rolling_candles(df, ["3 minutes"], "1 minute", chunk="1 hour").orderBy("datetime").collect()
    assert rc[2].high_3minutes == max(r[3] for r in rows[:3]) and rc[1].open_3minutes is None
