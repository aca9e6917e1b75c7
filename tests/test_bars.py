"""Bars: last state per right-closed minute, OHLC, left-labelled resample."""
from datetime import datetime as dt

from ticklake.operators import bars

CANDLE_SCHEMA = "symbol string, ts timestamp_ntz, seq long, open double, high double, low double, close double, vol double"


def test_last_state_right_closed_two_bars(spark):
    # A row exactly on 14:12:00 belongs to the bar closing at 14:12
    rows = [("X", dt(2025, 6, 3, 14, 11, 1), 1, 100.0, 110.0, 90.0, 105.0, 1000.0),
            ("X", dt(2025, 6, 3, 14, 11, 30), 2, 110.0, 104.0, 97.0, 120.0, 1500.0),
            ("X", dt(2025, 6, 3, 14, 12, 0), 3, 110.0, 104.0, 97.0, 120.0, 2000.0),
            ("X", dt(2025, 6, 3, 14, 12, 1), 4, 200.0, 300.0, 100.0, 210.0, 500.0)]
    df = spark.createDataFrame(rows, CANDLE_SCHEMA)
    out = {r.close_time: r for r in bars.stage_candles(df, "1 minute", seq=["seq"]).collect()}
    a, b = out[dt(2025, 6, 3, 14, 12)], out[dt(2025, 6, 3, 14, 13)]
    assert (a.open, a.high, a.low, a.close, a.vol) == (110.0, 104.0, 97.0, 120.0, 2000.0)
    assert a.open_time == dt(2025, 6, 3, 14, 11)
    assert (b.open, b.high, b.low, b.close, b.vol) == (200.0, 300.0, 100.0, 210.0, 500.0)


def test_last_state_tie_on_time_uses_sequence(spark):
    # Three rows at the same time; the last row (by ingest order) wins
    t = dt(2025, 1, 1, 11, 42)
    rows = [("X", t, 1, 101.0, 105.0, 99.0, 101.0, 1.0), ("X", t, 2, 102.0, 107.0, 97.0, 102.0, 2.0),
            ("X", t, 3, 102.0, 107.0, 97.0, 103.0, 3.0)]
    out = bars.stage_candles(spark.createDataFrame(rows, CANDLE_SCHEMA), seq=["seq"]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.open, r.high, r.low, r.close, r.vol) == (102.0, 107.0, 97.0, 103.0, 3.0)


def test_last_non_null_per_column(spark):
    rows = [("X", dt(2025, 1, 1, 0, 0, 10), 1, 1.0, 2.0, 0.5, 1.5, 10.0),
            ("X", dt(2025, 1, 1, 0, 0, 20), 2, None, 3.0, None, None, 20.0)]
    r = bars.stage_candles(spark.createDataFrame(rows, CANDLE_SCHEMA), seq=["seq"]).collect()[0]
    assert (r.open, r.high, r.low, r.close, r.vol) == (1.0, 3.0, 0.5, 1.5, 20.0)


def test_empty_input(spark):
    # C5
    assert bars.stage_candles(spark.createDataFrame([], CANDLE_SCHEMA)).count() == 0


def test_ohlc_and_resample(spark):
    rows = [("X", dt(2025, 1, 1, 0, 0, 10), 1, 5.0, 1.0), ("X", dt(2025, 1, 1, 0, 0, 40), 2, 7.0, 2.0),
            ("X", dt(2025, 1, 1, 0, 1, 0), 3, 3.0, 3.0), ("X", dt(2025, 1, 1, 0, 1, 30), 4, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, seq long, price double, vol double")
    o = {r.close_time: r for r in bars.ohlc_bars(df, seq=["seq"]).collect()}
    first = o[dt(2025, 1, 1, 0, 1)]
    assert (first.open, first.high, first.low, first.close, first.vol, first.n) == (5.0, 7.0, 3.0, 3.0, 6.0, 3)
    left = {r.datetime: r for r in bars.resample_last(df, seq=["seq"], cols=["price"]).collect()}
    assert left[dt(2025, 1, 1, 0, 0)].price == 7.0 and left[dt(2025, 1, 1, 0, 1)].price == 4.0


def test_resample_candles(spark):
    rows = [("X", dt(2025, 1, 1, 0, m), dt(2025, 1, 1, 0, m + 1), float(m), m + 10.0, m - 10.0, m + 0.5, 1.0)
            for m in range(10)]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close_time timestamp_ntz, "
                                     "open double, high double, low double, close double, vol double")
    out = sorted(bars.resample_candles(df, "5 minutes").collect(), key=lambda r: r.open_time)
    assert len(out) == 2
    assert (out[0].open, out[0].high, out[0].low, out[0].close, out[0].vol) == (0.0, 14.0, -10.0, 4.5, 5.0)
    assert out[0].close_time == dt(2025, 1, 1, 0, 5)
