"""History/stream stitching, gap, retention, high-water marks."""
from datetime import datetime as dt, timedelta

from ticklake.operators.increment import append_new, keep_last, last_produced, only_new, stitch, time_gap

S = "symbol string, datetime timestamp_ntz, v double"


def test_stitch_closes_gap(spark):
    # History ends 02:45 then 02:55; stream 02:55, 02:56 -> 02:45, 02:55 (history row), 02:56; ready
    d = dt(2025, 6, 1)
    hist = spark.createDataFrame([("X", d.replace(hour=2, minute=45), 1.0), ("X", d.replace(hour=2, minute=55), 2.0)], S)
    live = spark.createDataFrame([("X", d.replace(hour=2, minute=55), 9.0), ("X", d.replace(hour=2, minute=56), 3.0)], S)
    data, gap = stitch(hist, live)
    assert sorted((r.datetime.minute, r.v) for r in data.collect()) == [(45, 1.0), (55, 2.0), (56, 3.0)]
    g = gap.collect()[0]
    assert g.gap_seconds == 0.0 and g.is_good


def test_gap_stays_open(spark):
    # History ends 02:45:01, stream from 02:55 -> union of four rows, not ready
    d = dt(2025, 6, 1)
    hist = spark.createDataFrame([("X", d.replace(hour=2, minute=44), 1.0), ("X", d.replace(hour=2, minute=45, second=1), 2.0)], S)
    live = spark.createDataFrame([("X", d.replace(hour=2, minute=55), 3.0), ("X", d.replace(hour=2, minute=56), 4.0)], S)
    data, gap = stitch(hist, live)
    assert data.count() == 4
    g = gap.collect()[0]
    assert not g.is_good and abs(g.gap_seconds - 599.0) < 1e-9


def test_keep_last(spark):
    t0 = dt(2025, 1, 1)
    rows = [("X", t0 + timedelta(hours=i), float(i)) for i in range(100)] + [("Y", t0, 0.0)]
    out = keep_last(spark.createDataFrame(rows, S), 30, chunk="7 hours")
    xs = sorted(r.v for r in out.where("symbol = 'X'").collect())
    assert xs == [float(i) for i in range(70, 100)]
    assert out.where("symbol = 'Y'").count() == 1


def test_only_new(spark):
    t0 = dt(2025, 1, 1)
    df = spark.createDataFrame([("X", t0 + timedelta(minutes=i), float(i)) for i in range(5)] + [("Y", t0, 1.0)], S)
    assert only_new(df, None).count() == 6  # nothing produced yet: keep all
    assert only_new(df, t0 + timedelta(minutes=2)).count() == 2
    produced = spark.createDataFrame([("X", t0 + timedelta(minutes=3), 0.0)], S)
    out = only_new(df, last_produced(produced)).collect()
    assert sorted((r.symbol, r.v) for r in out) == [("X", 4.0), ("Y", 1.0)]


def test_append_new_allow_missing(spark):
    t0 = dt(2025, 1, 1)
    hist = spark.createDataFrame([("X", t0, 1.0)], S)
    new = spark.createDataFrame([("X", t0, 2.0, "a"), ("X", t0 + timedelta(minutes=1), 3.0, "b")],
                                "symbol string, datetime timestamp_ntz, v double, extra string")
    out = sorted((r.v, r.extra) for r in append_new(hist, new).collect())
    assert out == [(1.0, None), (3.0, "b")]
    assert time_gap is not None
