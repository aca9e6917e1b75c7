"""Grid fill: leading/inner/trailing gaps, off-step start, chunk carry."""
from datetime import datetime as dt, timedelta

from ticklake.operators.timegrid import fill_grid

S = "symbol string, ts timestamp_ntz, v double"


def test_linear_fill(spark):
    # [null, 1, null, 3, null] with a leading null row and trailing null -> [null, 1, 2, 3, 3]
    t0 = dt(2025, 1, 1)
    rows = [("X", t0, None), ("X", t0 + timedelta(minutes=1), 1.0), ("X", t0 + timedelta(minutes=3), 3.0),
            ("X", t0 + timedelta(minutes=4), None)]
    out = [r.v for r in fill_grid(spark.createDataFrame(rows, S), "1 minute", cols=["v"]).orderBy("datetime").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 3.0]


def test_off_step_start_is_floored(spark):
    t0 = dt(2025, 1, 1, 0, 0, 30)
    rows = [("X", t0, 1.0), ("X", t0 + timedelta(minutes=3), 4.0)]
    out = fill_grid(spark.createDataFrame(rows, S), "1 minute", cols=["v"]).orderBy("datetime").collect()
    assert [r.datetime for r in out][0] == dt(2025, 1, 1, 0, 0)
    assert [r.v for r in out] == [1.0, 2.0, 3.0, 4.0]


def test_long_gap_across_empty_chunks(spark):
    t0 = dt(2025, 1, 1)
    rows = [("X", t0, 0.0), ("X", t0 + timedelta(hours=10), 600.0), ("Y", t0, 5.0)]
    out = fill_grid(spark.createDataFrame(rows, S), "1 minute", cols=["v"], chunk="1 hour").orderBy("datetime")
    xs = [r.v for r in out.where("symbol = 'X'").collect()]
    assert len(xs) == 601 and all(abs(a - i) < 1e-9 for i, a in enumerate(xs))
    assert [r.v for r in out.where("symbol = 'Y'").collect()] == [5.0]


def test_timestamp_column_interpolated(spark):
    t0 = dt(2025, 1, 1)
    rows = [("X", t0, t0), ("X", t0 + timedelta(minutes=2), t0 + timedelta(minutes=4))]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, u timestamp_ntz")
    out = [r.u for r in fill_grid(df, "1 minute", cols=["u"]).orderBy("datetime").collect()]
    assert out == [t0, t0 + timedelta(minutes=2), t0 + timedelta(minutes=4)]
