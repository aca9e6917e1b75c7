"""Structured Streaming on file sources: staging, as-of, late rows,
restart from checkpoint, incremental feature job."""
import json
import os
import uuid
from datetime import datetime as dt, timedelta

from pyspark.sql import functions as F

from ticklake.operators import bars
from ticklake.operators.asof import asof_join
from ticklake.operators.metrics import ProgressCollector
from ticklake.streaming.asof_stream import asof_join_stream
from ticklake.streaming.staging import stage_stream

EPOCH = dt(1970, 1, 1)


def ms(t):
    return int((t - EPOCH).total_seconds() * 1000)


def candle_msg(t, o, h, lo, c, v, sym="BTC-USDT"):
    return json.dumps({"ch": f"market.{sym}.kline.1min", "ts": ms(t),
                       "tick": {"open": o, "high": h, "low": lo, "close": c, "amount": v}})


def write_lines(d, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{uuid.uuid4().hex}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def run_memory(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    return q


C2 = [(dt(2025, 6, 3, 14, 11, 1), 100.0, 110.0, 90.0, 105.0, 1000.0),
      (dt(2025, 6, 3, 14, 11, 30), 110.0, 104.0, 97.0, 120.0, 1500.0),
      (dt(2025, 6, 3, 14, 12, 0), 110.0, 104.0, 97.0, 120.0, 2000.0),
      (dt(2025, 6, 3, 14, 12, 1), 200.0, 300.0, 100.0, 210.0, 500.0)]


def test_stream_candles_equal_batch_and_emission(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    write_lines(src, [candle_msg(*r) for r in C2] + ['{"ping": 1}'])
    raw = spark.readStream.text(src)
    q = run_memory(stage_stream(raw, "candles", step="1 minute", lateness="10 seconds", seq=None), "st_c1")
    # last event 14:12:01: watermark 14:11:51, no bar is final yet
    assert spark.table("st_c1").count() == 0
    # an event at 14:13:10.001 closes both (strict: 14:13:10.000 would not close the second)
    write_lines(src, [candle_msg(dt(2025, 6, 3, 14, 13, 10, 1000), 1.0, 1.0, 1.0, 1.0, 1.0)])
    q.processAllAvailable()
    got = {r.close_time: r for r in spark.table("st_c1").collect()}
    q.stop()
    b = got[dt(2025, 6, 3, 14, 13)]
    assert (b.open, b.high, b.low, b.close, b.vol) == (200.0, 300.0, 100.0, 210.0, 500.0)
    rows = spark.createDataFrame([("BTC-USDT", *r) for r in C2],
                                 "symbol string, ts timestamp_ntz, open double, high double, low double, "
                                 "close double, vol double")
    batch = {r.close_time: tuple(r) for r in bars.stage_candles(rows).collect()}
    assert tuple(got[dt(2025, 6, 3, 14, 12)]) == batch[dt(2025, 6, 3, 14, 12)]


def test_boundary_timing_at_10s(spark, tmp_dir):
    # C1': bar labelled 14:12 needs an event later than 14:12:10
    src = f"{tmp_dir}/raw"
    write_lines(src, [candle_msg(dt(2025, 6, 3, 14, 11, 1), 1, 1, 1, 1, 1),
                      candle_msg(dt(2025, 6, 3, 14, 12, 10), 1, 1, 1, 1, 1)])
    q = run_memory(stage_stream(spark.readStream.text(src), "candles", seq=None), "st_c2")
    assert spark.table("st_c2").count() == 0
    write_lines(src, [candle_msg(dt(2025, 6, 3, 14, 12, 11), 1, 1, 1, 1, 1)])
    q.processAllAvailable()
    assert [r.close_time for r in spark.table("st_c2").collect()] == [dt(2025, 6, 3, 14, 12)]
    q.stop()


def test_late_row_dropped_and_counted(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    coll = ProgressCollector()
    spark.streams.addListener(coll)
    try:
        write_lines(src, [candle_msg(dt(2025, 6, 3, 14, 20), 1, 1, 1, 1, 1)])
        q = run_memory(stage_stream(spark.readStream.text(src), "candles", seq=None), "st_late")
        write_lines(src, [candle_msg(dt(2025, 6, 3, 14, 5), 9, 9, 9, 9, 9)])  # far behind the watermark
        q.processAllAvailable()
        q.stop()
        assert spark.table("st_late").where("open = 9").count() == 0
        import time
        time.sleep(1)
        assert sum(e["dropped_by_watermark"] for e in coll.events) >= 1
    finally:
        spark.streams.removeListener(coll)


def test_restart_from_checkpoint(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t0 = dt(2025, 6, 3, 10, 0, 30)
    msgs = [candle_msg(t0 + timedelta(minutes=i), float(i), i + 1.0, i - 1.0, float(i), 1.0) for i in range(30)]

    def run():
        q = (stage_stream(spark.readStream.text(src), "candles", seq=None).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    write_lines(src, msgs[:12])
    run()
    write_lines(src, msgs[12:])
    run()
    got = spark.read.parquet(out)
    assert got.count() == got.select("close_time").distinct().count() == 29  # last bar still open
    assert sorted(r.open for r in got.collect()) == [float(i) for i in range(29)]


def test_stream_asof_equals_batch(spark, tmp_dir):
    t0 = dt(2025, 1, 1)
    cdir, ldir = f"{tmp_dir}/c", f"{tmp_dir}/l"
    c_rows = [("X", t0 + timedelta(minutes=i), float(i), float(i), float(i), float(i), 1.0) for i in range(1, 40)]
    l_rows = [("X", t0 + timedelta(minutes=i, seconds=(17 * i) % 90 - 30), *[float(i)] * 6) for i in range(0, 40, 2)]
    cs = "symbol string, close_time timestamp, open double, high double, low double, close double, vol double"
    from ticklake.schemas import L2_COLS
    ls = "symbol string, datetime timestamp, " + ", ".join(f"{c} double" for c in L2_COLS)
    spark.createDataFrame(c_rows, cs).write.parquet(cdir)
    spark.createDataFrame(l_rows, ls).write.parquet(ldir)
    # flush rows far ahead move both watermarks past every real row
    spark.createDataFrame([("X", t0 + timedelta(days=1), 0.0, 0.0, 0.0, 0.0, 0.0)], cs).write.mode("append").parquet(cdir)
    spark.createDataFrame([("X", t0 + timedelta(days=1), *[0.0] * 6)], ls).write.mode("append").parquet(ldir)
    c = spark.readStream.schema(cs).parquet(cdir)
    l2 = spark.readStream.schema(ls).parquet(ldir)
    q = run_memory(asof_join_stream(c, l2, tolerance="59 seconds", watermark="2 minutes", chunk="10 minutes"), "st_asof")
    q.processAllAvailable()
    got = {r.close_time.replace(tzinfo=None): r.l2_bid_max for r in spark.table("st_asof").collect()
           if r.close_time < t0 + timedelta(days=1)}
    q.stop()
    cb = spark.createDataFrame(c_rows, cs.replace("timestamp", "timestamp_ntz"))
    lb = spark.createDataFrame(l_rows, ls.replace("timestamp", "timestamp_ntz"))
    want = {r.close_time: r.l2_bid_max for r in asof_join(cb, lb, left_ts="close_time", right_ts="datetime",
                                                          direction="nearest", tolerance="59 seconds").collect()}
    assert got == want and len(want) > 5


def test_feature_job_incremental_equals_batch(spark, tmp_dir):
    from ticklake.operators.indicators import clean_features
    from ticklake.operators.timegrid import fill_grid
    from ticklake.plans.features import CANDLE, feature_frame
    from ticklake.schemas import L2_COLS
    from ticklake.streaming.features_job import FeatureJob
    import numpy as np
    rnd = np.random.default_rng(5)
    t0 = dt(2025, 1, 1)
    rows = []
    for i in range(240):
        if i % 7 == 3:
            continue  # gaps for the grid fill
        p = 100 + float(rnd.normal())
        rows.append(("X", t0 + timedelta(minutes=i), p, p + 1, p - 1, p, 1.0, *[p + k for k in range(6)]))
    schema = ("symbol string, datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in CANDLE + L2_COLS))
    params = {"rsi": {"window": 3}, "macd": {"slow": 5, "fast": 2, "sign": 2}, "stoch": {"window": 4, "smooth_window": 2}}
    job = FeatureJob(f"{tmp_dir}/store", f"{tmp_dir}/sink", step="1 minute", candle_periods=["1 minute", "3 minutes"],
                     level2_periods=["2 minutes"], params=params, chunk="1 hour")
    job.bootstrap(spark.createDataFrame(rows[:100], schema))
    live = f"{tmp_dir}/live"
    # the live feed starts inside the history (offsets rewound to it)
    for part in (rows[95:160], rows[160:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(live)
        q = job.start(spark.readStream.schema(schema).parquet(live), f"{tmp_dir}/ck", trigger={"availableNow": True})
        q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/sink").drop("date")
    full = fill_grid(spark.createDataFrame(rows, schema), "1 minute", ts="datetime", cols=CANDLE + L2_COLS, chunk="1 hour")
    want = clean_features(feature_frame(full, step="1 minute", candle_periods=["1 minute", "3 minutes"],
                                        level2_periods=["2 minutes"], params=params, chunk="1 hour"),
                          keep=["symbol", "datetime"])
    g = {r.datetime: r.asDict() for r in got.collect()}
    w = {r.datetime: r.asDict() for r in want.collect()}
    assert got.count() == len(g)  # no duplicates
    assert set(g) == set(w)
    for k, row in w.items():
        for c, v in row.items():
            if isinstance(v, float):
                assert abs(g[k][c] - v) < 1e-9, (k, c)
    assert F is not None


def test_feature_job_replayed_batch_writes_nothing_twice(spark, tmp_dir):
    from ticklake.plans.features import CANDLE
    from ticklake.schemas import L2_COLS
    from ticklake.streaming.features_job import FeatureJob
    t0 = dt(2025, 1, 1)
    rows = [("X", t0 + timedelta(minutes=i), 100.0 + i, 101.0 + i, 99.0 + i, 100.0 + i, 1.0,
             *[100.0 + i + k for k in range(6)]) for i in range(60)]
    schema = "symbol string, datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in CANDLE + L2_COLS)
    job = FeatureJob(f"{tmp_dir}/store", f"{tmp_dir}/sink", params={"rsi": {"window": 3}}, chunk="1 hour",
                     history_ready=True)
    batch = spark.createDataFrame(rows[30:], schema)
    job.bootstrap(spark.createDataFrame(rows[:30], schema))
    job.process(batch, 0)
    first = spark.read.parquet(f"{tmp_dir}/sink").count()
    job.process(batch, 0)  # the same epoch again, as after a restart
    again = spark.read.parquet(f"{tmp_dir}/sink")
    assert first > 0 and again.count() == first == again.select("datetime").distinct().count()
