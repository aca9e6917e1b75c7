"""Kafka option building, history read + backward merge, counters, per-file metrics."""
import json
import os
from datetime import datetime as dt

from ticklake.operators.metrics import observe_counts, rows_per_file, time_lag
from ticklake.plans.staging import RAW_CANDLE_FILE
from ticklake.sources import kafka
from ticklake.sources.files import read_history
from ticklake.schemas import STAGED_LEVEL2


def test_kafka_reader_options():
    o = kafka.reader_options("b:9092", ["raw.htx.market.x.bbo", "raw.alor.SBER.level2"], starting="earliest")
    assert o["subscribe"] == "raw.htx.market.x.bbo,raw.alor.SBER.level2" and o["startingOffsets"] == "earliest"
    o = kafka.reader_options("b:9092", "t", start_time_ms=1750000000000)
    assert o["startingTimestamp"] == "1750000000000" and "startingOffsets" not in o
    o = kafka.reader_options("b:9092", "t", offsets_by_partition={"t": {0: 15, 1: -2}})
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 15, "1": -2}}


def test_kafka_messages(spark):
    df = spark.createDataFrame([("X", dt(2025, 1, 1, 0, 1), 1.5)], "symbol string, datetime timestamp_ntz, v double")
    m = kafka.to_messages(df, key="symbol", topic="features").collect()[0]
    assert m.key == "X" and json.loads(m.value) == {"symbol": "X", "datetime": "2025-01-01 00:01:00.000000", "v": 1.5}
    raw = spark.createDataFrame([("market.X.bbo", 1750851712041)], "ch string, ts long")
    p = kafka.publish_raw(raw).collect()[0]
    assert p.topic == "raw.htx.market.x.bbo" and p.datetime == "2025-06-25 11:41:52.041"


def _csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")


def test_read_history_backward_merge(spark, tmp_dir):
    # level2 on the left, candles on the right, 60 s tolerance, unmatched dropped
    l2h = "symbol,datetime," + ",".join(c.name for c in STAGED_LEVEL2.fields[2:])
    _csv(f"{tmp_dir}/l2/2025-01-01_X.csv", l2h, [f"X,2025-01-01 00:0{m}:30,{m},1,1,1,1,1" for m in range(5)])
    _csv(f"{tmp_dir}/l2/2025-02-01_X.csv", l2h, ["X,2025-02-01 00:00:30,9,1,1,1,1,1"])  # out of range
    ch = "symbol,open_time,close_time,open,high,low,close,vol"
    _csv(f"{tmp_dir}/c/2025-01-01_X.csv", ch, ["X,2025-01-01 00:00:00,2025-01-01 00:01:00,1,1,1,1,1",
                                               "X,2025-01-01 00:02:00,2025-01-01 00:03:00,3,3,3,3,3"])
    from pyspark.sql import types as T
    cs = T.StructType([T.StructField("symbol", T.StringType())] + list(RAW_CANDLE_FILE.fields))
    out = read_history(spark, f"{tmp_dir}/l2", f"{tmp_dir}/c", level2_schema=STAGED_LEVEL2, candle_schema=cs,
                       start="2025-01-01", end="2025-01-31").orderBy("datetime").collect()
    # 00:00:30 has no candle at or before it; 00:01:30 -> 00:01 and 00:03:30 -> 00:03 (30 s);
    # 00:02:30 and 00:04:30 are 90 s after their candle (> 60 s): dropped
    assert [(r.datetime.minute, r.close_time.minute) for r in out] == [(1, 1), (3, 3)]


def test_observe_and_per_file(spark, tmp_dir):
    _csv(f"{tmp_dir}/f/a.csv", "x", ["1", "2"])
    _csv(f"{tmp_dir}/f/b.csv", "x", ["3"])
    df = spark.read.option("header", True).csv(f"{tmp_dir}/f")
    r = rows_per_file(df).collect()[0]
    assert (r.n_rows, r.n_files) == (3, 2)
    obs_df, obs = observe_counts(df, "read")
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 3
    t = spark.createDataFrame([("a", dt(2025, 1, 1, 0, 0, 10), dt(2025, 1, 1, 0, 1))],
                              "topic string, e timestamp_ntz, i timestamp_ntz")
    assert time_lag(t, event_ts="e", ingest_ts="i").collect()[0].max_lag_s == 50.0


def test_offsets_fallback_to_beginning():
    j = json.loads(kafka.offsets_json("t", 3, {0: 15, 2: 7}))
    assert j == {"t": {"0": 15, "1": -2, "2": 7}}
    o = kafka.reader_options("b", "t", offsets_by_partition={"t": {0: 15, 1: -2}})
    assert json.loads(o["startingOffsets"])["t"]["1"] == -2


def test_message_rate(spark):
    from ticklake.operators.metrics import message_rate
    t0 = dt(2025, 1, 1)
    df = spark.createDataFrame([("a", t0), ("a", t0.replace(second=30)), ("b", t0.replace(minute=1))],
                               "topic string, ts timestamp_ntz")
    got = {(r.topic, r.window_start.minute): (r.n, r.per_sec, r.per_min) for r in message_rate(df).collect()}
    assert got == {("a", 0): (2, 2 / 60, 2.0), ("b", 1): (1, 1 / 60, 1.0)}
