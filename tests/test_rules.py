"""Null and tie rules, settings that win, and options that reach the reader."""
import json
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticklake import session
from ticklake.operators.asof import asof_join
from ticklake.operators.bars import last_state_bars, ohlc_bars
from ticklake.operators.increment import keep_last, time_gap
from ticklake.operators.metrics import ProgressCollector
from ticklake.sources import kafka
from ticklake.sources.files import read_history

T = dt(2025, 1, 1)


def ticks(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double, vol double, seq bigint")


def test_null_sequence_is_first_of_its_time(spark):
    later = T.replace(second=2)
    rows = [("X", T.replace(second=1), 1.0, 1.0, 5), ("X", later, 2.0, 1.0, None), ("X", later, 3.0, 1.0, -9)]
    got = ohlc_bars(ticks(spark, rows), "1 minute", seq=["seq"]).first()
    assert (got.open, got.close, got.n) == (1.0, 3.0, 3)
    got = ohlc_bars(ticks(spark, rows[:2]), "1 minute", seq=["seq"]).first()
    assert (got.close, got.n) == (2.0, 2)


def test_ties_without_sequence_do_not_depend_on_the_order_of_rows(spark):
    rows = [("X", T.replace(second=1), float(p), 1.0, 0) for p in range(20)]
    picks = {last_state_bars(ticks(spark, r).repartition(n), cols=["price"]).first().price
             for n, r in ((1, rows), (3, rows[::-1]), (7, rows[7:] + rows[:7]))}
    kept = {tuple(sorted(r.price for r in keep_last(ticks(spark, r).repartition(n), 3, ts="ts").collect()))
            for n, r in ((1, rows), (3, rows[::-1]))}
    assert len(picks) == 1 and len(kept) == 1


@pytest.mark.parametrize("how,want", [("inner", [("X", 1.0)]), ("left", [("X", 1.0), (None, None)])])
def test_null_keys_match_nothing(spark, how, want):
    left = spark.createDataFrame([("X", T), (None, T)], "symbol string, ts timestamp_ntz")
    right = spark.createDataFrame([("X", T, 1.0), (None, T, 2.0)], "symbol string, ts timestamp_ntz, v double")
    got = asof_join(left, right, how=how).select("symbol", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_gap_of_one_side_only(spark):
    s = "symbol string, datetime timestamp_ntz"
    got = {r.symbol: r for r in time_gap(spark.createDataFrame([("a", T), ("b", T)], s), spark.createDataFrame([("b", T), ("c", T)], s)).collect()}
    assert (got["a"].gap_seconds, got["a"].is_good, got["c"].gap_seconds, got["c"].is_good) == (None, False, None, False)
    assert (got["b"].gap_seconds, got["b"].is_good) == (0.0, True)


def test_kafka_options():
    assert kafka.reader_options("h:1", "t")["failOnDataLoss"] == "true"
    assert kafka.reader_options("h:1", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    text = kafka.offsets_json("t", 3, {1: 42})
    assert json.loads(kafka.reader_options("h:1", "t", offsets_by_partition=text)["startingOffsets"]) == {"t": {"0": -2, "1": 42, "2": -2}}
    assert kafka.mark_options("h:1", "t")["startingOffsets"] == "earliest"
    ends = kafka.mark_options("h:1", "t", since_ms=7)
    assert ends["startingTimestamp"] == "7" and "startingOffsets" not in ends


def test_callers_settings_win_and_come_back(spark):
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    with session.setting(spark, key, "false"):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == "true"
    spark.conf.set(key, before)


def test_no_shared_folder_is_an_error_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_progress_is_bounded():
    assert ProgressCollector(keep=3).events.maxlen == 3


def test_history_of_zipped_and_plain_files(spark, tmp_dir):
    import os
    import zipfile
    for kind in ("l2", "c"):
        os.makedirs(f"{tmp_dir}/{kind}")
    with open(f"{tmp_dir}/l2/2025-01-01_X.csv", "w") as f:
        f.write("datetime,l2_bid_max\n2025-01-01 00:00:30,5.0\n")
    with zipfile.ZipFile(f"{tmp_dir}/c/2025-01-01_X.csv.zip", "w") as z:
        z.writestr("x.csv", "close_time,close\n2025-01-01 00:00:00,7.0\n")
    schemas = {"level2_schema": "datetime timestamp_ntz, l2_bid_max double", "candle_schema": "close_time timestamp_ntz, close double"}
    got = read_history(spark, f"{tmp_dir}/l2", f"{tmp_dir}/c", end="2025-01-20", **schemas)
    assert [(r.symbol, r.l2_bid_max, r.close) for r in got.collect()] == [("X", 5.0, 7.0)]
    for bounds in ({"end": "2025-03-20"}, {}, {"start": "2024-01-01", "end": "2024-02-01"}):  # the default range is the last 30 days
        none = read_history(spark, f"{tmp_dir}/l2", f"{tmp_dir}/c", **bounds, **schemas)
        assert none.columns == got.columns and none.count() == 0
    assert F is not None


def test_bar_aggregation_can_be_replaced(spark):
    rows = [("X", T.replace(second=i), float(i), 2.0, i) for i in range(1, 5)]
    got = last_state_bars(ticks(spark, rows), aggs=[F.sum("vol").alias("v"), F.count(F.lit(1)).alias("n")]).first()
    assert got.asDict().keys() == {"symbol", "open_time", "close_time", "v", "n"} and (got.v, got.n) == (8.0, 4)


def test_csv_sink_writes_times_as_text_in_column_order(spark, tmp_dir):
    from ticklake.sources.sinks import write_staged
    df = spark.createDataFrame([("X", T, 1.5)], "symbol string, datetime timestamp_ntz, v double")
    write_staged(df, f"{tmp_dir}/c", fmt="csv")
    got = spark.read.option("header", True).csv(f"{tmp_dir}/c")
    assert got.columns[:2] == ["datetime", "v"] and [(r.datetime, r.v) for r in got.collect()] == [("2025-01-01 00:00:00", "1.5")]


def test_archive_rotates_by_records(spark, tmp_dir):
    import glob
    import os
    from ticklake.sources.sinks import archive_raw
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.txt", "w") as f:
        f.write("\n".join(f"m{i}" for i in range(250)))
    archive_raw(spark.readStream.text(f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ck", max_records_per_file=100,
                trigger={"availableNow": True}).awaitTermination()
    assert len(glob.glob(f"{tmp_dir}/out/year=*/month=*/day=*/*.gz")) == 3 and spark.read.json(f"{tmp_dir}/out").count() == 250


def test_features_only_at_input_times(spark):
    from ticklake.operators.indicators import clean_features
    s = "symbol string, datetime timestamp_ntz, f double"
    f = spark.createDataFrame([("X", T, 1.0), ("X", T.replace(minute=1), 2.0), ("X", T.replace(minute=2), float("inf"))], s)
    keep = ["symbol", "datetime"]
    got = clean_features(f, keep=keep, inputs=f.where("f <> 2.0").unionByName(f.where("f <> 2.0")))
    assert [r.f for r in got.collect()] == [1.0]
