"""Staging replaces what it read: one file, one unit."""
import os
import time
from datetime import datetime as dt, timedelta

import pytest
from pyspark.sql import types as T

from ticklake.plans import staging
from ticklake.plans.staging import read_staged, register, stage_files


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def level2_day(day, base, n=48):
    rows = [f"{day} 00:{m // 2:02d}:{30 * (m % 2):02d}.5,{base},1,{base + 1},2" for m in range(n - 1)] + [f"{day} 23:59:30,{base},1,{base + 1},2"]
    return "datetime,bid,bid_vol,ask,ask_vol\n" + "\n".join(rows)


def rows_of(spark, dst, where="true"):
    return {(r.symbol, r.datetime, r.src, r.l2_bid_max) for r in spark.read.parquet(dst).where(where).collect()}


def test_update_of_a_day_keeps_the_next_day(spark, tmp_dir):
    src, dst = f"{tmp_dir}/s", f"{tmp_dir}/d"
    for day in (1, 2):
        put(f"{src}/2025-01-0{day}_BTC.csv", level2_day(f"2025-01-0{day}", 100))
    assert len(stage_files(spark, src, dst, "level2")) == 2
    other = rows_of(spark, dst, "src = '2025-01-02_BTC.csv'")
    assert len(other) == 25 and (dt(2025, 1, 3) in {r[1] for r in other})
    time.sleep(1.1)
    put(f"{src}/2025-01-01_BTC.csv", level2_day("2025-01-01", 200, 20))
    assert stage_files(spark, src, dst, "level2") == ["2025-01-01_BTC.csv"]
    assert rows_of(spark, dst, "src = '2025-01-02_BTC.csv'") == other
    assert {r[3] for r in rows_of(spark, dst, "src = '2025-01-01_BTC.csv'")} == {200.0}
    assert stage_files(spark, src, dst, "level2") == []


def test_days_in_separate_runs_keep_the_midnight_bar(spark, tmp_dir):
    src, dst = f"{tmp_dir}/s", f"{tmp_dir}/d"
    for day in (1, 2, 3):
        put(f"{src}/2025-01-0{day}_BTC.csv", level2_day(f"2025-01-0{day}", 100 * day))
        stage_files(spark, src, dst, "level2")
    got = {r[1]: r[3] for r in rows_of(spark, dst)}
    assert [got[dt(2025, 1, d + 1)] for d in (1, 2, 3)] == [100.0, 200.0, 300.0]
    assert read_staged(spark, dst, "datetime").count() == spark.read.parquet(dst).count() == 75


def test_two_files_of_one_symbol_day(spark, tmp_dir):
    src, dst = f"{tmp_dir}/s", f"{tmp_dir}/d"
    put(f"{src}/2025-01-01_BTC_a.csv", level2_day("2025-01-01", 100))
    put(f"{src}/2025-01-01_BTC_b.csv", level2_day("2025-01-01", 300, 10))
    stage_files(spark, src, dst, "level2")
    both = rows_of(spark, dst)
    time.sleep(1.1)
    put(f"{src}/2025-01-01_BTC_b.csv", level2_day("2025-01-01", 400, 10))
    stage_files(spark, src, dst, "level2")
    assert rows_of(spark, dst, "src like '%_a.csv'") == {r for r in both if r[2].endswith("_a.csv")}
    merged = {r.datetime: r.l2_bid_max for r in read_staged(spark, dst, "datetime").collect()}
    assert merged[dt(2025, 1, 1, 0, 1)] == 400.0 and merged[dt(2025, 1, 1, 0, 20)] == 100.0


def test_update_without_rows_removes_the_old_ones(spark, tmp_dir):
    src, dst = f"{tmp_dir}/s", f"{tmp_dir}/d"
    for day in (1, 2):
        put(f"{src}/2025-01-0{day}_BTC.csv", level2_day(f"2025-01-0{day}", 100))
    stage_files(spark, src, dst, "level2")
    time.sleep(1.1)
    put(f"{src}/2025-01-01_BTC.csv", "datetime,bid,bid_vol,ask,ask_vol\n")
    assert stage_files(spark, src, dst, "level2") == ["2025-01-01_BTC.csv"]
    assert {r[2] for r in rows_of(spark, dst)} == {"2025-01-02_BTC.csv"}
    assert stage_files(spark, src, dst, "level2") == []


def test_unreadable_manifest_raises(spark, tmp_dir):
    src, dst = f"{tmp_dir}/s", f"{tmp_dir}/d"
    put(f"{src}/2025-01-01_BTC.csv", level2_day("2025-01-01", 100))
    stage_files(spark, src, dst, "level2")
    for name in os.listdir(f"{dst}/_manifest"):
        if name.endswith(".parquet"):
            put(f"{dst}/_manifest/{name}", "broken")
            crc = f"{dst}/_manifest/.{name}.crc"
            os.path.exists(crc) and os.unlink(crc)
    with pytest.raises(Exception, match="parquet|Parquet|CANNOT_READ|FAILED_READ"):
        stage_files(spark, src, dst, "level2")


def test_a_failed_write_leaves_the_old_rows(spark, tmp_dir, monkeypatch):
    src, dst = f"{tmp_dir}/s", f"{tmp_dir}/d"
    for day in (1, 2):
        put(f"{src}/2025-01-0{day}_BTC.csv", level2_day(f"2025-01-0{day}", 100))
    stage_files(spark, src, dst, "level2")
    before = rows_of(spark, dst)
    time.sleep(1.1)
    put(f"{src}/2025-01-01_BTC.csv", "datetime,bid,bid_vol,ask,ask_vol\n")  # the new version has no rows
    put(f"{src}/2025-01-02_BTC.csv", level2_day("2025-01-02", 300))
    with monkeypatch.context() as m:
        m.setattr(staging, "write_staged", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            stage_files(spark, src, dst, "level2")
    assert rows_of(spark, dst) == before
    assert len(stage_files(spark, src, dst, "level2")) == 2
    assert {(r[2], r[3]) for r in rows_of(spark, dst)} == {("2025-01-02_BTC.csv", 300.0)}


def test_registered_kind(spark, tmp_dir):
    schema = T.StructType([T.StructField("datetime", T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
    register("plain", schema, "datetime", lambda raw, step: raw.select("unit", "datetime", "v"))
    put(f"{tmp_dir}/s/2025-01-01_BTC.csv", "datetime,v\n2025-01-01 00:00:01,1.5\n")
    assert stage_files(spark, f"{tmp_dir}/s", f"{tmp_dir}/d", "plain") == ["2025-01-01_BTC.csv"]
    assert [(r.symbol, r.v) for r in spark.read.parquet(f"{tmp_dir}/d").collect()] == [("BTC", 1.5)]
    with pytest.raises(ValueError):
        stage_files(spark, f"{tmp_dir}/s", f"{tmp_dir}/d", "nothing")
    assert timedelta is not None
