"""File sources and sinks on temp directories: listings, new-or-updated
files, daily CSV, zipped CSV, raw JSON archive, staged writes, ingest job."""
import io
import json
import os
import time
import zipfile
from datetime import date, datetime as dt, timedelta

from pyspark.sql import functions as F

from ticklake.sources.files import daily_files, find_updated_files, list_files, read_daily, read_raw_json, read_zip_csv
from ticklake.sources.sinks import archive_raw, write_staged
from ticklake.plans.staging import RAW_CANDLE_FILE, stage_files


def _touch(path, text="x\n", mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_listing_and_new_or_updated(spark, tmp_dir):
    base = time.time() - 86400
    src, dst = f"{tmp_dir}/src", f"{tmp_dir}/dst"
    _touch(f"{src}/2025-06-10_BTC.csv.zip", mtime=base)      # missing in target -> new
    _touch(f"{src}/2025-06-11_BTC.csv.zip", mtime=base)      # target has unzipped twin, older -> updated
    _touch(f"{src}/2025-06-12_BTC.csv.zip", mtime=base)      # target newer -> unchanged
    _touch(f"{src}/2025-06-13_BTC.csv", mtime=base + 100)    # target same name older -> updated
    _touch(f"{src}/2025-07-01_BTC.csv", mtime=base)          # out of range
    _touch(f"{src}/notes.txt", mtime=base)                   # not a daily file
    _touch(f"{src}/bad-name_BTC.csv", mtime=base)            # no date
    _touch(f"{dst}/2025-06-11_BTC.csv", mtime=base - 100)
    _touch(f"{dst}/2025-06-12_BTC.csv.zip", mtime=base + 100)
    _touch(f"{dst}/2025-06-13_BTC.csv", mtime=base)
    s, d = list_files(spark, src), list_files(spark, dst)
    assert s.schema["mtime"] is not None
    days = sorted(r.name for r in daily_files(s, "2025-06-10", "2025-06-30").collect())
    assert days == ["2025-06-10_BTC.csv.zip", "2025-06-11_BTC.csv.zip", "2025-06-12_BTC.csv.zip", "2025-06-13_BTC.csv"]
    upd = sorted(r.name for r in find_updated_files(s, d, date(2025, 6, 1), date(2025, 6, 30)).collect())
    assert upd == ["2025-06-10_BTC.csv.zip", "2025-06-11_BTC.csv.zip", "2025-06-13_BTC.csv"]
    recent = daily_files(s, "2025-06-01", "2025-06-30", modified_after=dt.fromtimestamp(base + 50))
    assert [r.name for r in recent.collect()] == ["2025-06-13_BTC.csv"]


def test_read_daily_cleans(spark, tmp_dir):
    _touch(f"{tmp_dir}/d/2025-01-01_X.csv", "Unnamed: 0,open_time,close_time,close,close_time.1\n"
                                            "0,2025-01-01 11:41:00,2025-01-01 11:42:00,1.5,x\n")
    _touch(f"{tmp_dir}/d/2025-01-02_X.csv", "Unnamed: 0,open_time,close_time,close,close_time.1\n"
                                            "0,2025-01-02 11:41:00,2025-01-02 11:42:00,2.5,x\n")
    df = read_daily(spark, f"{tmp_dir}/d")
    assert df.columns == ["open_time", "close_time", "close", "_file"]
    assert sorted(r.close_time for r in df.collect()) == [dt(2025, 1, 1, 11, 42), dt(2025, 1, 2, 11, 42)]


def _zip_csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(os.path.basename(path)[:-4], text)


def test_read_zip_csv(spark, tmp_dir):
    text = "open_time,close_time,open,high,low,close,vol,close_time.1\n" + "\n".join(
        f"2025-01-01 11:{m:02d}:00,2025-01-01 11:{m + 1:02d}:00,{m},{m + 1},{m - 1},{m},1,x" for m in range(10))
    _zip_csv(f"{tmp_dir}/z/2025-01-01_BTC_candles.csv.zip", text)
    df = read_zip_csv(spark, f"{tmp_dir}/z", RAW_CANDLE_FILE)
    rows = df.orderBy("open_time").collect()
    assert len(rows) == 10 and rows[3].open == 3.0 and rows[3].close_time == dt(2025, 1, 1, 11, 4)
    assert rows[0]._file.endswith(".csv.zip")


def test_raw_json_archive_partitions(spark, tmp_dir):
    for day in ("01", "02"):
        _touch(f"{tmp_dir}/arch/year=2025/month=08/day={day}/part.json",
               json.dumps({"guid": "g", "data": {"t": 1.0}}) + "\n")
    txt = read_raw_json(spark, f"{tmp_dir}/arch")
    assert set(txt.columns) >= {"value", "year", "month", "day"}
    assert txt.where(F.col("day") == 2).count() == 1
    parsed = read_raw_json(spark, f"{tmp_dir}/arch", schema=__import__("ticklake.schemas", fromlist=["x"]).RAW_SECOND_EXCHANGE)
    assert parsed.count() == 2


def test_write_staged_dynamic_overwrite(spark, tmp_dir):
    out = f"{tmp_dir}/staged"
    s = "symbol string, datetime timestamp_ntz, v double"
    write_staged(spark.createDataFrame([("X", dt(2025, 1, 1, 1), 1.0), ("X", dt(2025, 1, 2, 1), 2.0)], s), out)
    write_staged(spark.createDataFrame([("X", dt(2025, 1, 2, 5), 3.0)], s), out)  # replaces day 2 only
    got = sorted((r.datetime, r.v) for r in spark.read.parquet(out).collect())
    assert got == [(dt(2025, 1, 1, 1), 1.0), (dt(2025, 1, 2, 5), 3.0)]


def test_archive_sink(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _touch(f"{src}/a.txt", '{"ch": "x"}\n{"ch": "y"}\n')
    q = archive_raw(spark.readStream.text(src), f"{tmp_dir}/arch", f"{tmp_dir}/ck", zone="UTC",
                    trigger={"availableNow": True})
    q.awaitTermination()
    back = spark.read.json(f"{tmp_dir}/arch")
    assert back.count() == 2 and {"year", "month", "day"} <= set(back.columns)
    assert any(n.endswith(".gz") for _, _, fs in os.walk(f"{tmp_dir}/arch") for n in fs)


def test_stage_files_incremental(spark, tmp_dir):
    src, dst = f"{tmp_dir}/src", f"{tmp_dir}/dst"
    def day_text(d, base):
        return "open_time,close_time,open,high,low,close,vol\n" + "\n".join(
            f"{d} 11:{m:02d}:00,{d} 11:{m + 1:02d}:00,{base + m},{base + m},{base + m},{base + m},{m}" for m in range(5))
    _zip_csv(f"{src}/2025-01-01_BTC_candles.csv.zip", day_text("2025-01-01", 100))
    _touch(f"{src}/2025-01-02_BTC_candles.csv", day_text("2025-01-02", 200))
    assert stage_files(spark, src, dst, "candles") == ["2025-01-01_BTC_candles.csv.zip", "2025-01-02_BTC_candles.csv"]
    assert spark.read.parquet(dst).count() == 10
    assert stage_files(spark, src, dst, "candles") == []        # nothing new
    time.sleep(1.1)
    _touch(f"{src}/2025-01-02_BTC_candles.csv", day_text("2025-01-02", 300))  # updated at the source
    assert stage_files(spark, src, dst, "candles") == ["2025-01-02_BTC_candles.csv"]
    got = spark.read.parquet(dst)
    assert got.count() == 10 and got.where("symbol = 'BTC' AND close >= 300").count() == 5
    assert got.where("close >= 200 AND close < 300").count() == 0
    assert io is not None and timedelta is not None
