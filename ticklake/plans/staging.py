"""Batch staging job: daily exchange files -> staged tables.

1. list the source directory and read the manifest (metadata only);
2. keep the daily files within ``[start, end]`` that are new or newer than
   the version in the manifest (``find_updated_files``);
3. read all selected files in one scan (zipped CSV via ``read_zip_csv``,
   plain CSV via ``read_daily``), symbol and date from the file name;
4. stage each file by itself (last-state candles or level2 expectation
   means) and replace what an older version of it had staged.

The unit that is replaced is the unit that was read: the staged table is
partitioned by ``symbol``, ``date`` and ``src`` -- the source file's date and
its name without ``.zip`` -- so a file's right-labelled midnight bar, which
is dated the next day, stays with its file, and no other file's rows are
touched.  :func:`read_staged` gives one row per bar.

The manifest (``_manifest`` in the staged folder: name, modification time)
is appended after the data is written.  A run that fails in between stages
the same files again, into the same partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.strings import base_name, file_date, strip_zip, symbol_from_file
from ticklake.operators import bars, book
from ticklake.sources.files import find_updated_files, list_files, path_exists, read_raw
from ticklake.sources.sinks import write_staged

RAW_CANDLE_FILE = T.StructType([T.StructField(c, T.TimestampNTZType()) for c in ("open_time", "close_time")]
                               + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "vol")])
RAW_LEVEL2_FILE = T.StructType([T.StructField("datetime", T.TimestampNTZType())]
                               + [T.StructField(c, T.DoubleType()) for c in ("bid", "bid_vol", "ask", "ask_vol")])


#: What is staged of a file, by kind: (schema of the file, time column, DataFrame of the file's rows -> bars).
#: The rows have ``unit``, the file they come from, as their symbol.
KINDS: dict[str, tuple] = {}


def register(kind: str, schema: T.StructType, ts: str, stage) -> None:
    """Make ``stage_files`` know another kind of file."""
    KINDS[kind] = (schema, ts, stage)


def _candles(raw: DataFrame, step: str) -> DataFrame:
    # last state per right-closed bar of the candle close time; rows of
    # equal time keep their file order (row id) as the tie-break
    raw = raw.withColumn("_row", F.monotonically_increasing_id()).drop("open_time")
    return bars.last_state_bars(raw, step, symbol="unit", ts="close_time", seq=["_row"], cols=["open", "high", "low", "close", "vol"])


def _level2(raw: DataFrame, step: str) -> DataFrame:
    return book.level2_bars(book.book_expectation_rows(raw, symbol="unit"), step, symbol="unit")


register("candles", RAW_CANDLE_FILE, "close_time", _candles)
register("level2", RAW_LEVEL2_FILE, "datetime", _level2)


def _manifest(spark: SparkSession, dst: str) -> DataFrame:
    """The staged files with the newest version staged of each.  Absent: nothing was staged; unreadable: it raises."""
    path = f"{dst}/_manifest"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "name string, path string, file_date date, mtime timestamp_ntz")
    return (spark.read.parquet(path).groupBy("name").agg(F.max("mtime").alias("mtime"))
            .withColumn("path", F.col("name"))
            .withColumn("file_date", F.try_to_date(F.substring_index("name", "_", 1), "yyyy-MM-dd")))


def read_staged(spark: SparkSession, dst: str, ts: str) -> DataFrame:
    """The staged bars, one row per (symbol, ``ts``).  Where two files hold the
    same bar (a midnight bar that the next file repeats, or two files of a
    day), the later one by date, then name, holds it.  The narrow key column
    is aggregated before the shuffle; ``date`` filters prune partitions."""
    t = spark.read.parquet(dst)
    values = [c for c in t.columns if c not in ("symbol", ts, "src", "date")]
    last = F.max(F.struct("date", "src", *values)).alias("_last")
    return t.groupBy("symbol", ts).agg(last).select("symbol", ts, *[F.col(f"_last.{c}").alias(c) for c in [*values, "date", "src"]])


def stage_files(spark: SparkSession, src_dir: str, dst_dir: str, kind: str, *, start=None, end=None,
                step: str = "1 minute") -> list[str]:
    """Stage the new or updated daily files of ``kind`` (``candles``,
    ``level2`` or a registered one); returns the names staged."""
    if kind not in KINDS:
        raise ValueError(kind)
    schema, ts, stage = KINDS[kind]
    src = list_files(spark, src_dir).withColumn("mtime", F.col("mtime").cast("timestamp_ntz"))
    # the reader takes a list of paths: one short row per file to stage goes through the driver
    rows = find_updated_files(src, _manifest(spark, dst_dir), start, end).select("path", "name", "mtime").collect()
    if not rows:
        return []
    raw = read_raw(spark, [r.path for r in rows], schema).withColumn("unit", strip_zip(base_name("_file")))
    staged = stage(raw, step).withColumn("src", F.col("unit")) \
        .withColumn("symbol", symbol_from_file("src")).withColumn("date", file_date("src")).drop("unit")
    # a file's partition is replaced by the write; only then goes what a new version without rows has left
    before = {r.name: _files(spark, dst_dir, r.name) for r in rows}
    write_staged(staged, dst_dir, ts=ts, partition_by=("symbol", "date", "src"))
    _clear(spark, dst_dir, [name for name, files in before.items() if files and _files(spark, dst_dir, name) == files])
    (spark.createDataFrame([(r.name, r.mtime) for r in rows], "name string, mtime timestamp_ntz").coalesce(1)
     .write.mode("append").parquet(f"{dst_dir}/_manifest"))
    return sorted(r.name for r in rows)


def _partition(spark: SparkSession, dst: str, name: str):
    """File system and path of the partition that a file is staged to."""
    unit = name.removesuffix(".zip")
    parts = unit.removesuffix(".csv").split("_")
    symbol = parts[1] if len(parts) > 1 else "__HIVE_DEFAULT_PARTITION__"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{dst}/symbol={symbol}/date={parts[0]}/src={unit}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, dst: str, name: str) -> set[str]:
    """The files of a partition; each write gives them new names."""
    fs, p = _partition(spark, dst, name)
    return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()


def _clear(spark: SparkSession, dst: str, names: list[str]) -> None:
    """Drop the partitions of files whose new version has no rows."""
    for name in names:
        fs, p = _partition(spark, dst, name)
        fs.delete(p, True)
