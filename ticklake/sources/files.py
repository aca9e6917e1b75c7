"""File sources: listings, daily files, zipped CSV, raw JSON archives.

A directory listing is a DataFrame (``path, name, file_date, mtime``) built
from the ``binaryFile`` source with the ``content`` column pruned, so only
file metadata is read.  Selecting files (date in the name, modification
time, new-or-updated against a target) is a filter or join on listings;
reading the selected files is one scan over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.strings import base_name, file_date, strip_zip
from ticklake.operators.parse import clean_columns

DAILY_SUFFIXES = (".csv", ".csv.zip")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there.  Any other trouble (no access, broken files) is left to raise on reading."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_files(spark: SparkSession, directory: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``path, name, file_date, mtime, size`` of the files under ``directory``."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(directory).select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    return listing(df)


def listing(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``name`` (base name) and ``file_date`` (date prefix of the name)."""
    return (df.withColumn("name", base_name(path))
            .withColumn("file_date", file_date(path)))


def _as_ts(v):
    """A time bound as a ``timestamp_ntz`` literal built from text (no zone
    conversion); Columns pass through."""
    if v is None:
        return None
    if isinstance(v, date) and not isinstance(v, datetime):
        v = datetime(v.year, v.month, v.day)
    if isinstance(v, datetime):
        v = v.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(v).cast("timestamp_ntz") if isinstance(v, str) else v


def daily_files(files: DataFrame, start: date | str | None = None, end: date | str | None = None,
                modified_after=None, suffixes: Sequence[str] = DAILY_SUFFIXES) -> DataFrame:
    """Daily CSV files with the date in the name within ``[start, end]``
    (inclusive) and modified at or after ``modified_after``.  Other files and
    names without a date are skipped."""
    cond = F.col("file_date").isNotNull()
    if suffixes:
        ok = F.lit(False)
        for s in suffixes:
            ok = ok | F.col("name").endswith(s)
        cond = cond & ok
    if start is not None:
        cond = cond & (F.col("file_date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        cond = cond & (F.col("file_date") <= F.lit(str(end)).cast("date"))
    if modified_after is not None:
        mt = F.col("mtime").cast("timestamp_ntz") if files.schema["mtime"].dataType != T.TimestampNTZType() \
            else F.col("mtime")
        cond = cond & (mt >= _as_ts(modified_after))
    return files.where(cond)


def find_updated_files(src: DataFrame, dst: DataFrame, start=None, end=None) -> DataFrame:
    """Source files missing in the target or newer there.

    A source ``x.csv.zip`` may be stored unzipped as ``x.csv`` in the target;
    the target file with the exact name wins over the unzipped twin.  Both
    listings are restricted to daily files within ``[start, end]``.
    """
    s = daily_files(src, start, end).select("name", "path", "file_date", "mtime")
    d = daily_files(dst, start, end).select("name", "mtime")
    exact = d.select(F.col("name").alias("_n1"), F.col("mtime").alias("_m1"))
    twin = d.select(F.col("name").alias("_n2"), F.col("mtime").alias("_m2"))
    j = (s.join(exact, s["name"] == exact["_n1"], "left")
         .join(twin, strip_zip(s["name"]) == twin["_n2"], "left"))
    dst_mtime = F.coalesce(F.col("_m1"), F.col("_m2"))
    return (j.where(dst_mtime.isNull() | (F.col("mtime") > dst_mtime))
            .select("name", "path", "file_date", "mtime"))


def read_daily(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType | str | None = None,
               header: bool = True) -> DataFrame:
    """One scan over many daily CSV files (a list of paths or a directory).

    With a schema the columns are typed at the reader (no inference pass);
    without one the header names are kept as strings and cleaned
    (``clean_columns``: junk export columns dropped, time columns cast).
    The source file of each row is kept in ``_file``.
    """
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    df = r.csv(list(paths) if not isinstance(paths, str) else paths)
    df = df.withColumn("_file", F.col("_metadata.file_path"))
    return clean_columns(df)


def read_zip_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType) -> DataFrame:
    """Zipped CSV files (zip is not a Hadoop codec): whole files are read as
    binary, one file per task, and unzipped and parsed with pandas inside
    ``mapInPandas``.  Output columns follow ``schema`` (by name) plus
    ``_file``."""
    out_schema = T.StructType(list(schema.fields) + [T.StructField("_file", T.StringType())])
    names = [f.name for f in schema.fields]

    def unzip(batches):
        import io
        import zipfile

        import pandas as pd
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in z.namelist():
                        if member.endswith("/"):
                            continue
                        with z.open(member) as fh:
                            for part in pd.read_csv(fh, chunksize=100_000):
                                part = part[[c for c in part.columns if c in names]].copy()
                                for f in schema.fields:
                                    if f.name not in part.columns:
                                        part[f.name] = None
                                    elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
                                        part[f.name] = pd.to_datetime(part[f.name])
                                part["_file"] = path
                                yield part[names + ["_file"]]

    src = spark.read.format("binaryFile").load(list(paths) if not isinstance(paths, str) else paths)
    return src.select("path", "content").mapInPandas(unzip, out_schema)


def read_raw_json(spark: SparkSession, directory: str, schema: T.StructType | None = None) -> DataFrame:
    """Raw message archive (``year=/month=/day=`` partitions, JSON lines,
    gzip or plain).  Without a schema: the text lines (``value``) plus the
    partition columns; with a schema: parsed rows.  A date filter on the
    partition columns prunes directories before any file is opened."""
    if schema is None:
        return spark.read.text(directory)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(directory)


HISTORY_DAYS = 30


def read_history(spark: SparkSession, level2_dir: str, candles_dir: str, *, level2_schema, candle_schema,
                 start=None, end=None, modified_after=None, tolerance: str = "60 seconds",
                 symbol: str = "symbol", chunk: str = "1 hour", days: int = HISTORY_DAYS) -> DataFrame:
    """History for the feature job: daily level2 and candle files (plain or
    zipped) within ``[start, end]``, read in one scan each and merged
    backward as-of (level2 on the left, within ``tolerance``; rows without a
    match dropped).  Without ``start`` the last ``days`` days up to ``end``
    (default: today, UTC) are read.  The symbol comes from the files'
    ``symbol`` column, or else from their names.  No files of either kind:
    an empty result of the same columns."""
    from datetime import timedelta, timezone

    from ticklake.functions.strings import symbol_from_file
    from ticklake.operators.asof import asof_join
    if start is None:
        last = date.fromisoformat(str(end)) if end is not None else datetime.now(timezone.utc).date()
        start = last - timedelta(days=days)

    def side(directory, schema):
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        found = daily_files(list_files(spark, directory), start, end, modified_after).select("path").collect()
        if found:
            df = read_raw(spark, [r.path for r in found], schema)
        else:
            df = spark.createDataFrame([], T.StructType(list(schema.fields) + [T.StructField("_file", T.StringType())]))
        if symbol not in df.columns:
            df = df.withColumn(symbol, symbol_from_file("_file"))
        return df.drop("_file")

    return asof_join(side(level2_dir, level2_schema), side(candles_dir, candle_schema), on=symbol, left_ts="datetime",
                     right_ts="close_time", direction="backward", tolerance=tolerance, how="inner", chunk=chunk)


def read_raw(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Plain and zipped daily CSV files as one frame: ``schema``'s columns and ``_file``."""
    zips = [p for p in paths if p.endswith(".zip")]
    csvs = [p for p in paths if not p.endswith(".zip")]
    parts = []
    if zips:
        parts.append(read_zip_csv(spark, zips, schema))
    if csvs:
        parts.append(read_daily(spark, csvs, schema).select(*[f.name for f in schema.fields], "_file"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
