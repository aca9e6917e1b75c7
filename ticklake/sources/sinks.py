"""Sinks: staged tables, raw archives, exports.

Staged tables are partitioned by ``symbol`` and ``date`` and written with
dynamic partition overwrite, so re-staging a day replaces exactly that day
(idempotent reruns, no whole-table rewrite).  Timestamps stay typed in
Parquet; CSV exports format them as text only at the sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_date(df: DataFrame, ts: str, out: str = "date") -> DataFrame:
    return df.withColumn(out, F.to_date(ts))


def format_times(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Timestamps to strings in the original column order (CSV/JSON exports)."""
    return df.select(*[F.date_format(c.name, fmt).alias(c.name)
                       if isinstance(c.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(c.name)
                       for c in df.schema.fields])


def write_staged(df: DataFrame, path: str, *, ts: str = "datetime", fmt: str = "parquet",
                 partition_by: Sequence[str] = ("symbol", "date"), max_records_per_file: int | None = None) -> None:
    """Write a staged table; partitions present in ``df`` are replaced, the
    others are kept (``partitionOverwriteMode=dynamic``)."""
    out = with_date(df, ts) if "date" in partition_by and "date" not in df.columns else df
    if fmt == "csv":
        out = format_times(out)
    # cluster rows by the output partitions so each task writes few files; a
    # rebalance splits a partition that is too large for one task
    out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    w = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).format(fmt))
    if fmt == "csv":
        w = w.option("header", True)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def archive_partitions(df: DataFrame, zone: str = "UTC", clock=None) -> DataFrame:
    """``year/month/day`` partition columns from the wall clock in ``zone``
    (the archive rotates on arrival time, not event time)."""
    now = clock if clock is not None else F.current_timestamp()
    local = F.from_utc_timestamp(now, zone)
    return (df.withColumn("year", F.date_format(local, "yyyy"))
            .withColumn("month", F.date_format(local, "MM"))
            .withColumn("day", F.date_format(local, "dd")))


def archive_raw(stream: DataFrame, path: str, checkpoint: str, *, zone: str = "Europe/Moscow",
                every: str = "1 hour", max_records_per_file: int | None = None, trigger: dict | None = None):
    """Continuously archive raw messages as gzip JSON lines under
    ``year=/month=/day=``; one file set per trigger (hourly rotation by
    default; ``every="1 minute", max_records_per_file=100`` for the fast
    rotating variant).  Returns the started query."""
    out = archive_partitions(stream, zone)
    w = (out.writeStream.format("json").option("compression", "gzip").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("year", "month", "day")
         .trigger(**(trigger or {"processingTime": every})).outputMode("append"))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w.start()
