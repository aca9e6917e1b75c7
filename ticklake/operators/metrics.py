"""Operational metrics as data: message rates, time lags, file counts,
stage counters and streaming progress.

Rates and lags are aggregations (tables you can chart or alert on), stage
row counters use ``DataFrame.observe`` (collected with the action that runs
the plan, no extra pass), and streaming progress comes from a
``StreamingQueryListener``.
"""

from __future__ import annotations

from collections import deque

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ticklake.operators.chunks import parse_duration_us


def message_rate(df: DataFrame, *, topic: str = "topic", ts: str = "ts", every: str = "1 minute") -> DataFrame:
    """Messages per topic and window: count, per second, per minute."""
    secs = parse_duration_us(every) / 1e6
    return (df.groupBy(F.col(topic).alias("topic"), F.window(ts, every).start.alias("window_start"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("per_sec", F.col("n") / secs)
            .withColumn("per_min", F.col("n") * 60.0 / secs))


def time_lag(df: DataFrame, *, event_ts: str, ingest_ts: Column | str, by: str | Sequence[str] = "topic") -> DataFrame:
    """Lag ``ingest - event`` in seconds per group: max, mean, count.  On a
    live stream pass ``F.current_timestamp()`` as ``ingest_ts``."""
    ing = F.col(ingest_ts) if isinstance(ingest_ts, str) else ingest_ts
    lag = F.timestamp_diff("MICROSECOND", F.col(event_ts), ing) / 1e6
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(F.max(lag).alias("max_lag_s"), F.avg(lag).alias("avg_lag_s"),
                                 F.count(F.lit(1)).alias("n"))


def file_counts(files: DataFrame, path: str = "path") -> DataFrame:
    """Files per directory and kind (``csv`` / ``csv.zip`` / other) with the
    range of file dates."""
    d = F.regexp_extract(F.col(path), r"^(.*)/[^/]*$", 1)
    kind = (F.when(F.col(path).endswith(".csv.zip"), F.lit("csv.zip"))
            .when(F.col(path).endswith(".csv"), F.lit("csv")).otherwise(F.lit("other")))
    return (files.groupBy(d.alias("dir"), kind.alias("kind"))
            .agg(F.count(F.lit(1)).alias("n_files"), F.min("file_date").alias("first_date"),
                 F.max("file_date").alias("last_date")))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per input file and directory of a file-based DataFrame."""
    f = F.col("_metadata.file_path")
    d = F.regexp_extract(f, r"^(.*)/[^/]*$", 1)
    return df.groupBy(d.alias("dir")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(f).alias("n_files"))


def observe_counts(df: DataFrame, name: str, *extra: Column):
    """Attach a row counter (and optional extra aggregates) to ``df``.
    Returns ``(df, observation)``; ``observation.get`` is filled by the first
    action on the returned frame, without an extra pass."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs


class ProgressCollector(StreamingQueryListener):
    """Streaming stage metrics: input rows, rate, event-time watermark,
    rows dropped behind the watermark, and observed metrics per batch.  The
    last ``keep`` batches are held, older ones are forgotten."""

    def __init__(self, keep: int = 1000):
        self.events: deque[dict] = deque(maxlen=keep)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(getattr(s, "numRowsDroppedByWatermark", 0) or 0 for s in (p.stateOperators or []))
        self.events.append({"id": str(p.id), "batch": p.batchId, "input_rows": p.numInputRows,
                            "rows_per_sec": p.processedRowsPerSecond, "watermark": (p.eventTime or {}).get("watermark"),
                            "dropped_by_watermark": dropped,
                            "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
