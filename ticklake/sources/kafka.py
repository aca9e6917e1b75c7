"""Kafka adapters (Structured Streaming).

The Kafka connector jar is not part of a plain PySpark install; these
functions build the reader/writer with the options the jobs need and are
exercised against file sources in the tests.  Offsets are tracked by the
query checkpoint (no consumer-group commits), so a restart resumes exactly.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.sources.epochs import EpochTable


def reader_options(servers: str, topics: str | Sequence[str], *, starting: str = "latest",
                   start_time_ms: int | None = None, offsets_by_partition: Mapping | str | None = None,
                   max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``start_time_ms``: start every partition at the first offset at or after
    that time (``startingTimestamp``); partitions without a later message
    start at their end.  ``offsets_by_partition``: explicit
    ``{topic: {partition: offset}}`` (``-2`` = earliest, ``-1`` = latest), the
    way to send chosen partitions back to the beginning; the JSON text of
    :func:`offsets_for_time` (start at a time, else at the beginning) is
    taken as it is.  ``fail_on_data_loss=False`` goes on when offsets have
    expired; by default the query fails, so that no loss passes unseen.
    """
    opts = {"kafka.bootstrap.servers": servers,
            "subscribe": topics if isinstance(topics, str) else ",".join(topics),
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if isinstance(offsets_by_partition, str):
        opts["startingOffsets"] = offsets_by_partition
    elif offsets_by_partition:
        opts["startingOffsets"] = json.dumps({t: {str(p): o for p, o in ps.items()}
                                              for t, ps in offsets_by_partition.items()})
    elif start_time_ms is not None:
        opts["startingTimestamp"] = str(int(start_time_ms))
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        opts["startingOffsets"] = starting
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_topic(spark: SparkSession, servers: str, topics, **kw) -> DataFrame:
    """Stream of ``key, value (string), topic, partition, offset, timestamp``."""
    df = spark.readStream.format("kafka").options(**reader_options(servers, topics, **kw)).load()
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
                     "offset", "timestamp")


def to_messages(df: DataFrame, key: str | None = "symbol", topic: str | None = None) -> DataFrame:
    """Rows -> Kafka records: JSON value of all columns (timestamps as
    ISO strings), optional key and per-row ``topic`` column."""
    cols = [c for c in df.columns if c != "topic"]
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    out = [F.to_json(F.struct(*cols), {"timestampFormat": fmt, "timestampNTZFormat": fmt}).alias("value")]
    if key:
        out.append(F.col(key).cast("string").alias("key"))
    if topic is None and "topic" in df.columns:
        out.append(F.col("topic"))
    return df.select(*out)


def write_topic(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None, key: str | None = "symbol"):
    """Publish a stream (one write, batched by the sink; no per-row flush).
    Without ``topic`` the rows' ``topic`` column routes each record."""
    w = (to_messages(df, key, topic).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("checkpointLocation", checkpoint))
    if topic:
        w = w.option("topic", topic)
    return w.start()


def mark_options(servers: str, topic: str, since_ms: int | None = None) -> dict[str, str]:
    """Options of the batch read behind :func:`last_produced`."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "endingOffsets": "latest"}
    if since_ms is None:
        return opts | {"startingOffsets": "earliest"}
    return opts | {"startingTimestamp": str(int(since_ms)), "startingOffsetsByTimestampStrategy": "latest"}


def last_produced(spark: SparkSession, servers: str, topic: str, ts_field: str = "datetime",
                  key: str = "symbol", since_ms: int | None = None) -> DataFrame:
    """High-water mark of a feature topic: latest ``datetime`` per key, by a
    batch read (empty topic -> no rows -> keep everything).  With
    ``since_ms`` only each partition's end is read: the records published at
    or after that time.  A key that published nothing since then has no mark."""
    raw = spark.read.format("kafka").options(**mark_options(servers, topic, since_ms)).load()
    msg = F.from_json(F.col("value").cast("string"), f"{key} string, {ts_field} string")
    return (raw.select(msg.alias("m")).groupBy(F.col(f"m.{key}").alias(key))
            .agg(F.max(F.to_timestamp_ntz(F.col(f"m.{ts_field}"))).alias("hwm")))


def ending_options(servers: str, topic: str, ends: Mapping[int, int], back: int) -> dict[str, str]:
    """Options of a batch read of the last ``back`` records of each partition, whose next offsets are ``ends``."""
    starts = {str(p): max(0, o - back) for p, o in ends.items()}
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "false",  # what has expired is not at the end
            "startingOffsets": json.dumps({topic: starts}), "endingOffsets": json.dumps({topic: {str(p): o for p, o in ends.items()}})}


def renew_marks(table: EpochTable, recent: DataFrame, key: str = "symbol") -> DataFrame:
    """High-water marks of all keys: those kept in ``table`` and those seen in ``recent`` (``key``, ``hwm``; from the ends
    of the partitions), written back as one entry.

    The ends are a bounded read, and a key that has been silent for longer keeps its mark, so nothing of it is
    published again.  The new entry is listed before the old ones go: a crash in between leaves marks that are
    merged again, and a step that is run again changes nothing, as marks only grow.
    """
    kept = table.read()
    marks = recent.select(key, "hwm")
    if kept is not None:
        marks = marks.unionByName(kept.select(key, "hwm"))
    marks = marks.groupBy(key).agg(F.max("hwm").alias("hwm"))
    before = [e["name"] for e in table.entries()]
    table.replace(marks, f"marks-{uuid.uuid4().hex}")
    table.drop(before)
    return table.read().select(key, "hwm")


def publish_raw(df: DataFrame, ch: str = "ch", ts_ms: str = "ts") -> DataFrame:
    """Raw message with its event time added as a string and its topic."""
    from ticklake.functions.strings import topic_name
    from ticklake.functions.time import ntz_from_millis
    return (df.withColumn("datetime", F.date_format(ntz_from_millis(ts_ms), "yyyy-MM-dd HH:mm:ss.SSS"))
            .withColumn("topic", topic_name(F.lower(F.col(ch)))))


def publish_second_feed(parsed: DataFrame, subscriptions: DataFrame, into: str = "msg") -> DataFrame:
    """Second-feed messages (:func:`ticklake.operators.parse.parse_json` with
    ``keep`` columns) to publish: those of a known subscription, with their
    event time (``tso``, ``tst`` or ``t``) added as a string and the
    subscription's topic.  Unknown guids and replies other than 200 go."""
    from ticklake.functions.time import event_time_auto
    from ticklake.operators.parse import route_by_guid
    data = f"{into}.data"
    flat = parsed.withColumns({"guid": F.col(f"{into}.guid"), "httpCode": F.col(f"{into}.httpCode"),
                               "datetime": F.date_format(event_time_auto(f"{data}.tso", f"{data}.tst", f"{data}.t"),
                                                         "yyyy-MM-dd HH:mm:ss.SSS")})
    return route_by_guid(flat, subscriptions).drop(into)


def offsets_json(topic: str, partitions: int, first_offsets: Mapping[int, int]) -> str:
    """``startingOffsets`` JSON: each partition's first offset at or after the
    start time; partitions without such a message start at the beginning
    (-2), unlike ``startingTimestamp`` whose fallback is error or latest."""
    return json.dumps({topic: {str(p): int(first_offsets.get(p, -2)) for p in range(partitions)}})


def offsets_for_time(spark: SparkSession, servers: str, topic: str, start_time_ms: int, partitions: int) -> str:
    """Per-partition starting offsets for a point in time.  A batch read from
    ``start_time_ms`` (only records at or after it) gives each partition's
    first offset -- one row per partition reaches the driver."""
    recent = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingTimestamp", str(int(start_time_ms)))
              .option("startingOffsetsByTimestampStrategy", "latest").option("endingOffsets", "latest").load())
    firsts = recent.groupBy("partition").agg(F.min("offset").alias("offset")).collect()
    return offsets_json(topic, partitions, {r.partition: r.offset for r in firsts})
