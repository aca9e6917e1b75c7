"""Streaming staging: raw exchange messages -> minute bars per kind.

The source is read once, and every message is parsed once: one query parses
the frames, routes them by kind (unreadable ones too) and writes them typed,
partitioned by kind.  A query per kind, each with its own checkpoint, reads
its partition of that table and needs no JSON any more; a kind added later
can be staged from what is there.

Bars are right-closed: the bin column is ``event_time - 1us`` and carries the
watermark, so a bar is emitted once an event more than ``lateness`` past its
end has been seen.  Messages later than the watermark are dropped and counted
by Spark (``numRowsDroppedByWatermark`` in the progress events, see
``ProgressCollector``); state lives in the checkpoint, so a restart loses no
partial minute.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.strings import channel_symbol
from ticklake.functions.time import to_instant, to_wall
from ticklake.operators import bars, book, parse

QUARANTINE = "quarantine"


def _candles(frames: DataFrame, step: str, lateness: str, seq: list[str]) -> DataFrame:
    t = parse.candle_ticks(frames).withColumn("ts", to_instant("ts"))
    out = bars.stage_candles(t, step, seq=seq, lateness=lateness)
    return out.withColumn("open_time", to_wall("open_time")).withColumn("close_time", to_wall("close_time"))


def _level2(frames: DataFrame, step: str, lateness: str, seq: list[str]) -> DataFrame:
    m = frames.select(channel_symbol("msg.ch").alias("symbol"),
                      to_instant(parse.ntz_from_millis(F.coalesce("msg.tick.ts", "msg.ts"))).alias("datetime"),
                      F.col("msg.tick.bids").alias("bids"), F.col("msg.tick.asks").alias("asks"))
    return book.stage_level2(m, step, lateness=lateness).withColumn("datetime", to_wall("datetime"))


def _bid_ask(frames: DataFrame, step: str, lateness: str, seq: list[str]) -> DataFrame:
    return parse.stage_bid_ask(frames)


#: Kind -> (parsed frames, step, lateness, sequence columns) -> staged rows.
STAGERS: dict[str, Callable[[DataFrame, str, str, list[str]], DataFrame]] = {
    "candles": _candles, "level2": _level2, "bid_ask": _bid_ask}
KINDS = tuple(STAGERS)


def register(kind: str, stager: Callable[[DataFrame, str, str, list[str]], DataFrame]) -> None:
    """Stage a further kind of :func:`ticklake.operators.parse.parse_frames` (``other``, say), or one differently."""
    STAGERS[kind] = stager


def _staged(frames: DataFrame, kind: str, step: str, lateness: str, seq: str | None) -> DataFrame:
    if kind not in STAGERS:
        raise ValueError(kind)
    keep = [seq] if seq and seq in frames.columns else []
    return STAGERS[kind](frames.where(F.col("kind") == kind).select(*keep, "msg"), step, lateness, keep)


def stage_stream(raw: DataFrame, kind: str, *, step: str = "1 minute", lateness: str = "10 seconds",
                 seq: str | None = "offset") -> DataFrame:
    """Staged rows of one kind from a stream of JSON text (``value``)."""
    keep = [seq] if seq and seq in raw.columns else []
    return _staged(parse.parse_frames(raw, keep=keep), kind, step, lateness, seq)


def route_frames(raw: DataFrame, seq: str | None = "offset") -> DataFrame:
    """The parsed frames to write, partitioned by ``kind``; the text stays with unreadable ones only.  Control frames go."""
    keep = [seq] if seq and seq in raw.columns else []
    frames = parse.parse_frames(raw, keep=keep).where("kind <> 'control'")
    bad = F.col("kind") == QUARANTINE
    # observed by name: how many messages no kind can read
    return frames.select(*keep, F.when(bad, F.col("value")).alias("value"), F.when(~bad, F.col("msg")).alias("msg"), "topic", "kind") \
        .observe(QUARANTINE, F.count(F.when(bad, 1)).alias("rows"))


def start_staging(raw: DataFrame, out_dir: str, checkpoint_dir: str, *, kinds=KINDS, step: str = "1 minute",
                  lateness: str = "10 seconds", trigger: dict | None = None, fmt: str = "parquet"):
    """Start the query that parses and routes (``out_dir/frames``), and from
    its table one append-mode query per kind (``out_dir/<kind>``) and one that
    keeps unreadable messages (``out_dir/quarantine``); the first one's
    progress events count them (observed metric ``quarantine``).  With a
    trigger that ends, the others start when the frames are written."""
    spark, trigger = raw.sparkSession, trigger or {}
    frames = route_frames(raw)
    path = f"{out_dir}/frames"

    def started(df: DataFrame, name: str, target: str, by: tuple[str, ...] = (), kind: str = fmt):
        w = (df.writeStream.format(kind).outputMode("append").option("path", target)
             .option("checkpointLocation", f"{checkpoint_dir}/{name}").queryName(f"staging_{name}"))
        w = w.partitionBy(*by) if by else w
        return (w.trigger(**trigger) if trigger else w).start()

    queries = [started(frames, "frames", path, ("kind",), "parquet")]
    if "availableNow" in trigger or "once" in trigger:
        queries[0].awaitTermination()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    columns = [f for f in frames.schema.fields if f.name != "kind"] + [T.StructField("kind", T.StringType())]
    routed = spark.readStream.schema(T.StructType(columns)).parquet(path)
    queries += [started(_staged(routed, k, step, lateness, "offset"), k, f"{out_dir}/{k}") for k in kinds]
    bad = routed.where(F.col("kind") == QUARANTINE).select("value")
    return [*queries, started(bad, QUARANTINE, f"{out_dir}/{QUARANTINE}")]
