"""Message parsing, routing and cleaning (projections and filters only).

All operators here are narrow: no shuffle, one pass, codegen'd, and they
work unchanged on streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake import schemas
from ticklake.functions.strings import channel_kind, channel_symbol, topic_name
from ticklake.functions.time import col, event_time_auto, event_time_ms, ntz_from_millis

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", into: str = "msg",
               keep: Sequence[str] = ()) -> DataFrame:
    """Parse JSON text with an explicit schema (PERMISSIVE: bad text -> null
    struct plus the text kept in ``_corrupt_record``).

    The struct leaves a generator of one row, below which no filter on its
    fields is pushed: in a plain projection each such filter would parse the
    text once more."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(col(value), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.select(*keep, col(value).alias(value) if value not in keep else F.lit(None).alias("_v"),
                     F.explode(F.array(parsed)).alias(into)).drop("_v")


def parse_frames(df: DataFrame, value: str = "value", into: str = "msg", keep: Sequence[str] = ()) -> DataFrame:
    """Every frame of the feed, parsed once: ``msg`` (``schemas.RAW_FRAME``), ``kind`` and ``topic``.

    ``kind`` is that of the channel (``candles``, ``level2``, ``bid_ask``,
    else ``other``), ``control`` for control frames and frames without a
    channel (as :func:`drop_control_messages`), and ``quarantine`` for what is
    no JSON object or has not one readable field."""
    parsed = parse_json(df, schemas.RAW_FRAME, value, into, keep)
    m = F.col(into)
    nothing = F.lit(True)
    for field in schemas.RAW_FRAME.fieldNames():
        nothing = nothing & m[field].isNull()
    bad = m.isNull() | (m[CORRUPT].isNotNull() & nothing)
    control = m["ping"].isNotNull() | m["op"].isNotNull() | m["action"].isNotNull() | m["ch"].isNull()
    ch = F.lower(m["ch"])
    kind = F.when(bad, F.lit("quarantine")).when(control, F.lit("control")).otherwise(F.coalesce(channel_kind(ch), F.lit("other")))
    return parsed.withColumn("kind", kind).withColumn("topic", F.when(F.col("kind").isin("quarantine", "control"), None).otherwise(topic_name(ch)))


def split_corrupt(parsed: DataFrame, into: str = "msg") -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of :func:`parse_json`; bad rows keep their raw text
    for a quarantine table instead of failing the job."""
    bad_cond = F.col(f"{into}.{CORRUPT}").isNotNull() | F.col(into).isNull()
    return parsed.where(~bad_cond), parsed.where(bad_cond)


def with_event_time(df: DataFrame, into: str = "msg", out: str = "ts") -> DataFrame:
    """Event time ``tick.ts`` else envelope ``ts`` (ms epoch)."""
    return df.withColumn(out, event_time_ms(f"{into}.tick.ts", f"{into}.ts"))


def with_event_time_auto(df: DataFrame, fields: Sequence[str] = ("data.tso", "data.tst", "data.t"),
                         out: str = "datetime") -> DataFrame:
    """Event time of second-feed messages: priority ``tso > tst > t``, unit
    (s or ms) inferred per value."""
    return df.withColumn(out, event_time_auto(*fields))


def candle_ticks(parsed: DataFrame, into: str = "msg") -> DataFrame:
    """Flatten parsed candle messages: symbol from the channel, event time, OHLCV."""
    t = f"{into}.tick"
    return parsed.select(channel_symbol(f"{into}.ch").alias("symbol"),
                         event_time_ms(f"{t}.ts", f"{into}.ts").alias("ts"),
                         *[F.col(f"{t}.{c}").alias(c) for c in ("open", "high", "low", "close")],
                         F.col(f"{t}.amount").alias("vol"),
                         *[c for c in parsed.columns if c not in (into, "value")])


def stage_bid_ask(parsed: DataFrame, into: str = "msg") -> DataFrame:
    """Best bid/ask flatten: one row per message, no accumulation.  Messages
    without a tick (``{}``) give no row; what a short list lacks is null."""
    t = f"{into}.tick"
    return (parsed.where(F.col(t).isNotNull())
            .select(channel_symbol(f"{into}.ch").alias("symbol"),
                    ntz_from_millis(F.coalesce(F.col(f"{t}.ts"), F.col(f"{into}.ts"))).alias("datetime"),
                    F.get(f"{t}.bid", 0).alias("bid"), F.get(f"{t}.bid", 1).alias("bid_vol"),
                    F.get(f"{t}.ask", 0).alias("ask"), F.get(f"{t}.ask", 1).alias("ask_vol")))


def route_by_channel(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``ch`` (lower-cased channel), ``kind`` and ``topic`` columns from
    the raw JSON text; downstream filters on ``kind`` (one query per kind) or
    writes with the ``topic`` column (one query, dynamic topics)."""
    ch = F.lower(F.get_json_object(col(value), "$.ch"))
    return (df.withColumn("ch", ch).withColumn("kind", channel_kind("ch"))
            .withColumn("topic", topic_name("ch")))


def route_by_guid(df: DataFrame, subscriptions: DataFrame, guid: str = "guid", code: str = "httpCode") -> DataFrame:
    """Deliver second-feed messages to their subscription; unknown guids and
    non-200 replies are dropped.  ``subscriptions`` (guid -> kind, ...) is a
    small configuration table: the inner equi-join is planned by size (AQE
    broadcasts it when its measured size is under the broadcast threshold and
    falls back to a shuffle join otherwise)."""
    ok = df.where(F.col(code).isNull() | (F.col(code) == 200))
    return ok.join(subscriptions, on=guid, how="inner")


def drop_control_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep data messages, drop control frames.  Precedence as in the feed
    handler: a frame with ``ping``, ``op`` or ``action`` is control; else a
    frame with a channel is data (even if it also says ``status: error``);
    anything else (error status, unknown) is dropped."""
    keys = F.from_json(col(value), "ping long, op string, action string, ch string")
    return (df.withColumn("_k", keys)
            .where(F.col("_k.ping").isNull() & F.col("_k.op").isNull() & F.col("_k.action").isNull()
                   & F.col("_k.ch").isNotNull())
            .drop("_k"))


def unreadable(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages that are no JSON object, for a quarantine: text (``null`` too)
    as it came, with all other columns.  Control frames are readable."""
    keys = F.from_json(col(value), f"ch string, {CORRUPT} string",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.where(keys.isNull() | keys[CORRUPT].isNotNull())


def clean_columns(df: DataFrame, junk_prefixes: Sequence[str] = ("Unnamed:",),
                  junk_names: Sequence[str] = ("close_time.1", "datetime.1")) -> DataFrame:
    """Drop rubbish columns of CSV exports and cast time-named string columns
    (``datetime``, ``*_time``) to timestamps."""
    keep = [c for c in df.columns if c not in junk_names and not any(c.startswith(p) for p in junk_prefixes)]
    out = []
    for c in keep:
        is_time = c.lower() == "datetime" or c.lower().endswith("_time")
        if is_time and isinstance(df.schema[c].dataType, T.StringType):
            out.append(F.to_timestamp_ntz(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)
