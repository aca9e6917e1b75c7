"""Market-data inputs derived from the driver tables.

The driver tables hold no market data, so the registered queries derive it
deterministically (same definitions in the DuckDB oracle, see
``ticklake/plans/oracle.py``).  Every derivation is a projection of a scan,
so filters and column pruning still reach the parquet reader.

- ``ticks``: one trade per event, ``symbol=event_type``, ``price=value``,
  ``vol=props.k``, ``seq=event_id``.
- ``raw_candles``: a cumulative candle state per event.
- ``raw_candle_messages`` / ``raw_book_messages`` / ``raw_bbo_messages``:
  the same events as JSON exchange messages (order book with five levels
  per side).
- ``asof_left`` / ``asof_right``: the two sides of the as-of tests.
- ``src_files`` / ``dst_files``: object-store listings built from orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.time import millis_ntz
from ticklake.session import ensure_utc

# Fixed values of the derivations (shared with the SQL oracle).
BOOK_LEVELS = 5
PRICE_STEP = 0.01
VOL_MOD = 7
ASOF_SYMBOLS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(df: DataFrame):
    return F.get_json_object("props", "$.k").cast("double")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"),
                    _k(e).alias("vol"), F.col("event_id").alias("seq"))


def raw_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative candle state per event; ``close`` missing when ``k % 10 == 0``
    (exercises per-column last non-null)."""
    e = table(spark, sf_dir, "events")
    k = _k(e)
    return e.select(F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"),
                    F.col("value").alias("open"),
                    (F.col("value") + k * PRICE_STEP).alias("high"),
                    (F.col("value") - k * PRICE_STEP).alias("low"),
                    F.when(k % 10 != 0, F.col("value")).alias("close"),
                    k.alias("vol"))


def _levels(side: str):
    sign = -1 if side == "bids" else 1
    mult = 1 if side == "bids" else 2
    return F.transform(
        F.sequence(F.lit(1), F.lit(BOOK_LEVELS)),
        lambda i: F.array(F.col("value") + sign * PRICE_STEP * i,
                          (1 + (F.col("event_id") + mult * i) % VOL_MOD).cast("double")))


def raw_candle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"ch": "market.<type>.kline.1min", "ts": ms, "tick": {open, high, low, close, amount}}``."""
    c = raw_candles(spark, sf_dir)
    return c.select(
        F.col("seq").alias("msg_id"),
        F.to_json(F.struct(
            F.concat(F.lit("market."), "symbol", F.lit(".kline.1min")).alias("ch"),
            millis_ntz("ts").alias("ts"),
            F.struct("open", "high", "low", "close", F.col("vol").alias("amount")).alias("tick"),
        )).alias("value"))


def raw_book_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-book snapshot per event: five bid and five ask levels."""
    e = table(spark, sf_dir, "events")
    ms = millis_ntz("ts")
    return e.select(
        F.col("event_id").alias("msg_id"),
        F.to_json(F.struct(
            F.concat(F.lit("market."), "event_type", F.lit(".depth.step0")).alias("ch"),
            ms.alias("ts"),
            F.struct(F.col("event_id").alias("id"), _levels("bids").alias("bids"),
                     _levels("asks").alias("asks"), ms.alias("ts")).alias("tick"),
        )).alias("value"))


def raw_bbo_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best bid/ask per event; ``error`` events arrive as an empty ``{}``."""
    e = table(spark, sf_dir, "events")
    ms = millis_ntz("ts")
    msg = F.to_json(F.struct(
        F.concat(F.lit("market."), "event_type", F.lit(".bbo")).alias("ch"),
        ms.alias("ts"),
        F.struct(F.array(F.col("value") - PRICE_STEP, (1 + (F.col("event_id") + 1) % VOL_MOD).cast("double")).alias("bid"),
                 F.array(F.col("value") + PRICE_STEP, (1 + (F.col("event_id") + 2) % VOL_MOD).cast("double")).alias("ask"),
                 ms.alias("ts")).alias("tick")))
    return e.select(F.col("event_id").alias("msg_id"),
                    F.when(F.col("event_type") == "error", F.lit("{}")).otherwise(msg).alias("value"))


def asof_side(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    # every event is on one side: even ids left, odd ids right
    return (e.where(F.col("event_id") % 2 == (0 if side == "left" else 1))
            .select((F.col("user_id") % ASOF_SYMBOLS).alias("symbol"),
                    F.date_trunc("second", "ts").alias("ts"),
                    "event_id", "value"))


def file_listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(source listing, target listing) of daily files ``<date>_<priority>.csv.zip``.

    The target holds the files whose smallest order key is not a multiple of
    three, stored unzipped when that key is even, with a modification time
    one hour later (odd key) or earlier (even key) than the source's.
    """
    o = table(spark, sf_dir, "orders")
    g = (o.groupBy(F.to_date("o_orderdate").alias("d"), "o_orderpriority")
         .agg(F.max("o_orderdate").alias("mx"), F.min("o_orderkey").alias("kmin")))
    name = F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("_"), F.col("o_orderpriority"), F.lit(".csv.zip"))
    src = g.select(F.concat(F.lit("src/"), name).alias("path"),
                   (F.col("mx") + F.expr("INTERVAL 1 DAY")).alias("mtime"))
    dst_name = F.when(F.col("kmin") % 2 == 0, F.regexp_replace(name, r"\.zip$", "")).otherwise(name)
    shift = F.when(F.col("kmin") % 2 == 1, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL -1 HOUR"))
    dst = (g.where(F.col("kmin") % 3 != 0)
           .select(F.concat(F.lit("dst/"), dst_name).alias("path"),
                   (F.col("mx") + F.expr("INTERVAL 1 DAY") + shift).alias("mtime")))
    return src, dst


# Frame kinds of the synthetic raw feed.
FRAME_SUFFIXES = ("kline.1min", "depth.step0", "bbo")
SECOND_FEED_TICKET = "SBER"


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed websocket frames: ``error`` events are control frames (ping, op,
    action, error status, in turn by event id), the others data frames whose
    channel kind rotates over candles / book / best bid-ask and whose symbol
    is upper-cased for every fifth event."""
    e = table(spark, sf_dir, "events")
    is_ctl = F.col("event_type") == "error"
    r4 = F.col("event_id") % 4
    sym = F.when(F.col("event_id") % 5 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    suffix = F.element_at(F.array(*[F.lit(s) for s in FRAME_SUFFIXES]), (F.col("event_id") % 3 + 1).cast("int"))
    frame = F.struct(
        F.when(is_ctl & (r4 == 0), millis_ntz("ts")).alias("ping"),
        F.when(is_ctl & (r4 == 1), F.lit("notify")).alias("op"),
        F.when(is_ctl & (r4 == 2), F.lit("ping")).alias("action"),
        F.when(is_ctl & (r4 == 3), F.lit("error")).alias("status"),
        F.when(~is_ctl, F.concat(F.lit("market."), sym, F.lit("."), suffix)).alias("ch"),
        F.when(~is_ctl, millis_ntz("ts")).alias("ts"),
        F.when(~is_ctl, F.struct(F.col("value").alias("close"))).alias("tick"),
    )
    return e.select(F.col("event_id").alias("msg_id"), F.to_json(frame).alias("value"))


def raw_frames_with_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`raw_frames` where every 13th frame is cut short (broken JSON)."""
    f = raw_frames(spark, sf_dir)
    return f.select("msg_id", F.when(F.col("msg_id") % 13 == 0, F.substring("value", 1, 9))
                    .otherwise(F.col("value")).alias("value"))


def second_feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-feed messages: ``guid`` per event type (``unknown`` for every
    tenth user), ``httpCode`` 401 for every 17th event, event time in
    ``tso`` (ms), ``tst`` (ms) or only ``t`` (seconds with fraction) in turn."""
    e = table(spark, sf_dir, "events")
    ms = millis_ntz("ts").cast("double")
    from ticklake.functions.time import micros_ntz
    secs = micros_ntz("ts").cast("double") / 1000000
    r3 = F.col("event_id") % 3
    msg = F.struct(
        F.when(F.col("user_id") % 10 == 0, F.lit("unknown"))
         .otherwise(F.concat(F.lit("g-"), "event_type")).alias("guid"),
        F.when(F.col("event_id") % 17 == 0, F.lit(401)).otherwise(F.lit(200)).alias("httpCode"),
        F.struct(F.when(r3 == 0, ms).alias("tso"), F.when(r3 == 1, ms).alias("tst"), secs.alias("t")).alias("data"),
    )
    return e.select(F.col("event_id").alias("msg_id"), F.to_json(msg).alias("value"))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription table guid -> kind, topic: one per event type seen."""
    e = table(spark, sf_dir, "events")
    from ticklake.functions.strings import kind_topic
    return (e.select("event_type").distinct()
            .select(F.concat(F.lit("g-"), "event_type").alias("guid"), F.col("event_type").alias("kind"),
                    kind_topic(F.lit(SECOND_FEED_TICKET), F.col("event_type")).alias("topic")))
