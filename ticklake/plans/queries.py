"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables (through ``ticklake.plans.derive``) in
full and runs one library operator (or a short chain of them).  Doubles that
come out of arithmetic are rounded to 6 places so the oracle comparison is
exact; timestamps come out as ``timestamp_ntz`` (UTC wall clock).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.strings import split_instrument, topic_name
from ticklake.functions.time import ntz_from_millis
from ticklake.operators import bars, book, parse
from ticklake.plans import derive

BAR = "1 hour"


def r6(c) -> F.Column:
    """Round to 6 places for comparison.  Values sitting exactly on a
    half (common with 2-decimal prices) are nudged by 1e-9 first, so a
    last-bit difference in summation order cannot flip the rounding; ``+ 0.0``
    turns ``-0.0`` into ``0.0``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + 1e-9, 6) + 0.0


def _round_all(df: DataFrame, cols) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- bars

def bars_last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.stage_candles(derive.raw_candles(spark, sf_dir), BAR, seq=["seq"])


def bars_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bars.ohlc_bars(derive.ticks(spark, sf_dir), BAR, seq=["seq"])
    return out


def resample_left_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = derive.ticks(spark, sf_dir)
    return bars.resample_last(t, BAR, seq=["seq"], cols=["price", "vol"])


def candles_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles rolled up to 4-hour candles (G7 on staged candles)."""
    hourly = bars.ohlc_bars(derive.ticks(spark, sf_dir), BAR, seq=["seq"])
    return bars.resample_candles(hourly, "4 hours")


def stage_candles_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON candle messages -> parse -> event time -> last-state bars."""
    msgs = derive.raw_candle_messages(spark, sf_dir)
    parsed = parse.parse_json(msgs, schemas.RAW_CANDLE, keep=["msg_id"])
    ticks = parse.candle_ticks(parsed)
    return bars.stage_candles(ticks, BAR, seq=["msg_id"])


# ---------------------------------------------------------------- parsing and routing

def event_time_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = derive.second_feed_messages(spark, sf_dir)
    parsed = parse.parse_json(msgs, schemas.RAW_SECOND_EXCHANGE, keep=["msg_id"])
    return parse.with_event_time_auto(parsed.select("msg_id", "msg.data"), ("data.tso", "data.tst", "data.t")) \
        .select("msg_id", "datetime")


def route_by_guid(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = derive.second_feed_messages(spark, sf_dir)
    parsed = parse.parse_json(msgs, schemas.RAW_SECOND_EXCHANGE, keep=["msg_id"]) \
        .select("msg_id", "msg.guid", "msg.httpCode")
    subs = derive.subscriptions(spark, sf_dir)
    return parse.route_by_guid(parsed, subs).select("msg_id", "guid", "kind", "topic")


def drop_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = derive.raw_frames(spark, sf_dir)
    return parse.drop_control_messages(frames).select("msg_id")


def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = parse.drop_control_messages(derive.raw_frames(spark, sf_dir))
    return parse.route_by_channel(frames).select("msg_id", "ch", "kind", "topic")


def split_instrument_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = derive.table(spark, sf_dir, "events")
    inst = F.concat(F.lit("MOEX.TQBR."), F.upper("event_type"), F.lit("."), F.col("user_id").cast("string"))
    return e.select("event_id", inst.alias("instrument")).select("event_id", "instrument",
                                                                  *split_instrument("instrument"))


def topic_name_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topic per channel, the prefix added once (some channels arrive
    already prefixed), plus the second feed's per-kind topic."""
    e = derive.table(spark, sf_dir, "events")
    ch = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("raw.htx.market."), "event_type")) \
        .otherwise(F.concat(F.lit("market."), "event_type"))
    return e.select("event_id", topic_name(ch).alias("topic"),
                    F.concat(F.lit("raw.alor.SBER."), F.col("event_type")).alias("kind_topic"))


def parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good/bad split of JSON text: per kind of outcome, row counts."""
    msgs = derive.raw_frames_with_garbage(spark, sf_dir)
    parsed = parse.parse_json(msgs, schemas.CONTROL_KEYS, keep=["msg_id"])
    good, bad = parse.split_corrupt(parsed)
    return (good.select(F.lit("good").alias("outcome")).unionByName(bad.select(F.lit("bad").alias("outcome")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- book

def _book_msgs(spark, sf_dir):
    msgs = derive.raw_book_messages(spark, sf_dir)
    p = parse.parse_json(msgs, schemas.RAW_LEVEL2, keep=["msg_id"])
    from ticklake.functions.strings import channel_symbol
    return p.select(channel_symbol("msg.ch").alias("symbol"),
                    ntz_from_millis(F.coalesce("msg.tick.ts", "msg.ts")).alias("datetime"),
                    F.col("msg.tick.bids").alias("bids"), F.col("msg.tick.asks").alias("asks"))


def bid_ask_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = derive.raw_bbo_messages(spark, sf_dir)
    p = parse.parse_json(msgs, schemas.RAW_BID_ASK, keep=["msg_id"])
    return _round_all(parse.stage_bid_ask(p), {"bid", "ask"})


def book_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(book.explode_book(_book_msgs(spark, sf_dir)), {"bid", "ask"})


def book_expectation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(book.book_expectation(_book_msgs(spark, sf_dir)), set(schemas.L2_COLS))


def book_expectation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book.explode_book(_book_msgs(spark, sf_dir))
    return _round_all(book.book_expectation_rows(rows), set(schemas.L2_COLS))


def level2_bar_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(book.stage_level2(_book_msgs(spark, sf_dir), BAR), set(schemas.L2_COLS))


# ---------------------------------------------------------------- as-of

ASOF_TOLERANCE = "30 minutes"
ASOF_CHUNK = "1 day"


def _asof(spark, sf_dir, direction, how="inner"):
    from ticklake.operators.asof import asof_join
    left = derive.asof_side(spark, sf_dir, "left")
    right = derive.asof_side(spark, sf_dir, "right")
    return asof_join(left, right, on="symbol", direction=direction, tolerance=ASOF_TOLERANCE,
                     right_order=["event_id"], right_prefix="r_", how=how, chunk=ASOF_CHUNK)


def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "backward")


def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "forward")


def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, "nearest")


def asof_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.asof import unmatched
    left = derive.asof_side(spark, sf_dir, "left")
    right = derive.asof_side(spark, sf_dir, "right")
    return unmatched(left, right, on="symbol", direction="nearest", tolerance=ASOF_TOLERANCE,
                     right_order=["event_id"], right_prefix="r_", chunk=ASOF_CHUNK)


def match_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.asof import match_quality as mq
    left = derive.asof_side(spark, sf_dir, "left")
    right = derive.asof_side(spark, sf_dir, "right")
    return mq(left, right, on="symbol", direction="backward", tolerance=ASOF_TOLERANCE,
              right_order=["event_id"], right_prefix="r_", chunk=ASOF_CHUNK)


# ---------------------------------------------------------------- increments

HISTORY_END = "2024-01-16 00:00:00"
STREAM_START = "2024-01-14 00:00:00"
PRODUCED_END = "2024-01-20 00:00:00"
GAP_SPLIT = "2024-01-15 12:00:00"
KEEP_LAST_N = 100


def _hourly(spark, sf_dir, where=None):
    t = derive.ticks(spark, sf_dir)
    if where is not None:
        t = t.where(where)
    return bars.ohlc_bars(t, BAR, seq=["seq"]).withColumnRenamed("close_time", "datetime").drop("open_time")


def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of the history files (before 01-16) stitched with bars of
    the live feed (from 01-14): overlapping hours keep the history row."""
    from ticklake.operators.increment import append_new as an
    hist = _hourly(spark, sf_dir, F.col("ts") < F.lit(HISTORY_END)).withColumn("src", F.lit("history"))
    live = _hourly(spark, sf_dir, F.col("ts") >= F.lit(STREAM_START)).withColumn("src", F.lit("live"))
    return an(hist, live, ["symbol", "datetime"])


def features_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle bars inner-joined with level2 bars on (symbol, bar time).  The
    aggregations leave both sides partitioned by the bar's window, the join
    is on its end: a shuffle of the bars (not of the ticks) lies between."""
    candles = _hourly(spark, sf_dir)
    l2 = book.stage_level2(_book_msgs(spark, sf_dir), BAR)
    j = candles.join(l2, ["symbol", "datetime"], "inner")
    return _round_all(j, set(schemas.L2_COLS))


def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.increment import keep_last as kl
    return kl(_hourly(spark, sf_dir), KEEP_LAST_N, ts="datetime", chunk="1 day")


def only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars newer than what the sink already holds (per-symbol high-water
    mark of the bars produced before 01-20)."""
    from ticklake.operators.increment import last_produced, only_new as on
    produced = _hourly(spark, sf_dir, F.col("ts") < F.lit(PRODUCED_END))
    return on(_hourly(spark, sf_dir), last_produced(produced))


def time_gap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.increment import time_gap as tg
    t = derive.ticks(spark, sf_dir)
    # one symbol gets another name on either side: symbols with one side only
    def one_sided(name):
        return F.when(F.col("symbol") == "error", name).otherwise(F.col("symbol"))
    hist = t.where(F.col("ts") < F.lit(GAP_SPLIT)).withColumn("symbol", one_sided("history_only"))
    live = t.where(F.col("ts") >= F.lit(GAP_SPLIT)).withColumn("symbol", one_sided("stream_only"))
    out = tg(hist, live, ts="ts", max_gap="1 minute")
    return out.withColumn("gap_seconds", r6("gap_seconds"))


# ---------------------------------------------------------------- grid fill

def fill_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.timegrid import fill_grid as fg
    out = fg(derive.ticks(spark, sf_dir), BAR, seq=["seq"], cols=["price", "vol"], chunk="1 day")
    return _round_all(out, {"price", "vol"})


# ---------------------------------------------------------------- indicators and features

IND_CHUNK = "10 days"


def staged(df: DataFrame) -> DataFrame:
    """Stage boundary: in production the feature job reads staged tables;
    here a reliable checkpoint in the shared checkpoint folder plays that
    table (the grid fill reads its input twice)."""
    from ticklake.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def filled_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly OHLC bars of the ticks on a regular hourly grid (left label)."""
    from ticklake.operators.timegrid import fill_grid as fg
    b = staged(bars.ohlc_bars(derive.ticks(spark, sf_dir), BAR, seq=["seq"]).drop("n", "close_time"))
    return fg(b, BAR, ts="open_time", cols=["open", "high", "low", "close", "vol"], chunk=IND_CHUNK)


def grid_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled hourly candles with the candle times that follow the grid."""
    from ticklake.operators.timegrid import with_candle_times
    cols = ["open", "high", "low", "close", "vol"]
    return _round_all(with_candle_times(filled_candles(spark, sf_dir), BAR).select("symbol", "open_time", "close_time", *cols), cols)


def time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.increment import time_bounds as tb
    return tb(derive.ticks(spark, sf_dir), ts="ts")


def second_feed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.sources.kafka import publish_second_feed
    parsed = parse.parse_json(derive.second_feed_messages(spark, sf_dir), schemas.RAW_SECOND_EXCHANGE, keep=["msg_id"])
    return publish_second_feed(parsed, derive.subscriptions(spark, sf_dir)).select("msg_id", "datetime", "topic")


def _feature_cols(df: DataFrame) -> set:
    return {c for c in df.columns if c not in ("symbol", "datetime")}


def rolling_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.indicators import rolling_candles as rc
    out = rc(filled_candles(spark, sf_dir), ["3 hours"], BAR, chunk=IND_CHUNK)
    return _round_all(out, _feature_cols(out))


def _indicator(spark, sf_dir, key):
    from ticklake.operators.indicators import DEFAULT_PARAMS, candle_indicators
    f = filled_candles(spark, sf_dir)
    out = candle_indicators(f, [BAR], BAR, {key: DEFAULT_PARAMS[key]}, chunk=IND_CHUNK)
    out = out.drop("open", "high", "low", "close", "vol")
    return _round_all(out, _feature_cols(out))


def cci(spark, sf_dir):
    return _indicator(spark, sf_dir, "cca")


def ichimoku(spark, sf_dir):
    return _indicator(spark, sf_dir, "ichimoku")


def rsi(spark, sf_dir):
    return _indicator(spark, sf_dir, "rsi")


def adx(spark, sf_dir):
    return _indicator(spark, sf_dir, "adx")


def stochastic(spark, sf_dir):
    return _indicator(spark, sf_dir, "stoch")


def macd(spark, sf_dir):
    return _indicator(spark, sf_dir, "macd")


def bollinger(spark, sf_dir):
    return _indicator(spark, sf_dir, "bb")


def filled_level2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.timegrid import fill_grid as fg
    l2 = staged(book.stage_level2(_book_msgs(spark, sf_dir), BAR))
    return fg(l2, BAR, ts="datetime", cols=list(schemas.L2_COLS), chunk=IND_CHUNK)


def level2_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.indicators import level2_features as lf
    out = lf(filled_level2(spark, sf_dir), ["1 hour", "3 hours"], BAR, chunk=IND_CHUNK)
    return _round_all(out, _feature_cols(out))


FEATURE_PARAMS = {
    "cca": {"window": 5}, "ichimoku": {"window1": 3, "window2": 5, "window3": 9}, "adx": {"window": 5},
    "rsi": {"window": 5}, "stoch": {"window": 5, "smooth_window": 3}, "macd": {"slow": 8, "fast": 4, "sign": 3},
    "bb": {"window": 5, "window_dev": 2},
}


def features(spark: SparkSession, sf_dir: str, step: str = BAR, periods=("1 hour", "3 hours"),
             chunk: str = IND_CHUNK) -> DataFrame:
    """The feature job on the derived market data: hourly candles and level2
    bars, as-of merged (59 s), gridded, indicators for two periods, level2
    features, cleaned."""
    from ticklake.plans.features import features as fj
    t = derive.ticks(spark, sf_dir)
    candles = bars.ohlc_bars(t, step, seq=["seq"])
    l2 = book.stage_level2(_book_msgs(spark, sf_dir), step)
    out = fj(candles, l2, step=step, candle_periods=list(periods), level2_periods=list(periods),
             params=FEATURE_PARAMS, tolerance="59 seconds", chunk=chunk)
    return _round_all(out, _feature_cols(out))


# ---------------------------------------------------------------- files and metrics

def _listings(spark, sf_dir):
    from ticklake.sources.files import listing
    src, dst = derive.file_listings(spark, sf_dir)
    return listing(src), listing(dst)


def list_daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.sources.files import daily_files
    src, _ = _listings(spark, sf_dir)
    return daily_files(src, "1996-01-01", "1996-12-31", modified_after="1996-06-01").select("name", "file_date", "mtime")


def find_updated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.sources.files import find_updated_files as fu
    src, dst = _listings(spark, sf_dir)
    return fu(src, dst, "1996-01-01", "1999-12-31")


def file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.metrics import file_counts as fc
    src, dst = _listings(spark, sf_dir)
    return fc(src.unionByName(dst))


def message_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticklake.operators.metrics import message_rate as mr
    frames = parse.parse_frames(derive.raw_frames(spark, sf_dir)).where(~F.col("kind").isin("control", "quarantine"))
    out = mr(frames.withColumn("ts", ntz_from_millis("msg.ts")), topic="topic", ts="ts", every=BAR)
    return _round_all(out, {"per_sec", "per_min"})


def time_lag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each hourly bar's close trails the ticks it contains."""
    from ticklake.operators.metrics import time_lag as tl
    t = derive.ticks(spark, sf_dir).withColumn("close_time", bars.bar_close_col("ts", BAR))
    return _round_all(tl(t, event_ts="ts", ingest_ts="close_time", by="symbol"), {"max_lag_s", "avg_lag_s"})


def features_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature job at the source's resolution: one-minute bars and grid
    (30 days x 1440 minutes per symbol, most minutes gap-filled), periods of
    1 and 5 minutes, one-day chunks."""
    return features(spark, sf_dir, step="1 minute", periods=("1 minute", "5 minutes"), chunk="1 day")
