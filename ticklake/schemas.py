"""Explicit schemas.  Raw messages are parsed with these (no inference), and
every staged table carries a ``symbol`` column: one job handles many
instruments, partitioned by symbol and time."""

from pyspark.sql import types as T

D = T.DoubleType()
L = T.LongType()
S = T.StringType()
TS = T.TimestampNTZType()

PRICE_LEVELS = T.ArrayType(T.ArrayType(D))

RAW_LEVEL2 = T.StructType([
    T.StructField("ch", S), T.StructField("ts", L),
    T.StructField("tick", T.StructType([
        T.StructField("id", L), T.StructField("mrid", L), T.StructField("version", L),
        T.StructField("ts", L), T.StructField("bids", PRICE_LEVELS), T.StructField("asks", PRICE_LEVELS),
    ])),
])

RAW_CANDLE = T.StructType([
    T.StructField("ch", S), T.StructField("ts", L),
    T.StructField("tick", T.StructType([
        T.StructField("id", L), T.StructField("ts", L),
        T.StructField("open", D), T.StructField("high", D), T.StructField("low", D),
        T.StructField("close", D), T.StructField("amount", D),
    ])),
])

RAW_BID_ASK = T.StructType([
    T.StructField("ch", S), T.StructField("ts", L),
    T.StructField("tick", T.StructType([
        T.StructField("ts", L), T.StructField("bid", T.ArrayType(D)), T.StructField("ask", T.ArrayType(D)),
    ])),
])

#: Any frame of the market feed: control keys, and the union of the kinds' ticks.
RAW_FRAME = T.StructType([
    T.StructField("ping", L), T.StructField("op", S), T.StructField("action", S), T.StructField("ch", S), T.StructField("ts", L),
    T.StructField("tick", T.StructType(list({f.name: f for kind in (RAW_LEVEL2, RAW_CANDLE, RAW_BID_ASK)
                                             for f in kind["tick"].dataType.fields}.values()))),
])

RAW_SECOND_EXCHANGE = T.StructType([
    T.StructField("guid", S), T.StructField("httpCode", T.IntegerType()),
    T.StructField("data", T.StructType([
        T.StructField("tso", D), T.StructField("tst", D), T.StructField("t", D),
    ])),
])

CONTROL_KEYS = T.StructType([
    T.StructField("ping", L), T.StructField("op", S), T.StructField("action", S),
    T.StructField("status", S), T.StructField("ch", S),
])

STAGED_CANDLE = T.StructType([
    T.StructField("symbol", S), T.StructField("open_time", TS), T.StructField("close_time", TS),
    T.StructField("open", D), T.StructField("high", D), T.StructField("low", D),
    T.StructField("close", D), T.StructField("vol", D),
])

L2_COLS = ["l2_bid_max", "l2_bid_expect", "l2_bid_vol", "l2_ask_min", "l2_ask_expect", "l2_ask_vol"]

STAGED_LEVEL2 = T.StructType([T.StructField("symbol", S), T.StructField("datetime", TS)]
                             + [T.StructField(c, D) for c in L2_COLS])

STAGED_BID_ASK = T.StructType([
    T.StructField("symbol", S), T.StructField("datetime", TS),
    T.StructField("bid", D), T.StructField("bid_vol", D), T.StructField("ask", D), T.StructField("ask_vol", D),
])

BOOK_ROWS = T.StructType([
    T.StructField("symbol", S), T.StructField("datetime", TS),
    T.StructField("bid", D), T.StructField("bid_vol", D), T.StructField("ask", D), T.StructField("ask_vol", D),
])

FILE_LISTING = T.StructType([
    T.StructField("path", S), T.StructField("mtime", TS),
])
