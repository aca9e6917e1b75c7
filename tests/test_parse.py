"""Parsing, event time, routing, control frames, topics, file names."""
import json
from datetime import date, datetime as dt, timezone

from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.strings import file_date, split_instrument, topic_name
from ticklake.operators import parse


def _msgs(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "msg_id long, value string")


def test_bid_ask_flatten(spark):
    # several levels: the first two numbers are price and volume; a message without a tick gives no row
    at = dt(2024, 2, 29, 23, 59, 58, 750000)
    ms = int(at.replace(tzinfo=timezone.utc).timestamp() * 1000)
    own_time = {"ch": "market.eth-usd.bbo", "ts": ms + 9, "tick": {"bid": [2950.25, 0.4, 2950.0, 7], "ask": [2950.75, 1.6, 2951.0, 3], "ts": ms}}
    envelope_time = {"ch": "market.eth-usd.bbo", "ts": ms, "tick": {"bid": [2949.5], "ask": None}}
    p = parse.parse_json(_msgs(spark, [json.dumps(own_time), "{}", json.dumps(envelope_time)]), schemas.RAW_BID_ASK, keep=["msg_id"])
    out = sorted(parse.stage_bid_ask(p).collect(), key=lambda r: -r.bid)
    assert [(r.bid, r.bid_vol, r.ask, r.ask_vol) for r in out] == [(2950.25, 0.4, 2950.75, 1.6), (2949.5, None, None, None)]
    assert {(r.symbol, r.datetime) for r in out} == {("eth-usd", at)}


def test_event_time_units(spark):
    # t in seconds, tso / tst in ms, priority tso > tst > t
    want = dt(2031, 7, 4, 6, 30, 15, 250000)
    sec = want.replace(tzinfo=timezone.utc).timestamp()
    vals = [{"data": {"t": sec}}, {"data": {"tso": sec * 1000}}, {"data": {"tst": sec * 1000, "t": 1.0}},
            {"data": {}}]
    p = parse.parse_json(_msgs(spark, [json.dumps(v) for v in vals]), schemas.RAW_SECOND_EXCHANGE, keep=["msg_id"])
    out = [r.datetime for r in parse.with_event_time_auto(p.select("msg_id", "msg.data")).orderBy("msg_id").collect()]
    assert out[:3] == [want, want, want]
    assert out[3] is None


def test_route_by_guid(spark):
    # C17: known guid delivered, unknown dropped, non-200 dropped
    vals = [{"guid": "g1", "data": {}}, {"guid": "unknown", "data": {}}, {"guid": "g2", "httpCode": 401}]
    p = parse.parse_json(_msgs(spark, [json.dumps(v) for v in vals]), schemas.RAW_SECOND_EXCHANGE, keep=["msg_id"]) \
        .select("msg_id", "msg.guid", "msg.httpCode")
    subs = spark.createDataFrame([("g1", "candles"), ("g2", "level2")], "guid string, kind string")
    out = parse.route_by_guid(p, subs).collect()
    assert [(r.msg_id, r.kind) for r in out] == [(0, "candles")]


def test_drop_control_and_route_by_channel(spark):
    vals = ['{"ping": 1}', '{"op": "notify", "topic": "x"}', '{"action": "ping"}', '{"status": "error"}',
            '{"ch": "market.BTC-USDT.KLINE.1min", "ts": 1}', '{"ch": "market.x.depth.step0", "status": "error"}']
    kept = parse.route_by_channel(parse.drop_control_messages(_msgs(spark, vals))).orderBy("msg_id").collect()
    assert [r.msg_id for r in kept] == [4, 5]
    assert kept[0].ch == "market.btc-usdt.kline.1min" and kept[0].kind == "candles"
    assert kept[0].topic == "raw.htx.market.btc-usdt.kline.1min"
    assert kept[1].kind == "level2"


def test_topic_prefix_once_and_instrument(spark):
    df = spark.createDataFrame([("market.a.bbo",), ("raw.htx.market.a.bbo",)], "ch string")
    assert [r.t for r in df.select(topic_name("ch").alias("t")).collect()] == ["raw.htx.market.a.bbo"] * 2
    i = spark.createDataFrame([("MOEX.TQBR.SBER",)], "s string").select(*split_instrument("s")).collect()[0]
    assert (i.exchange, i.board, i.code) == ("MOEX", "TQBR", "SBER")


def test_file_date(spark):
    # C15 plus a bad name
    df = spark.createDataFrame([("2025-06-14_BTC-USDT.csv",), ("dir/sub/2025-06-14_BTC-USDT_level2.csv.zip",),
                                ("notes_2025.csv",)], "p string")
    assert [r.d for r in df.select(file_date("p").alias("d")).collect()] == [date(2025, 6, 14), date(2025, 6, 14), None]


def test_corrupt_split(spark):
    p = parse.parse_json(_msgs(spark, ['{"ch": "a"}', '{"ch": "a', "not json"]), schemas.CONTROL_KEYS, keep=["msg_id"])
    good, bad = parse.split_corrupt(p)
    assert [r.msg_id for r in good.collect()] == [0]
    assert sorted(r.msg_id for r in bad.collect()) == [1, 2]


def test_clean_columns(spark):
    # C4: duplicate export column dropped, time columns cast
    df = spark.createDataFrame([("2025-01-01 11:42:00", "2025-01-01 11:43:00", "x", 1.0)],
                               "open_time string, close_time string, `close_time.1` string, `Unnamed: 0` double")
    out = parse.clean_columns(df)
    assert out.columns == ["open_time", "close_time"]
    assert out.collect()[0].close_time == dt(2025, 1, 1, 11, 43)


def test_candle_messages_to_ticks(spark):
    m = {"ch": "market.BTC-USDT.kline.1min", "ts": 1749046260000,
         "tick": {"open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "amount": 10.0}}
    p = parse.parse_json(_msgs(spark, [json.dumps(m)]), schemas.RAW_CANDLE, keep=["msg_id"])
    r = parse.candle_ticks(p).collect()[0]
    assert r.symbol == "BTC-USDT" and r.vol == 10.0 and r.ts == dt(2025, 6, 4, 14, 11)
    assert F is not None
