"""All kinds through ``start_staging``, with messages that nothing can read."""
import json
import os
from datetime import datetime as dt

from ticklake.operators.metrics import ProgressCollector
from ticklake.streaming import staging
from ticklake.streaming.staging import start_staging

MS = int(dt(2025, 6, 3, 10, 0, 30).timestamp() * 1000)


def messages():
    out = []
    for i in range(6):
        ts = MS + 60_000 * i
        out += [{"ch": "market.x.kline.1min", "ts": ts, "tick": {"open": 1.0 + i, "high": 2.0, "low": 0.5, "close": 1.5, "amount": 3.0}},
                {"ch": "market.x.depth.step0", "ts": ts, "tick": {"id": i, "ts": ts, "bids": [[10.0 + i, 1.0], [9.0, 1.0]], "asks": [[12.0, 2.0]]}},
                {"ch": "market.x.bbo", "ts": ts, "tick": {"ts": ts, "bid": [10.0, i], "ask": [11.0, 2]}}]
    return [json.dumps(m) for m in out] + ['{"ping": 5}', "{broken", "not json at all"]


def test_every_kind_and_the_quarantine(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.txt", "w") as f:
        f.write("\n".join(messages()))
    seen = ProgressCollector()
    spark.streams.addListener(seen)
    queries = start_staging(spark.readStream.text(f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger={"availableNow": True})
    for q in queries:
        q.awaitTermination()
    read = lambda kind: spark.read.parquet(f"{tmp_dir}/out/{kind}")
    assert [r.open for r in read("candles").orderBy("close_time").collect()] == [1.0 + i for i in range(5)]
    assert [r.l2_bid_max for r in read("level2").orderBy("datetime").collect()] == [10.0 + i for i in range(5)]
    assert sorted(r.bid_vol for r in read("bid_ask").collect()) == [float(i) for i in range(6)]
    assert {r.value for r in read("quarantine").collect()} == {"{broken", "not json at all"}
    spark.streams.removeListener(seen)
    assert max([e["observed"].get("quarantine", {}).get("rows", 0) for e in seen.events], default=0) in (0, 2)


def test_one_parse_for_all_kinds(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    odd = ['{"ch": "market.x.trade.detail", "ts": 5}', '{"ch": "market.x.kline.1min", "ts": 1, "tick": {"open": "no number", "close": 2.0}}', '{"ts": "no time"}', "[1]", "", "{}"]
    with open(f"{tmp_dir}/in/a.txt", "w") as f:
        f.write("\n".join(messages() + odd))
    staging.register("other", lambda frames, step, lateness, seq: frames.select("msg.ch", "msg.ts"))
    try:
        queries = start_staging(spark.readStream.text(f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ck", kinds=("level2", "other"), trigger={"availableNow": True})
        for q in queries:
            q.awaitTermination()
    finally:
        del staging.STAGERS["other"]
    parses = [q._jsq.streamingQuery().lastExecution().optimizedPlan().toString().count("from_json(") for q in queries]
    assert parses == [1, 0, 0, 0]  # the source is read and parsed by the first query alone
    read = lambda name: spark.read.parquet(f"{tmp_dir}/out/{name}")
    assert [(r.ch, r.ts) for r in read("other").collect()] == [("market.x.trade.detail", 5)]
    assert {r.value for r in read("quarantine").collect()} == {"{broken", "not json at all", '{"ts": "no time"}', "[1]", ""}
    candles = read("frames").where("kind = 'candles' and msg.ts = 1").collect()
    assert [(r.msg.tick.open, r.msg.tick.close, r.value) for r in candles] == [(None, 2.0, None)]
