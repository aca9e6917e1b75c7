"""The streaming feature job against the batch job: gaps, replays, gates."""
import glob
import json
import re
from datetime import datetime as dt, timedelta

import numpy as np
import pytest

from ticklake.operators.indicators import clean_features
from ticklake.operators.timegrid import fill_grid
from ticklake.plans.features import CANDLE, feature_frame
from ticklake.schemas import L2_COLS
from ticklake.sources import epochs
from ticklake.streaming import features_job
from ticklake.streaming.features_job import FeatureJob

SCHEMA = "symbol string, datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in CANDLE + L2_COLS)
PARAMS = {"rsi": {"window": 5}, "macd": {"slow": 5, "fast": 2, "sign": 2}, "stoch": {"window": 4, "smooth_window": 2}}
T0 = dt(2025, 1, 1)


def bars(minutes, symbol="X", seed=3):
    rnd = np.random.default_rng(seed)
    price = {m: 100 + float(rnd.normal()) for m in range(max(minutes) + 1)}
    return [(symbol, T0 + timedelta(minutes=m), price[m], price[m] + 1, price[m] - 1, price[m], 1.0, *[price[m] + k for k in range(6)]) for m in minutes]


def job(tmp_dir, **more):
    return FeatureJob(f"{tmp_dir}/store", f"{tmp_dir}/sink", params=PARAMS, chunk="1 hour", **more)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batch_result(spark, rows):
    full = fill_grid(frame(spark, rows), "1 minute", ts="datetime", cols=CANDLE + L2_COLS, chunk="1 hour")
    f = feature_frame(full, step="1 minute", candle_periods=["1 minute"], level2_periods=["1 minute"], params=PARAMS, chunk="1 hour")
    return {(r.symbol, r.datetime): r.asDict() for r in clean_features(f, keep=["symbol", "datetime"]).collect()}


def same(spark, sink, want):
    rows = features_job.read_table(spark, sink).collect()
    got = {(r.symbol, r.datetime): r for r in rows}
    assert len(rows) == len(got) and set(got) == set(want)
    for k, row in want.items():
        for c, v in row.items():
            if isinstance(v, float):
                assert abs(got[k][c] - v) < 1e-9, (k, c)


def test_gap_longer_than_the_look_back(spark, tmp_dir):
    minutes = [*range(0, 70), *range(105, 125), *range(500, 530)]
    rows = bars(minutes)
    j = job(tmp_dir, history_ready=True)
    j.bootstrap(frame(spark, rows[:40]))
    for n, (a, b) in enumerate(((40, 70), (70, 90), (90, 95), (95, 120))):
        j.process(frame(spark, rows[a:b]), n)
    same(spark, f"{tmp_dir}/sink", batch_result(spark, rows))


@pytest.mark.parametrize("failing", ["sink", "_state"])
def test_replay_after_a_failure_between_the_writes(spark, tmp_dir, monkeypatch, failing):
    rows = bars(range(0, 90))
    j = job(tmp_dir, history_ready=True)
    j.bootstrap(frame(spark, rows[:40]))
    j.process(frame(spark, rows[40:60]), 0)
    write, state = features_job._replace, FeatureJob._write_state

    def broken(df, path, epoch, *a):
        if path.endswith("sink") and failing == "sink":
            raise RuntimeError("lost")
        write(df, path, epoch, *a)

    monkeypatch.setattr(features_job, "_replace", broken)
    if failing == "_state":
        monkeypatch.setattr(FeatureJob, "_write_state", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        j.process(frame(spark, rows[60:75]), 1)
    monkeypatch.setattr(features_job, "_replace", write)
    monkeypatch.setattr(FeatureJob, "_write_state", state)
    again = job(tmp_dir, history_ready=True)
    again.process(frame(spark, rows[60:75]), 1)
    again.process(frame(spark, rows[75:]), 2)
    same(spark, f"{tmp_dir}/sink", batch_result(spark, rows))


def test_gate_is_per_symbol_and_closes_by_reloading(spark, tmp_dir):
    x, y, z = bars(range(0, 60)), bars(range(0, 60), "Y", 4), bars(range(30, 60), "Z", 5)
    j = job(tmp_dir)
    j.bootstrap(frame(spark, x[:30] + y[:20]))  # Y's history ends ten minutes early, Z has none
    j.process(frame(spark, x[29:45] + y[29:45] + z[:15]), 0)
    assert {r.symbol for r in spark.read.parquet(f"{tmp_dir}/sink").collect()} == {"X"}
    asked = []

    def reload(session, since):
        asked.append(since)
        return frame(session, y[18:30])

    j.reload_history = reload
    j.process(frame(spark, x[45:] + y[45:] + z[15:]), 1)
    same(spark, f"{tmp_dir}/sink", {**batch_result(spark, x), **batch_result(spark, y)})
    assert asked == [T0 + timedelta(minutes=19)]


def test_published_messages_and_counts(spark, tmp_dir):
    rows, sent = bars(range(0, 50)), []
    j = job(tmp_dir, history_ready=True, publish=lambda messages, epoch: sent.append((epoch, messages.collect())))
    j.bootstrap(frame(spark, rows[:30]))
    j.process(frame(spark, rows[25:50]), 7)
    assert j.counts["input"] == 25 and j.counts["new"] == 20 and j.counts["output"] == len(sent[0][1]) > 20
    assert j.counts["dirty"] >= j.counts["cleaned"] >= j.counts["output"] and j.counts["duration_s"] > 0 and j.counts["lag_s"] > 0
    first = json.loads(sent[0][1][0].value)
    assert sent[0][0] == 7 and sent[0][1][0].key == "X" and {"symbol", "datetime"} <= set(first)


def test_store_and_sink_are_read_by_date(spark, tmp_dir):
    rows = bars([0, 1, 2, *range(4400, 4900)])
    j = job(tmp_dir, history_ready=True)
    j.bootstrap(frame(spark, rows[:-20]))
    j.process(frame(spark, rows[-20:]), 0)
    state = j._state(spark, "manual", 1)
    plan = j._tail(spark, state)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(date#\d+ >= 2025-01-04\)", plan)


def test_files_stay_few_and_replays_stay_exact_over_many_epochs(spark, tmp_dir, monkeypatch):
    """Merged runs, a bounded number of files, replaced epochs, all rows once."""
    fan = 3
    monkeypatch.setattr(epochs, "FAN", fan)
    table = epochs.EpochTable(spark, f"{tmp_dir}/t")
    rows = bars(range(0, 80), "X") + bars(range(0, 80), "Y", 4)
    for n in range(40):
        part = frame(spark, rows[2 * n:2 * n + 2] + rows[80 + 2 * n:82 + 2 * n]).coalesce(1)
        if n % 20 == 7:  # an epoch that wrote something else before its replay
            table.replace(frame(spark, rows[:3]).coalesce(1), f"r-{n}", "r", n)
        table.replace(part, f"r-{n}", "r", n)
        table.merge(lambda e: e["run"] != "r" or e["at"] <= n - 2)
    got = table.read().select("symbol", "datetime", "close").collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted((r[0], r[1], r[5]) for r in rows)
    levels = [e["level"] for e in table.entries()]
    assert max(levels) == 3 and len(levels) <= (max(levels) + 1) * fan
    files = glob.glob(f"{tmp_dir}/t/epoch=*/date=*/*.parquet")
    assert len(files) <= len(levels) + epochs.GRACE * fan
    assert table.read(dt(2025, 1, 2).date()) is None


def test_a_write_that_fails_is_never_read(spark, tmp_dir):
    table = epochs.EpochTable(spark, f"{tmp_dir}/t")
    table.replace(frame(spark, bars([0])), "a-0", "a", 0)
    table._write(frame(spark, bars([1])), "a-1")  # written, not listed
    assert table.read().count() == 1
    table.replace(frame(spark, bars([1, 2])), "a-1", "a", 1)
    assert table.read().count() == 3
    table.drop(["a-0"])
    assert table.read().count() == 2 and table.read(but=["a-1"]) is None


def test_a_new_run_drops_what_the_one_before_did_not_commit(spark, tmp_dir, monkeypatch):
    rows = bars(range(0, 90))
    j = job(tmp_dir, history_ready=True)
    j.bootstrap(frame(spark, rows[:40]))
    j.process(frame(spark, rows[40:60]), 0)
    state = FeatureJob._write_state
    monkeypatch.setattr(FeatureJob, "_write_state", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        j.process(frame(spark, rows[60:75]), 1)
    monkeypatch.setattr(FeatureJob, "_write_state", state)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    try:
        job(tmp_dir, history_ready=True).process(frame(spark, rows[50:]), 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    same(spark, f"{tmp_dir}/sink", batch_result(spark, rows))


def test_a_new_symbol_reads_its_own_rows(spark, tmp_dir):
    x, y = bars(range(0, 60)), bars(range(0, 60), "Y", 4)
    j = job(tmp_dir, history_ready=True)
    j.bootstrap(frame(spark, x[:30]))
    j.process(frame(spark, x[30:50]), 0)
    j.process(frame(spark, x[50:] + y), 1)
    same(spark, f"{tmp_dir}/sink", {**batch_result(spark, x), **batch_result(spark, y)})
    state = spark.createDataFrame([("X", T0 + timedelta(minutes=59)), ("Y", None)], "symbol string, hwm timestamp_ntz")
    plan = j._tail(spark, state)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,Y)" in plan or "In(symbol, [Y])" in plan
