"""Plan-shape checks for scale: time-series operators shuffle by
(symbol, time chunk), never by symbol alone; the as-of join uses no
nested-loop or range join; scans get filters and pruned columns."""
import re
from datetime import datetime as dt, timedelta

import pytest

from ticklake.operators.asof import asof_join
from ticklake.operators.increment import keep_last
from ticklake.operators.indicators import candle_indicators
from ticklake.operators.timegrid import fill_grid
from ticklake.plans import catalog, queries as q

from conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _windows(plan: str) -> list[tuple[str, str]]:
    """(window functions, partition keys) of each Window operator."""
    return re.findall(r"Window \[(.*?)\], \[([^\]]*)\], \[", plan)


def _df(spark):
    t0 = dt(2025, 1, 1)
    rows = [("X", t0 + timedelta(minutes=i), float(i), float(i) + 1, float(i) - 1, float(i), 1.0) for i in range(50)]
    return spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, open double, high double, "
                                       "low double, close double, vol double")


def test_asof_plan(spark):
    left = q.derive.asof_side(spark, SF, "left")
    right = q.derive.asof_side(spark, SF, "right")
    p = _plan(asof_join(left, right, direction="nearest", tolerance="1 minute", right_order=["event_id"]))
    assert "NestedLoop" not in p and "Cartesian" not in p
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert exchanges and all("_c" in e for e in exchanges)
    assert "PushedFilters: [In(event_type" in p or "PushedFilters" in p


def test_time_series_windows_partition_by_chunk(spark):
    df = _df(spark)
    for out in (fill_grid(df, "1 minute", ts="datetime", cols=["close"], chunk="10 minutes"),
                candle_indicators(df, ["3 minutes"], "1 minute", {"rsi": {"window": 3}}, chunk="10 minutes")):
        ws = _windows(_plan(out))
        # every row-level window is keyed by (symbol, chunk); the only
        # symbol-only windows run over the one-row-per-chunk carry table
        assert ws and any("_c#" in keys for _, keys in ws)
        for funcs, keys in ws:
            carry = "_last_" in funcs or "_first_" in funcs
            assert carry or "_c#" in keys, (funcs[:80], keys)


def test_keep_last_ranks_only_the_tail(spark):
    p = _plan(keep_last(_df(spark), 5, chunk="10 minutes"))
    assert "LeftSemi" in p  # rows are cut to the needed chunks before ranking


def test_stream_asof_join_key_has_chunk(spark, tmp_dir):
    from ticklake.schemas import L2_COLS
    from ticklake.streaming.asof_stream import asof_join_stream
    cs = "symbol string, close_time timestamp, open double, high double, low double, close double, vol double"
    ls = "symbol string, datetime timestamp, " + ", ".join(f"{c} double" for c in L2_COLS)
    spark.createDataFrame([], cs).write.parquet(f"{tmp_dir}/c")
    spark.createDataFrame([], ls).write.parquet(f"{tmp_dir}/l")
    j = asof_join_stream(spark.readStream.schema(cs).parquet(f"{tmp_dir}/c"),
                         spark.readStream.schema(ls).parquet(f"{tmp_dir}/l"))
    plan = j._jdf.queryExecution().analyzed().toString()
    assert "_l_c" in plan and "_c" in plan


def test_bars_use_hash_aggregation(spark):
    # a struct ordering key or struct value would make Spark sort every row
    for name in ("bars_ohlc", "bars_last_state", "resample_left_last", "fill_grid"):
        p = _plan(getattr(q, name)(spark, SF))
        assert "SortAggregate" not in p and "HashAggregate" in p, name


@pytest.mark.parametrize("name", ["level2_bar_mean", "stage_candles_json", "bid_ask_flatten", "message_rate"])
def test_messages_are_parsed_once(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
