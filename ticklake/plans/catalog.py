"""Name -> query and name -> oracle SQL registries used by ``__spark_entry__``."""

from __future__ import annotations

from ticklake.plans import oracle, queries as q

QUERIES = {
    "bars_last_state": q.bars_last_state,
    "stage_candles_json": q.stage_candles_json,
    "bars_ohlc": q.bars_ohlc,
    "resample_left_last": q.resample_left_last,
    "candles_resample": q.candles_resample,
    "event_time_auto": q.event_time_auto,
    "route_by_guid": q.route_by_guid,
    "drop_control": q.drop_control,
    "route_messages": q.route_messages,
    "split_instrument": q.split_instrument_q,
    "topic_name": q.topic_name_q,
    "parse_quarantine": q.parse_quarantine,
    "bid_ask_flatten": q.bid_ask_flatten,
    "book_explode": q.book_explode,
    "book_expectation": q.book_expectation,
    "book_expectation_rows": q.book_expectation_rows,
    "level2_bar_mean": q.level2_bar_mean,
    "asof_backward": q.asof_backward,
    "asof_forward": q.asof_forward,
    "asof_nearest": q.asof_nearest,
    "asof_unmatched": q.asof_unmatched,
    "match_quality": q.match_quality,
    "append_new": q.append_new,
    "features_inner": q.features_inner,
    "keep_last": q.keep_last,
    "only_new": q.only_new,
    "time_gap": q.time_gap_q,
    "fill_grid": q.fill_grid,
    "grid_candles": q.grid_candles,
    "time_bounds": q.time_bounds,
    "second_feed_publish": q.second_feed_publish,
    "rolling_candles": q.rolling_candles,
    "cci": q.cci,
    "ichimoku": q.ichimoku,
    "rsi": q.rsi,
    "adx": q.adx,
    "stochastic": q.stochastic,
    "macd": q.macd,
    "bollinger": q.bollinger,
    "level2_features": q.level2_features,
    "features": q.features,
    "features_1min": q.features_1min,
    "list_daily_files": q.list_daily_files,
    "find_updated_files": q.find_updated_files,
    "file_counts": q.file_counts,
    "message_rate": q.message_rate,
    "time_lag": q.time_lag_q,
}

FLAGSHIP = "features"

ORACLE = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
