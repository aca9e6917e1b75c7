"""DuckDB SQL oracle for the registered queries.

Each statement recomputes a query's result directly from the driver tables
(views ``events``, ``orders`` ...), independently of the Spark plan: the same
derivations (``ticklake/plans/derive.py``) written as SQL, with the
operator semantics spelled out (right-closed bins, last non-null by
``(ts, seq)``, as-of tie rules, ...).
"""

from __future__ import annotations

import math

# -- shared derivations -------------------------------------------------------

K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
MS_TS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"  # event time floored to the millisecond


def bucket(step: str, ts: str = "ts") -> str:
    """Right-closed bin start for ``ts`` (``(start, start+step]``)."""
    return f"time_bucket(INTERVAL '{step}', {ts} - INTERVAL '1 microsecond')"


TICKS = f"""ticks AS (
  SELECT event_type AS symbol, ts, value AS price, {K} AS vol, event_id AS seq FROM events)"""

RAW_CANDLES = f"""raw_candles AS (
  SELECT event_type AS symbol, ts, event_id AS seq, value AS open,
         value + k * 0.01::DOUBLE AS high, value - k * 0.01::DOUBLE AS low,
         CASE WHEN k % 10 <> 0 THEN value END AS close, k AS vol
  FROM (SELECT *, {K} AS k FROM events))"""

BOOK_LEVELS = f"""levels AS (
  SELECT event_type AS symbol, {MS_TS} AS datetime, event_id, i,
         value + (-0.01::DOUBLE * i) AS bid, CAST(1 + (event_id + i) % 7 AS DOUBLE) AS bid_vol,
         value + (0.01::DOUBLE * i) AS ask, CAST(1 + (event_id + 2 * i) % 7 AS DOUBLE) AS ask_vol
  FROM events, range(1, 6) r(i))"""

SNAPSHOTS = f"""{BOOK_LEVELS},
snap AS (
  SELECT symbol, datetime,
         max(bid) AS l2_bid_max, sum(bid * bid_vol) / sum(bid_vol) AS l2_bid_expect, sum(bid_vol) AS l2_bid_vol,
         min(ask) AS l2_ask_min, sum(ask * ask_vol) / sum(ask_vol) AS l2_ask_expect, sum(ask_vol) AS l2_ask_vol
  FROM levels GROUP BY symbol, datetime)"""

def r6(x: str) -> str:
    """Same comparison rounding as ``queries.r6``."""
    return f"(round({x} + 1e-9, 6) + 0.0)"


L2 = ["l2_bid_max", "l2_bid_expect", "l2_bid_vol", "l2_ask_min", "l2_ask_expect", "l2_ask_vol"]


def last_state(cols, order="(ts, seq)") -> str:
    return ",\n       ".join(f"arg_max({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)


SQL: dict[str, str] = {}

SQL["bars_last_state"] = f"""
WITH {RAW_CANDLES}
SELECT symbol, {bucket('1 hour')} AS open_time, {bucket('1 hour')} + INTERVAL '1 hour' AS close_time,
       {last_state(['open', 'high', 'low', 'close', 'vol'])}
FROM raw_candles GROUP BY symbol, open_time, close_time
"""

SQL["stage_candles_json"] = f"""
WITH {RAW_CANDLES}, msg AS (SELECT symbol, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, seq, open, high, low, close, vol
                            FROM raw_candles)
SELECT symbol, {bucket('1 hour')} AS open_time, {bucket('1 hour')} + INTERVAL '1 hour' AS close_time,
       {last_state(['open', 'high', 'low', 'close', 'vol'])}
FROM msg GROUP BY symbol, open_time, close_time
"""

SQL["bars_ohlc"] = f"""
WITH {TICKS}
SELECT symbol, {bucket('1 hour')} AS open_time, {bucket('1 hour')} + INTERVAL '1 hour' AS close_time,
       arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, seq)) AS close, sum(vol) AS vol, count(*) AS n
FROM ticks GROUP BY symbol, open_time, close_time
"""

SQL["resample_left_last"] = f"""
WITH {TICKS}
SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS datetime, {last_state(['price', 'vol'])}
FROM ticks GROUP BY symbol, datetime
"""

SQL["candles_resample"] = f"""
WITH {TICKS},
hourly AS (
  SELECT symbol, {bucket('1 hour')} AS open_time, {bucket('1 hour')} + INTERVAL '1 hour' AS close_time,
         arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (ts, seq)) AS close, sum(vol) AS vol
  FROM ticks GROUP BY symbol, open_time, close_time)
SELECT symbol, min(open_time) AS open_time, max(close_time) AS close_time,
       arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, close_time) AS close, sum(vol) AS vol
FROM hourly GROUP BY symbol, {bucket('4 hours', 'close_time')}
"""

SQL["event_time_auto"] = """
WITH m AS (
  SELECT event_id AS msg_id,
         CASE WHEN event_id % 3 = 0 THEN CAST(epoch_us(ts) // 1000 AS DOUBLE) END AS tso,
         CASE WHEN event_id % 3 = 1 THEN CAST(epoch_us(ts) // 1000 AS DOUBLE) END AS tst,
         CAST(epoch_us(ts) AS DOUBLE) / 1000000 AS t
  FROM events)
SELECT msg_id, make_timestamp(CAST(CASE WHEN v > 9999999999 THEN round(v * 1000) ELSE round(v * 1000000) END AS BIGINT))
       AS datetime
FROM (SELECT msg_id, coalesce(tso, tst, t) AS v FROM m)
"""

SQL["route_by_guid"] = """
SELECT event_id AS msg_id, 'g-' || event_type AS guid, event_type AS kind, 'raw.alor.SBER.' || event_type AS topic
FROM events WHERE user_id % 10 <> 0 AND event_id % 17 <> 0
"""

SQL["second_feed_publish"] = """
SELECT event_id AS msg_id, 'raw.alor.SBER.' || event_type AS topic, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS datetime
FROM events WHERE user_id % 10 <> 0 AND event_id % 17 <> 0
"""

SQL["time_bounds"] = "SELECT event_type AS symbol, min(ts) AS min_ts, max(ts) AS max_ts FROM events GROUP BY 1"

SQL["drop_control"] = """
SELECT event_id AS msg_id FROM events WHERE event_type <> 'error'
"""

SQL["route_messages"] = """
WITH f AS (
  SELECT event_id, lower('market.' || event_type || '.' ||
         CASE event_id % 3 WHEN 0 THEN 'kline.1min' WHEN 1 THEN 'depth.step0' ELSE 'bbo' END) AS ch,
         CASE event_id % 3 WHEN 0 THEN 'candles' WHEN 1 THEN 'level2' ELSE 'bid_ask' END AS kind
  FROM events WHERE event_type <> 'error')
SELECT event_id AS msg_id, ch, kind, 'raw.htx.' || ch AS topic FROM f
"""

SQL["split_instrument"] = """
SELECT event_id, 'MOEX.TQBR.' || upper(event_type) || '.' || CAST(user_id AS VARCHAR) AS instrument,
       'MOEX' AS exchange, 'TQBR' AS board, upper(event_type) || '.' || CAST(user_id AS VARCHAR) AS code
FROM events
"""

SQL["topic_name"] = """
SELECT event_id, 'raw.htx.market.' || event_type AS topic, 'raw.alor.SBER.' || event_type AS kind_topic FROM events
"""

SQL["parse_quarantine"] = """
SELECT CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE 'good' END AS outcome, count(*) AS n
FROM events GROUP BY 1
"""

SQL["bid_ask_flatten"] = f"""
SELECT event_type AS symbol, {MS_TS} AS datetime,
       {r6("value - 0.01::DOUBLE")} AS bid, CAST(1 + (event_id + 1) % 7 AS DOUBLE) AS bid_vol,
       {r6("value + 0.01::DOUBLE")} AS ask, CAST(1 + (event_id + 2) % 7 AS DOUBLE) AS ask_vol
FROM events WHERE event_type <> 'error'
"""

SQL["book_explode"] = f"""
WITH {BOOK_LEVELS}
SELECT symbol, datetime, {r6("bid")} AS bid, bid_vol, CAST(NULL AS DOUBLE) AS ask, CAST(NULL AS DOUBLE) AS ask_vol
FROM levels
UNION ALL
SELECT symbol, datetime, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), {r6("ask")}, ask_vol FROM levels
"""

SQL["book_expectation"] = f"""
WITH {SNAPSHOTS}
SELECT symbol, datetime, {", ".join(f"{r6(c)} AS {c}" for c in L2)} FROM snap
"""
SQL["book_expectation_rows"] = SQL["book_expectation"]

SQL["level2_bar_mean"] = f"""
WITH {SNAPSHOTS}
SELECT symbol, {bucket('1 hour', 'datetime')} + INTERVAL '1 hour' AS datetime,
       {", ".join(f"{r6(f'avg({c})')} AS {c}" for c in L2)}
FROM snap GROUP BY 1, 2
"""

ASOF_SIDES = """l AS (SELECT user_id % 8 AS symbol, date_trunc('second', ts) AS ts, event_id, value
      FROM events WHERE event_id % 2 = 0),
r AS (SELECT user_id % 8 AS symbol, date_trunc('second', ts) AS ts, event_id, value
      FROM events WHERE event_id % 2 = 1)"""
ASOF_TOL = "INTERVAL '30 minutes'"
ASOF_RANK = {
    "backward": ("r.ts <= l.ts AND r.ts >= l.ts - " + ASOF_TOL, "r.ts DESC, r.event_id DESC"),
    "forward": ("r.ts >= l.ts AND r.ts <= l.ts + " + ASOF_TOL, "r.ts ASC, r.event_id ASC"),
    "nearest": (f"r.ts >= l.ts - {ASOF_TOL} AND r.ts <= l.ts + {ASOF_TOL}",
                "abs(epoch_us(r.ts) - epoch_us(l.ts)), r.ts, "
                "CASE WHEN r.ts <= l.ts THEN -r.event_id ELSE r.event_id END"),
}
for _d, (_cond, _ord) in ASOF_RANK.items():
    SQL[f"asof_{_d}"] = f"""
WITH {ASOF_SIDES},
c AS (SELECT l.symbol, l.ts, l.event_id, l.value, r.ts AS r_ts, r.event_id AS r_event_id, r.value AS r_value,
             row_number() OVER (PARTITION BY l.event_id ORDER BY {_ord}) AS rn
      FROM l JOIN r ON l.symbol = r.symbol AND {_cond})
SELECT symbol, ts, event_id, value, r_ts, r_event_id, r_value FROM c WHERE rn = 1
"""

SQL["asof_unmatched"] = f"""
WITH {ASOF_SIDES}
SELECT * FROM l WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.symbol = l.symbol AND r.ts >= l.ts - {ASOF_TOL} AND r.ts <= l.ts + {ASOF_TOL})
"""

SQL["match_quality"] = f"""
WITH {ASOF_SIDES},
m AS (SELECT l.symbol, l.event_id,
             EXISTS (SELECT 1 FROM r WHERE r.symbol = l.symbol AND {ASOF_RANK['backward'][0]}) AS hit
      FROM l)
SELECT symbol, count(*) AS n_left, count(*) FILTER (WHERE hit) AS n_merged,
       count(*) FILTER (WHERE NOT hit) AS n_not_merged
FROM m GROUP BY symbol
"""

HOURLY = f"""{TICKS},
hourly AS (
  SELECT symbol, {bucket('1 hour')} + INTERVAL '1 hour' AS datetime,
         arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (ts, seq)) AS close, sum(vol) AS vol, count(*) AS n
  FROM ticks GROUP BY symbol, datetime)"""


def hourly_where(name: str, cond: str) -> str:
    return f"""{name} AS (
  SELECT symbol, {bucket('1 hour')} + INTERVAL '1 hour' AS datetime,
         arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (ts, seq)) AS close, sum(vol) AS vol, count(*) AS n
  FROM ticks WHERE {cond} GROUP BY symbol, datetime)"""


SQL["append_new"] = f"""
WITH {TICKS},
{hourly_where('h', "ts < TIMESTAMP '2024-01-16 00:00:00'")},
{hourly_where('s', "ts >= TIMESTAMP '2024-01-14 00:00:00'")}
SELECT *, 'history' AS src FROM h
UNION ALL
SELECT *, 'live' AS src FROM s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.symbol = s.symbol AND h.datetime = s.datetime)
"""

SQL["features_inner"] = f"""
WITH {HOURLY}, {SNAPSHOTS},
l2 AS (SELECT symbol, {bucket('1 hour', 'datetime')} + INTERVAL '1 hour' AS datetime,
              {", ".join(f"avg({c}) AS {c}" for c in L2)}
       FROM snap GROUP BY 1, 2)
SELECT hourly.*, {", ".join(f"{r6('l2.' + c)} AS {c}" for c in L2)}
FROM hourly JOIN l2 USING (symbol, datetime)
"""

SQL["keep_last"] = f"""
WITH {HOURLY}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn FROM hourly)
WHERE rn <= 100
"""

SQL["only_new"] = f"""
WITH {HOURLY},
{hourly_where('p', "ts < TIMESTAMP '2024-01-20 00:00:00'")},
m AS (SELECT symbol, max(datetime) AS hwm FROM p GROUP BY symbol)
SELECT hourly.* FROM hourly LEFT JOIN m USING (symbol) WHERE m.hwm IS NULL OR hourly.datetime > m.hwm
"""

SQL["time_gap"] = f"""
WITH {TICKS},
h AS (SELECT CASE WHEN symbol = 'error' THEN 'history_only' ELSE symbol END AS symbol, max(ts) AS history_max
      FROM ticks WHERE ts < TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1),
s AS (SELECT CASE WHEN symbol = 'error' THEN 'stream_only' ELSE symbol END AS symbol, min(ts) AS stream_min
      FROM ticks WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1),
j AS (SELECT coalesce(h.symbol, s.symbol) AS symbol, history_max, stream_min,
             CASE WHEN history_max IS NULL OR stream_min IS NULL THEN NULL
                  WHEN stream_min < history_max THEN 0.0
                  ELSE date_diff('microsecond', history_max, stream_min) / 1e6 END AS gap_seconds
      FROM h FULL OUTER JOIN s ON h.symbol = s.symbol)
SELECT symbol, history_max, stream_min, {r6('gap_seconds')} AS gap_seconds,
       coalesce(gap_seconds < 60.0, false) AS is_good
FROM j
"""


def fill_cte(step: str = "1 hour", src: str = "ticks", cols=("price", "vol"), name: str = "filled") -> str:
    """Resample last (left label) + reindex + linear fill by position, as SQL."""
    lc = ", ".join(f"arg_max({c}, (ts, seq)) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)
    prev = ", ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN {{'t': epoch_us(datetime), 'v': {c}}} END IGNORE NULLS) "
        f"OVER (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p_{c}, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN {{'t': epoch_us(datetime), 'v': {c}}} END IGNORE NULLS) "
        f"OVER (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n_{c}"
        for c in cols)
    interp = ", ".join(
        f"CASE WHEN p_{c} IS NULL THEN NULL WHEN n_{c} IS NULL OR p_{c}.t = epoch_us(datetime) THEN p_{c}.v "
        f"ELSE p_{c}.v + (n_{c}.v - p_{c}.v) * ((epoch_us(datetime) - p_{c}.t) / (n_{c}.t - p_{c}.t)) END AS {c}"
        for c in cols)
    return f"""res AS (
  SELECT symbol, time_bucket(INTERVAL '{step}', ts) AS datetime, {lc} FROM {src} GROUP BY 1, 2),
bnd AS (SELECT symbol, min(datetime) AS lo, max(datetime) AS hi FROM res GROUP BY symbol),
g AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL '{step}')) AS datetime FROM bnd),
gj AS (SELECT g.symbol, g.datetime, {", ".join("res." + c for c in cols)}
       FROM g LEFT JOIN res ON g.symbol = res.symbol AND g.datetime = res.datetime),
pn AS (SELECT symbol, datetime, {prev} FROM gj),
{name} AS (SELECT symbol, datetime, {interp} FROM pn)"""


SQL["fill_grid"] = f"""
WITH {TICKS}, {fill_cte()}
SELECT symbol, datetime, {r6('price')} AS price, {r6('vol')} AS vol FROM filled
"""


# -- indicators ------------------------------------------------------------------

WIN = "PARTITION BY symbol ORDER BY datetime"


def fr(n: int) -> str:
    return f"({WIN} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


class Chain:
    """CTE chain: every stage selects the previous one plus new columns
    (window functions cannot nest, so dependent windows get new stages)."""

    def __init__(self, src: str):
        self.ctes: list[str] = []
        self.cur = src
        self.n = 0

    def add(self, *exprs: str) -> None:
        self.n += 1
        name = f"s{self.n}"
        self.ctes.append(f"{name} AS (SELECT *, {', '.join(exprs)} FROM {self.cur})")
        self.cur = name


def ewm_list(x: str, name: str, alpha: float) -> str:
    """All inputs so far that can count: smaller weights vanish in a double."""
    k = math.ceil(60 / -math.log(1 - alpha)) if alpha < 1 else 1
    return f"list({x}) FILTER (WHERE {x} IS NOT NULL) OVER {fr(k)} AS {name}"


def ewm_of(lst: str, alpha: float, n: int, name: str) -> str:
    """The weighted mean of the list as defined: newest weight 1, each older one times (1 - alpha)."""
    b = dbl(1.0 - alpha)
    weights = f"list_transform(range(len({lst})), lambda k: power({b}, len({lst}) - 1 - k))"
    return (f"CASE WHEN len({lst}) >= {n} THEN list_dot_product({lst}, {weights}) / "
            f"list_sum({weights}) END AS {name}")


def rolling_candle_sql(ch: Chain, p: int, sfx: str) -> None:
    ok = f"count(*) OVER {fr(p)} = {p}"
    ch.add(f"CASE WHEN {ok} THEN lag(open, {p - 1}) OVER ({WIN}) END AS open{sfx}",
           f"CASE WHEN {ok} THEN max(high) OVER {fr(p)} END AS high{sfx}",
           f"CASE WHEN {ok} THEN min(low) OVER {fr(p)} END AS low{sfx}",
           f"CASE WHEN {ok} THEN close END AS close{sfx}",
           f"CASE WHEN {ok} THEN sum(vol) OVER {fr(p)} END AS vol{sfx}")


def indicators_sql(ch: Chain, params: dict, sfx: str, src: str) -> list[str]:
    h, lo, c = f"high{src}", f"low{src}", f"close{src}"
    out: list[str] = []
    if "cca" in params:
        n = params["cca"]["window"]
        ch.add(f"({h} + {lo} + {c}) / 3 AS _tp{sfx}")
        ch.add(f"list(_tp{sfx}) FILTER (WHERE _tp{sfx} IS NOT NULL) OVER {fr(n)} AS _tpl{sfx}",
               f"avg(_tp{sfx}) OVER {fr(n)} AS _tpm{sfx}")
        ch.add(f"list_sum(list_transform(_tpl{sfx}, lambda v: abs(v - _tpm{sfx}))) / len(_tpl{sfx}) AS _mad{sfx}")
        ch.add(f"CASE WHEN len(_tpl{sfx}) = {n} AND _mad{sfx} <> 0 THEN (_tp{sfx} - _tpm{sfx}) / "
               f"({dbl(0.015)} * _mad{sfx}) END AS cci{sfx}")
        out.append(f"cci{sfx}")
    if "ichimoku" in params:
        p = params["ichimoku"]

        def mid(n):
            return (f"CASE WHEN count({h}) OVER {fr(n)} = {n} THEN "
                    f"(max({h}) OVER {fr(n)} + min({lo}) OVER {fr(n)}) / 2 END")
        ch.add(f"{mid(p['window1'])} AS ichimoku_conv{sfx}", f"{mid(p['window2'])} AS ichimoku_base{sfx}",
               f"{mid(p['window3'])} AS ichimoku_b{sfx}")
        ch.add(f"(ichimoku_conv{sfx} + ichimoku_base{sfx}) / 2 AS ichimoku_a{sfx}")
        out += [f"ichimoku_conv{sfx}", f"ichimoku_base{sfx}", f"ichimoku_b{sfx}", f"ichimoku_a{sfx}"]
    if "rsi" in params:
        n = params["rsi"]["window"]
        ch.add(f"{c} - lag({c}) OVER ({WIN}) AS _d{sfx}")
        ch.add(f"CASE WHEN _d{sfx} IS NOT NULL THEN greatest(_d{sfx}, 0.0) END AS _gain{sfx}",
               f"CASE WHEN _d{sfx} IS NOT NULL THEN greatest(-_d{sfx}, 0.0) END AS _loss{sfx}")
        ch.add(ewm_list(f"_gain{sfx}", f"_gl{sfx}", 1.0 / n), ewm_list(f"_loss{sfx}", f"_ll{sfx}", 1.0 / n))
        ch.add(ewm_of(f"_gl{sfx}", 1.0 / n, n, f"_eg{sfx}"), ewm_of(f"_ll{sfx}", 1.0 / n, n, f"_el{sfx}"))
        ch.add(*[f"CASE WHEN {x} <= {dbl(1e-12)} * abs({c}) THEN 0.0 ELSE {x} END AS {x}0" for x in (f"_eg{sfx}", f"_el{sfx}")])
        ch.add(f"CASE WHEN _el{sfx}0 = 0 THEN 100.0 ELSE 100 - 100 / (1 + _eg{sfx}0 / _el{sfx}0) END AS rsi{sfx}")
        out.append(f"rsi{sfx}")
    if "adx" in params:
        n = params["adx"]["window"]
        a = 1.0 / n
        ch.add(f"lag({c}) OVER ({WIN}) AS _pc{sfx}", f"lag({h}) OVER ({WIN}) AS _ph{sfx}",
               f"lag({lo}) OVER ({WIN}) AS _pl{sfx}")
        up, dn = f"({h} - _ph{sfx})", f"(_pl{sfx} - {lo})"
        ch.add(f"CASE WHEN _pc{sfx} IS NOT NULL THEN greatest({h} - {lo}, abs({h} - _pc{sfx}), abs({lo} - _pc{sfx})) END AS _tr{sfx}",
               f"CASE WHEN _ph{sfx} IS NOT NULL THEN CASE WHEN {up} > {dn} AND {up} > 0 THEN {up} ELSE 0.0 END END AS _pdm{sfx}",
               f"CASE WHEN _pl{sfx} IS NOT NULL THEN CASE WHEN {dn} > {up} AND {dn} > 0 THEN {dn} ELSE 0.0 END END AS _mdm{sfx}")
        ch.add(ewm_list(f"_tr{sfx}", f"_trl{sfx}", a), ewm_list(f"_pdm{sfx}", f"_pdl{sfx}", a),
               ewm_list(f"_mdm{sfx}", f"_mdl{sfx}", a))
        ch.add(ewm_of(f"_trl{sfx}", a, n, f"_atr{sfx}"), ewm_of(f"_pdl{sfx}", a, n, f"_pe{sfx}"),
               ewm_of(f"_mdl{sfx}", a, n, f"_me{sfx}"))
        ch.add(*[f"CASE WHEN {x} <= {dbl(1e-12)} * abs({c}) THEN 0.0 ELSE {x} END AS {x}0"
                 for x in (f"_atr{sfx}", f"_pe{sfx}", f"_me{sfx}")])
        ch.add(f"CASE WHEN _atr{sfx}0 = 0 THEN 0.0 ELSE 100 * _pe{sfx}0 / _atr{sfx}0 END AS adx_pos{sfx}",
               f"CASE WHEN _atr{sfx}0 = 0 THEN 0.0 ELSE 100 * _me{sfx}0 / _atr{sfx}0 END AS adx_neg{sfx}")
        ch.add(f"CASE WHEN adx_pos{sfx} + adx_neg{sfx} = 0 THEN 0.0 ELSE "
               f"100 * abs(adx_pos{sfx} - adx_neg{sfx}) / (adx_pos{sfx} + adx_neg{sfx}) END AS _dx{sfx}")
        ch.add(ewm_list(f"_dx{sfx}", f"_dxl{sfx}", a))
        ch.add(ewm_of(f"_dxl{sfx}", a, n, f"adx{sfx}"))
        out += [f"adx_pos{sfx}", f"adx_neg{sfx}", f"adx{sfx}"]
    if "stoch" in params:
        n, s = params["stoch"]["window"], params["stoch"]["smooth_window"]
        hh, ll = f"max({h}) OVER {fr(n)}", f"min({lo}) OVER {fr(n)}"
        ch.add(f"CASE WHEN count({c}) OVER {fr(n)} = {n} AND {hh} <> {ll} THEN 100 * ({c} - {ll}) / ({hh} - {ll}) "
               f"END AS stoch{sfx}")
        ch.add(f"CASE WHEN count(stoch{sfx}) OVER {fr(s)} = {s} THEN avg(stoch{sfx}) OVER {fr(s)} END AS stoch_signal{sfx}")
        out += [f"stoch{sfx}", f"stoch_signal{sfx}"]
    if "macd" in params:
        m = params["macd"]
        slow, fast, sign = m.get("slow", 26), m.get("fast", 12), m.get("sign", 9)
        ch.add(ewm_list(c, f"_fl{sfx}", 2.0 / (fast + 1)), ewm_list(c, f"_sl{sfx}", 2.0 / (slow + 1)))
        ch.add(ewm_of(f"_fl{sfx}", 2.0 / (fast + 1), fast, f"_ef{sfx}"),
               ewm_of(f"_sl{sfx}", 2.0 / (slow + 1), slow, f"_es{sfx}"))
        ch.add(f"_ef{sfx} - _es{sfx} AS macd{sfx}")
        ch.add(ewm_list(f"macd{sfx}", f"_ml{sfx}", 2.0 / (sign + 1)))
        ch.add(ewm_of(f"_ml{sfx}", 2.0 / (sign + 1), sign, f"macd_signal{sfx}"))
        ch.add(f"macd{sfx} - macd_signal{sfx} AS macd_diff{sfx}")
        out += [f"macd{sfx}", f"macd_signal{sfx}", f"macd_diff{sfx}"]
    if "bb" in params:
        n, dev = params["bb"]["window"], params["bb"]["window_dev"]
        ok = f"count({c}) OVER {fr(n)} = {n}"
        mavg, sd = f"avg({c}) OVER {fr(n)}", f"stddev_pop({c}) OVER {fr(n)}"
        ch.add(f"CASE WHEN {ok} THEN {mavg} END AS bb_mavg{sfx}",
               f"CASE WHEN {ok} THEN {mavg} + {dev} * {sd} END AS bb_hband{sfx}",
               f"CASE WHEN {ok} THEN {mavg} - {dev} * {sd} END AS bb_lband{sfx}")
        out += [f"bb_mavg{sfx}", f"bb_hband{sfx}", f"bb_lband{sfx}"]
    return out


def level2_sql(ch: Chain, p: int, sfx: str) -> list[str]:
    ch.add(*[f"CASE WHEN count({c}) OVER {fr(p)} = {p} THEN avg({c}) OVER {fr(p)} END AS {c}{sfx}" for c in L2])
    ch.add(f"l2_ask_min{sfx} - l2_bid_max{sfx} AS l2_spread{sfx}",
           f"CASE WHEN l2_bid_vol{sfx} + l2_ask_vol{sfx} <> 0 THEN (l2_bid_vol{sfx} - l2_ask_vol{sfx}) / "
           f"(l2_bid_vol{sfx} + l2_ask_vol{sfx}) END AS l2_imbalance{sfx}")
    return [f"{c}{sfx}" for c in L2] + [f"l2_spread{sfx}", f"l2_imbalance{sfx}"]


CANDLE = ("open", "high", "low", "close", "vol")
OHLC_SRC = f"""{TICKS},
ob AS (SELECT symbol, bts AS ts, 0 AS seq, open, high, low, close, vol FROM (
         SELECT symbol, {bucket('1 hour')} AS bts,
                arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low,
                arg_max(price, (ts, seq)) AS close, sum(vol) AS vol
         FROM ticks GROUP BY symbol, bts)),
{fill_cte('1 hour', 'ob', CANDLE, 'filled')}"""

SQL["grid_candles"] = f"""
WITH {OHLC_SRC}
SELECT symbol, datetime - INTERVAL '1 hour' AS open_time, datetime AS close_time, {", ".join(f"{r6(c)} AS {c}" for c in CANDLE)} FROM filled
"""

L2_SRC = f"""{SNAPSHOTS},
lb AS (SELECT symbol, {bucket('1 hour', 'datetime')} + INTERVAL '1 hour' AS ts, 0 AS seq,
              {", ".join(f"avg({c}) AS {c}" for c in L2)}
       FROM snap GROUP BY 1, 2),
{fill_cte('1 hour', 'lb', L2, 'filled')}"""

DEFAULTS = {
    "cca": {"window": 20}, "ichimoku": {"window1": 9, "window2": 26, "window3": 52}, "adx": {"window": 14},
    "rsi": {"window": 14}, "stoch": {"window": 14, "smooth_window": 3}, "macd": {"slow": 26, "fast": 12, "sign": 9},
    "bb": {"window": 20, "window_dev": 2},
}


def _finish(src: str, ch: Chain, cols: list[str], keep: list[str] | None = None) -> str:
    sel = ", ".join([*(keep or []), *[f"{r6(c)} AS {c}" for c in cols]])
    return f"WITH {src},\n" + ",\n".join(ch.ctes) + f"\nSELECT symbol, datetime, {sel} FROM {ch.cur}"


def indicator_query(key: str) -> str:
    ch = Chain("filled")
    ch.add("1 AS _one")
    cols = indicators_sql(ch, {key: DEFAULTS[key]}, "_1hour", "")
    return _finish(OHLC_SRC, ch, cols)


for _q, _k in [("cci", "cca"), ("ichimoku", "ichimoku"), ("rsi", "rsi"), ("adx", "adx"), ("stochastic", "stoch"),
               ("macd", "macd"), ("bollinger", "bb")]:
    SQL[_q] = indicator_query(_k)

_ch = Chain("filled")
rolling_candle_sql(_ch, 3, "_3hours")
SQL["rolling_candles"] = _finish(OHLC_SRC, _ch, [*CANDLE, *[f"{c}_3hours" for c in CANDLE]])

_ch = Chain("filled")
_l2c = level2_sql(_ch, 1, "_1hour") + level2_sql(_ch, 3, "_3hours")
SQL["level2_features"] = _finish(L2_SRC, _ch, [*L2, *_l2c])

FEATURE_PARAMS = {
    "cca": {"window": 5}, "ichimoku": {"window1": 3, "window2": 5, "window3": 9}, "adx": {"window": 5},
    "rsi": {"window": 5}, "stoch": {"window": 5, "smooth_window": 3}, "macd": {"slow": 8, "fast": 4, "sign": 3},
    "bb": {"window": 5, "window_dev": 2},
}


def features_query(periods=((1, "_1hour"), (3, "_3hours")), step: str = "1 hour") -> str:
    bars = f"""{TICKS},
hourly AS (
  SELECT symbol, {bucket(step)} + INTERVAL '{step}' AS datetime,
         arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (ts, seq)) AS close, sum(vol) AS vol, count(*) AS n
  FROM ticks GROUP BY symbol, datetime)"""
    src = f"""{bars}, {SNAPSHOTS},
l2b AS (SELECT symbol, {bucket(step, 'datetime')} + INTERVAL '{step}' AS datetime,
               {", ".join(f"avg({c}) AS {c}" for c in L2)}
        FROM snap GROUP BY 1, 2),
mc AS (SELECT c.symbol, c.datetime AS close_time, l.datetime AS l2dt, {", ".join("c." + x for x in CANDLE)},
              {", ".join("l." + x for x in L2)},
              row_number() OVER (PARTITION BY c.symbol, c.datetime
                                 ORDER BY abs(epoch_us(l.datetime) - epoch_us(c.datetime)), l.datetime) AS rn
       FROM hourly c JOIN l2b l ON c.symbol = l.symbol
        AND l.datetime BETWEEN c.datetime - INTERVAL '59 seconds' AND c.datetime + INTERVAL '59 seconds'),
merged AS (SELECT symbol, greatest(l2dt, close_time) AS ts, 0 AS seq, {", ".join(CANDLE)}, {", ".join(L2)}
           FROM mc WHERE rn = 1),
{fill_cte(step, 'merged', (*CANDLE, *L2), 'filled')}"""
    ch = Chain("filled")
    feats: list[str] = []
    for p, sfx in periods:
        rolling_candle_sql(ch, p, f"_rc{sfx}")
        feats += indicators_sql(ch, FEATURE_PARAMS, sfx, f"_rc{sfx}")
    for p, sfx in periods:
        feats += level2_sql(ch, p, sfx)
    cond = " AND ".join(f"{c} IS NOT NULL AND isfinite({c})" for c in feats)
    sel = ", ".join(f"{r6(c)} AS {c}" for c in feats)
    return f"WITH {src},\n" + ",\n".join(ch.ctes) + f"\nSELECT symbol, datetime, {sel} FROM {ch.cur} WHERE {cond}"


SQL["features"] = features_query()
SQL["features_1min"] = features_query(((1, "_1minute"), (5, "_5minutes")), step="1 minute")

LISTINGS = """g AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p, max(o_orderdate) AS mx,
              min(o_orderkey) AS kmin FROM orders GROUP BY 1, 2),
src AS (SELECT strftime(d, '%Y-%m-%d') || '_' || p || '.csv.zip' AS name, d AS file_date,
               mx + INTERVAL 1 DAY AS mtime FROM g),
dst AS (SELECT CASE WHEN kmin % 2 = 0 THEN strftime(d, '%Y-%m-%d') || '_' || p || '.csv'
                    ELSE strftime(d, '%Y-%m-%d') || '_' || p || '.csv.zip' END AS name, d AS file_date,
               mx + INTERVAL 1 DAY + CASE WHEN kmin % 2 = 1 THEN INTERVAL 1 HOUR ELSE INTERVAL (-1) HOUR END AS mtime
        FROM g WHERE kmin % 3 <> 0)"""

SQL["list_daily_files"] = f"""
WITH {LISTINGS}
SELECT name, file_date, mtime FROM src
WHERE file_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND mtime >= TIMESTAMP '1996-06-01 00:00:00'
"""

SQL["find_updated_files"] = f"""
WITH {LISTINGS},
s AS (SELECT * FROM src WHERE file_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'),
t AS (SELECT * FROM dst WHERE file_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')
SELECT s.name, 'src/' || s.name AS path, s.file_date, s.mtime FROM s
LEFT JOIN t e ON e.name = s.name
LEFT JOIN t z ON z.name = regexp_replace(s.name, '\\.zip$', '')
WHERE coalesce(e.mtime, z.mtime) IS NULL OR s.mtime > coalesce(e.mtime, z.mtime)
"""

SQL["file_counts"] = f"""
WITH {LISTINGS},
a AS (SELECT 'src' AS dir, name, file_date FROM src UNION ALL SELECT 'dst', name, file_date FROM dst)
SELECT dir, CASE WHEN name LIKE '%.csv.zip' THEN 'csv.zip' WHEN name LIKE '%.csv' THEN 'csv' ELSE 'other' END AS kind,
       count(*) AS n_files, min(file_date) AS first_date, max(file_date) AS last_date
FROM a GROUP BY 1, 2
"""

SQL["message_rate"] = f"""
WITH f AS (
  SELECT 'raw.htx.' || lower('market.' || event_type || '.' ||
         CASE event_id % 3 WHEN 0 THEN 'kline.1min' WHEN 1 THEN 'depth.step0' ELSE 'bbo' END) AS topic,
         {MS_TS} AS ts
  FROM events WHERE event_type <> 'error')
SELECT topic, time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS n,
       {r6('count(*) / 3600.0')} AS per_sec, {r6('count(*) * 60.0 / 3600.0')} AS per_min
FROM f GROUP BY 1, 2
"""

SQL["time_lag"] = f"""
WITH {TICKS}, l AS (SELECT symbol, (epoch_us({bucket('1 hour')} + INTERVAL '1 hour') - epoch_us(ts)) / 1e6 AS lag FROM ticks)
SELECT symbol, {r6('max(lag)')} AS max_lag_s, {r6('avg(lag)')} AS avg_lag_s, count(*) AS n FROM l GROUP BY symbol
"""
