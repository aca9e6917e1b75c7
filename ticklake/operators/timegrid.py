"""Regular time grid with linear fill.

Per symbol: resample to ``step`` (last value, left label), reindex to every
step between the first and the last label, and fill gaps linearly by
position (on a regular grid position is time).  Leading gaps stay null,
trailing gaps repeat the last value, a step with data keeps it.  The grid
starts at the floored first timestamp (a grid starting off-step would never
meet the resampled labels).

Plan: the grid is generated per ``(symbol, chunk)`` after a shuffle of the
tiny chunk list, so no task generates a whole symbol's grid; data rows and
grid rows are unioned and windowed per ``(symbol, chunk)``; the last value
before a chunk and the first after it come from a one-row-per-chunk summary
propagated over the chunk table (gaps may be arbitrarily long, so a fixed
halo would not be exact).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.time import interval
from ticklake.operators.bars import resample_last
from ticklake.operators.chunks import chunk_of, parse_duration_us, ts_micros


def grid(bounds: DataFrame, step: str, chunk: str, *, symbol: str = "symbol", lo: str = "lo", hi: str = "hi",
         out_ts: str = "datetime") -> DataFrame:
    """Every ``step`` from ``lo`` to ``hi`` (inclusive) per symbol, with chunk ``_c``."""
    step_us, chunk_us = parse_duration_us(step), parse_duration_us(chunk)
    lo_us, hi_us = ts_micros(bounds, lo), ts_micros(bounds, hi)
    chunks = bounds.select(symbol, lo, hi, F.explode(F.sequence(chunk_of(lo_us, chunk_us),
                                                                  chunk_of(hi_us, chunk_us))).alias("_c"))
    # spread the chunk list before expanding it: a long symbol is generated by many tasks
    chunks = chunks.repartition(symbol, "_c")
    us_lo = F.greatest(ts_micros(chunks, lo), F.col("_c") * chunk_us)
    us_hi = F.least(ts_micros(chunks, hi), (F.col("_c") + 1) * chunk_us - 1)
    # first grid point at or after the chunk start, aligned to lo
    first = us_lo + F.pmod(ts_micros(chunks, lo) - us_lo, F.lit(step_us))
    pts = chunks.select(symbol, "_c", first.alias("_a"), us_hi.alias("_b")).where(F.col("_a") <= F.col("_b"))
    pts = pts.select(symbol, "_c", F.explode(F.sequence("_a", "_b", F.lit(step_us))).alias("_us"))
    ts_type = bounds.schema[lo].dataType
    from ticklake.functions.time import ntz_from_micros
    ts_col = ntz_from_micros("_us") if isinstance(ts_type, T.TimestampNTZType) else F.timestamp_micros("_us")
    return pts.select(symbol, ts_col.alias(out_ts), "_c")


def _num(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        return ts_micros(df, c).cast("double"), dt
    return F.col(c).cast("double"), None


def with_candle_times(filled: DataFrame, step: str = "1 minute", *, ts: str = "datetime") -> DataFrame:
    """Candle times of filled rows: ``close_time`` is the grid time and
    ``open_time`` one step before it."""
    return filled.withColumn("close_time", F.col(ts)) \
        .withColumn("open_time", F.col(ts) - F.expr(f"INTERVAL {parse_duration_us(step)} MICROSECONDS"))


def fill_grid(df: DataFrame, step: str = "1 minute", *, symbol: str = "symbol", ts: str = "ts",
              seq: Sequence[str] = (), cols: Sequence[str] | None = None, chunk: str = "1 day",
              out_ts: str = "datetime", resampled: bool = False) -> DataFrame:
    """Resample (unless ``resampled``) and fill ``cols`` on a regular grid."""
    if resampled:
        data = df.withColumnRenamed(ts, out_ts) if ts != out_ts else df
        cols = list(cols) if cols is not None else [c for c in data.columns if c not in (symbol, out_ts)]
    else:
        cols = list(cols) if cols is not None else [c for c in df.columns if c not in (symbol, ts, *seq)]
        data = resample_last(df, step, symbol=symbol, ts=ts, seq=seq, cols=cols, out_ts=out_ts)
    chunk_us = parse_duration_us(chunk)
    data = data.withColumn("_c", chunk_of(ts_micros(data, out_ts), chunk_us))
    tus = ts_micros(data, out_ts)

    kinds = {}
    num = {}
    for c in cols:
        num[c], kinds[c] = _num(data, c)
    # value with its position: struct(us, v) where v is not null
    pv = {c: F.when(num[c].isNotNull(), F.struct(tus.alias("t"), num[c].alias("v"))) for c in cols}

    # per-chunk edge values (and time bounds), then carried across chunks over
    # the small chunk table.  Bounds come from this summary, not from a third
    # pass over the data: both consumers of ``data`` then need the same
    # columns and share one shuffle (exchange reuse).
    # primitive buffers only (a struct value would force sort-based aggregation)
    t_nn = {c: F.when(num[c].isNotNull(), tus) for c in cols}
    edge = data.groupBy(symbol, "_c").agg(
        F.min(out_ts).alias("_lo"), F.max(out_ts).alias("_hi"),
        *[F.max(t_nn[c]).alias(f"_lt_{c}") for c in cols],
        *[F.max_by(num[c], t_nn[c]).alias(f"_lv_{c}") for c in cols],
        *[F.min(t_nn[c]).alias(f"_ft_{c}") for c in cols],
        *[F.min_by(num[c], t_nn[c]).alias(f"_fv_{c}") for c in cols])
    edge = edge.select(symbol, "_c", "_lo", "_hi",
                       *[F.when(F.col(f"_lt_{c}").isNotNull(), F.struct(F.col(f"_lt_{c}").alias("t"),
                                                                        F.col(f"_lv_{c}").alias("v")))
                         .alias(f"_last_{c}") for c in cols],
                       *[F.when(F.col(f"_ft_{c}").isNotNull(), F.struct(F.col(f"_ft_{c}").alias("t"),
                                                                        F.col(f"_fv_{c}").alias("v")))
                         .alias(f"_first_{c}") for c in cols])
    bounds = edge.groupBy(symbol).agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))
    g = grid(bounds, step, chunk, symbol=symbol, out_ts=out_ts)
    # every chunk of the grid, also those without data rows (long gaps)
    all_chunks = bounds.select(symbol, F.explode(F.sequence(chunk_of(ts_micros(bounds, "lo"), chunk_us),
                                                            chunk_of(ts_micros(bounds, "hi"), chunk_us))).alias("_c"))
    edge = all_chunks.join(edge.drop("_lo", "_hi"), [symbol, "_c"], "left")
    before = Window.partitionBy(symbol).orderBy(F.col("_c").asc()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(symbol).orderBy(F.col("_c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = edge.select(symbol, "_c",
                        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_cp_{c}") for c in cols],
                        *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_cn_{c}") for c in cols])

    u = (data.select(symbol, out_ts, "_c", F.lit(0).alias("_g"), *[pv[c].alias(f"_pv_{c}") for c in cols])
         .unionByName(g.select(symbol, out_ts, "_c", F.lit(1).alias("_g"),
                               *[F.lit(None).cast(data.select(pv[c]).schema[0].dataType).alias(f"_pv_{c}")
                                 for c in cols])))
    u = u.join(carry, [symbol, "_c"], "left")
    w_up = (Window.partitionBy(symbol, "_c").orderBy(F.col(out_ts).asc(), F.col("_g").asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_dn = (Window.partitionBy(symbol, "_c").orderBy(F.col(out_ts).desc(), F.col("_g").asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumns({f"_p_{c}": F.coalesce(F.last(f"_pv_{c}", ignorenulls=True).over(w_up), F.col(f"_cp_{c}"))
                       for c in cols})
    u = u.withColumns({f"_n_{c}": F.coalesce(F.last(f"_pv_{c}", ignorenulls=True).over(w_dn), F.col(f"_cn_{c}"))
                       for c in cols})
    u = u.where(F.col("_g") == 1)
    t = ts_micros(g, out_ts)
    out = []
    for c in cols:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        frac = (t - p["t"]) / (n["t"] - p["t"])
        v = (F.when(p.isNull(), F.lit(None))
             .when(n.isNull() | (p["t"] == t), p["v"])
             .otherwise(p["v"] + (n["v"] - p["v"]) * frac))
        if kinds[c] is not None:
            from ticklake.functions.time import ntz_from_micros
            us = F.round(v).cast("long")
            v = ntz_from_micros(us) if isinstance(kinds[c], T.TimestampNTZType) else F.timestamp_micros(us)
        out.append(v.alias(c))
    return u.select(symbol, out_ts, *out)
