"""As-of joins (backward, forward, nearest) with a bounded tolerance.

Each left row gets at most one right row with the same key:

- ``backward``: latest right row with ``right_ts <= left_ts``;
- ``forward``: earliest right row with ``right_ts >= left_ts``;
- ``nearest``: the smaller distance of the two, the earlier (backward) row
  on a tie.

The tolerance is inclusive.  Right rows sharing a timestamp are ordered by
``right_order`` (e.g. an id): the last of them is taken looking back, the
first looking ahead.  A right row may serve many left rows.

Plan (no range join, no nested loop, one shuffle): both sides are unioned
and hash-partitioned by ``(key, time chunk)``.  A right row is copied into
each neighbouring chunk that holds left rows within the tolerance of it, so
every chunk is complete.  Inside a chunk a running ``last(ignorenulls)``
over the ascending order finds the backward candidate and the same over the
descending order finds the forward one (two sorts of the same partitions;
unbounded-following frames are avoided because Spark evaluates them in
quadratic time).  ``chunk`` sizes the tasks: a hot key is spread over
``time span / chunk`` partitions, and halo copies cost ``tolerance / chunk``
of the right side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.chunks import chunk_of, chunks_reaching, parse_duration_us, ts_micros

_R = "_asof_r"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def asof_join(left: DataFrame, right: DataFrame, *, on: str | Sequence[str] = "symbol",
              left_ts: str = "ts", right_ts: str = "ts", direction: str = "backward",
              tolerance: str | int | float = "1 minute", right_order: str | Sequence[str] = (),
              right_prefix: str = "right_", how: str = "inner", chunk: str = "1 hour") -> DataFrame:
    """As-of join of ``left`` with ``right`` on equal ``on`` keys.

    Output: all left columns, then the right columns (key excluded); right
    names that collide with left names get ``right_prefix``.  ``how="inner"``
    drops left rows without a match (what the source did with ``dropna``),
    ``how="left"`` keeps them with null right columns.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction: {direction}")
    keys = _as_list(on)
    order = _as_list(right_order)
    tol_us = parse_duration_us(tolerance)
    chunk_us = parse_duration_us(chunk)
    back = direction in ("backward", "nearest")
    ahead = direction in ("forward", "nearest")

    r_cols = [c for c in right.columns if c not in keys]
    out_names = {c: (right_prefix + c if c in left.columns else c) for c in r_cols}
    r_struct_t = right.select(F.struct(*[F.col(c) for c in r_cols])).schema[0].dataType

    lus = ts_micros(left, left_ts)
    rus = ts_micros(right, right_ts)

    l = left.select(*[F.col(k) for k in keys],
                    lus.alias("_us"), F.lit(1).alias("_side"),
                    *[F.lit(None).alias(f"_o{i}") for i in range(len(order))],
                    chunk_of(lus, chunk_us).alias("_c"),
                    F.struct(*[F.col(c) for c in left.columns]).alias("_l"),
                    F.lit(None).cast(r_struct_t).alias(_R))
    # null keys match nothing (a window partition would take them for equal)
    for k in keys:
        right = right.where(F.col(k).isNotNull())
    r = right.select(*[F.col(k) for k in keys],
                     rus.alias("_us"), F.lit(0).alias("_side"),
                     *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                     F.explode(chunks_reaching(rus, chunk_us, tol_us if ahead else 0,
                                               tol_us if back else 0)).alias("_c"),
                     F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_l"),
                     F.struct(*[F.col(c) for c in r_cols]).alias(_R))
    u = l.unionByName(r)

    part = [*keys, "_c"]
    ocols = [F.col(f"_o{i}") for i in range(len(order))]
    rus_col = F.struct(F.col("_us").alias("us"), F.col(_R).alias("row"))
    cand = F.when(F.col("_side") == 0, rus_col)
    if back:
        wb = (Window.partitionBy(*part).orderBy(F.col("_us").asc(), F.col("_side").asc(), *[o.asc() for o in ocols])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        u = u.withColumn("_b", F.last(cand, ignorenulls=True).over(wb))
    if ahead:
        wf = (Window.partitionBy(*part).orderBy(F.col("_us").desc(), F.col("_side").asc(), *[o.desc() for o in ocols])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        u = u.withColumn("_f", F.last(cand, ignorenulls=True).over(wf))

    u = u.where(F.col("_side") == 1)
    tol = F.lit(tol_us)
    b_ok = (F.col("_b").isNotNull() & (F.col("_us") - F.col("_b.us") <= tol)) if back else F.lit(False)
    f_ok = (F.col("_f").isNotNull() & (F.col("_f.us") - F.col("_us") <= tol)) if ahead else F.lit(False)
    if direction == "backward":
        pick = F.when(b_ok, F.col("_b.row"))
    elif direction == "forward":
        pick = F.when(f_ok, F.col("_f.row"))
    else:
        b_closer = (F.col("_us") - F.col("_b.us")) <= (F.col("_f.us") - F.col("_us"))
        pick = (F.when(b_ok & (~f_ok | b_closer), F.col("_b.row"))
                .when(f_ok, F.col("_f.row")))
    u = u.select("_l", pick.alias(_R))
    if how == "inner":
        u = u.where(F.col(_R).isNotNull())
    return u.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns],
                    *[F.col(f"{_R}.{c}").alias(out_names[c]) for c in r_cols])


def unmatched(left: DataFrame, right: DataFrame, **kw) -> DataFrame:
    """Left rows that find no right row within the tolerance (the rows an
    incremental merger keeps waiting for)."""
    kw = dict(kw, how="left")
    probe = right.withColumn("_hit", F.lit(True))
    j = asof_join(left, probe, **kw)
    hit = "_hit" if "_hit" not in left.columns else kw.get("right_prefix", "right_") + "_hit"
    return j.where(F.col(hit).isNull()).select(*left.columns)


def match_quality(left: DataFrame, right: DataFrame, *, on: str | Sequence[str] = "symbol", **kw) -> DataFrame:
    """Per key: left rows, merged rows, rows not merged (the source's
    good / not-merged counters as a table)."""
    kw = dict(kw, how="left", on=on)
    probe = right.withColumn("_hit", F.lit(True))
    j = asof_join(left, probe, **kw)
    keys = _as_list(on)
    return (j.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_left"),
                 F.count("_hit").alias("n_merged"),
                 F.count(F.when(F.col("_hit").isNull(), 1)).alias("n_not_merged")))
