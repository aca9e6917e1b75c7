"""As-of join: reference cases, tie rules, chunk halo, random vs pandas."""
import random
from datetime import datetime as dt, timedelta

import pandas as pd

from ticklake.operators.asof import asof_join, match_quality, unmatched

L = "symbol string, ts timestamp_ntz, close double"
R = "symbol string, ts timestamp_ntz, id long, bid double"


def _one(spark, lag_s, tol="59 seconds", direction="nearest"):
    t0 = dt(2025, 1, 1)
    left = spark.createDataFrame([("X", t0, 100.0)], L)
    right = spark.createDataFrame([("X", t0 + timedelta(seconds=lag_s), 1, 200.0)], R)
    return asof_join(left, right, direction=direction, tolerance=tol, right_order=["id"]).collect()


def test_reference_tolerance_cases(spark):
    # 0 s and 59 s match, 60 s does not (tolerance 59 s, inclusive)
    assert [(r.close, r.bid) for r in _one(spark, 0)] == [(100.0, 200.0)]
    assert len(_one(spark, 59)) == 1 and _one(spark, 59)[0].right_ts == dt(2025, 1, 1, 0, 0, 59)
    assert _one(spark, 60) == []


def test_ties(spark):
    t0 = dt(2025, 1, 1, 0, 10)
    left = spark.createDataFrame([("X", t0, 1.0)], L)
    right = spark.createDataFrame([
        ("X", t0 - timedelta(seconds=5), 1, 10.0), ("X", t0 - timedelta(seconds=5), 2, 20.0),
        ("X", t0 + timedelta(seconds=5), 3, 30.0), ("X", t0 + timedelta(seconds=5), 4, 40.0)], R)
    kw = dict(tolerance="1 minute", right_order=["id"])
    # equal distance -> earlier; duplicates behind -> last, ahead -> first
    assert asof_join(left, right, direction="nearest", **kw).collect()[0].id == 2
    assert asof_join(left, right, direction="backward", **kw).collect()[0].id == 2
    assert asof_join(left, right, direction="forward", **kw).collect()[0].id == 3


def test_chunk_boundary_halo(spark):
    # the match sits in the previous / next chunk
    left = spark.createDataFrame([("X", dt(2025, 1, 2, 0, 0, 10), 1.0), ("X", dt(2025, 1, 1, 23, 59, 50), 2.0)], L)
    right = spark.createDataFrame([("X", dt(2025, 1, 1, 23, 59, 30), 1, 10.0),
                                   ("X", dt(2025, 1, 2, 0, 0, 20), 2, 20.0)], R)
    out = {r.close: r.id for r in asof_join(left, right, direction="backward", tolerance="1 minute",
                                              chunk="1 hour").collect()}
    assert out == {1.0: 1, 2.0: 1}
    out = {r.close: r.id for r in asof_join(left, right, direction="forward", tolerance="1 minute",
                                              chunk="1 hour").collect()}
    assert out == {1.0: 2, 2.0: 2}


def test_random_vs_pandas(spark):
    rnd = random.Random(7)
    t0 = dt(2025, 1, 1)
    lrows = [(s, t0 + timedelta(seconds=rnd.randrange(0, 20000)), float(i)) for i, s in
             enumerate(rnd.choice("AB") for _ in range(300))]
    rrows = [(s, t0 + timedelta(seconds=rnd.randrange(0, 20000)), i, float(i)) for i, s in
             enumerate(rnd.choice("AB") for _ in range(300))]
    left, right = spark.createDataFrame(lrows, L), spark.createDataFrame(rrows, R)
    for direction in ("backward", "forward", "nearest"):
        got = {r.close: r.id for r in asof_join(left, right, direction=direction, tolerance="120 seconds",
                                                  right_order=["id"], how="left", chunk="1 hour").collect()}
        lp = pd.DataFrame(lrows, columns=["symbol", "ts", "close"]).sort_values("ts")
        rp = pd.DataFrame(rrows, columns=["symbol", "ts", "id", "bid"]).sort_values(["ts", "id"])
        m = pd.merge_asof(lp, rp, on="ts", by="symbol", direction=direction, tolerance=pd.Timedelta("120s"))
        want = {r.close: (None if pd.isna(r.id) else int(r.id)) for r in m.itertuples()}
        assert got == want, direction


def test_unmatched_and_quality(spark):
    t0 = dt(2025, 1, 1)
    left = spark.createDataFrame([("X", t0, 1.0), ("X", t0 + timedelta(minutes=10), 2.0)], L)
    right = spark.createDataFrame([("X", t0 + timedelta(seconds=30), 1, 5.0)], R)
    assert [r.close for r in unmatched(left, right, direction="nearest", tolerance="1 minute").collect()] == [2.0]
    q = match_quality(left, right, direction="nearest", tolerance="1 minute").collect()[0]
    assert (q.n_left, q.n_merged, q.n_not_merged) == (2, 1, 1)


def test_null_times_and_empty_right(spark):
    t0 = dt(2025, 1, 1)
    left = spark.createDataFrame([("X", t0, 1.0), ("X", None, 2.0)], L)
    right = spark.createDataFrame([("X", None, 1, 5.0), ("X", t0, 2, 6.0)], R)
    inner = asof_join(left, right, direction="nearest", tolerance="1 minute", right_order=["id"]).collect()
    assert [(r.close, r.id) for r in inner] == [(1.0, 2)]  # null-time rows never match
    outer = asof_join(left, right, direction="backward", tolerance="1 minute", how="left").collect()
    assert sorted((r.close, r.id) for r in outer) == [(1.0, 2), (2.0, None)]  # left rows are kept whole
    empty = spark.createDataFrame([], R)
    assert asof_join(left, empty, direction="nearest", tolerance="1 minute").count() == 0
    assert asof_join(left, empty, direction="nearest", tolerance="1 minute", how="left").count() == 2
