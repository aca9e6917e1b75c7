"""Order book: explode, expectation, bar means."""
from datetime import datetime as dt

from ticklake.operators import book

MSG = "symbol string, datetime timestamp_ntz, bids array<array<double>>, asks array<array<double>>"


def _two_msgs(spark):
    t1, t2 = dt(2025, 6, 3, 14, 11, 30), dt(2025, 6, 3, 14, 11, 40)
    return spark.createDataFrame([
        ("X", t1, [[101.0, 1.0], [102.0, 2.0]], [[103.0, 3.0], [104.0, 4.0]]),
        ("X", t2, [[100.0, 1.0], [99.0, 1.0]], [[105.0, 1.0], [106.0, 3.0]]),
    ], MSG)


def test_explode_book(spark):
    # Two messages x (2 bids + 2 asks) -> 8 rows, opposite side null
    rows = book.explode_book(_two_msgs(spark)).collect()
    assert len(rows) == 8
    bids = [r for r in rows if r.bid is not None]
    assert len(bids) == 4 and all(r.ask is None and r.ask_vol is None for r in bids)


def test_expectation_and_max(spark):
    # l2_bid_max = max bid; expectation = volume weighted price
    e = {r.datetime: r for r in book.book_expectation(_two_msgs(spark)).collect()}
    r = e[dt(2025, 6, 3, 14, 11, 30)]
    assert r.l2_bid_max == 102.0 and r.l2_ask_min == 103.0
    assert abs(r.l2_bid_expect - (101 * 1 + 102 * 2) / 3) < 1e-12 and r.l2_bid_vol == 3.0
    assert abs(r.l2_ask_expect - (103 * 3 + 104 * 4) / 7) < 1e-12


def test_fast_path_equals_row_path(spark):
    msgs = _two_msgs(spark)
    fast = sorted(tuple(r) for r in book.book_expectation(msgs).collect())
    rows = sorted(tuple(r) for r in book.book_expectation_rows(book.explode_book(msgs)).collect())
    assert fast == rows


def test_level2_bar_mean(spark):
    out = book.stage_level2(_two_msgs(spark), "1 minute").collect()
    assert len(out) == 1
    assert out[0].datetime == dt(2025, 6, 3, 14, 12)
    assert out[0].l2_bid_max == (102.0 + 100.0) / 2


def test_one_sided_book(spark):
    df = spark.createDataFrame([("X", dt(2025, 1, 1), [[1.0, 2.0]], [])], MSG)
    r = book.book_expectation(df).collect()[0]
    assert r.l2_bid_max == 1.0 and r.l2_ask_min is None and r.l2_ask_expect is None
