"""A gap that only earlier offsets of the source can close."""
import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ticklake.sources import kafka
from ticklake.sources.epochs import EpochTable
from ticklake.streaming import features_job
from ticklake.streaming.rewind import Rewinder, reached, starting_offsets
from test_features_job import SCHEMA, T0, bars, batch_result, frame, job, same

LOG = "partition string, offset long, " + SCHEMA


class Log:
    """A file-backed log: partition x holds symbol X, y holds Y; offsets are minutes."""

    def __init__(self, spark, path):
        self.spark, self.path, self.end = spark, path, 0
        self.opened = []

    def append(self, minutes):
        rows = [(s.lower(), m, *r) for s, seed in (("X", 3), ("Y", 4)) for m, r in zip(range(200), bars(range(200), s, seed)) if m in minutes]
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(self.path)
        self.end = max(minutes) + 1

    def open_at(self, starts):
        self.opened.append(starts)
        wanted = F.lit(False)
        for p, o in starts.items():
            wanted = wanted | ((F.col("partition") == p) & (F.col("offset") >= o))
        return self.spark.readStream.schema(LOG).parquet(self.path).where(wanted).drop("partition", "offset")

    def offsets_at(self, time):
        first = int((time - T0).total_seconds() // 60)
        return {"x": max(first, 10), "y": max(first, 10)}  # what was before offset 10 has expired

    def next_offsets(self, query):
        return {"x": self.end, "y": self.end}


def test_gap_closes_only_by_rewinding(spark, tmp_dir):
    log, j = Log(spark, f"{tmp_dir}/log"), job(tmp_dir)
    x, y = bars(range(0, 200), "X"), bars(range(0, 200), "Y", 4)
    j.bootstrap(frame(spark, x[:20] + y[:30]))
    log.append(range(10, 50))
    r = Rewinder(spark, j, f"{tmp_dir}/run", log.open_at, log.offsets_at, log.next_offsets, {"x": 35, "y": 30})
    assert r.run({"availableNow": True}) == 2  # Y's live rows follow its history, X's begin 16 minutes late
    assert log.opened == [{"x": 35, "y": 30}, {"x": 19, "y": 19}]
    same(spark, f"{tmp_dir}/sink", {**batch_result(spark, x[:50]), **batch_result(spark, y[:50])})
    log.append(range(50, 60))
    again = Rewinder(spark, job(tmp_dir), f"{tmp_dir}/run", log.open_at, log.offsets_at, log.next_offsets)
    assert again.run({"availableNow": True}) == 2  # goes on in its checkpoint
    same(spark, f"{tmp_dir}/sink", {**batch_result(spark, x[:60]), **batch_result(spark, y[:60])})


def test_what_the_source_cannot_close_stays_open(spark, tmp_dir):
    log, j = Log(spark, f"{tmp_dir}/log"), job(tmp_dir)
    j.bootstrap(frame(spark, bars(range(0, 5))))  # ends before the first offset that is left
    log.append(range(10, 30))
    r = Rewinder(spark, j, f"{tmp_dir}/run", log.open_at, log.offsets_at, log.next_offsets, {"x": 20, "y": 30})
    assert r.run({"availableNow": True}) == 2
    assert [(g.symbol, g.history_max.minute, g.live_min.minute) for g in j.open_gaps(spark).collect()] == [("X", 4, 10)]
    assert features_job.read_table(spark, f"{tmp_dir}/sink") is None


def test_kafka_offsets_round_trip():
    class Query:
        lastProgress = {"sources": [{"endOffset": {"t/a": {"0": 5, "1": 7}}}]}

    assert reached(Query()) == {"t/a/0": 5, "t/a/1": 7}
    assert json.loads(starting_offsets(reached(Query()))) == {"t/a": {"0": 5, "1": 7}}
    Query.lastProgress = None
    assert reached(Query()) == {}


def test_a_silent_key_keeps_its_mark(spark, tmp_dir):
    table = EpochTable(spark, f"{tmp_dir}/marks", by_date=False)

    def ends(*rows):
        return spark.createDataFrame(list(rows), "symbol string, hwm timestamp_ntz")

    at = [T0 + timedelta(minutes=m) for m in range(5)]
    kafka.renew_marks(table, ends(("X", at[1]), ("Y", at[2])))
    kafka.renew_marks(table, ends(("X", at[3])))  # Y has nothing among the last records
    kafka.renew_marks(table, ends(("X", at[0]), ("Z", at[4])))  # an older record changes nothing
    got = kafka.renew_marks(table, ends())
    assert {(r.symbol, r.hwm) for r in got.collect()} == {("X", at[3]), ("Y", at[2]), ("Z", at[4])}
    assert len(table.entries()) == 1


def test_options_of_the_ends():
    options = kafka.ending_options("s", "t", {0: 500, 1: 20}, 100)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 400, "1": 0}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 500, "1": 20}}


@pytest.fixture(autouse=True)
def _no_manual_run(spark):
    yield
    assert not spark.streams.active
