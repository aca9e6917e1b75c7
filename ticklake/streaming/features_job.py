"""Streaming feature job: history + live merged bars -> feature rows.

Each micro-batch (``foreachBatch``) of newly merged bars:

1. stitches into the merged-bar store: rows whose ``(symbol, datetime)`` is
   already stored are dropped (the stored row wins), the rest written;
2. decides per symbol whether its history reaches the live rows
   (``time_gap`` below ``max_gap``); a symbol that is not ready only extends
   the store, the others publish.  With ``reload_history`` the gap is first
   closed from newer history files;
3. reads back, for the batch's symbols, the tail that the indicators need:
   ``lookback`` before the symbol's high-water mark, and on to the last
   stored row at or before that instant, so that the grid fill starts from
   the same row as in batch;
4. computes features on that tail (grid fill, indicators, level2 features,
   cleaning) -- the same code as the batch job -- and writes the rows newer
   than the mark.

Replays: store, sink and state are tables of epochs (``sources.epochs``) and
an epoch replaces what it wrote.  Its inputs are what earlier epochs left, so
a batch that is run again, after any of its writes, gives the same rows in
the same places.  The state is written last; a new run (another checkpoint)
drops from the sink what an interrupted one wrote without its state.

Files: epochs that cannot be replayed any more are merged into daily runs
sorted by symbol and time, so the number of files grows with the days and
the logarithm of the epochs, not with symbols times epochs.

Reads: ``read_table`` gives the rows of store or sink.  A batch reads the
days from its look-back on; symbols that have published nothing, or that
have a gap before those days, read their own rows only.  What is known per
symbol (mark, last history row, first live row, ready) is a table of one row
per symbol, written anew by each epoch.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.chunks import parse_duration_us
from ticklake.operators.increment import only_new, ts_diff_seconds
from ticklake.operators.indicators import clean_features, lookback_rows, params_for, period_steps
from ticklake.operators.metrics import observe_counts
from ticklake.operators.timegrid import fill_grid
from ticklake.plans.features import CANDLE, feature_frame
from ticklake.schemas import L2_COLS
from ticklake.session import checkpoint_dir, setting
from ticklake.sources.epochs import EpochTable
from ticklake.sources.kafka import to_messages

ROW = ["symbol", "datetime", *CANDLE, *L2_COLS]
STATE = "symbol string, hwm timestamp_ntz, history_max timestamp_ntz, live_min timestamp_ntz, ready boolean"


#: Symbols that a read may name one by one; more of them are joined.
NAMED = 1000


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a store or sink, with their ``date`` and ``epoch``; none if nothing is written yet."""
    return EpochTable(spark, path).read()


def _replace(df: DataFrame, path: str, epoch: str, run: str | None = None, at: int | None = None) -> None:
    """Write the rows of an epoch in place of what it wrote before."""
    EpochTable(df.sparkSession, path).replace(df, epoch, run, at)


class FeatureJob:
    """``store``, ``sink``: folders of the merged bars and of the features;
    ``sink + "_state"`` holds the table of symbols.

    ``history_ready``: publish without waiting for the history to reach the
    live rows.  ``reload_history(spark, since)`` returns merged bars from
    newer history files, from ``since`` on (the least last history row of
    the symbols with a gap).  ``publish(messages, epoch)`` gets each epoch's
    feature rows as messages (key, JSON value), for a topic; after a replay
    it gets the same messages again.
    """

    def __init__(self, store: str, sink: str, *, step: str = "1 minute", candle_periods: Sequence[str] = ("1 minute",),
                 level2_periods: Sequence[str] = ("1 minute",), params: Mapping | None = None,
                 chunk: str = "1 day", max_gap: str = "1 minute", history_ready: bool = False,
                 reload_history: Callable | None = None, publish: Callable | None = None):
        self.store, self.sink = store, sink
        self.step, self.cp, self.lp = step, list(candle_periods), list(level2_periods)
        self.params = params
        self.chunk, self.max_gap = chunk, max_gap
        self.history_ready = history_ready
        self.reload_history, self.publish = reload_history, publish
        rows = max([period_steps(p, step) - 1 + lookback_rows(params_for(params or {}, p)) for p in self.cp]
                   + [period_steps(p, step) for p in self.lp]) + 2
        self.lookback_us = rows * parse_duration_us(step)
        #: Whether a new run goes on where the last one stopped (see ``rewind``): symbols that were ready stay so.
        self.handed_over = False
        #: Of the last batch: rows of input, new, dirty, cleaned, output; duration_s; lag_s of the newest output row.
        self.counts: dict[str, float] = {}

    def bootstrap(self, history: DataFrame) -> None:
        """Load history (merged bars) into the store."""
        rows = history.select("symbol", F.col("datetime").cast("timestamp_ntz").alias("datetime"), *CANDLE, *L2_COLS)
        _replace(rows, self.store, "history")
        empty = F.lit(None).cast("timestamp_ntz")
        state = rows.groupBy("symbol").agg(F.max("datetime").alias("history_max")) \
            .select("symbol", empty.alias("hwm"), "history_max", empty.alias("live_min"), F.lit(self.history_ready).alias("ready"))
        self._write_state(state, "history", -1)

    # the table of symbols

    def _marks(self, spark: SparkSession) -> EpochTable:
        return EpochTable(spark, self.sink + "_state", by_date=False)

    def _write_state(self, state: DataFrame, run: str, epoch: int) -> None:
        """Write the state that an epoch leaves; with it the epoch is done."""
        table = self._marks(state.sparkSession)
        done = table.manifest()["notes"].get("committed", {})
        table.replace(state, f"{run}-{epoch}", run, epoch, {"committed": done | {run: epoch}})

    def _state(self, spark: SparkSession, run: str, epoch: int) -> DataFrame:
        """State as the epochs before this one left it: that of this run, else of the latest one before it."""
        table = self._marks(spark)
        steps = table.entries()
        columns = [c.split()[0] for c in STATE.split(", ")]
        own = [e for e in steps if e["run"] == run and e["at"] < epoch]
        if own:
            last = max(own, key=lambda e: e["at"])["name"]
            return table.read(but=[e["name"] for e in steps if e["name"] != last]).select(*columns)
        others = [e["name"] for e in steps if e["run"] != run]
        if not others:
            return spark.createDataFrame([], STATE)
        # a run's first epoch goes on from the marks of the runs before; whether
        # its live rows reach what is stored is to be seen again, unless no
        # row was left out in between
        ready = F.max("ready") if self.handed_over else F.lit(False)
        return table.read(but=[e["name"] for e in steps if e["name"] not in others]) \
            .groupBy("symbol").agg(F.max("hwm").alias("hwm"), F.max("history_max").alias("_h"), ready.alias("ready")) \
            .select("symbol", "hwm", F.greatest("_h", "hwm").alias("history_max"), F.lit(None).cast("timestamp_ntz").alias("live_min"),
                    "ready")

    def open_gaps(self, spark: SparkSession) -> DataFrame:
        """(symbol, history_max, live_min) of the symbols whose history does not reach their live rows, as of the last epoch."""
        table = self._marks(spark)
        steps = [e["name"] for e in table.entries()]
        if not steps:
            return spark.createDataFrame([], STATE).select("symbol", "history_max", "live_min")
        return table.read(but=steps[:-1]).where("not ready and history_max is not null and live_min is not null") \
            .select("symbol", "history_max", "live_min")

    def _forget(self, spark: SparkSession, run: str, epoch: int) -> None:
        """Drop states that no replay needs: older ones of this run, and all but the last of other runs.  A state holds
        all symbols, so the last one tells all; the history's is kept beside it."""
        table = self._marks(spark)
        steps = table.entries()
        others = [e["name"] for e in steps if e["run"] not in (run, "history")]
        table.drop([e["name"] for e in steps if e["run"] == run and e["at"] < epoch - 2] + others[:-1])

    def _drop_uncommitted(self, spark: SparkSession, run: str) -> None:
        """Drop from the sink what other runs wrote in an epoch whose state they did not write."""
        done = self._marks(spark).manifest()["notes"].get("committed", {})
        sink = EpochTable(spark, self.sink)
        sink.drop([e["name"] for e in sink.entries()
                   if e["run"] not in (None, run) and e["at"] > done.get(e["run"], -1)])

    def _merge(self, spark: SparkSession, run: str, epoch: int) -> None:
        for path in (self.store, self.sink):
            EpochTable(spark, path).merge(lambda e: e["run"] != run or e["at"] <= epoch - 2)

    # one micro-batch

    def process(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        epoch = f"{run}-{epoch_id}"
        checkpoint_dir(spark)
        rows, seen = observe_counts(batch.select("symbol", F.col("datetime").cast("timestamp_ntz").alias("datetime"),
                                                 *CANDLE, *L2_COLS), "input")
        batch = rows.checkpoint(eager=True)
        span = batch.agg(F.min("datetime").alias("first"), F.max("datetime").alias("last")).first()
        began = time.monotonic()
        self.counts = {"input": seen.get["rows"]}
        if span["first"] is None:
            return
        state = self._state(spark, run, epoch_id)
        self._drop_uncommitted(spark, run)
        stored = self._stored(spark, epoch, span["first"].date())
        fresh = batch.dropDuplicates(["symbol", "datetime"])
        if stored is not None:
            near = stored.where(F.col("date") <= F.lit(span["last"].date()))
            fresh = fresh.join(near.select("symbol", "datetime"), ["symbol", "datetime"], "left_anti")
        # what is written must not depend on itself: cut before writing
        fresh = fresh.checkpoint(eager=True)
        self.counts["new"] = fresh.count()
        _replace(fresh, self.store, epoch, run, epoch_id)
        state = self._advance(spark, batch, state, epoch, run, epoch_id)
        publishing = state.join(batch.select("symbol").distinct(), "symbol", "left_semi").where("ready")
        features = self._features(spark, publishing)
        if features is not None:
            new = only_new(features, publishing.select("symbol", "hwm")).checkpoint(eager=True)
            self.counts["output"] = new.count()
            _replace(new, self.sink, epoch, run, epoch_id)
            marks = new.groupBy("symbol").agg(F.max("datetime").alias("_new"))
            state = state.join(marks, "symbol", "left").withColumn("hwm", F.greatest("hwm", "_new")).drop("_new")
            if self.publish is not None:
                self.publish(to_messages(new), epoch_id)
            newest = new.agg(F.max("datetime").alias("t")).first()["t"]
            if newest is not None:
                self.counts["lag_s"] = (datetime.now(timezone.utc).replace(tzinfo=None) - newest).total_seconds()
        self._write_state(state, run, epoch_id)
        self._forget(spark, run, epoch_id)
        self._merge(spark, run, epoch_id)
        self.counts["duration_s"] = time.monotonic() - began

    def _stored(self, spark: SparkSession, epoch: str, since: date | None = None) -> DataFrame | None:
        """The store from a day on, without what this epoch wrote before it was run again."""
        stored = EpochTable(spark, self.store).read(since, but=[epoch])
        return None if stored is None else stored.select(*ROW, "date")

    def _advance(self, spark: SparkSession, batch: DataFrame, state: DataFrame, epoch: str, run: str, epoch_id: int) -> DataFrame:
        """State with this batch's first live rows; ready where the history reaches them."""
        live = batch.groupBy("symbol").agg(F.min("datetime").alias("_live"))
        state = state.join(live, "symbol", "full_outer").withColumn("live_min", F.least("live_min", "_live")).drop("_live")
        gap = ts_diff_seconds(F.col("history_max"), F.col("live_min"))
        good = F.coalesce(gap < parse_duration_us(self.max_gap) / 1e6, F.lit(False))
        ready = F.lit(self.history_ready) | F.coalesce("ready", F.lit(False))
        state = state.withColumn("ready", ready | good).checkpoint(eager=True)
        if self.reload_history is None:
            return state
        waiting = state.where(~F.col("ready"))
        since = waiting.agg(F.min("history_max").alias("since"), F.count(F.lit(1)).alias("n")).first()
        if not since["n"]:
            return state
        newer = self.reload_history(spark, since["since"]).select(
            "symbol", F.col("datetime").cast("timestamp_ntz").alias("datetime"), *CANDLE, *L2_COLS) \
            .join(waiting.select("symbol"), "symbol", "left_semi").dropDuplicates(["symbol", "datetime"]).checkpoint(eager=True)
        top = newer.groupBy("symbol").agg(F.max("datetime").alias("_top"))
        known = self._stored(spark, epoch + "-history", since["since"] and since["since"].date())
        if known is not None:
            newer = newer.join(known.select("symbol", "datetime"), ["symbol", "datetime"], "left_anti").checkpoint(eager=True)
        _replace(newer, self.store, epoch + "-history", run, epoch_id)
        state = state.join(top, "symbol", "left").withColumn("history_max", F.greatest("history_max", "_top")).drop("_top")
        return state.withColumn("ready", F.col("ready") | good).checkpoint(eager=True)

    def _of(self, spark: SparkSession, symbols: DataFrame) -> DataFrame:
        """All stored rows of some symbols; files sorted by symbol are read in part."""
        rows = EpochTable(spark, self.store).read().select(*ROW, "date")
        names = [r["symbol"] for r in symbols.select("symbol").limit(NAMED + 1).collect()]
        if len(names) <= NAMED:
            return rows.where(F.col("symbol").isin(names))
        return rows.join(symbols.select("symbol"), "symbol", "left_semi")

    def _tail(self, spark: SparkSession, symbols: DataFrame) -> DataFrame:
        """Stored rows of the symbols from the last one at or before ``hwm - lookback`` on; of a symbol that has
        published nothing, all."""
        lo = F.col("hwm") - F.expr(f"INTERVAL {self.lookback_us} MICROSECONDS")
        marks = symbols.select("symbol", lo.alias("_lo"))
        bound = marks.agg(F.min("_lo").alias("lo"), F.count(F.when(F.col("_lo").isNull(), 1)).alias("open")).first()
        parts = []
        if bound["open"]:
            parts.append(self._of(spark, marks.where("_lo is null")).select(*ROW))
        whole = F.lit(True)
        for c in CANDLE + L2_COLS:
            whole = whole & F.col(c).isNotNull()

        def anchored(rows, marks):
            found = rows.join(marks, "symbol").where((F.col("datetime") <= F.col("_lo")) & whole) \
                .groupBy("symbol").agg(F.max("datetime").alias("_anchor"))
            return found, lambda own: rows.join(own.join(found, "symbol", "left"), "symbol") \
                .where(F.col("datetime") >= F.coalesce("_anchor", "_lo")).select(*ROW)

        if bound["lo"] is not None:
            known = marks.where("_lo is not null")
            near = EpochTable(spark, self.store).read(bound["lo"].date())
            if near is None:
                missing = known
            else:
                found, tail = anchored(near.select(*ROW, "date"), known)
                missing = known.join(found, "symbol", "left_anti")
            if not missing.isEmpty():  # a gap before the first day read: these symbols look further back
                missing = missing.checkpoint(eager=True)
                parts.append(anchored(self._of(spark, missing), missing)[1](missing))
                known = known.join(missing.select("symbol"), "symbol", "left_anti")
            if near is not None:
                parts.append(tail(known))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _features(self, spark: SparkSession, symbols: DataFrame) -> DataFrame | None:
        if symbols.isEmpty():
            return None
        tail = self._tail(spark, symbols).checkpoint(eager=True)
        filled = fill_grid(tail, self.step, ts="datetime", cols=CANDLE + L2_COLS, chunk=self.chunk)
        # stage boundary: the window pass reads a materialized grid
        filled = filled.checkpoint(eager=True)
        f = feature_frame(filled, step=self.step, candle_periods=self.cp, level2_periods=self.lp,
                          params=self.params, chunk=self.chunk)
        # the wide plan is cut before any join, and optimized without
        # constraint propagation, which grows combinatorially over it
        with setting(spark, "spark.sql.constraintPropagation.enabled", "false"):
            f, dirty = observe_counts(f, "features")
            f = clean_features(f, keep=["symbol", "datetime"]).checkpoint(eager=True)
        self.counts["dirty"] = dirty.get["rows"]
        self.counts["cleaned"] = f.count()
        return f

    def start(self, merged_stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        w = (merged_stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
             .queryName("features"))
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
