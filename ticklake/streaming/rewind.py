"""Rewinding a live source until history and live rows meet.

A live feed may begin after the history ends.  Where the source keeps what it delivered (a topic's offsets), the
gap is closed by reading it from an earlier place.  The offsets of a running query are fixed in its checkpoint, so
the job is run in *generations*: a generation is a checkpoint of its own and the offsets it starts at.  After the
batches of a generation, the symbols whose gap is open tell how far back to go; the query is stopped, the next
generation is written (a versioned file, renamed into place), and its query opens the source there.

Nothing is lost or repeated:

- a partition that need not go back starts where the last generation stopped, and symbols that were ready stay so;
- rows read again are found in the store and dropped, and features at or before a symbol's mark are not written;
- a batch that the stop interrupted has no state; what it wrote to the sink is dropped by the next generation's first
  batch, and its rows are read again, as the offsets reached are those of committed batches;
- a generation that was written but not begun is begun by the next call.

A partition is never sent back twice to the same place, so the loop ends: with all gaps closed, or with those that
the source cannot close (:meth:`FeatureJob.open_gaps` names them).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.sources.epochs import Versions
from ticklake.streaming.features_job import FeatureJob


def reached(query) -> dict[str, int]:
    """``topic/partition`` -> next offset, of a query with Kafka sources, from its last committed batch."""
    progress = query.lastProgress
    found = {}
    for source in (progress or {}).get("sources", []):
        offsets = source["endOffset"]
        offsets = json.loads(offsets) if isinstance(offsets, str) else offsets or {}
        found |= {f"{topic}/{p}": o for topic, partitions in offsets.items() for p, o in partitions.items()}
    return found


def starting_offsets(starts: dict[str, int]) -> str:
    """``startingOffsets`` of a Kafka reader from ``topic/partition`` -> offset."""
    topics: dict[str, dict[str, int]] = {}
    for place, offset in starts.items():
        topic, _, partition = place.rpartition("/")
        topics.setdefault(topic, {})[partition] = offset
    return json.dumps(topics)


class Rewinder:
    """``open_at(starts)``: the stream of merged bars from offsets by partition (None: the source's own beginning).
    ``offsets_at(time)``: by partition, the first offset at or after a time, as far as the source still has it.
    ``next_offsets(query)``: by partition, the offset after the last committed batch (:func:`reached`)."""

    def __init__(self, spark: SparkSession, job: FeatureJob, root: str, open_at: Callable[[dict | None], DataFrame],
                 offsets_at: Callable[[datetime], dict[str, int]], next_offsets: Callable = reached, starts: dict | None = None):
        self.spark, self.job, self.root = spark, job, root
        self.open_at, self.offsets_at, self.next_offsets = open_at, offsets_at, next_offsets
        self.versions = Versions(spark, f"{root}/_generations")
        if not self.versions.numbers():
            self.versions.commit(1, {"generation": 1, "starts": starts, "lowest": starts or {}}, keep=1000)

    def generation(self) -> dict:
        return self.versions.latest()

    def _earlier(self, now: dict, query) -> dict | None:
        """The next generation, or None where no gap is open or the source has nothing earlier."""
        bound = self.job.open_gaps(self.spark).agg(F.min("history_max").alias("since")).first()["since"]
        if bound is None:
            return None
        lowest = now["lowest"]
        back = {p: o for p, o in self.offsets_at(bound).items() if p not in lowest or o < lowest[p]}
        if not back or now["starts"] is None:  # begun at the source's beginning: there is nothing before
            return None
        return {"generation": now["generation"] + 1, "starts": now["starts"] | self.next_offsets(query) | back, "lowest": lowest | back}

    def run(self, trigger: dict | None = None, poll_s: float = 30.0) -> int:
        """Run the job, rewinding while that closes gaps; the number of the last generation.

        With a trigger that ends (``availableNow``), returns when the last generation's query has ended.  A query
        that goes on is looked at every ``poll_s`` seconds; it is stopped only to be sent back, and the call
        returns only when the query ends or fails.
        """
        while True:
            now = self.generation()
            self.job.handed_over = now["generation"] > 1
            query = self.job.start(self.open_at(now["starts"]), f"{self.root}/generation-{now['generation']}", trigger)
            then = None
            while not query.awaitTermination(poll_s):
                then = self._earlier(now, query)
                if then is not None:
                    query.stop()
                    break
            # offsets of what was committed, read when nothing is running
            then = self._earlier(now, query)
            if then is None:
                return now["generation"]
            self.versions.commit(then["generation"], then, keep=1000)
