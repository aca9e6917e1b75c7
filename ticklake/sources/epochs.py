"""A table written epoch by epoch: one folder an epoch, merged into sorted daily runs, listed by a manifest.

A writer that adds a little at a time and must replace what it wrote (a replayed micro-batch) wants a folder of its
own for each epoch; a reader wants few, sorted files.  Both hold here:

- ``replace`` writes an epoch's rows to ``epoch=<name>/date=<day>`` and lists the folder in the manifest.  What is not
  listed does not exist: a write that fails halfway is never read, and is written over by the epoch's replay.
- ``merge`` turns every ``FAN`` settled entries of one level into one entry of the next level, sorted by ``order``
  within each day.  So there are at most ``FAN`` entries a level (and those not settled yet), and every row is
  rewritten once a level.  The merged folder is listed in place of its parts by one manifest; a crash before that
  leaves the parts, a crash after it leaves the run.
- Replaced folders stay for ``GRACE`` further manifests, so that a reader that has begun can finish.

The manifest is one small JSON file a version, renamed into place; the highest version counts.  One writer is
assumed, as a streaming query is one.  Entries keep which run and epoch wrote them, so that what an interrupted run
did not commit can be dropped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8
GRACE = 4


class Versions:
    """A small JSON document in versions: each is renamed into place, the highest one counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def latest(self) -> dict | None:
        numbers = self.numbers()
        if not numbers:
            return None
        source = self._fs.open(self._path(f"{self.folder}/{numbers[-1]:010d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def commit(self, number: int, document: dict, keep: int = 2 * GRACE) -> None:
        temporary = self._path(f"{self.folder}/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(temporary, True)
        try:
            out.write(bytearray(json.dumps(document).encode()))
        finally:
            out.close()
        if not self._fs.rename(temporary, self._path(f"{self.folder}/{number:010d}.json")):
            raise RuntimeError(f"version {number} of {self.folder} is there already: another writer?")
        for old in self.numbers()[:-keep]:
            self._fs.delete(self._path(f"{self.folder}/{old:010d}.json"), False)


class EpochTable:
    """``path``: folder of the table; ``by_date``: partition every entry by the day of ``datetime``."""

    def __init__(self, spark: SparkSession, path: str, by_date: bool = True, order: Sequence[str] = ("symbol", "datetime")):
        self.spark, self.path, self.by_date, self.order = spark, path, by_date, list(order)
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._versions = Versions(spark, f"{path}/_manifest")

    # the manifest

    def manifest(self) -> dict:
        """``entries`` in the order of their first commit, ``retired`` folders with their version, ``version``, ``notes``."""
        return self._versions.latest() or {"version": 0, "entries": [], "retired": {}, "notes": {}}

    def _commit(self, found: dict) -> None:
        found["version"] += 1
        gone = [f for f, v in found["retired"].items() if v <= found["version"] - GRACE]
        for folder in gone:
            del found["retired"][folder]
        self._versions.commit(found["version"], found)
        for folder in gone:
            self._fs.delete(self._hadoop(f"{self.path}/epoch={folder}"), True)

    def entries(self) -> list[dict]:
        return self.manifest()["entries"]

    # writing

    def _write(self, df: DataFrame, name: str, merged: bool = False) -> list[str]:
        """Write a folder and give its days."""
        folder = f"{self.path}/epoch={name}"
        if not self.by_date:
            df.write.mode("overwrite").parquet(folder)
            return []
        out = df.withColumn("date", F.to_date("datetime")).hint("rebalance", F.col("date"))
        if merged:
            out = out.sortWithinPartitions("date", *self.order)
        # an overwrite of the folder, also where dynamic overwriting is on: an epoch may have days it had not before
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(folder)
        found = [s.getPath().getName() for s in self._fs.listStatus(self._hadoop(folder))]
        return sorted(n.split("=", 1)[1] for n in found if n.startswith("date="))

    def replace(self, df: DataFrame, name: str, run: str | None = None, at: int | None = None, notes: dict | None = None) -> None:
        """Write the rows of an epoch in place of what it wrote before."""
        days = self._write(df, name)
        found = self.manifest()
        entry = {"name": name, "level": 0, "days": days, "run": run, "at": at}
        found["entries"] = [e for e in found["entries"] if e["name"] != name] + [entry]
        found["notes"].update(notes or {})
        self._commit(found)

    def drop(self, names: Iterable[str]) -> None:
        """Forget entries."""
        names, found = set(names), self.manifest()
        if names & {e["name"] for e in found["entries"]}:
            found["entries"] = [e for e in found["entries"] if e["name"] not in names]
            found["retired"].update({n: found["version"] for n in names})
            self._commit(found)

    def merge(self, settled: Callable[[dict], bool] = lambda entry: True) -> int:
        """Merge settled entries, level by level, while some level has ``FAN`` of them; the number of merges done."""
        done, level = 0, 0
        while True:
            found = self.manifest()
            parts = [e for e in found["entries"] if e["level"] == level and settled(e)]
            if len(parts) < FAN:
                if level >= max((e["level"] for e in found["entries"]), default=0):
                    return done
                level += 1
                continue
            name = f"merged-{uuid.uuid4().hex}"
            rows, days = self._read(parts), []
            if rows is not None:
                days = self._write(rows.drop("epoch", "date"), name, merged=True)
            names = [e["name"] for e in parts]
            at = found["entries"].index(parts[0])
            kept = [e for e in found["entries"] if e["name"] not in names]
            kept.insert(at, {"name": name, "level": level + 1, "days": days, "run": None, "at": None})
            found["entries"] = kept
            found["retired"].update({n: found["version"] for n in names})
            self._commit(found)
            self._sweep()
            done += 1

    def _sweep(self) -> None:
        """Delete merged folders that no manifest lists (left by a merge that did not end)."""
        found = self.manifest()
        known = {e["name"] for e in found["entries"]} | set(found["retired"])
        for status in self._fs.listStatus(self._hadoop(self.path)):
            name = status.getPath().getName()
            if name.startswith("epoch=merged-") and name[len("epoch="):] not in known:
                self._fs.delete(status.getPath(), True)

    # reading

    def _read(self, entries: list[dict], since: date | None = None) -> DataFrame | None:
        if not self.by_date:
            folders = [f"{self.path}/epoch={e['name']}" for e in entries]
        elif since is None:
            folders = [f"{self.path}/epoch={e['name']}" for e in entries if e["days"]]
        else:
            folders = [f"{self.path}/epoch={e['name']}/date={d}" for e in entries for d in e["days"] if d >= since.isoformat()]
        return self.spark.read.option("basePath", self.path).parquet(*folders) if folders else None

    def read(self, since: date | None = None, but: Iterable[str] = ()) -> DataFrame | None:
        """The rows of all listed entries but some, with ``epoch`` and ``date``; only days from ``since`` on are listed."""
        but = set(but)
        rows = self._read([e for e in self.entries() if e["name"] not in but], since)
        if rows is not None and self.by_date and since is not None:
            rows = rows.where(F.col("date") >= F.lit(since))
        return rows
