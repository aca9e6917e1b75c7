"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master without that setting (tests); any other master
    without it is an error, because executors would write to their own disks.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    found = tempfile.mkdtemp(prefix="ticklake-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: their Python workers import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="ticklake-ship-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
            if not (package / "__init__.py").exists():
                out.writestr(f"{package.name}/__init__.py", "")
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)


#: Paths given out by :func:`scratch` and not deleted yet, in order.
_scratch: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder.  It stays until :func:`released` or the folder's owner deletes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`scratch` gave out inside.  For a step whose result is written elsewhere by then:
    tables that read the deleted ones cannot be read any more."""
    begun = len(_scratch)
    try:
        yield
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in _scratch[begun:]:
            p = path(folder)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        del _scratch[begun:]


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder (a new path, unless one is given) and read it back.

    Survives lost executors, keeps column statistics (so that joins can be planned by true sizes) and
    lets later steps read only the columns they use.
    """
    path = path or scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(df: DataFrame, make: Callable[[], Callable], schema: str, finish: bool = False) -> DataFrame:
    """``mapInArrow`` with a state per task.

    ``make()`` runs once in each task and returns ``step(columns) -> dict | None``, which gets the
    columns of a record batch as Arrow arrays and returns the columns of the output.  With ``finish``,
    ``step(None)`` is called after the last batch.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(batch.columns)
                yield from emit(out)
        if finish:
            yield from emit(step(None))

    def emit(out):
        for part in [out] if isinstance(out, dict) else out or []:
            yield pa.RecordBatch.from_arrays([pa.array(part[n]) if not isinstance(part[n], pa.Array) else part[n]
                                              for n in names], names)

    return df.mapInArrow(run, schema)


def longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 for null) and validity of an integer column."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), valid


def nullable(values, valid: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.array(values, type=kind or pa.int64(), mask=~np.asarray(valid, dtype=bool))


def running_start(totals: DataFrame, group: str, order: str, amount: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows before this one by (group, order).

    Rows are summed within their group; only the sums of the groups (one row each) meet in one task.
    """
    within = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy(group).agg(F.sum(amount).alias("_sum")) \
        .select(F.col(group).alias("_group"), F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    inner = totals.withColumn("_before", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return inner.join(groups, F.col(group).eqNullSafe(F.col("_group"))) \
        .withColumn(name, F.col("_base") + F.col("_before")).drop("_group", "_base", "_before")


def sifted(df: DataFrame, key: Column, marked: DataFrame, marked_key: Column, most_bits: int = 1 << 27) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key (a bigint hash) is surely none of those of ``marked``, and all others.

    For joins of long rows with a table that meets few of them: only the second part has to be shuffled.  A bitmap of 16
    bits a marked row, ``most_bits`` at most (16 MB), is broadcast; it lets about one in 16 of the other rows, or more if
    it is full, into the second part, so that part is still to be joined.
    """
    bits = min(most_bits, 1 << max(15, (16 * marked.count()).bit_length()))
    slots = marked.select(F.pmod(marked_key, F.lit(bits)).alias("_slot"))
    pages = written(slots.groupBy(F.expr("_slot div 32768").alias("_page")).agg(F.bitmap_construct_agg(F.expr("_slot % 32768")).alias("_bitmap")),
                    "marked-bitmap")
    slotted = df.select(*[F.col(c).alias(f"row_{i}") for i, c in enumerate(df.columns)], F.pmod(key, F.lit(bits)).alias("_slot")) \
        .join(F.broadcast(pages), F.expr("_slot div 32768 = _page"), "left")
    byte = F.expr("cast(conv(hex(substring(_bitmap, cast(_slot % 32768 div 8 as int) + 1, 1)), 16, 10) as int)")
    met = F.col("_page").isNotNull() & (F.getbit(byte, F.expr("cast(_slot % 8 as int)")) == 1)
    columns = [F.col(f"row_{i}").alias(c) for i, c in enumerate(df.columns)]
    return slotted.where(~met).select(columns), slotted.where(met).select(columns)
