"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``length`` nearest of ``pivots`` pivots, nearest first.  The rows are dealt
to shards of about ``shard_rows`` by hash.  A shard holds, for each pivot, an inverted file of the vectors
that have the pivot in their list, with its place there.  A query walks the files of its own pivots and
gets the footrule distance of every vector of the shard:

    footrule(q, v) = constant - 2 * sum over shared pivots of (length - max(place in q, place in v))

(a missing pivot counts as standing at place ``length``).  The nearest share ``kept`` of a shard's distinct
vectors, at least ``least``, and every vector with more than ``COPIES`` copies in the shard are ranked again
by the exact measure, the inner product in double precision; a shard returns its ``k`` best and the best of all shards are the answer.  Both numbers follow the shard,
so every row is indexed and work grows with the data.  Equal vectors of a shard are one entry that lists
all its ids, so that copies cannot crowd out others.

The pivots are a sample of fixed size: the vectors whose ids have the smallest hashes.  Queries are dealt to
blocks by hash; each block meets each shard in a task of its own, and the memory a task needs is one
shard, one block and their answers.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do
null ids and vectors whose dimension is not the most frequent one; of rows that repeat a query's id the
smallest vector is the query; a query is never its own candidate; equal scores are ranked by id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.llm.common import by_batch, ship, written

#: A vector with more copies than this in a shard can fill an answer by itself, so it is always reranked.
COPIES = 4


@dataclass
class Index:
    shards: DataFrame
    pivots: np.ndarray
    dims: int
    length: int
    kept: float
    least: int


def usable(vector: str) -> Column:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _clean(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("vec_id").isNotNull() & usable("v"))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def permutations(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots (largest inner product, then smaller number) of each vector, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int16)


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the points, each the least similar (by cosine) to those chosen before it: a dense clump in
    the data gives few pivots, so that the lists of vectors outside it still tell them apart."""
    if len(points) <= count:
        return points
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < count:
        nearest[chosen[-1]] = np.inf
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return points[chosen]


def _dealt(df: DataFrame, name: str, parts: int) -> DataFrame:
    """Deal rows evenly, rows of one id too."""
    return df.withColumn(name, F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(parts)).cast("int"))


def build(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = 256, length: int = 64,
          shard_rows: int = 8192, kept: float = 0.12, least: int = 800) -> Index:
    """Index every usable row.  The rows are shuffled once, to their shards."""
    ship(df.sparkSession)
    rows = written(_clean(df, id_col, vec_col), "vectors")
    size = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims, n = (size["dims"], size["count"]) if size else (0, 0)
    rows = rows.where(F.size("v") == dims)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).collect()  # bounded: 4 x pivots rows
    points = np.unique(_matrix([r.v for r in sample]), axis=0) if sample else np.zeros((0, dims))
    points = spread(points, pivots)
    length = min(length, len(points))

    def shard(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        ids, vectors = frame["vec_id"].to_numpy(), _matrix(frame["v"])
        distinct, member = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, member.ravel()))
        perm = permutations(distinct, points, length)
        at = np.argsort(perm.ravel(), kind="stable")
        return pd.DataFrame({"shard": frame["shard"].iloc[:1].to_numpy(), "n": [len(distinct)], "ids": [ids[order].tobytes()],
                             "ends": [np.cumsum(np.bincount(member.ravel())).astype(np.int64).tobytes()], "vectors": [distinct.tobytes()],
                             "file_rows": [(at // max(length, 1)).astype(np.int32).tobytes()],
                             "file_places": [(at % max(length, 1)).astype(np.int16).tobytes()],
                             "file_ends": [np.cumsum(np.bincount(perm.ravel(), minlength=len(points))).astype(np.int64).tobytes()]})

    made = _dealt(rows, "shard", max(1, -(-n // shard_rows))).groupBy("shard").applyInPandas(
        shard, "shard int, n int, ids binary, ends binary, vectors binary, file_rows binary, file_places binary, file_ends binary")
    return Index(written(made, "shards"), points, dims, length, kept, least)


class _Shard:
    def __init__(self, row: dict, dims: int):
        self.ids, self.ends = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["ends"], dtype=np.int64)
        self.vectors = np.frombuffer(row["vectors"]).reshape(-1, dims)
        self.rows = np.frombuffer(row["file_rows"], dtype=np.int32).astype(np.intp)
        self.places = np.frombuffer(row["file_places"], dtype=np.int16)
        self.files = np.concatenate([[0], np.frombuffer(row["file_ends"], dtype=np.int64)])
        begins = np.concatenate([[0], self.ends[:-1]])
        self.first = self.ids[begins]
        self.large = np.flatnonzero(self.ends - begins > COPIES)
        self.single = self.ends - begins == 1
        self.by_id = np.empty(len(begins), dtype=np.int64)  # place of each entry by its smallest id
        self.by_id[np.argsort(self.first, kind="stable")] = np.arange(len(begins))

    def nearness(self, perm: np.ndarray, length: int) -> np.ndarray:
        """Sum over shared pivots of (length - larger place): the larger, the smaller the footrule distance."""
        near = np.zeros(len(self.ends), dtype=np.int32)
        for place, pivot in enumerate(perm):
            own = slice(self.files[pivot], self.files[pivot + 1])
            near[self.rows[own]] += length - np.maximum(self.places[own], place)
        return near

    def search(self, query_id: int, query: np.ndarray, perm: np.ndarray, k: int, index_length: int, kept: float, least: int):
        n = len(self.ends)
        near = self.nearness(perm, index_length)
        count = min(n, max(least, int(np.ceil(kept * n))))
        if count < n:
            # ties of the footrule by the smallest id of an entry, in one unique key
            found = np.argpartition(self.by_id - near.astype(np.int64) * n, count - 1)[:count]
            found = np.union1d(found, self.large)
        else:
            found = np.arange(n)
        scores = (self.vectors[found] * query).sum(axis=1)
        if len(found) > k + 1:  # all entries down to the score of number k + 1 (one may be the query itself)
            limit = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            keep = scores >= limit
            found, scores = found[keep], scores[keep]
        alone = self.single[found]
        ids, out = [self.first[found[alone]]], [scores[alone]]
        if len(own := np.flatnonzero(ids[0] == query_id)):
            ids, out = [np.delete(ids[0], own)], [np.delete(out[0], own)]
        for entry, score in zip(found[~alone], scores[~alone]):
            own = self.ids[self.ends[entry - 1] if entry else 0:self.ends[entry]]
            at = np.searchsorted(own, query_id), np.searchsorted(own, query_id, side="right")
            own = np.concatenate([own[:min(at[0], k)], own[at[1]:at[1] + k]])[:k]
            ids.append(own)
            out.append(np.full(len(own), score))
        ids, out = np.concatenate(ids), np.concatenate(out)
        order = np.lexsort((ids, -out))[:k]
        return ids[order], out[order]


def search(index: Index, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           block_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, nearest first."""
    asked = _clean(queries, id_col, vec_col).where(F.size("v") == index.dims).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = written(asked, "queries")
    blocks = max(1, -(-asked.count() // block_rows))
    shards = index.shards.count()
    dims, length, pivots, kept, least = index.dims, index.length, index.pivots, index.kept, index.least

    def bound(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": frame["block"].iloc[:1].to_numpy(), "query_ids": [frame["vec_id"].to_numpy().tobytes()],
                             "queries": [_matrix(frame["v"]).tobytes()]})

    blobs = written(_dealt(asked, "block", blocks).groupBy("block").applyInPandas(bound, "block int, query_ids binary, queries binary"), "query-blocks")
    # every block of queries against every shard: pairs of blocks, each pair a key of its own
    left = index.shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = blobs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(1, shards) - 1))))

    def make():
        def step(columns):
            names = ["ids", "ends", "vectors", "file_rows", "file_places", "file_ends", "query_ids", "queries"]
            for cells in zip(*(c.to_pylist() for c in columns)):
                row = dict(zip(names, cells))
                shard = _Shard(row, dims)
                ids, asked_ = np.frombuffer(row["query_ids"], dtype=np.int64), np.frombuffer(row["queries"]).reshape(-1, dims)
                perms = permutations(asked_, pivots, length)
                got = [shard.search(i, q, p, k, length, kept, least) for i, q, p in zip(ids, asked_, perms)]
                counts = [len(g[0]) for g in got]
                yield {"query_id": np.repeat(ids, counts), "vec_id": np.concatenate([g[0] for g in got]).astype(np.int64),
                       "score": np.concatenate([g[1] for g in got])}

        return step

    pairs = left.join(right, ["shard", "block"]).select("ids", "ends", "vectors", "file_rows", "file_places", "file_ends", "query_ids", "queries")
    found = by_batch(pairs, make, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
