"""Packing documents into fixed-length token sequences by best-fit decreasing.

Each task packs the documents of its own partition, so no token is shuffled and no key can be hot.
A document's ids (its text's ids and an end id) are cut into full windows and a rest.  Rests wait in a
buffer of at most ``buffer_ids`` ids; when it is full, or the partition ends, they are packed longest
first, each into the open sequence with the least remaining room that still holds it.  That sequence is
found with a segment tree indexed by remaining room.  A sequence's id is the partition's number and a
counter, so a task that runs again after a lost executor makes the same ids from the same split.

Defined cases: a null or empty text is a document of the end id alone; rows that repeat an id are packed
as documents of their own; a null id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ticklake.llm import tokens
from ticklake.llm.common import by_batch

SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, " \
         "padded_length bigint, ids binary"


class RoomTree:
    """Segment tree over remaining rooms 0..capacity: how many open sequences have each room."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room >= need of an open sequence."""
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:  # up to the first right-hand sibling that holds a sequence, then down to its least leaf
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, room: int) -> int:
        node = room + self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.open[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Sequence and offset of each piece, and the number of sequences.  Equal lengths keep their order."""
    tree, sequence, offset, used = RoomTree(capacity), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.tightest(lengths[i])
        if room is None:
            sequence[i], room, used = used, capacity, used + 1
        else:
            sequence[i] = tree.take(room)
        offset[i] = capacity - room
        if room > lengths[i]:
            tree.add(room - lengths[i], sequence[i])
    return sequence, offset, used


def padded(length: int, capacity: int) -> int:
    """The length a sequence is padded to: the full window, unless it is at a power of two already."""
    return length if length & (length - 1) == 0 else capacity


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         end_id: int = 1, buffer_ids: int = 8_000_000) -> DataFrame:
    """One row per piece: its document, place in the document, sequence, place there and ids (LE uint32)."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def make():
        encoder, task, state = tokens.encoder(tokenizer), TaskContext.get().partitionId() << 32, {"next": 0, "ids": 0}
        rests: list[tuple] = []

        def rows(pieces: list[tuple], sequence, offset, size) -> dict:
            doc, start, length, counts, ids = zip(*pieces)
            return {"doc_id": pa.array(doc, type=pa.int64()), "start": np.array(start, dtype=np.int64),
                    "length": np.array(length, dtype=np.int64), "doc_tokens": np.array(counts, dtype=np.int64),
                    "sequence_id": np.array(sequence, dtype=np.int64) + task, "offset": np.array(offset, dtype=np.int64),
                    "padded_length": np.array(size, dtype=np.int64), "ids": pa.array(ids, type=pa.binary())}

        def flush():
            for out in packed():
                yield out

        def packed():
            if not rests:
                return
            sequence, offset, used = best_fit_decreasing([r[2] for r in rests], capacity)
            fill = np.bincount(sequence, weights=[r[2] for r in rests], minlength=used).astype(np.int64)
            size = np.array([padded(int(n), capacity) for n in fill])
            sequence = np.array(sequence, dtype=np.int64)
            for i in range(0, len(rests), 2000):
                yield rows(rests[i:i + 2000], sequence[i:i + 2000] + state["next"], offset[i:i + 2000],
                           size[sequence[i:i + 2000]])
            state["next"] += used
            state["ids"] = 0
            rests.clear()

        def step(columns):
            if columns is None:
                yield from flush()
                return
            docs, texts = columns[0].to_pylist(), columns[1].to_pylist()
            for doc, ids in zip(docs, encoder_ids(texts)):
                n_ids = len(ids) // 4
                full = n_ids // capacity
                if full:
                    for i in range(0, full, 1000):
                        pieces = [(doc, k * capacity, capacity, n_ids, ids[4 * k * capacity:4 * (k + 1) * capacity])
                                  for k in range(i, min(full, i + 1000))]
                        n = len(pieces)
                        yield rows(pieces, np.arange(state["next"], state["next"] + n), np.zeros(n), np.full(n, padded(capacity, capacity)))
                        state["next"] += n
                if n_ids % capacity:
                    rests.append((doc, full * capacity, n_ids % capacity, n_ids, ids[4 * full * capacity:]))
                    state["ids"] += n_ids % capacity
                    if state["ids"] >= buffer_ids:
                        yield from flush()

        def encoder_ids(texts):
            for i in range(0, len(texts), 64):
                for ids in encoder.encode(texts[i:i + 64]):
                    yield ids + end

        return step

    return by_batch(df.select(F.col(id_col).cast("bigint"), F.col(text_col)), make, SCHEMA, finish=True)
