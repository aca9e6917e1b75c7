"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with control bytes.

Ids are replaced by their rank in the corpus's own frequencies, so that common ids need one byte.  Four
ranks share a control byte that holds their four byte counts (2 bits each); the ranks' bytes follow in a
stream of their own.  The reader finds lengths with one numpy lookup in a table of the 256 control bytes.

A volume (one file, little-endian):

    bytes 0-3    b"TLV1"
    bytes 4-7    number of the range partition it belongs to        (uint32)
    bytes 8-11   number of the volume in that partition             (uint32)
    bytes 12-15  documents                                          (uint32)
    bytes 16-23  ids                                                (uint64)
    bytes 24-31  control bytes                                      (uint64)
    then         document ids (int64 each), null marks (uint8 each), id counts (uint32 each),
                 control bytes, data bytes, one line feed

Each document begins on a control byte of its own, so documents can be decoded singly.  The folder
``ranks`` beside the volumes holds the id of each rank; it has at most one row per vocabulary entry.
Volumes hold ``volume_ids`` ids at most, or one document if that is longer.  Partitions and volumes are
in ascending document-id order; null document ids come first; equal ones are ordered by crc and ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ticklake.llm.common import by_batch, longs, nullable, running_start, written
from ticklake.llm.tokens import Encoder, encoder

MAGIC = b"TLV1"
HEADER = np.dtype([("magic", "S4"), ("part", "<u4"), ("volume", "<u4"), ("docs", "<u4"), ("ids", "<u8"), ("controls", "<u8")])
#: Byte counts of the four ranks of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def coded(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of one document's ranks."""
    n = len(ranks)
    codes = np.zeros(-(-n // 4) * 4, dtype=np.uint8)
    codes[:n] = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = codes.reshape(-1, 4)
    controls = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    if n and codes.max() <= 1:  # the common case: one or two bytes
        pair = ranks.astype("<u2").view(np.uint8).reshape(-1, 2)
        keep = np.ones((n, 2), dtype=bool)
        keep[:, 1] = codes[:n] > 0
        return controls.tobytes(), pair[keep].tobytes()
    raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return controls.tobytes(), raw[np.arange(4) <= codes[:n, None]].tobytes()


def decoded(controls: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ranks of a volume's documents, one after the other, by table lookup of the control bytes."""
    lengths = LENGTHS[controls].ravel()
    quads = -(-counts // 4)  # control bytes of each document
    first = np.concatenate([[0], np.cumsum(quads)[:-1]]) * 4
    real = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    lengths = lengths[real]
    begin = np.cumsum(lengths, dtype=np.int64) - lengths
    data = np.concatenate([data, np.zeros(4, dtype=np.uint8)])
    ranks = data[begin].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        if not len(more):
            break
        ranks[more] |= data[begin[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def tokenized(df: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int | None, wide: bool) -> DataFrame:
    """(doc_id, crc, n, ids): ids as 16-bit integers unless ``wide``; crc and n are those of 32-bit ids."""
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def make():
        encode = encoder(tokenizer).encode

        def step(columns):
            docs, valid = longs(columns[0])
            texts = columns[1].to_pylist()
            for i in range(0, len(texts), 512):
                found = [ids + end for ids in encode(texts[i:i + 512])]
                yield {"doc_id": nullable(docs[i:i + 512], valid[i:i + 512]),
                       "crc": np.array([zlib.crc32(x) for x in found], dtype=np.int64),
                       "n": np.array([len(x) // 4 for x in found], dtype=np.int64),
                       "ids": pa.array(found if wide else [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in found],
                                       type=pa.binary())}

        return step

    return by_batch(df.select(F.col(id_col).cast("bigint"), F.col(text_col)), make,
                    "doc_id bigint, crc bigint, n bigint, ids binary")


def write_token_files(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int | None = 2, volume_ids: int = 4_000_000) -> None:
    """Tokenize whole texts and write them to ``path``/volumes and ``path``/ranks.

    The frequencies are counted over all documents, in each task first; the driver gets one row per
    vocabulary entry (its bound is the vocabulary's size).  Text is never shuffled; ids are, once.
    """
    vocabulary = Encoder(tokenizer).vocabulary
    wide = vocabulary > 0x10000
    kind = "<u4" if wide else "<u2"
    ids = written(tokenized(df, tokenizer, id_col, text_col, end_id, wide), "token-ids")

    def counter():
        total = np.zeros(vocabulary, dtype=np.int64)

        def step(columns):
            if columns is not None:
                total[:] += np.bincount(np.frombuffer(b"".join(columns[0].to_pylist()), kind), minlength=vocabulary)
                return None
            used = np.flatnonzero(total)
            return {"id": used, "seen": total[used]}

        return step

    ranks = by_batch(ids.select("ids"), counter, "id bigint, seen bigint", finish=True) \
        .groupBy("id").agg(F.sum("seen").alias("seen")).toPandas().sort_values(["seen", "id"], ascending=[False, True])["id"].to_numpy()
    spark = df.sparkSession
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(ranks)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(vocabulary, dtype=np.uint32)
    rank_of[ranks.astype(np.int64)] = np.arange(len(ranks), dtype=np.uint32)

    def binder():
        part, kept, state = TaskContext.get().partitionId(), [], {"ids": 0, "volume": 0}

        def volume():
            doc, n, coded_ = zip(*kept)
            controls, data = zip(*coded_)
            head = np.zeros(1, dtype=HEADER)
            head[0] = (MAGIC, part, state["volume"], len(doc), sum(n), sum(map(len, controls)))
            blob = b"".join([head.tobytes(), np.array([d or 0 for d in doc], dtype="<i8").tobytes(),
                             np.array([d is None for d in doc], dtype=np.uint8).tobytes(), np.array(n, dtype="<u4").tobytes(),
                             *controls, *data])
            kept.clear()
            state.update(ids=0, volume=state["volume"] + 1)
            return {"volume": pa.array([blob], type=pa.binary())}

        def step(columns):
            if columns is None:
                if kept:
                    yield volume()
                return
            for doc, n, raw in zip(*(c.to_pylist() for c in columns)):
                if kept and state["ids"] + n > volume_ids:
                    yield volume()
                kept.append((doc, n, coded(rank_of[np.frombuffer(raw, kind)])))
                state["ids"] += n

        return step

    # the ranges are sampled from the written table, and coding follows the shuffle, so that it runs once
    order = ["doc_id", "crc", "n"]
    bound = by_batch(ids.repartitionByRange(*order).sortWithinPartitions(*order, "ids").select("doc_id", "n", "ids"),
                     binder, "volume binary", finish=True)
    # Spark's text writer writes a string's bytes as they are: one row, one file
    bound.select(F.col("volume").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{path}/volumes")


def _number(column: str, at: int, size: int):
    """A little-endian unsigned number of a header (below 2**63), without Python."""
    return F.conv(F.concat(*(F.hex(F.substring(column, at + k + 1, 1)) for k in reversed(range(size)))), 16, 10).cast("bigint")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the volumes, ids as LE uint32; start counts all ids before it."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy().astype("<u4")
    files = spark.read.format("binaryFile").load(f"{path}/volumes").where(F.col("length") >= HEADER.itemsize)
    starts = written(running_start(files.select(F.substring("content", 1, HEADER.itemsize).alias("head"))
                           .select(_number("head", 4, 4).alias("part"), _number("head", 8, 4).alias("volume"), _number("head", 16, 8).alias("ids")),
                           "part", "volume", "ids", "volume_start").select("part", "volume", "volume_start"), "volume-starts")

    def reader():
        def step(columns):
            for blob in columns[0]:
                raw = np.frombuffer(blob.as_buffer(), dtype=np.uint8)
                head = raw[:HEADER.itemsize].view(HEADER)[0]
                if head["magic"] != MAGIC:
                    raise ValueError("not a token-id volume")
                docs, at = int(head["docs"]), HEADER.itemsize
                doc, at = raw[at:at + 8 * docs].view("<i8"), at + 8 * docs
                null, at = raw[at:at + docs].astype(bool), at + docs
                counts, at = raw[at:at + 4 * docs].copy().view("<u4").astype(np.int64), at + 4 * docs
                controls, data = raw[at:at + int(head["controls"])], raw[at + int(head["controls"]):-1]
                ids = ranks[decoded(controls, data, counts)] if counts.sum() else np.zeros(0, dtype="<u4")
                ends = np.cumsum(counts)
                for i in range(0, docs, 4096):
                    k = slice(i, i + 4096)
                    own = [ids[b - n:b].tobytes() for b, n in zip(ends[k], counts[k])]
                    yield {"part": np.full(len(own), head["part"], dtype=np.int64), "volume": np.full(len(own), head["volume"], dtype=np.int64),
                           "doc_id": nullable(doc[k], ~null[k]), "begin": (ends - counts)[k], "n_tokens": counts[k],
                           "ids": pa.array(own, type=pa.binary())}

        return step

    # the starts are a table with a known size (one row per volume), so Spark broadcasts them only while they are small
    docs = by_batch(files.select("content"), reader, "part bigint, volume bigint, doc_id bigint, begin bigint, n_tokens bigint, ids binary")
    return docs.join(starts, ["part", "volume"]).select("doc_id", (F.col("volume_start") + F.col("begin")).alias("start"), "n_tokens", "ids")
