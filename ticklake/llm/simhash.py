"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints are 64 bits: a bit is 1 if it is set in over half of the hashes of a text's word shingles.
Two fingerprints link if at most three bits differ.  Equal fingerprints are one class from the start.

Six blocks (of 11 or 10 bits): three differing bits lie in three of them at most, so a linked pair agrees in
at least three others.  Every class emits one row for each three blocks, 20 in all, keyed by their bits.
Members of a small bucket (equal key) are compared with each other.  Whoever meets over ``CROWDED`` others
in a bucket, and only they, are linked among themselves by variants instead:

Every crowded class emits all variants within half the radius (3 / 2, rounded down: one flipped bit).  As the
radius is odd, one of four 16-bit blocks is erased from fingerprint and variants, for each block in
turn: of three differing bits at least one lies in some block, so that the other two, outside it, are met
by one flip on either side.  That is 4 x 49 rows a class; flipping two bits on one side instead would be
over 2,000.  The rows are shuffled and sorted by variant (48 bits and the block's number).

Members of a bucket (equal variant) differ in two bits outside the block at most, so:

*   equal in the block: all link; each is linked to the first of them, not to all others;
*   one bit apart in the block: all link; the first members of the two sets are linked;
*   three bits apart in the block and equal outside it: probed among the members that are unflipped.

Every set of at most three differing bits is one of these in some bucket.  So no crowded bucket is expanded into
pairs, and a bucket of any size is linked by about as many edges as it has members.  A bucket of variants has at
most 2**16 x 49 members, as classes are distinct; that bounds what one task holds at a time.  Crowded buckets of
three blocks are passed on as they go by.

Defined cases: null and empty texts and texts of white space have the fingerprint zero and link like any
other; rows that repeat an id are rows of their own; a null id is never a component's id unless all its
members' ids are null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ticklake.llm.common import by_batch, written
from ticklake.llm.components import components

RADIUS = 3
BLOCK = 16
BLOCKS = 4
OUTSIDE = np.uint64((1 << 48) - 1)
#: For each byte value its bits, most significant first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
LANES = (np.arange(8) * 256)[None, :]
TRIPLES = np.array([1 << a | 1 << b | 1 << c for a, b, c in itertools.combinations(range(BLOCK), 3)], dtype=np.int64)
SHINGLES_AT_ONCE = 100_000
#: First bit and width of six blocks; any three of them make a key.
SIXTHS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
THREES = list(itertools.combinations(SIXTHS, 3))
#: Members up to which a bucket of three blocks is compared pair by pair.
CROWDED = 32


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a whole text: ASCII capitals lowered, words split at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    digest, space = xxhash.xxh64_digest, b" "
    for i in range(0, total, SHINGLES_AT_ONCE):
        part = words[i:i + SHINGLES_AT_ONCE + shingle - 1]
        if total == 1:
            raw = digest(space.join(words), seed)
        else:
            raw = b"".join([digest(space.join(s), seed) for s in zip(*(part[k:] for k in range(shingle)))])
        lanes = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8) + LANES
        counts += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ BITS).ravel()
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def text_digest(text: Column) -> Column:
    """What tells the texts of rows that share an id apart."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, digest, fp): the digest of every row's text and its fingerprint as a signed 64-bit integer.  No shuffle."""
    def make():
        def step(columns):
            found = [fingerprint(t, shingle, seed) for t in columns[1].to_pylist()]
            return {"doc_id": columns[0], "digest": columns[2], "fp": np.array(found, dtype=np.uint64).view(np.int64)}

        return step

    return by_batch(df.select(F.col(id_col).cast("bigint"), F.col(text_col), text_digest(F.col(text_col)).alias("_digest")), make,
                    "doc_id bigint, digest binary, fp bigint")


def outside(fp: np.ndarray, block: int) -> np.ndarray:
    """The 48 bits of unsigned fingerprints that are not in the block."""
    low = fp & np.uint64((1 << BLOCK * block) - 1)
    high = fp >> np.uint64(BLOCK * (block + 1)) if block < BLOCKS - 1 else np.zeros_like(fp)
    return high << np.uint64(BLOCK * block) | low


FLIPS = np.array([0, *(1 << i for i in range(48))], dtype=np.uint64)


def _variants():
    def step(columns):
        fp = columns[0].to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fp), 1000):
            own = fp[i:i + 1000]
            keys = [(outside(own, b)[:, None] ^ FLIPS | np.uint64(b << 48)).ravel() for b in range(BLOCKS)]
            yield {"key": np.concatenate(keys).view(np.int64), "fp": np.tile(np.repeat(own, len(FLIPS)), BLOCKS).view(np.int64)}

    return step


def bucket_links(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Edges (rows of two fingerprints) of whole buckets; ``key`` is sorted, ``fp`` unsigned."""
    first = np.concatenate([[True], key[1:] != key[:-1]])
    run = np.cumsum(first) - 1
    several = np.bincount(run)[run] > 1
    if not several.any():
        return np.zeros((0, 2), dtype=np.uint64)
    key, fp, run = key[several].view(np.uint64), fp[several], run[several]
    block = (key >> np.uint64(48)).astype(np.int64)
    inner = (fp >> (block * BLOCK).astype(np.uint64) & np.uint64(0xFFFF)).astype(np.int64)
    own = np.choose(block, [outside(fp, b) for b in range(BLOCKS)]) == key & OUTSIDE
    code = run.astype(np.int64) << BLOCK | inner
    order = np.lexsort((fp, code))
    code, fp, own = code[order], fp[order], own[order]
    head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    lead = np.repeat(head, np.diff(np.append(head, len(code))))
    edges = [np.stack([fp[lead], fp], axis=1)[lead != np.arange(len(fp))]]
    sets, leads = code[head], fp[head]

    def probe(codes, values, mask):
        at = np.minimum(np.searchsorted(codes, codes ^ mask), len(codes) - 1)
        hit = (codes[at] == codes ^ mask) & (at > np.arange(len(codes)))
        return np.stack([values[hit], values[at[hit]]], axis=1)

    edges += [probe(sets, leads, 1 << bit) for bit in range(BLOCK)]
    code, fp = code[own], fp[own]  # unflipped members: equal outside the block, so distinct in it
    if len(code) > 1:
        runs = code >> BLOCK
        start = np.concatenate([[True], runs[1:] != runs[:-1]])
        size = np.bincount(np.cumsum(start) - 1)[np.cumsum(start) - 1]
        few = np.flatnonzero((size > 1) & (size <= 32))
        for gap in range(1, 32):  # the few members of a small bucket, each against the next ones
            a, b = few[:-gap], few[gap:]
            near = (runs[a] == runs[b]) & np.isin(code[a] ^ code[b], TRIPLES)
            if not (runs[a] == runs[b]).any():
                break
            edges.append(np.stack([fp[a[near]], fp[b[near]]], axis=1))
        many = size > 32
        if many.any():
            edges += [probe(code[many], fp[many], mask) for mask in TRIPLES]
    found = np.concatenate(edges)
    return np.unique(found, axis=0) if len(found) else found


def _scan():
    """Buckets from rows sorted by key; the last one waits for the next batch."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def links():
        key, fp = (np.concatenate(x) for x in zip(*held))
        held.clear()
        found = bucket_links(key, fp.view(np.uint64)).view(np.int64)
        return {"a": found[:, 0], "b": found[:, 1]}

    def step(columns):
        if columns is None:
            if held:
                yield links()
            return
        key, fp = (c.to_numpy(zero_copy_only=False) for c in columns)
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            held.append((key[:cut], fp[:cut]))
            yield links()
        elif held and held[-1][0][-1] != key[0]:
            yield links()
        held.append((key[cut:], fp[cut:]))

    return step


def ball_links(classes: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) by variants, about as many as members of buckets."""
    variants = by_batch(classes.select("fp"), _variants, "key bigint, fp bigint")
    return by_batch(variants.repartition("key").sortWithinPartitions("key"), _scan, "a bigint, b bigint", finish=True).distinct()


def _keys():
    def step(columns):
        fp = columns[0].to_numpy(zero_copy_only=False).view(np.uint64)
        keys = []
        for n, three in enumerate(THREES):
            key = np.full(len(fp), n, dtype=np.uint64)
            for first, width in three:
                key = key << np.uint64(width) | fp >> np.uint64(first) & np.uint64((1 << width) - 1)
            keys.append(key)
        return {"key": np.concatenate(keys).view(np.int64), "fp": np.tile(fp, len(THREES)).view(np.int64)}

    return step


def shared_links(key: np.ndarray, fp: np.ndarray, crowded: int) -> np.ndarray:
    """Edges of whole buckets of three blocks; ``key`` is sorted, ``fp`` unsigned.  Members of crowded buckets get a loop each."""
    run = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    size = np.bincount(run)[run]
    many, few = fp[size > crowded], (size > 1) & (size <= crowded)
    edges = [np.stack([many, many], axis=1)]
    run, fp = run[few], fp[few]
    for gap in range(1, crowded):
        same = run[gap:] == run[:-gap]
        if not same.any():
            break
        near = same & (np.bitwise_count(fp[gap:] ^ fp[:-gap]) <= RADIUS)
        edges.append(np.stack([fp[:-gap][near], fp[gap:][near]], axis=1))
    return np.concatenate(edges)


def _meet(crowded: int):
    """Buckets of three blocks from rows sorted by key.  Of the last one ``crowded`` + 1 rows wait for the next batch."""
    key, fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def out(found):
        return {"a": found[:, 0].view(np.int64), "b": found[:, 1].view(np.int64)}

    def step(columns):
        nonlocal key, fp
        if columns is not None:
            key, fp = (np.concatenate([x, c.to_numpy(zero_copy_only=False)]) for x, c in zip((key, fp), columns))
        cut = len(key) if columns is None else int(np.searchsorted(key, key[-1]))
        if cut:
            yield out(shared_links(key[:cut], fp[:cut].view(np.uint64), crowded))
        rest = fp[cut + crowded + 1:]
        if len(rest):  # more of a crowded bucket
            yield {"a": rest, "b": rest}
        key, fp = key[cut:cut + crowded + 1], fp[cut:cut + crowded + 1]

    return step


def links(classes: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), enough of them to connect all that link."""
    keyed = by_batch(classes.select("fp"), _keys, "key bigint, fp bigint")
    found = written(by_batch(keyed.repartition("key").sortWithinPartitions("key"), lambda: _meet(crowded), "a bigint, b bigint", finish=True)
                    .distinct(), "fingerprint-links")
    many = found.where("a = b").select(F.col("a").alias("fp"))
    if many.isEmpty():
        return found
    return found.where("a <> b").unionByName(ball_links(many))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id, digest, component) of every row; component_id is the smallest id reachable over links.
    Where ids repeat, several components may have the same smallest id: ``component`` tells them apart."""
    rows = written(fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    star = components(links(classes))
    members = star.unionByName(star.select(F.col("b").alias("a"), "b").distinct())
    joined = members.join(classes, F.col("a") == F.col("fp")).select("fp", "b", "least")
    roots = joined.groupBy("b").agg(F.min("least").alias("smallest"))
    linked = written(joined.join(roots, "b").select(F.col("fp").alias("_fp"), F.col("b").alias("component"), "smallest"), "linked-classes")
    per_class = written(classes.join(linked, F.col("fp") == F.col("_fp"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("smallest", "least").alias("component_id"), F.coalesce("component", "fp").alias("component")), "components")
    return rows.join(per_class, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id", "digest", "component")
