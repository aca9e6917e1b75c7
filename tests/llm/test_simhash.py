import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from ticklake.llm import simhash
from ticklake.llm.components import components

MASK = (1 << 64) - 1


def naive_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("aB É\n\t\x0b\x1cz "), max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == naive_fingerprint(text)


def test_fingerprint_in_slices(monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 3)
    text = " ".join(f"w{i * i % 17}" for i in range(50))
    assert simhash.fingerprint(text) == naive_fingerprint(text)


def test_hash_is_sparks(spark):
    assert spark.sql("select xxhash64('a b c') as h").first().h & MASK == xxhash.xxh64_intdigest(b"a b c", seed=42)


def naive_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def flipped(fp, bits):
    for b in bits:
        fp ^= 1 << b
    return fp


@pytest.mark.parametrize("seed", range(6))
def test_links_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    fps = [0]
    for _ in range(12):  # chains, stars, and all three bits in one block
        base = rng.getrandbits(64)
        fps.append(base)
        for _ in range(rng.randrange(1, 30)):
            src = rng.choice([base, fps[-1]])
            block = rng.randrange(4) * 16
            where = rng.choice([range(64), range(block, block + 16), range(block, block + 4)])
            fps.append(flipped(src, rng.sample(list(where), rng.randrange(1, 5) if len(where) > 4 else 3)))
    fps = sorted({f & MASK for f in fps})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint").repartition(3)
    links = [(r.a & MASK, r.b & MASK) for r in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = [find(f) for f in fps]
    want = [fps[i] for i in naive_components(fps)]
    assert got == want


def test_large_bucket_is_not_expanded(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = {base} | {flipped(base, c) for c in itertools.combinations(range(0, 64, 3), 2)} | {flipped(base, c) for c in itertools.combinations(range(16, 32), 3)}
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    found = simhash.links(df)
    assert found.count() < 60 * len(fps)
    assert components(found).count() == len(fps) - 1


@pytest.mark.parametrize("crowded", [1, 3, 40])
def test_crowded_buckets_are_linked_by_variants(spark, crowded):
    rng = random.Random(crowded)
    fps = {0}
    for _ in range(8):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randrange(1, 40)):
            base = flipped(base, rng.sample(range(64), rng.randrange(1, 5)))
            fps.add(base)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint").repartition(3)
    roots = {r.a & MASK: r.b & MASK for r in components(simhash.links(df, crowded)).collect()}
    classes = {}
    for f, i in zip(fps, naive_components(fps)):
        classes.setdefault(i, set()).add(roots.get(f, f))
    assert all(len(x) == 1 for x in classes.values()) and len({min(x) for x in classes.values()}) == len(classes)


def test_few_rows_a_class(spark):
    fps = np.random.default_rng(3).integers(0, 1 << 63, 500)
    keys = simhash._keys()([pa.array(fps)])
    assert len(keys["key"]) == len(keys["fp"]) == 20 * len(fps)
    assert len(set(keys["key"].tolist())) > 19.9 * len(fps)


def test_rows_of_a_crowded_bucket_pass_by_in_any_batches():
    fp = np.arange(50, dtype=np.int64)
    key = np.sort(np.where(fp < 9, fp // 3, 7))
    for size in (1, 4, 7, 50):
        step, got = simhash._meet(5), []
        for i in range(0, 50, size):
            got += step([pa.array(key[i:i + size]), pa.array(fp[i:i + size])])
        got += step(None)
        pairs = {p for x in got for p in zip(x["a"].tolist(), x["b"].tolist())}
        assert {a for a, b in pairs if a == b} == set(range(9, 50))
        assert {(a, b) for a, b in pairs if a != b} == {(a, b) for a in range(9) for b in range(a + 1, 9)
                                                          if a // 3 == b // 3 and (a ^ b).bit_count() <= 3}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)] + [(1000, i) for i in range(1001, 1100)]
    got = {r.a: r.b for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 150: 100, **{i: 1000 for i in range(1001, 1100)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_edges(spark):
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(5, text), (3, text.upper()), (9, text + " tail"), (None, text), (1, None), (8, " \n"), (2, "one"), (2, "one"), (4, "a b"), (None, "lonely text here now"),
            (6, "x " * 200_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, fp int, component_id int")
    got = {(r.doc_id, r.fp & MASK): r.component_id for r in simhash.near_duplicates(df).collect()}
    fps = [naive_fingerprint(t) if len(t or "") < 10_000 else simhash.fingerprint(t) for _, t in rows]
    comps = naive_components(fps)
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if comps[j] == comps[i] and rows[j][0] is not None]
        assert got[doc, fps[i]] == (min(ids) if ids else None)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    fps = [naive_fingerprint(r.text) for r in rows]
    comps = naive_components(fps)
    got = {r.doc_id: (r.fp & MASK, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {r.doc_id: (fps[i], rows[comps[i]].doc_id) for i, r in enumerate(rows)}
