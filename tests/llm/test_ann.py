import numpy as np
import pytest

from ticklake.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def table(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in zip(ids, vectors)], SCHEMA)


def exact(ids, x, query, k=20):
    x = np.asarray(x, dtype=np.float32).astype(np.float64)
    out = []
    for i in query:
        scores = x @ x[list(ids).index(i)]
        order = sorted((-s, j) for s, j in zip(scores, ids) if j != i)[:k]
        out.append([j for _, j in order])
    return out


def found(index, queries, k=20):
    out = {}
    for r in ann.search(index, queries, k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r)
        assert r.rank == len(out[r.query_id])
    return out


def test_recall(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 64))
    x = centres[rng.integers(0, 10, 12_000)] * 0.5 + rng.normal(size=(12_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = list(range(12_000))
    df = table(spark, ids, x)
    queries = [i for i in ids if i % 200 == 0]
    got = found(ann.build(df, shard_rows=4000), df.where("vec_id % 200 = 0"))
    want = exact(ids, x, queries)
    hits = [len({r.vec_id for r in got[q]} & set(w)) / 20 for q, w in zip(queries, want)]
    assert np.mean(hits) >= 0.93
    for q in queries:
        assert all(abs(r.score - float(np.float32(x[q]).astype(np.float64) @ np.float32(x[r.vec_id]).astype(np.float64))) < 1e-12 for r in got[q])


def test_small_table_is_exact_and_skips_unusable_rows(spark):
    rng = np.random.default_rng(0)
    x = [list(map(float, rng.normal(size=4))) for _ in range(50)]
    x[3], x[4], x[5], x[6], x[7], x[8] = None, [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan"), 1, 1, 1], [float("inf"), 1, 1, 1], [1.0, 2.0]
    ids = list(range(49)) + [None]
    df = table(spark, ids, x)
    got = found(ann.build(df), df.where("vec_id % 20 = 0 or vec_id in (3, 4, 8)"))
    usable = [i for i in range(49) if not 3 <= i <= 8]
    want = exact(usable, [x[i] for i in usable], [0, 20, 40])
    assert {q: [r.vec_id for r in rs] for q, rs in got.items()} == dict(zip([0, 20, 40], want))


def test_ties_copies_and_repeated_ids(spark):
    v = [0.6, 0.8, 0.0]
    rng = np.random.default_rng(1)
    vectors = [v] * 3000 + [list(map(float, rng.normal(size=3))) for _ in range(500)]
    df = table(spark, list(range(3500)), vectors)
    index = ann.build(df, pivots=32, length=16, shard_rows=500)
    got = found(index, df.where("vec_id in (0, 40)"))
    assert [r.vec_id for r in got[40] if r.score == got[40][0].score][:1] and len(got[40]) == 20
    top = exact(list(range(3500)), vectors, [0, 40])
    assert [r.vec_id for r in got[0]] == top[0] and [r.vec_id for r in got[40]] == top[1]
    twice = table(spark, [1, 1, 2, 2], [[1.0, 0.0], [1.0, 0.0], [0.5, 0.5], [0.5, 0.5]])
    assert [(r.vec_id, r.score) for r in found(ann.build(twice), twice.where("vec_id = 1"))[1]] == [(2, 0.5), (2, 0.5)]


def test_few_and_none(spark):
    one = table(spark, [0, 20], [[1.0, 2.0], [3.0, 4.0]])
    got = found(ann.build(one), one)
    assert {q: [(r.vec_id, r.score) for r in rs] for q, rs in got.items()} == {0: [(20, 11.0)], 20: [(0, 11.0)]}
    empty = table(spark, [], [])
    assert ann.search(ann.build(empty), empty).count() == 0
    assert ann.search(ann.build(one), empty).count() == 0


@pytest.mark.parametrize("length", [3, 8])
def test_nearness_is_footrule(length):
    rng = np.random.default_rng(length)
    x, pivots = rng.normal(size=(40, 6)), rng.normal(size=(12, 6))
    perms = ann.permutations(x, pivots, length)
    at = np.argsort(perms.ravel(), kind="stable")
    shard = ann._Shard({"ids": np.arange(40).tobytes(), "ends": np.arange(1, 41).tobytes(), "vectors": x.tobytes(), "file_rows": (at // length).astype(np.int32).tobytes(),
                        "file_places": (at % length).astype(np.int16).tobytes(), "file_ends": np.cumsum(np.bincount(perms.ravel(), minlength=12)).tobytes()}, 6)
    place = np.full((40, 12), length)
    place[np.arange(40)[:, None], perms] = np.arange(length)
    for q in range(40):
        footrule = np.abs(place - place[q]).sum(axis=1)
        assert (footrule == length * (length + 1) - 2 * shard.nearness(perms[q], length)).all()
