import hashlib
import random
import zlib

import pytest

from ticklake.llm import manifest as m


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def up(nodes):
    return [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append(up(levels[-1]))
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        first = at - at % 8
        out.append((nodes[first:at], nodes[at + 1:first + 8]))
        at //= 8
    return out


def brute(rows):
    def leaf(doc, source, lang, n, text):
        return h(field(doc), field(source), field(lang), field(n), field(text))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = own, tree([leaf(*r) for r in own])
    top = tree([trees[x][1][-1][0] for x in langs])
    out = []
    for j, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            path = siblings(levels, i) + siblings(top, j)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            back = leaf(*r[:4], lower(r[4])) if changed else leaf(*r)
            for before, after in path:
                back = h(*before, back, *after)
            out.append((r[0], leaf(*r), levels[-1][0], top[-1][0], h(*(x for a, b in path for x in a + b)), back, back == top[-1][0]))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, idx int, grp string")
    return [tuple(r) for r in m.tampering(df).collect()]


def key(r):
    return r[0] is not None, r[0] or 0, r[1:]


@pytest.mark.parametrize("sizes", [[1], [9], [0, 1, 8, 65], [512, 513, 1, 64], [2000]])
def test_against_plain_trees(spark, sizes):
    rng = random.Random(sum(sizes))
    names = [None, "", "de", "éé", "zz"]
    rows, ids = [], list(range(sum(sizes)))
    rng.shuffle(ids)
    for lang, n in zip(names if len(sizes) > 1 else ["en"], sizes):
        for _ in range(n):
            rows.append((ids.pop(), rng.choice(["a", None]), lang, rng.choice([3, None]), rng.choice(["Text é", "text", "", None, "LONG " * 50])))
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_many_groups(spark):
    rows = [(i, "s", f"g{i % 700}", 1, "A") for i in range(1500)]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_repeated_and_null_keys(spark):
    rows = [(None, None, None, None, None)] * 2 + [(None, "a", "en", 1, "X")] + [(5, "a", "en", 1, "X")] * 3 + [(5, "a", "en", 1, "B"), (6, "a", "en", 1, "Y" * 300_000)]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_empty(spark):
    assert run(spark, []) == []


def test_only_every_third_level_is_stored(spark):
    rows = spark.createDataFrame([("g", i, h(str(i))) for i in range(600)], "lang string, doc_id bigint, leaf string")
    found = m.Manifest(rows, "lang", "doc_id", "leaf")
    assert [x.count() for x in found.levels] == [600, 2, 1]
    assert found.root == tree([h(str(i)) for i in range(600)])[-1][0]
