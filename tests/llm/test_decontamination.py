import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ticklake.llm import decontamination as d, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    wins = []
    for item, text in items:
        w = split(text)
        n = min(len(w), 10)
        if item is not None and n:
            wins += [(str(item), w[i:i + n]) for i in range(len(w) - n + 1)]
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(item)
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def run(spark, docs, items, **more):
    docs = spark.createDataFrame([(*r, "x", 5) for r in docs], "doc_id bigint, text string, key string, start int")
    items = spark.createDataFrame([(*r, "y") for r in items], "item_id bigint, text string, window string")
    rows = d.decontaminate(docs, items, **more).collect()
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.items) for r in rows)
    return [(r.doc_id, r.n_words, r.n_hit, r.items) for r in rows]


def key(r):
    return r[0] is not None, r[0] or 0, r[1:]


@pytest.mark.parametrize("seed,shortest", [(0, 10), (1, 5), (2, 1)])
def test_against_all_windows(spark, seed, shortest):
    rng = random.Random(seed)
    letters = ["a", "B", "cé", "7", "ß"]  # few words, so that hashes, windows and ties repeat

    def text(n):
        return "".join(rng.choice(letters) + rng.choice([" ", "\n", ", ", "-"]) for _ in range(n))

    items = [(i, text(rng.randint(shortest, 30))) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(30)]
    docs += [(100 + i, text(9) + " " + rng.choice(items)[1] + " x " + text(5)) for i in range(20)]
    assert sorted(run(spark, docs, items), key=key) == sorted(brute(docs, items), key=key)


def test_defined_cases(spark):
    ten = "one two three four five six seven eight nine ten"
    items = [(1, ten), (2, ten.upper() + " eleven"), (None, "alpha beta"), (3, None), (4, "..."), (5, "Solo"), (5, "six, of eight words: is one window too")]
    docs = [(1, None), (2, ""), (3, ten + "! eleven"), (3, ten + "! eleven"), (None, "x " + ten), (None, None), (7, ten.replace("five", "fife")),
            (8, "solo"), (9, "alpha beta"), (10, "Six of eight words is one window too"), (11, " ".join([ten] * 40_000))]
    got = sorted(run(spark, docs, items), key=key)
    assert got == sorted(brute(docs[:-1], items) + [(11, 400_000, 400_000, ["1", "2"])], key=key)
    by = {r[0]: r for r in got}
    assert by[3][2:] == (11, ["1", "2"]) and by[8][2:] == (1, ["5"]) and by[7][2:] == (0, []) and by[9][2] == 0


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]
    assert run(spark, [(1, "a b")], [(1, None), (None, "a")]) == [(1, 2, 0, [])]


def test_shared_spans_are_maximal(spark):
    found = spark.createDataFrame([(b"a", 0, 10), (b"a", 1, 10), (b"a", 11, 10), (b"a", 22, 3), (b"b", 5, 2)], "key binary, start int, length int")
    assert sorted((bytes(r.key), r.begin, r.end) for r in d.shared_spans(found).collect()) == [(b"a", 0, 21), (b"a", 22, 25), (b"b", 5, 7)]


def test_native(spark):
    plan = queries.op11_decontamination(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions|Cartesian|NestedLoop", plan)


def test_query_digest(spark):
    got = queries.op11_decontamination(spark, "/root/testdata/sf0.001")
    clean = got.where(~F.col("contaminated")).select("items_sha256").distinct().collect()
    assert [r[0] for r in clean] in ([hashlib.sha256(b"").hexdigest()], [])
