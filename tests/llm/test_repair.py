import hashlib
import heapq
import random
import re
import zlib

import pytest

from ticklake.llm import repair as r

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ROLE = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """Least (cost, audit) and repaired rows, by a search over whole audits."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        for target in NEXT[state].values():
            if target != "s":
                heapq.heappush(heap, (cost + 2, audit + "I", i, target, (*out, (ROLE[target], ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for initial, target in NEXT[state].items():
                    if role[:1] == initial:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, target, (*out, (role, text))))
                    if target != "s":
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, target, (*out, (ROLE[target], text))))


def brute(rows):
    shown = lambda x: " " if x is None else str(x)
    out = []
    for conv in {x[0] for x in rows}:
        after = []
        for _, turn, role, text in (x for x in rows if x[0] == conv):
            kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
            role, text = shown(role), shown(text)
            if kind:
                text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                after += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        after.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        faults, seen = [], set()
        for _, role, text in after:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
        cost, audit, fixed = cheapest([(role, text, f) for (_, role, text), f in zip(after, faults)])
        turns = {x[0] for x in after if x[0] is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(after, after[1:])]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()))
    return out


def key(x):
    return tuple((v is not None, v) for v in x)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*x, 3, "x") for x in rows], "conv_id bigint, turn bigint, role string, text string, idx int, conv string")
    return sorted([tuple(x) for x in r.repair(df, **more)[0].collect()], key=key)


def conversations(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["A.", "B!", "no end", " \t", "", None, "é?\n", "C.  ", f"{turn}."])))
    return rows


@pytest.mark.parametrize("seed,chunk", [(0, 1024), (1, 3), (2, 1)])
def test_against_a_search_over_whole_audits(spark, seed, chunk):
    rows = conversations(seed, 40, 14) + [(None, 0, "user", "x."), (None, 1, "assistant", "y."), (-1, 1, "user", "\t")]
    assert run(spark, rows, chunk=chunk) == sorted(brute(rows), key=key)


def test_long_conversation_in_chunks(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t}{rng.choice(['.', ''])}") for t in range(900)]
    rows += [(8, t, "system", "same.") for t in range(300)]  # all but one are duplicates
    rows += [(9, 0, "user", "word " * 200_000 + "."), (9, 1, "assistant", "end.")]
    assert run(spark, rows, chunk=64) == sorted(brute(rows), key=key)
    assert run(spark, rows) == run(spark, rows, chunk=64)


def test_empty_and_dropped(spark):
    assert run(spark, []) == []
    gone = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert run(spark, [(1, gone, "user", "A.")]) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("modulus", [r.MODULUS, 7, 1])
def test_audits_compare_as_text_even_when_hashes_collide(modulus):
    rng = random.Random(modulus)
    audits = r.Audits(modulus)
    nodes = [(audits.root(), "")]
    for _ in range(300):
        node, text = rng.choice(nodes[-40:])
        letter = rng.choice("DIKR")
        nodes.append((audits.add(node, letter), text + letter))
    for _ in range(3000):
        (a, x), (b, y) = rng.choice(nodes), rng.choice(nodes)
        assert audits.before(a, b) == (x < y) and audits.text(a) == x
    assert all(audits.text(audits.prefix(n, len(t) // 2)) == t[:len(t) // 2] for n, t in nodes)


def test_colliding_hashes_change_no_solution():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 20))]
        assert r.solve(rows, r.START) == r.solve(rows, r.START, modulus=1)


def test_repaired_rows(spark):
    rows = [(1, t, role, text) for t, (role, text) in enumerate([("system", "S."), ("user", "q"), ("user", "r."), ("assistant", "A."), ("tool", "x.")])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for chunk in (1, 2, 1024):
        found, fixed = r.repair(df, damage=False, chunk=chunk)
        _, _, want = cheapest([(role, text, "truncated" if text == "q" else None) for _, _, role, text in rows])
        assert [(x.role, x.text) for x in fixed.collect()] == list(want)
        assert found.first().audit.count("I") + 5 == len(found.first().audit)
