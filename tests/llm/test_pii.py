import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ticklake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def naive(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in digits(m[0])]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("aZ0192.@-+ ()%_\né٣"), max_size=70) | st.lists(st.sampled_from(
    ["4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "a@b.c", "x.y@b-c.d.e", "+1 (555) 555-0100", "+", "@", ".", " ", "_", "000.1.2.3", "é"]),
    max_size=8).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == naive(text)


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "@" * 200_000, "+1 " * 100_000, "a." * 200_000 + "@b", "1 " * 200_000, "(1" * 100_000, "12-" * 100_000):
        base = pii.base_spans(text)
        pii.instances(text, base, True)


def bootstrap_rows():
    rows = [(i, f"blah{i} please reach me at +1 (555) 555-{1000 + i} for more") for i in range(12)]
    rows += [(100 + i, f"other{i} card number is 411111111111111{d} charged today") for i, d in enumerate("1" * 6)]
    rows += [(200, "well please reach me at (555) 777-1234 for more"), (201, "random words item 555 888 4321 elsewhere now"),
             (203, "the same number, 555 777 1234, is known now"),
             (202, "mail bob (at) example (dot) com today")]
    return rows


def test_contexts_find_unseen_identifiers(spark):
    rows = bootstrap_rows()
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    text = dict(rows)[200]
    begin = text.index("(555)")
    assert [tuple(s) for s in got[200].spans] == [("phone", begin, begin + len("(555) 777-1234"))] and got[200].base == []
    assert got[201].spans == [] and got[202].spans == []
    assert [tuple(s) for s in got[203].spans] == [("phone", 17, 29)]
    assert all(list(map(tuple, got[i].base)) == naive(t) for i, t in rows)


def test_digest_and_edges(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "a@b.c 1.2.3.4", 0), (3, "a@b.c 1.2.3.4", 0), (None, "x@y.z", 0), (4, "word " * 300_000 + "q@r.st", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, base int")
    got = [tuple(r) for r in pii.digest(pii.find(df)).collect()]

    def want(i, text):
        spans = naive(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        return (i, *(sum(s[0] == k for s in spans) for k in pii.KINDS), hashlib.sha256(listed.encode()).hexdigest(), listed)

    assert sorted(got, key=str) == sorted((want(i, t) for i, t, _ in rows), key=str)
    assert pii.find(df.limit(0)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pii.find(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [tuple(s) for s in r.base] == naive(texts[r.doc_id])
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_redact(spark):
    rows = bootstrap_rows() + [(300, None), (301, "")]
    df = spark.createDataFrame([(i, t, "x", None if t is None else len(t), "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, n_chars bigint, source string, row int")
    new = pii.redact(df)
    assert new.columns == df.columns and new.dtypes == df.dtypes
    got = {r.doc_id: r for r in new.collect()}
    assert got[200].text == "well please reach me at [PHONE] for more" and got[200].n_chars == len(got[200].text)
    assert got[201].text == dict(rows)[201] and got[300].text is None and got[300].n_chars is None and got[301].text == ""
    assert new.where(F.col("text").contains("4111")).count() == 0


def test_redacted_overlaps():
    assert pii.redacted("ab12345cd", [("ip", 2, 5), ("card", 2, 7), ("phone", 6, 7)]) == "ab[CARD]cd"


@pytest.mark.parametrize("limit", [100_000, 8])  # the patterns at once, and in several blocks
def test_patterns_find_any_spelling(spark, monkeypatch, limit):
    monkeypatch.setattr(pii, "PATTERNS", limit)
    phones = ["5551234567", "0301234567", "030 12345678", "(555) 1234567", "555-1234"]
    cards = ["3782 822463 10006", "5018 0000 0009"]
    ips = ["10 20 30 40", "10-20-30-41", "fe80::1"]
    emails = ["bob at example dot com", "bob@example"]
    rows = [(i, f"blah{i} please reach me at +1 (555) 555-{1000 + i} for more") for i in range(12)]
    seeds = [n for n in range(4111111111110000, 4111111111111000) if pii.luhn(str(n))][:12]
    rows += [(100 + i, f"other{i} her card number {n} was charged today") for i, n in enumerate(seeds)]
    rows += [(200 + i, f"x{i} logged in from 10.0.0.{i} last night") for i in range(12)]
    rows += [(300 + i, f"x{i} mail goes to u{i}@example.com every day") for i in range(12)]
    want = {}
    for kind, found, left, right in (("phone", phones, "well please reach me at", "for more"), ("card", cards, "so her card number", "was charged today"),
                                     ("ip", ips, "he logged in from", "last night"), ("email", emails, "the mail goes to", "every day")):
        for x in found:
            i = 1000 + len(want)
            rows.append((i, f"{left} {x} {right}"))
            want[i] = [(kind, len(left) + 1, len(left) + 1 + len(x))]
    rows += [(2000, "nothing known about 9998887776 here at all"), (2001, "please reach me at 12345 for more"), (2002, "that one, 5551234567, again")]
    want |= {2000: [], 2001: [], 2002: [("phone", 10, 20)]}
    got = {r.doc_id: list(map(tuple, r.spans)) for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: got[i] for i in want} == want


def test_slots_are_linear():
    known = pii.Known([("L reach me", "phone", 0.9), ("B is _ for", "card", 0.9), ("L a b", "email", 0.9), ("L a b", "ip", 0.9)])
    for text in ("1" * 100_000, "1." * 100_000, "1 " * 50_000, "12-" * 50_000, "a." * 50_000 + "@b", "(1" * 50_000, "1:" * 50_000, "a at " * 20_000):
        pii.instances(text, [], True, known)


def test_no_word_of_a_context_is_cut():
    long = "w" * 78
    text = f"one {long} me 5551234567 at {long} two"
    begin = text.index("555")
    assert pii._context(text, begin, begin + 10) == (["me"], ["at"])
    text = f"please reach me 5551234567 for more {long}"
    begin = text.index("555")
    assert pii._context(text, begin, begin + 10) == (["reach", "me"], ["for", "more"])
    assert pii._context("a " * 60 + "7", 120, 121) == (["a", "a"], []) and pii._context("x" * 300, 150, 151) == ([], [])
    assert pii._context("7" + " b" * 60, 0, 1) == ([], ["b", "b"])
