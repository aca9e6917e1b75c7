import zlib
from collections import Counter

from hypothesis import given, settings, strategies as st

from ticklake.llm import langid, queries

SF = "/root/testdata/sf0.001"


def naive_counts(text):
    out = Counter()
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    for w in words:
        for n in (1, 2, 3):
            padded = f" {w} " if n > 1 else w
            for i in range(len(padded) - n + 1):
                gram = padded[i:i + n]
                out[gram] += 1
    return out


def number(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text(st.sampled_from("aB é.\nİß中"), max_size=80))
def test_counts(text):
    keys, counts = langid.gram_counts(text)
    assert dict(zip(keys.tolist(), counts.tolist())) == {number(g): n for g, n in naive_counts(text).items()}


def test_counts_in_slices(monkeypatch):
    text = "some words, and a verylongwordindeed " * 30
    want = langid.gram_counts(text)
    monkeypatch.setattr(langid, "SLICE", 7)
    got = langid.gram_counts(text)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def naive_predict(model, text, profile):
    counts = {number(g): n for g, n in naive_counts(text).items()}
    top = sorted(counts, key=lambda g: (-counts[g], g))[:profile]
    if not top:
        return "und", 0.0
    far = {lang: sum(abs(grams.index(g) - i) if g in grams else profile for i, g in enumerate(top)) for lang, grams in model.items()}
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (len(top) * profile)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    counts = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update({number(g): n for g, n in naive_counts(r.text).items()})
    model = {lang: sorted(c, key=lambda g: (-c[g], g))[:langid.PROFILE] for lang, c in counts.items()}
    got = {r.doc_id: r for r in queries.op5_language_id(spark, SF).collect()}
    hits = total = 0
    for r in docs:
        lang, score = naive_predict(model, r.text, langid.PROFILE)
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-12
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if got[r.doc_id].held_out and r.lang:
            total, hits = total + 1, hits + (lang == r.lang)
    assert hits / total > 0.9


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, "der hund und die katze", "de", 1), (None, "the end", None, 1), (4, None, "en", 1), (5, "123 !", "en", 1), (5, "123 !", "en", 1),
            (6, "the " * 400_000, None, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    model = langid.train(df)
    got = langid.predict(df.drop("score"), model, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "en"), (1, "en"), (2, "de"), (4, "und"), (5, "und"), (5, "und"), (6, "en")]
    assert all(0 <= r.score <= 1 for r in got) and [r.score for r in got if r.lang_pred == "und"] == [0.0] * 3
    nothing = langid.train(df.limit(0))
    assert nothing == {} and {r.lang_pred for r in langid.predict(df.drop("score"), nothing, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(df.limit(0), model, ["doc_id"]).count() == 0


def test_training_in_flushes(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = langid.train(docs)
    assert all(len(grams) <= langid.PROFILE for grams in want.values()) and set(want) == {"en", "de", "fr", "es"}
