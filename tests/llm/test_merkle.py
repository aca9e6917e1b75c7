import hashlib

from hypothesis import given, settings, strategies as st

from ticklake.llm import merkle


def texts_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, fingerprint string")


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 4
        new = text[:len(text) - k] + following[:k]
        a, b, c = (merkle.fingerprint(t) for t in (text, new, following))
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, merkle.likeness(a, b), merkle.likeness(a, c)))
    return out


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in merkle.edit_likeness(docs.repartition(7)).collect())
    assert got == sorted(expected(rows))
    likely = [r[5] - r[6] for r in got if r[1] > 100 and r[6] < 0.5]
    assert sum(x > 0.4 for x in likely) / len(likely) > 0.95


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "abc"), (4, "é" * 9 + "🙂"), (4, "same id"), (None, "null id\nx"), (7, "w " * 200_000), (7, "w " * 200_000)]
    got = sorted((tuple(r) for r in merkle.edit_likeness(texts_of(spark, rows).repartition(5)).collect()), key=str)
    assert got == sorted(expected(rows), key=str)
    alone = [(9, "only one document here")]
    assert [tuple(r) for r in merkle.edit_likeness(texts_of(spark, alone)).collect()] == expected(alone)
    assert merkle.edit_likeness(texts_of(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n."), max_size=60), st.text(st.sampled_from("ab \n."), max_size=60))
def test_roots_test_equality(a, b):
    x, y = merkle.fingerprint(a), merkle.fingerprint(b)
    assert (x == y) == (a == b) and (x.split(":")[0] == y.split(":")[0]) == (a == b)
    like = merkle.likeness(x, y)
    assert 0 <= like <= 1 and like == merkle.likeness(y, x) and (like == 1.0 or a != b)
    assert (merkle.differences(x, y) == []) == (a == b) or len(a) < len(b)


def test_differences_locate_an_edit():
    lines = [f"paragraph {i} has some words of its own number {i * 7}" for i in range(40)]
    new = lines[:]
    new[17] = new[17].replace("words", "terms")
    a, b = merkle.fingerprint("\n".join(lines)), merkle.fingerprint("\n".join(new))
    found = merkle.differences(a, b)
    assert found and all(0.95 < merkle.likeness(a, b) < 1 for _ in [0])
    shown = a.split(":")[1].split("/")
    flat = [(s, p) for s, section in enumerate(shown) for p in range(len(section.split(",")))]
    assert (found[0][0], found[0][1]) == flat[17] and found[0][2] == 1


def test_paragraph_cache_changes_nothing():
    build = merkle.Builder()
    for t in ("a b c d e\nf", "a b c d e\ng", "", "f\nf\nf"):
        assert build.tree(t) == merkle.fingerprint(t)
