import base64
import random

import corpus_pipeline
from ticklake.llm import langid, pii, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == COLUMNS and kept.dtypes == docs.dtypes
    stayed = {r.doc_id for r in kept.collect()}
    assert all(before[i].text is None or not any(c.isalpha() for c in before[i].text) for i in set(before) - stayed)
    single = corpus_pipeline.near_duplicates(spark, kept, SF)
    groups = {}
    for r in simhash.near_duplicates(kept).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(min(g) for g in groups.values()) and single.columns == COLUMNS
    clean = corpus_pipeline.personal_data(spark, single, SF)
    assert clean.columns == COLUMNS and clean.dtypes == docs.dtypes
    for r in clean.collect():
        assert r.n_chars == len(r.text) and pii.base_spans(r.text) == []
        assert pii.base_spans(before[r.doc_id].text) or r.text == before[r.doc_id].text
    pieces = corpus_pipeline.pack(spark, clean, SF)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in clean.collect()}


def test_run_equals_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    got = corpus_pipeline.run(spark, SF).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, docs.select(names).collect()))


def test_stages_on_odd_rows(spark):
    rows = [(1, "the cat sat on the mat with the dog", "en", "s", 1, "x"), (1, "the cat sat on the mat with the dog", "en", "s", 1, "x"),
            (None, "the cat sat on the mat with the dog", None, None, None, None), (2, None, "en", "s", 0, "x"), (3, "", "en", "s", 0, "x"), (4, "42", "en", "s", 2, "x"),
            (5, "write to a@b.com or the cat sat on it", "en", None, 37, None), (7, "the THE " * 100_000, "en", "s", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string")
    out = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == df.columns and out.dtypes == df.dtypes, name
    got = out.collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 5, 7]
    assert next(r.text for r in got if r.doc_id == 5) == "write to [EMAIL] or the cat sat on it"
    empty = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
    assert langid.UNKNOWN == "und"


def test_near_duplicates_are_told_apart_by_id_and_text(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "ABCD"}
    names = ["gone", "again", "component_id", "fp", "digest", "_id", "first"]
    rows = [(i, texts[k], "en", "s", 1, *names) for i, k in ((1, "A"), (2, "A"), (2, "B"), (3, "C"), (3, "D"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names))
    out = corpus_pipeline.near_duplicates(spark, df, SF)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text[0]) for r in out.collect()) == [(1, "A"), (2, "B"), (3, "C"), (3, "D")]
    twice = df.unionByName(df.withColumn("gone", df.doc_id.cast("string")))  # the least row of a repeated one stays
    assert {(r.doc_id, r.text[0], r.gone) for r in corpus_pipeline.near_duplicates(spark, twice, SF).collect()} == {
        (1, "A", "1"), (2, "B", "2"), (3, "C", "3"), (3, "D", "3")}


def test_near_duplicates_shuffle_only_sifted_texts(spark):
    text = " ".join(f"A{i}" for i in range(40))
    df = spark.createDataFrame([(i, text, "en", "s", 1) for i in (1, 1, 2)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.near_duplicates(spark, df, SF)
        plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [(r.doc_id, r.text) for r in out.collect()] == [(1, text)]
    joins = [i for i, line in enumerate(plan) if "Join " in line and "_digest" in line]
    sifts = [i for i, line in enumerate(plan) if "getbit" in line]
    assert len(joins) == 2 and all(any(i < k < i + 4 for k in sifts) for i in joins), "\n".join(plan)


FINNISH = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
           "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.")
POLISH = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
          "i powinni postępować wobec innych w duchu braterstwa.")
ITALIAN = ("Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono "
           "agire gli uni verso gli altri in spirito di fratellanza.")
ENGLISH = ("All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act "
           "towards one another in a spirit of brotherhood.")


def test_language_rejects_latin_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(COLUMNS)
    rnd = random.Random(5)

    def words(letters, low, high, n):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in range(n))

    az = "abcdefghijklmnopqrstuvwxyz"
    noise = [words(az, 2, 10, n) for n in (30, 100, 400)] + [words(az, 1, 3, 200), words(az, 20, 40, 30), words("abcdef", 3, 9, 200)]
    noise += [base64.b64encode(rnd.randbytes(n)).decode() for n in (120, 400, 4000)] + [FINNISH, POLISH, ITALIAN, "Все люди рождаются свободными"]
    clean = ["ok", "Hello world", "the cat sat on the mat with the dog", ENGLISH]
    odd = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(noise + clean)]
    kept = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(odd, docs.schema)), "")
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert [t[:30] for i, t, *_ in odd if i in ids] == [t[:30] for t in clean]
    assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids  # every labelled document stays
