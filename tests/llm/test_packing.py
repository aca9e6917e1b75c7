import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ticklake.llm import packing, token_files, tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "one", "It's a <|endoftext|> test'LL <|startoftext|>x", "ÀÉ naïve Ünïcode  \t\n tabs", "é ́x İstanbul ΣΑΣ", "中文 字符 🙂🙂", "a" * 30_000,
         "word " * 9_000, "12345 1.5e3 $$%%", "x\x1cy\x85z w", "it'S we'RE"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_cached_encoder_equals_library(spark, library):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = tokens.Encoder(WORDS).encode(texts)
    assert tokens.Encoder(WORDS).by_word
    for text, found in zip(texts, got):
        assert np.frombuffer(found, "<u4").tolist() == ids(library, text)


def test_cache_bound(monkeypatch, library):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 8)
    encoder = tokens.Encoder(WORDS)
    texts = [" ".join(f"w{i}x{j} the" for j in range(20)) for i in range(20)]
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u4").tolist() == ids(library, text)
        assert len(encoder.words) <= 8 + 4


def test_words_are_kept_without_the_marks_after_them(library):
    encoder = tokens.Encoder(WORDS)
    texts = ["Alpha, alpha. alpha; (alpha) alpha).\nalpha", "é. 5, a_ b' x's. a-\x1c b-", "x<|endoftext|> y.", "x<|ENDOFTEXT|>. y,", "Д<|ENDOFTEXT|> d. д."]
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u4").tolist() == ids(library, text), text
    assert {w for w in encoder.words if "alpha" in w} == {"alpha", "(alpha"}


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aZé5.,'s-)<\u0338\u0301 \n\t\x1c—Д"), max_size=40))
def test_marks_after_words(text):
    if not hasattr(test_marks_after_words, "lib"):
        test_marks_after_words.lib, test_marks_after_words.enc = Tokenizer.from_file(WORDS), tokens.Encoder(WORDS)
    assert np.frombuffer(test_marks_after_words.enc.encode([text])[0], "<u4").tolist() == ids(test_marks_after_words.lib, text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_cached_encoder_on_any_text(text):
    library = Tokenizer.from_file(WORDS) if not hasattr(test_cached_encoder_on_any_text, "lib") else test_cached_encoder_on_any_text.lib
    test_cached_encoder_on_any_text.lib = library
    encoder = getattr(test_cached_encoder_on_any_text, "enc", None) or tokens.Encoder(WORDS)
    test_cached_encoder_on_any_text.enc = encoder
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids(library, text)


def naive_best_fit(lengths, capacity):
    rooms, where = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            where[i] = min(fits)
        else:
            where[i] = capacity
        rooms.append(where[i] - lengths[i])
    return where, len(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing(lengths):
    sequence, offset, used = packing.best_fit_decreasing(lengths, 64)
    where, bins = naive_best_fit(lengths, 64)
    assert used == bins and all(64 - offset[i] == room for i, room in where.items())
    ends = defaultdict(list)
    for s, o, n in zip(sequence, offset, lengths):
        ends[s].append((o, o + n))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 64 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def check_pieces(rows, docs, library, capacity=2048, end=1):
    want = sorted(tuple(ids(library, t) + [end]) for t in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_seq[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    total = sorted(i for r in rows for i in np.frombuffer(r.ids, "<u4").tolist())
    assert total == sorted(i for w in want for i in w)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and {r.padded_length for r in seq} == {at if at & (at - 1) == 0 else capacity}
    return by_doc, by_seq


def test_pack_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs, WORDS).collect()
    by_doc, by_seq = check_pieces(rows, texts.values(), library)
    for (doc, n), pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == [2048 * k for k in range(len(pieces))]
        assert np.frombuffer(b"".join(p.ids for p in pieces), "<u4").tolist() == ids(library, texts[doc]) + [1]
    used = sum(r.length for r in rows)
    assert len(by_seq) <= -(-used // 2048) + 1  # one more than the least possible


def test_pack_edges(spark, library):
    rows = [(i % 9, t, "x") for i, t in enumerate(TEXTS)] + [(None, "null id", "x"), (1, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = packing.pack(df, WORDS, buffer_ids=3000).collect()
    check_pieces(got, [t for _, t, _ in rows], library)
    assert packing.pack(df.limit(0), WORDS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40), min_size=1, max_size=6))
def test_byte_aligned_coding(docs):
    coded = [token_files.coded(np.array(d, dtype=np.uint32)) for d in docs]
    got = token_files.decoded(np.frombuffer(b"".join(c[0] for c in coded), np.uint8), np.frombuffer(b"".join(c[1] for c in coded), np.uint8),
                              np.array([len(d) for d in docs], dtype=np.int64))
    assert got.tolist() == [x for d in docs for x in d]


def check_files(spark, rows, library, path, end, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, crc int").repartition(4)
    token_files.write_token_files(df, path, WORDS, end_id=end, **more)
    got = token_files.read_token_files(spark, path).collect()
    tail = [] if end is None else [end]
    want = sorted(((i is not None, i), zlib.crc32(x), len(x) // 4, x) for i, t in rows for x in [np.array(ids(library, t) + tail, dtype="<u4").tobytes()])
    start, out = 0, []
    for (_, i), crc, n, x in want:
        out.append((i, start, n, x))
        start += n
    assert sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got), key=lambda r: (r[1], r[2])) == sorted(out, key=lambda r: (r[1], r[2]))


def test_token_files_edges(spark, library, tmp_dir):
    rows = [(i % 9, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (None, "second"), (1, "again"), (1, "again"), (-5, "negative")]
    check_files(spark, rows, library, f"{tmp_dir}/a", 2, volume_ids=5000)
    check_files(spark, rows, library, f"{tmp_dir}/b", None, volume_ids=50)


def test_token_files_whole_table(spark, library, tmp_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_files(spark, rows, library, f"{tmp_dir}/c", 2)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    token_files.write_token_files(empty, f"{tmp_dir}/d", WORDS)
    assert token_files.read_token_files(spark, f"{tmp_dir}/d").count() == 0
