import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from ticklake.llm import sentencepiece_codec as codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = codec.load(PATH)


def naive(text):
    """Viterbi over the whole text, one piece at a time."""
    if not text:
        return []
    shown = codec.SPACE + text.replace(" ", codec.SPACE)
    best, back = [0.0] + [float("-inf")] * len(shown), [None] * (len(shown) + 1)
    for i in range(1, len(shown) + 1):
        for n in range(min(MODEL.longest, i), 0, -1):
            piece = MODEL.id_of.get(shown[i - n:i])
            score = MODEL.scores[piece] if piece is not None else MODEL.unknown_score if n == 1 else None
            if score is not None and best[i - n] + score > best[i]:
                best[i], back[i] = best[i - n] + score, (n, piece)
    ids, i = [], len(shown)
    while i:
        n, piece = back[i]
        ids = ([piece] if piece is not None else [MODEL.bytes_of[b] for b in shown[i - 1].encode()]) + ids
        i -= n
    return ids


def encoded(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in MODEL.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aehnort  \n\t1é中🙂\u0000▁") | st.characters(exclude_categories=["Cs"]), max_size=50), max_size=4))
def test_viterbi_equals_brute_force(texts):
    got = encoded(texts)
    assert got == [naive(t) for t in texts]
    for t, ids in zip(texts, got):
        assert MODEL.decode(np.array(ids, dtype="<u4").tobytes()) == t.replace(codec.SPACE, " ")


def test_library_agrees_as_unigram_model():
    """The library's own unigram encoder on the same pieces and scores (plain words: no sum loses precision)."""
    raw = open(PATH, "rb").read()
    at = raw.index(b"\x18\x02", raw.index(b"tok_v0"))  # trainer_spec.model_type: BPE
    library = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2:])
    rng = random.Random(0)
    texts = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 12))) for _ in range(500)]
    assert encoded(texts) == [library.encode(t) for t in texts]


def test_pieces_as_the_library_reads_them():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert MODEL.pieces == [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert MODEL.scores == [library.get_score(i) for i in range(library.get_piece_size())]


def test_long_part_in_blocks(monkeypatch):
    text = "".join(random.Random(2).choice("eathon") for _ in range(3000))
    whole = encoded([text])
    monkeypatch.setattr(codec, "CELLS", 500)
    fresh = codec.Model(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in fresh.encode([text])] == whole == [naive(text)]
    very_long = "ab" * 100_000
    ids = codec.Model(PATH).encode([very_long])[0]
    assert MODEL.decode(ids) == very_long


def test_cache_bound(monkeypatch):
    monkeypatch.setattr(codec, "CACHED_PARTS", 10)
    fresh = codec.Model(PATH)
    texts = [" ".join(f"w{i}x{j} the" for j in range(30)) for i in range(10)] + [None, ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in fresh.encode(texts)] == [naive(t) for t in texts]


def test_round_trip_of_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in codec.decode(codec.encode(docs, PATH), PATH).collect():
        assert r.text == texts[r.doc_id] and len(r.ids) == 4 * r.n_tokens
        if len(r.text) < 1000:
            assert np.frombuffer(r.ids, "<u4").tolist() == naive(r.text) and zlib.crc32(r.ids) > 0


def test_edges(spark):
    rows = [(1, None, 0), (2, "", 0), (None, " a  b ", 0), (1, "again\x00", 0), (1, "again\x00", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = codec.decode(codec.encode(df, PATH), PATH).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.text) for r in got) == sorted((i is not None, i, t or "") for i, t, _ in rows)
    assert codec.encode(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("ids", [[1, 2], [3 + 0xFF], [5, 31999], [270, 0, 280]])
def test_decode_like_library(ids):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert MODEL.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids)
