"""SentencePiece encoding and decoding by batched numpy Viterbi.

The pieces and scores of a SentencePiece model file are read from the file itself.  A text's ids are the
segmentation with the largest sum of piece scores; of equal sums, the one whose last piece is longest, and
so on from the end (the rule of the library's unigram encoder).  A character that is no piece becomes
its UTF-8 bytes' ids (byte fallback) or the unknown id.

How a batch is encoded:

1.  Texts are cut where no piece can cross: before a space run that follows another character, at line
    feeds, and between two neighbours that are neighbours in no piece.  So the parts' best
    segmentations are the whole text's, and a bounded cache of parts serves most of them.
2.  New parts of equal length advance together: one row per part, one step per character.
3.  Hashes of all substrings up to the longest piece come from prefix hashes and probe the sorted hashes
    of the pieces (``searchsorted``); the score is minus infinity where there is no such piece.
4.  In each step the maximum over the piece lengths is taken for all rows at once and its length is stored
    as the backpointer.  The pieces found are compared with the part's characters, so that a hash
    collision cannot pass unseen.

Defined cases: null and empty texts have no ids and decode to the empty text; long parts are worked on in
blocks of positions, so memory stays bounded; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticklake.llm.common import by_batch

# Fixed values of the model file format (piece types) and of its text form.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"
#: Parts of one generation of a cache; there are a young one and an old one.
CACHED_PARTS = 250_000
#: Leading bits of a hash by which its place among the sorted keys is looked up.
LEAD = 17
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
CELLS = 400_000


def _messages(data: bytes):
    """(field number, value) of a protobuf message: int, 4 raw bytes or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield key >> 3, data[at:at + size]
            at += size


class Model:
    """Pieces of a model file and the Viterbi encoder over them."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            fields = list(_messages(f.read()))
        self.pieces, self.scores, self.kinds = [], [], []
        self.dummy_prefix, self.fold_spaces = True, True
        for number, value in fields:
            if number == 1:
                piece = dict(_messages(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 3:
                spec = dict(_messages(value))
                if spec.get(2):
                    raise ValueError("model files with a character map are not supported")
                self.dummy_prefix, self.fold_spaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if self.fold_spaces:
            raise ValueError("model files that remove extra white space are not supported")
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes_of = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED)}
        self.longest = max(map(len, self.id_of))
        # a character that is no piece scores below any real segmentation
        self.unknown_score = min(self.scores[i] for i in self.id_of.values()) - 10.0
        self._hash_pieces()
        pairs = {p[i:i + 2] for p in self.id_of for i in range(len(p) - 1)}
        if any(a != SPACE and b == SPACE for a, b in pairs):
            raise ValueError("pieces with a space after another character are not supported")
        self.neighbours = frozenset(a + b for a, b in pairs)
        self.pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs), dtype=np.int64)
        self.split = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if not any("\n" in p for p in self.id_of) else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.plain = [self._plain(p, k) for p, k in zip(self.pieces, self.kinds)]
        self.cache: dict[str, bytes] = {}  # of parts
        self.old_cache: dict[str, bytes] = {}
        self.cuts: dict[str, bytes] = {}  # of what parts are cut into
        self.old_cuts: dict[str, bytes] = {}

    def _hash_pieces(self) -> None:
        power = np.ones(self.longest + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(1, self.longest + 1):
                power[i] = power[i - 1] * BASE
        self.power = power
        keys, ids = [], []
        for piece, i in self.id_of.items():
            h = self.prefix_hashes(np.array([[ord(c) for c in piece]], dtype=np.uint64))[0, -1]
            keys.append(h)
            ids.append(i)
        order = np.argsort(np.array(keys, dtype=np.uint64))
        self.keys, self.key_ids = np.array(keys, dtype=np.uint64)[order], np.array(ids, dtype=np.int32)[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have the same hash")
        self.lead_start = np.searchsorted(self.keys >> np.uint64(64 - LEAD), np.arange((1 << LEAD) + 1, dtype=np.uint64))
        self.key_scores = np.array([self.scores[i] for i in self.key_ids])

    @staticmethod
    def _mixed(codes: np.ndarray) -> np.ndarray:
        x = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def prefix_hashes(self, codes: np.ndarray) -> np.ndarray:
        """Polynomial hashes of every prefix (columns 0..length), modulo 2**64."""
        rows, length = codes.shape
        out = np.zeros((rows, length + 1), dtype=np.uint64)
        mixed = self._mixed(codes)
        with np.errstate(over="ignore"):
            for i in range(length):
                out[:, i + 1] = out[:, i] * BASE + mixed[:, i]
        return out

    def _plain(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    # encoding -----------------------------------------------------------------------------------

    def _fallback(self, char: str) -> list[int]:
        if not self.bytes_of:
            return [self.unknown]
        return [self.bytes_of[b] for b in char.encode("utf-8", "surrogatepass")]

    def _cut(self, part: str) -> list[str]:
        """Cut where no piece has the two neighbours side by side."""
        if len(part) <= self.longest:  # a last character (as a rule punctuation) that no piece joins to the word
            return [part] if len(part) < 2 or part[-2:] in self.neighbours else [part[:-1], part[-1]]
        codes = np.frombuffer(part.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        pairs = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        cuts = [0, *(np.flatnonzero(self.pairs[at] != pairs) + 1).tolist(), len(part)]
        return [part[a:b] for a, b in zip(cuts, cuts[1:])]

    def _probe(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the sorted piece keys, or -1.  Its first bits name the few keys that begin alike;
        for most substrings there are none."""
        lead = (hashes >> np.uint64(64 - LEAD)).astype(np.int32)
        at = self.lead_start[lead]
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.flatnonzero(at < self.lead_start[lead + 1])
        while len(left):
            here = at[left]
            equal = self.keys[here] == hashes[left]
            out[left[equal]] = here[equal]
            at[left] += 1
            left = left[~equal & (here + 1 < self.lead_start[lead[left] + 1])]
        return out

    def viterbi(self, parts: list[str]) -> list[bytes]:
        """Best ids of each part (little-endian); all have the same length."""
        rows, length = len(parts), len(parts[0])
        most = min(self.longest, length)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(rows, length)
        prefix = self.prefix_hashes(codes.astype(np.uint64))
        best = np.full((rows, length + 1 + most), -np.inf)  # column i + most: best score of the first i characters
        best[:, most] = 0.0
        back = np.zeros((rows, length + 1), dtype=np.int32)
        piece = np.zeros((rows, length + 1), dtype=np.int32)
        block = max(1, CELLS // (rows * most))
        sizes = np.arange(most, 0, -1)  # longest first, so that argmax takes the longest of equal sums
        row = np.arange(rows)
        for begin in range(1, length + 1, block):
            ends = np.arange(begin, min(begin + block, length + 1))
            starts = ends[:, None] - sizes
            inside = np.maximum(starts, 0)
            with np.errstate(over="ignore"):
                hashes = prefix[:, ends][:, :, None] - prefix[:, inside] * self.power[sizes]
            at = self._probe(hashes.ravel()).reshape(hashes.shape)
            found = (at >= 0) & (starts >= 0)
            score = np.where(found, self.key_scores[at], -np.inf)
            ids = np.where(found, self.key_ids[at], -1)
            lone = ~found[:, :, -1]
            score[:, :, -1] = np.where(lone, self.unknown_score, score[:, :, -1])
            for k, i in enumerate(ends):
                total = best[:, i:i + most] + score[:, k]
                choice = total.argmax(axis=1)
                best[:, i + most] = total[row, choice]
                back[:, i] = sizes[choice]
                piece[:, i] = ids[row, k, choice]
        # all rows go back together, one piece at a time
        ids, count, at = np.zeros((rows, length), dtype="<u4"), np.zeros(rows, dtype=np.int64), np.full(rows, length)
        unknown = np.zeros(rows, dtype=bool)
        left = row
        while len(left):
            found = piece[left, at[left]]
            unknown[left] |= found < 0
            count[left] += 1
            ids[left, length - count[left]] = np.maximum(found, 0)
            at[left] -= back[left, at[left]]
            left = left[at[left] > 0]
        out = [ids[r, length - n:].tobytes() for r, n in enumerate(count.tolist())]
        pieces = self.pieces
        for r, part in enumerate(parts):
            if unknown[r]:
                out[r] = self._with_fallback(part, back[r], piece[r])
            elif "".join([pieces[i] for i in ids[r, length - count[r]:].tolist()]) != part:
                raise ValueError(f"hash collision in {part!r}")
        return out

    def _with_fallback(self, part: str, back: np.ndarray, piece: np.ndarray) -> bytes:
        """Ids of a part that has characters which are no piece."""
        i, ids = len(part), []
        while i:
            n, p = int(back[i]), int(piece[i])
            if p < 0:
                ids.extend(reversed(self._fallback(part[i - 1])))
            elif self.pieces[p] != part[i - n:i]:
                raise ValueError(f"hash collision in {part!r}")
            else:
                ids.append(p)
            i -= n
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def _learn(self, parts: list[str]) -> None:
        """Encode parts that are not in the young generation of the cache."""
        old, pieces = self.old_cache, {}
        for part in parts:
            found = old.get(part)
            if found is None:
                pieces[part] = self._cut(part)
            else:
                self.cache[part] = found
        wanted = {x for cut in pieces.values() for x in cut}
        if len(self.cuts) + len(wanted) > CACHED_PARTS:
            self.cuts, self.old_cuts = {}, self.cuts
        known, by_length = self.cuts, {}
        for x in wanted:
            if x not in known:
                found = self.old_cuts.get(x)
                if found is None:
                    by_length.setdefault(len(x), []).append(x)
                else:
                    known[x] = found
        for length, own in by_length.items():
            step = max(1, CELLS // (length * self.longest))
            for i in range(0, len(own), step):
                known.update(zip(own[i:i + step], self.viterbi(own[i:i + step])))
        for part, cut in pieces.items():
            self.cache[part] = known[cut[0]] if len(cut) == 1 else b"".join([known[x] for x in cut])

    def parts(self, text: str) -> list[str]:
        shown = text.replace(" ", SPACE)
        return self.split.findall(SPACE + shown if self.dummy_prefix else shown)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, waiting = [b""] * len(texts), []
        new: set[str] = set()

        def settle():
            if len(self.cache) + len(new) > CACHED_PARTS:
                self.cache, self.old_cache = {}, self.cache
                new.update(*(set(p) for _, p in waiting))
            self._learn(list(new))
            for k, parts in waiting:
                out[k] += b"".join(map(self.cache.__getitem__, parts))
            new.clear()
            waiting.clear()

        for k, text in enumerate(texts):
            if not text:
                continue
            parts = self.parts(text)
            for i in range(0, len(parts), CACHED_PARTS // 4):  # a very long text: in portions
                portion = parts[i:i + CACHED_PARTS // 4]
                new.update(set(portion).difference(self.cache))
                waiting.append((k, portion))
                if len(new) > CACHED_PARTS // 4:
                    settle()
        settle()
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.plain.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        if self.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers.  No shuffle."""
    def make():
        m = load(model)

        def step(columns):
            for i in range(0, len(columns[0]), 256):
                found = m.encode(columns[1].slice(i, 256).to_pylist())
                yield {"doc_id": columns[0].slice(i, 256), "n_tokens": np.array([len(x) // 4 for x in found], dtype=np.int64),
                       "ids": pa.array(found, type=pa.binary())}

        return step

    return by_batch(df.select(F.col(id_col).cast("bigint"), F.col(text_col)), make, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text) of encoded rows.  No shuffle."""
    def make():
        m = load(model)

        def step(columns):
            for i in range(0, len(columns[0]), 256):
                part = [c.slice(i, 256) for c in columns]
                yield {"doc_id": part[0], "n_tokens": part[1], "ids": part[2], "text": pa.array([m.decode(x or b"") for x in part[2].to_pylist()], type=pa.string())}

        return step

    return by_batch(encoded.select("doc_id", "n_tokens", "ids"), make, "doc_id bigint, n_tokens bigint, ids binary, text string")
