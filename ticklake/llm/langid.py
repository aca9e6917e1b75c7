"""Language identification by rank-order profiles.

A language's profile is the ranking of its most frequent letter n-grams (1 to 3 letters, words padded
with a space on either side) over all its training texts.  A document's own ranking is compared with each
profile by out-of-place distance: the sum of rank differences, and ``profile`` for an n-gram that the
profile lacks.  The nearest language wins; of equal distances, the first in alphabetical order.

An n-gram is one 64-bit integer (21 bits a character), so counting is sorting integers in numpy and
cannot collide.  Training counts are summed in each task before they are shuffled; the most frequent of
each language are found in two steps (by hash bucket, then of those), so that no task holds all n-grams of
a language.  The model that goes to the tasks has at most ``profile`` rows a language.

Any text in the same letters shares short n-grams with every profile, so noise scores well above 0: random
Latin words 0.15 to 0.3 in long texts, and more the shorter the text.  :func:`least_scores` learns from the training texts,
and from pieces of them, what a text with so many distinct n-grams scores at least.

Defined cases: a text that is null or has no letter gives ``und`` with score 0, and so does every text if
nothing was learned; null labels are not learned; long texts are counted in slices; equal counts are
ranked by the n-gram's characters; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.llm.common import by_batch

UNKNOWN = "und"
PROFILE = 400
BUCKETS = 64
SLICE = 1_000_000
FLUSH = 1_000_000
#: The least score is this quantile of the training scores, times a margin for texts that were not trained on.
LOW = 0.01
MARGIN = 0.65
BINS = 1000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _grams(codes: np.ndarray) -> np.ndarray:
    """The n-grams of a padded, space-separated run of letters (it begins and ends with a space)."""
    space = codes == 32
    c = codes.astype(np.int64)
    two = c[:-1] << 21 | c[1:]
    three = (two[:-1] << 21 | c[2:])[~space[1:-1]]
    return np.concatenate([c[~space], two[~(space[:-1] & space[1:])], three])


def _padded(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_letters()[codes], codes, 32)
    codes = np.concatenate([[32], codes, [32]])
    return codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and their counts."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (ascending) of a whole text and their counts; empty without letters."""
    if not text:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    codes = _padded(text)
    if len(codes) <= 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if len(codes) <= SLICE:
        return _summed(_grams(codes))
    spaces, begin, parts = np.flatnonzero(codes == 32), 0, []
    while begin < len(codes) - 1:  # slices end at a space, so that no n-gram is lost or made; a longer word is one slice
        k = np.searchsorted(spaces, begin + SLICE, side="right") - 1
        end = spaces[k] if spaces[k] > begin else spaces[k + 1]
        parts.append(_summed(_grams(codes[begin:end + 1])))
        # the space between two slices ends one word and begins the next: no unigram of it is counted
        begin = end
    return _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def ranked(keys: np.ndarray, counts: np.ndarray, profile: int) -> np.ndarray:
    """The most frequent keys, most frequent first, equal counts by key."""
    order = np.argsort(-counts, kind="stable")
    return keys[order[:profile]]


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> dict[str, list[int]]:
    """Profile of each label over all rows with a label: its n-grams, most frequent first."""
    def make():
        kept: dict[str, list] = {}
        held = {"n": 0}

        def merged():
            for lang, parts in kept.items():
                keys, counts = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield lang, keys, counts

        def out():
            for lang, keys, counts in merged():
                for i in range(0, len(keys), 100_000):
                    n = len(keys[i:i + 100_000])
                    yield {"lang": pa.array([lang] * n, type=pa.string()), "gram": keys[i:i + 100_000], "seen": counts[i:i + 100_000].astype(np.int64)}
            kept.clear()
            held["n"] = 0

        def step(columns):
            if columns is None:
                yield from out()
                return
            for text, lang in zip(columns[0].to_pylist(), columns[1].to_pylist()):
                found = gram_counts(text)
                if len(found[0]):
                    kept.setdefault(lang, []).append(found)
                    held["n"] += len(found[0])
                if held["n"] > FLUSH:
                    for name, keys, counts in list(merged()):
                        kept[name] = [(keys, counts)]
                    held["n"] = sum(len(p[0][0]) for p in kept.values())
                    if held["n"] > FLUSH // 2:
                        yield from out()

        return step

    labelled = df.where(F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col))
    seen = by_batch(labelled, make, "lang string, gram bigint, seen bigint", finish=True).groupBy("lang", "gram").agg(F.sum("seen").alias("seen"))
    order = [F.desc("seen"), F.asc("gram")]
    part = seen.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)))
    for keys in (["lang", "bucket"], ["lang"]):
        part = part.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= profile)
    model: dict[str, list[int]] = {}
    for row in part.select("lang", "gram", "place").orderBy("lang", "place").collect():  # at most ``profile`` rows a label
        model.setdefault(row.lang, []).append(row.gram)
    return model


class Classifier:
    def __init__(self, model: dict[str, list[int]], profile: int = PROFILE):
        self.langs, self.profile = sorted(model), profile
        self.keys = np.array(sorted({g for grams in model.values() for g in grams}), dtype=np.int64)
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), -1, dtype=np.int64)  # -1: not in the profile
        for row, lang in enumerate(self.langs):
            self.ranks[row, np.searchsorted(self.keys, np.array(model[lang], dtype=np.int64))] = np.arange(len(model[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Label and score: 1 minus the distance's share of the largest possible one."""
        return self.judged(text)[:2]

    def judged(self, text: str | None) -> tuple[str, float, int]:
        """Label, score and the number of distinct n-grams."""
        keys, counts = gram_counts(text)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0, len(keys)
        top = ranked(keys, counts, self.profile)
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        at = np.where(self.keys[at] == top, at, len(self.keys))
        ranks = self.ranks[:, at]
        far = np.where(ranks < 0, self.profile, np.abs(ranks - np.arange(len(top)))).sum(axis=1)
        best = int(far.argmin())
        return self.langs[best], 1.0 - float(far[best]) / (len(top) * self.profile), len(keys)


def size_class(n: int) -> int:
    """Half octave of a number of distinct n-grams (at least 1)."""
    return (n * n).bit_length() - 1


def pieces(text: str) -> list[str]:
    """A text, and of it one run each of 1, 2, 4, ... words, at a place that the text's hash chooses."""
    words = text[:SLICE].split()
    out, k, seed = [text], 1, zlib.crc32(text[:SLICE].encode("utf-8", "surrogatepass"))
    while k < len(words):
        begin = seed * (2 * k + 1) % (len(words) - k + 1)
        out.append(" ".join(words[begin:begin + k]))
        k *= 2
    return out


def least_scores(df: DataFrame, model: dict[str, list[int]], text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> dict[int, float]:
    """The least score of a text in a learned language, by :func:`size_class` of its number of distinct n-grams.

    Every training text counts with its own score and those of its :func:`pieces`, so that short texts are
    measured by short ones.  Scores are counted in ``BINS`` steps per task, so one row a class and step is shuffled.
    A class of fewer than 1 / ``LOW`` scores has no such quantile and is left out.
    """
    def make():
        classifier = Classifier(model, profile)
        seen: Counter = Counter()

        def step(columns):
            if columns is None:
                keys = sorted(seen)
                return {"size": np.array([k[0] for k in keys], dtype=np.int64), "bin": np.array([k[1] for k in keys], dtype=np.int64),
                        "n": np.array([seen[k] for k in keys], dtype=np.int64)} if keys else None
            for text in columns[0].to_pylist():
                for piece in pieces(text or ""):
                    _, score, n = classifier.judged(piece)
                    if n:
                        seen[size_class(n), int(score * BINS)] += 1

        return step

    labelled = df.where(F.col(lang_col).isNotNull()).select(text_col)
    counted = by_batch(labelled, make, "size bigint, bin bigint, n bigint", finish=True).groupBy("size", "bin").agg(F.sum("n").alias("n"))
    below = Window.partitionBy("size").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked_ = counted.withColumn("to", F.sum("n").over(below)).withColumn("all", F.sum("n").over(Window.partitionBy("size")))
    low = ranked_.where((F.col("all") >= 1 / LOW) & (F.col("to") > F.col("all") * LOW)).groupBy("size").agg(F.min("bin").alias("bin"))
    return {r["size"]: MARGIN * r["bin"] / BINS for r in low.collect()}  # a row a class


def least_score(least: dict[int, float], n: int) -> float:
    """The least score for ``n`` distinct n-grams; a class that was left out takes the lower one of its neighbours.

    A score is a mean over the n-grams, so its spread grows as they get fewer, and the least score falls by 1 / sqrt(n).
    """
    if not least:
        return 0.0
    size = size_class(n)
    near = [max((k for k in least if k <= size), default=None), min((k for k in least if k >= size), default=None)]
    return min(least[k] for k in near if k is not None) * (1 - n ** -0.5)


def predict(df: DataFrame, model: dict[str, list[int]], id_cols: list[str], text_col: str = "text", profile: int = PROFILE,
            least: dict[int, float] | None = None) -> DataFrame:
    """``id_cols`` with lang_pred and score.  The text is the only input of a prediction.  No shuffle.

    With ``least`` (see :func:`least_scores`), a text that scores below it is in no learned language: ``und``, with its score.
    """
    def make():
        classifier = Classifier(model, profile)

        def judged(text):
            lang, score, n = classifier.judged(text)
            return (UNKNOWN if least and n and score < least_score(least, n) else lang), score

        def step(columns):
            found = [judged(t) for t in columns[-1].to_pylist()]
            return {**dict(zip(id_cols, columns)), "lang_pred": pa.array([f[0] for f in found], type=pa.string()),
                    "score": np.array([f[1] for f in found], dtype=np.float64)}

        return step

    kinds = dict(df.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in id_cols] + ["lang_pred string", "score double"])
    return by_batch(df.select(*id_cols, F.col(text_col)), make, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 4, is 2 (a null id is not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
