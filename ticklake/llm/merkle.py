"""Document fingerprints: a Merkle tree over sections, paragraphs and word groups.

A text's lines are its paragraphs.  A paragraph is cut into leaves of ``LEAF_WORDS`` space-separated words,
counted from its beginning.  A section ends with a paragraph whose digest is 0 modulo ``SECTION``, or at
the end of the text, so an edit moves no section boundary but those of the paragraphs it touches.  Digests
are 128-bit BLAKE2b over the children's digests with the node's level; so equal roots mean equal texts, and
walking down from differing roots into differing branches finds the edited leaves (:func:`differences`).

A fingerprint is text: the root's digest, then the sections separated by ``/``, their paragraphs by ``,``,
each paragraph being its leaves' digests cut to 6 hex digits.  :func:`likeness` is 1 for equal roots and else
the number of leaves the two have in common (each counted as often as it occurs in both) over the larger
number of leaves, looking only at differing branches.

Defined cases: a null text is an empty one; it has one empty leaf; rows that repeat an id are ordered by
text, null ids come first; the only document of a table is its own next one; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from ticklake.llm.common import by_batch

LEAF_WORDS = 4
SECTION = 8
SHOWN = 6


def _digest(level: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(level + data, digest_size=16).digest()


def _paragraph(line: str) -> list[bytes]:
    """Digests of a paragraph's leaves."""
    words = line.split(" ")
    new = hashlib.blake2b
    return [new((" ".join(words[i:i + LEAF_WORDS])).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            for i in range(0, len(words), LEAF_WORDS)]


class Builder:
    """Builds trees; keeps the paragraphs of the last text, since an edited text shares most of them."""

    def __init__(self):
        self.known: dict[str, tuple[bytes, str]] = {}

    def tree(self, text: str) -> str:
        """The fingerprint of a text."""
        known, fresh = self.known, {}
        sections, shown, own, own_shown = [], [], [], []
        for line in text.split("\n"):
            node = known.get(line) or fresh.get(line)
            if node is None:
                leaves = _paragraph(line)
                node = _digest(b"p", b"".join(leaves)), "".join([x.hex()[:SHOWN] for x in leaves])
            fresh[line] = node
            own.append(node[0])
            own_shown.append(node[1])
            if node[0][0] % SECTION == 0:
                sections.append(_digest(b"s", b"".join(own)))
                shown.append(",".join(own_shown))
                own, own_shown = [], []
        if own:
            sections.append(_digest(b"s", b"".join(own)))
            shown.append(",".join(own_shown))
        self.known = fresh
        return _digest(b"r", b"".join(sections)).hex() + ":" + "/".join(shown)


def fingerprint(text: str | None) -> str:
    return Builder().tree(text or "")


def _leaves(paragraph: str) -> list[str]:
    return [paragraph[i:i + SHOWN] for i in range(0, len(paragraph), SHOWN)]


def _count(paragraphs: Counter) -> int:
    return sum(len(p) // SHOWN * n for p, n in paragraphs.items())


def likeness(a: str, b: str) -> float:
    """Share of common leaves, from two fingerprints: 0 to 1, and 1 for equal ones."""
    (root_a, _, body_a), (root_b, _, body_b) = a.partition(":"), b.partition(":")
    if root_a == root_b:
        return 1.0
    pa_, pb = Counter(body_a.replace("/", ",").split(",")), Counter(body_b.replace("/", ",").split(","))
    most = max(_count(pa_), _count(pb))
    same = pa_ & pb  # equal branches are not opened
    common = _count(same)
    pa_.subtract(same)
    pb.subtract(same)
    left, right = Counter(), Counter()
    for source, into in ((pa_, left), (pb, right)):
        for paragraph, n in source.items():
            if n > 0:
                for leaf in _leaves(paragraph):
                    into[leaf] += n
    common += sum((left & right).values())
    return min(common / most, 1.0) if most else 0.0


def differences(a: str, b: str) -> list[tuple[int, int, int]]:
    """Where two fingerprints differ: (section, paragraph, leaf) in the first one's numbering, going down
    only into branches that differ from the branch at the same place of the other one."""
    (root_a, _, body_a), (root_b, _, body_b) = a.partition(":"), b.partition(":")
    if root_a == root_b:
        return []
    sections, others = body_a.split("/"), body_b.split("/")
    found = []
    for s, section in enumerate(sections):
        other = others[s] if s < len(others) else None
        if section == other:
            continue
        paragraphs, its = section.split(","), (other or "").split(",")
        for p, paragraph in enumerate(paragraphs):
            leaves, theirs = _leaves(paragraph), _leaves(its[p]) if p < len(its) else []
            if paragraph == (its[p] if p < len(its) else None):
                continue
            found += [(s, p, k) for k, leaf in enumerate(leaves) if k >= len(theirs) or theirs[k] != leaf]
    return found


def document_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row.  No shuffle."""
    def make():
        def step(columns):
            texts = [t or "" for t in columns[1].to_pylist()]
            build = Builder()
            return {"doc_id": columns[0], "n_chars": np.array([len(t) for t in texts], dtype=np.int64),
                    "fingerprint": pa.array([build.tree(t) for t in texts], type=pa.string())}

        return step

    return by_batch(df.select(F.col(id_col).cast("bigint"), F.col(text_col)), make, "doc_id bigint, n_chars bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k] if k else text


ROW = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
      "near_edited double, near_next double"
KINDS = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
         "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}


def _row(build: Builder, doc, text: str, print_: str, following: str, next_print: str) -> tuple:
    new = edited(text, following)
    new_print = build.tree(new) if new != text else print_
    return (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), print_, new_print,
            likeness(print_, new_print), likeness(print_, next_print))


def _columns(rows: list[tuple]) -> dict:
    cells = list(zip(*rows)) or [()] * len(KINDS)
    return {n: pa.array(c, type=k) for (n, k), c in zip(KINDS.items(), cells)}


def _parts(ids: DataFrame, count: int) -> tuple[Callable[[DataFrame], DataFrame], list[tuple[int, int | None]]]:
    """What adds ``part``, ranges of the id of about equal size, to rows with doc_id; and (part, first id) of
    every part in order.  A null id is in part 0, before all others.  The driver gets ``count`` bounds."""
    bounds = sorted({float(b) for b in ids.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.001)})
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_place", outputCol="_part")

    def parted(df: DataFrame) -> DataFrame:
        if not bounds:
            return df.withColumn("part", F.lit(0))
        return cut.transform(df.withColumn("_place", place)).withColumn("part", F.col("_part").cast("int")).drop("_place", "_part")

    found = parted(ids).groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("null")).collect()
    return parted, sorted((r["part"], None if r["null"] else r["first"]) for r in found)


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its text edited with the next document's (by ascending id).

    The documents are dealt to ranges of the id and sorted there; each meets the next one as the rows go
    by.  A range's last document needs the next range's first one, of which a copy comes along at its end
    (one row a range, the only thing that is read twice).  The texts are shuffled once.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parted, firsts = _parts(docs.select("doc_id"), 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the range before each first document; the table's first one follows its last one
    before = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    named = df.sparkSession.createDataFrame(before, "first bigint, part int")
    wanted = [f for f, _ in before if f is not None]
    copies = docs.where(F.col("doc_id").isin(wanted) | (F.col("doc_id").isNull() if len(wanted) < len(before) else F.lit(False))) \
        .groupBy("doc_id").agg(F.min("text").alias("text"))
    copies = copies.join(named, F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "text", "part", F.lit(1).alias("copy"))
    rows = parted(docs).withColumn("copy", F.lit(0)).unionByName(copies)

    def make():
        last, build = [], Builder()

        def step(columns):
            out = []
            for doc, text, copy in zip(*(c.to_pylist() for c in columns)):
                print_ = build.tree(text)
                if last:
                    out.append(_row(build, *last[0], text, print_))
                # after the copy comes another range
                last[:] = [] if copy else [(doc, text, print_)]
                if len(out) == 500:
                    yield _columns(out)
                    out = []
            if out:
                yield _columns(out)

        return step

    ordered = rows.repartition("part").sortWithinPartitions("part", "copy", "doc_id", "text")
    return by_batch(ordered.select("doc_id", "text", "copy"), make, ROW)
