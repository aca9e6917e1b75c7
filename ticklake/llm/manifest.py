"""Merkle manifest of a dataset: proofs from a few stored levels (checkpoint and recompute).

Rows are leaves; a group's leaves (a language, here) ascend by key.  While more than one node remains, every
``ARITY`` consecutive ones become their parent; the groups' roots, in order, make the dataset's root in the same way.
A parent is SHA-256 of its children's digests as hex text.

Only every ``KEPT``-th level is stored.  Its nodes fall into aligned subtrees of at most ``ARITY ** KEPT`` nodes of
the level stored below, so a row of one subtree's digests is a bounded unit of work: building folds it to one node;
proving makes its inner nodes anew from the stored descendants, emits every child's siblings, and discards them.
The path above a subtree is that of its root, looked up in the level above.  So nothing is ever grouped by group or
dataset, however large one group is, and a proof costs one subtree a stored level.

Leaves are numbered without a task that sees a whole group: a range shuffle sorts them, each partition counts its
own, and the counts (one row per partition and group in it) are summed to offsets.

Defined cases: nulls in any column are ``-`` in the leaf; null groups and null keys come first; rows that share a
group and a key are ordered by their leaves; an empty table has no rows, no groups and no root; a group or dataset
of one leaf has that leaf as root, and an empty proof.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.llm.common import written

ARITY = 8
KEPT = 3
PATH = "array<struct<before:string,after:string>>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its UTF-8 length and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def leaf(columns: list[str], **changed: Column) -> Column:
    """The digest of a row, from these columns in this order; ``changed`` replaces some of them."""
    return hashed(*(field(changed.get(c, F.col(c))) for c in columns))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``idx`` (place in the group by ``order``) and ``n`` (rows of the group); writes the sorted rows."""
    place = F.monotonically_increasing_id()  # partition << 33 | row: the partitions are sorted, and written with it
    sorted_ = written(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", place), name)
    parts = sorted_.groupBy(F.shiftright("_at", 33).alias("_part"), F.col(group).alias("_group")) \
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
                    .withColumn("n", F.sum("_rows").over(Window.partitionBy("_group"))), f"{name}-parts")
    on = (F.shiftright("_at", 33) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return sorted_.join(parts, on).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")) \
        .drop("_at", "_part", "_group", "_rows", "_first", "_before")


def _raised(nodes: Column) -> Column:
    """The parents of consecutive digests."""
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(nodes) / ARITY).cast("int") - 1),
                       lambda i: hashed(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), "")))


def _levels(n: Column) -> Column:
    """How many levels lie between a level of ``n`` nodes and the next stored one, or the root."""
    found = F.lit(KEPT)
    for k in reversed(range(KEPT)):
        found = F.when(n <= ARITY ** k, F.lit(k)).otherwise(found)
    return found


def _subtrees(nodes: DataFrame, *carried: str) -> DataFrame:
    """(grp, n, sub, kids, l0, .. l<KEPT>): the aligned subtrees of a stored level, with their inner nodes made anew."""
    kids = nodes.groupBy("grp", "n", F.expr(f"idx div {ARITY ** KEPT}").alias("sub")) \
        .agg(F.array_sort(F.collect_list(F.struct("idx", "digest", *carried))).alias("kids")) \
        .withColumn("l0", F.transform("kids", lambda k: k["digest"]))
    for k in range(KEPT):
        kids = kids.withColumn(f"l{k + 1}", _raised(F.col(f"l{k}")))
    return kids


def _roots(nodes: DataFrame) -> DataFrame:
    """The next stored level: one node per subtree."""
    top = F.col("l0")
    for k in range(1, KEPT + 1):
        top = F.when(_levels(F.col("n")) >= k, F.col(f"l{k}")).otherwise(top)
    return _subtrees(nodes).select("grp", F.expr(f"cast(ceil(n / {ARITY ** KEPT}) as bigint)").alias("n"), F.col("sub").alias("idx"),
                                   top[0].alias("digest"))


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The stored levels of every group's tree, from (grp, n, idx, digest): leaves first, then every ``KEPT``-th."""
    levels = [leaves]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        levels.append(written(_roots(levels[-1].select("grp", "n", "idx", "digest")), f"{name}-level-{KEPT * len(levels)}"))
        largest = -(-largest // ARITY ** KEPT)
    return levels


def _below(nodes: DataFrame, above: DataFrame, *carried: str) -> DataFrame:
    """(grp, idx, digest, path): the siblings of each node, from the paths of the subtrees' roots (grp, idx, path)."""
    def siblings(at: Column, k: int) -> Column:
        place = F.floor(at / ARITY ** k).cast("int")
        first = place - place % ARITY
        run = F.col(f"l{k}")
        return F.struct(F.array_join(F.slice(run, first + 1, place - first), "").alias("before"),
                        F.array_join(F.slice(run, place + 2, ARITY - 1 - (place - first)), "").alias("after"))

    def own(at: Column) -> Column:
        found = F.array().cast(PATH)
        for k in reversed(range(1, KEPT + 1)):
            found = F.when(_levels(F.col("n")) == k, F.array(*(siblings(at, j) for j in range(k)))).otherwise(found)
        return found

    trees = _subtrees(nodes, *carried).join(above.select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), F.col("path").alias("_path")),
                                            F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("sub") == F.col("_idx")))
    rows = trees.select("grp", "_path", F.inline(F.transform("kids", lambda k, at: F.struct(
        k["idx"].alias("idx"), k["digest"].alias("digest"), *(k[c].alias(c) for c in carried), own(at).alias("_own")))))
    return rows.select("grp", "idx", "digest", *carried, F.concat("_own", "_path").alias("path"))


def proofs(levels: list[DataFrame], above: DataFrame, name: str, *carried: str) -> DataFrame:
    """(grp, idx, digest, carried, path) of every leaf: its siblings, run by run, up to what ``above`` (grp, path) tells.

    Goes down the stored levels; the paths of stored nodes are written (one in ``ARITY ** KEPT`` of the level below),
    those of leaves are not.
    """
    if len(levels) == 1:  # every group is one leaf
        paths = above.select(F.col("grp").alias("_grp"), F.col("path"))
        return levels[0].join(paths, F.col("grp").eqNullSafe(F.col("_grp"))).select("grp", "idx", "digest", *carried, "path")
    known = above.select("grp", F.lit(0).cast("bigint").alias("idx"), "path")
    for k in reversed(range(1, len(levels) - 1)):
        known = written(_below(levels[k], known).select("grp", "idx", "path"), f"{name}-paths-{KEPT * k}")
    return _below(levels[0], known, *carried)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda d, s: hashed(s["before"], d, s["after"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


class Manifest:
    """The stored levels of a dataset: ``leaves`` (grp, n, idx, digest and the columns carried), ``levels`` of the
    groups' trees, ``tops`` of the tree over their roots, and ``root`` (none for an empty table).  All are tables
    under ``spark.checkpoint.dir``."""

    def __init__(self, rows: DataFrame, group: str, key: str, digest: str, carried: tuple[str, ...] = ()):
        plain = rows.select(F.col(group).alias("grp"), F.col(key).alias("key"), F.col(digest).alias("digest"),
                            *(F.col(c).alias(f"with_{c}") for c in carried))
        self.carried = ["key", *(f"with_{c}" for c in carried)]
        self.leaves = numbered(plain, "grp", ["key", "digest"], "manifest-leaves")
        self.levels = build(self.leaves, "manifest")
        self.subroots = self.levels[-1].select("grp", F.col("digest").alias("subroot"))
        ordered = numbered(self.subroots.select(F.lit(0).alias("all"), F.col("grp").alias("of"), F.col("subroot").alias("digest")),
                           "all", ["of"], "manifest-groups")
        self.tops = build(ordered.select(F.col("all").alias("grp"), "n", "idx", "digest", "of"), "manifest-top")
        found = self.tops[-1].select("digest").first()
        self.root = found[0] if found else None

    def proofs(self) -> DataFrame:
        """(grp, idx, digest, the carried columns, subroot, path) of every leaf."""
        start = self.subroots.sparkSession.createDataFrame([(0, [])], f"grp int, path {PATH}")
        tops = written(proofs(self.tops, start, "manifest-top", "of").select(
            F.col("of").alias("grp"), "path", F.col("digest").alias("subroot")), "manifest-group-paths")
        rows = proofs(self.levels, tops, "manifest", *self.carried)
        named = tops.select(F.col("grp").alias("_grp"), "subroot")
        return rows.join(named, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampering(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, with every third row (by the hash of its id) lower-cased and checked against it."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("doc_id", "lang", leaf(FIELDS).alias("leaf"),
                         F.when(changed, leaf(FIELDS, text=lowered(F.col("text")))).alias("tampered"))
    manifest = Manifest(leaves, "lang", "doc_id", "leaf", ("tampered",))
    root = F.lit(manifest.root)
    back = folded(F.coalesce("with_tampered", "digest"), F.col("path"))
    rows = manifest.proofs().select(F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"),
                                    proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
