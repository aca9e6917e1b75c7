"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text is a list of words.  Each run of ``GRAM`` words has a hash; of every ``span - GRAM + 1`` consecutive hashes
the least is kept (winnowing).  Two texts that share ``span`` words in a row share those hashes, so both keep the same
least one: no shared span of ``span`` words is missed, while a text keeps two hashes in seven words.

1. The hashes that the benchmark keeps are a table of distinct values.  A document's kept hashes (each with the
   windows whose least hash it is) are tested against it: a semi join, in which a frequent hash pairs nothing.
2. A hit is extended to the windows that it stands for, and these are looked up by their words in the table of
   distinct benchmark windows; so a hash that collides, or the same few words in another sentence, is no hit.
   Overlapping windows are merged into maximal shared spans.
3. Items are named by classes: windows that occur in the same items are one class, and texts that hold the same
   classes get their list of items worked out once.  A passage that many documents share with many items is
   never expanded into all pairs.  Classes are told apart by 128 bits of hashes of their members.

Texts are known by their MD5, so copies are extended once.  Nothing is collected but the window
lengths in use (ten at most).  An item of fewer than ``span`` words is one window.  Items of 5 to 9 words narrow
the windows to the shortest one's length; items of 1 to 4 words add a pass over all runs of their length.

Defined cases: null and empty texts have no words, no hits and no items; a null item id takes no part; an item
id that repeats stands for all its texts; documents that repeat an id or a text are rows of their own; an empty
benchmark or an empty table of documents gives clean rows or none; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.llm.common import written

# What separates words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 5


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, runs of digits, letters and everything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, GAP), "")


def _upto(last: Column) -> Column:
    """0, 1 .. last; empty where last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _windows(array: Column, length: Column | int, make) -> Column:
    """``make(slice)`` of all slices of ``length`` elements."""
    return F.transform(_upto(F.size(array) - length), lambda i: make(F.slice(array, i + F.lit(1), length)))


def _least(df: DataFrame, gram: int, span: int) -> DataFrame:
    """Add ``_least``: of each window of ``span`` words in ``_words``, the least hash of ``gram`` words."""
    hashed = df.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("_grams", _windows(F.col("_hash"), gram, lambda g: F.xxhash64(g)))
    return grams.withColumn("_least", _windows(F.col("_grams"), span - gram + 1, F.array_min))


def _runs(df: DataFrame, gram: int, span: int, longest: int, keep: list[str]) -> DataFrame:
    """One row per kept hash: ``value``, the windows ``first`` to ``last`` (by first word) that keep it, and the words from
    there on that a benchmark window may hold.  The list of runs is a column before it is exploded, so that the words are
    cut out only of the rows that a broadcast join lets pass, and no row carries its whole text.  It is exploded with
    ``inline_outer``: for ``inline``, Spark would infer a filter on its size and work out the whole list twice, from the
    text, in nested loops.  A text without runs so gives a row of nulls, which joins nothing."""
    least = _least(df, gram, span)
    starts = least.withColumn("_starts", F.filter(
        _upto(F.size("_least") - 1), lambda i: (i == 0) | (F.get("_least", i) != F.get("_least", i - F.lit(1)))))
    runs = starts.withColumn("_runs", F.transform("_starts", lambda i, n: F.struct(
        F.get("_least", i).alias("value"), i.alias("first"),
        (F.coalesce(F.get("_starts", n + F.lit(1)), F.size("_least")) - 1).alias("last"))))
    return runs.select(*keep, "_words", F.inline_outer("_runs")) \
        .select(*keep, "value", "first", "last", F.slice("_words", F.col("first") + 1, F.col("last") - F.col("first") + longest).alias("_words"))


class Benchmark:
    """What a benchmark's texts are recognised by.

    ``windows``: (window, length, item_id), the distinct windows with the items that hold them; ``values``: the
    distinct hashes they keep; ``passes``: the (gram, span) under which documents are to be fingerprinted.
    """

    def __init__(self, items: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = 10):
        own = written(items.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("_words"))
                      .where(F.col("item_id").isNotNull() & (F.size("_words") > 0)).distinct(), "benchmark-words")
        length = F.least(F.size("_words"), F.lit(span))
        cut = own.withColumn("length", length)
        self.windows = written(cut.select("item_id", "length", F.explode(_windows(
            F.col("_words"), F.col("length"), lambda w: F.array_join(w, " "))).alias("window")).distinct(), "benchmark-windows")
        self.lengths = sorted(r["length"] for r in cut.select("length").distinct().collect())  # at most ``span`` values
        least = min([n for n in self.lengths if n >= GRAM], default=span)
        self.passes = [(GRAM, least)] if any(n >= GRAM for n in self.lengths) else []
        self.passes += [(n, n) for n in self.lengths if n < GRAM]
        kept = [_runs(own.where(F.size("_words") >= s), g, s, span, []).select("value").where("value is not null") for g, s in self.passes]
        none = items.sparkSession.createDataFrame([], "value bigint")
        self.values = written(_union(kept, none).distinct(), "benchmark-hashes")


def _union(frames: list[DataFrame], none: DataFrame) -> DataFrame:
    for df in frames:
        none = none.unionByName(df)
    return none


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def occurrences(docs: DataFrame, benchmark: Benchmark, text_col: str = "text") -> DataFrame:
    """(key, start, length, window): every occurrence of a benchmark window in the distinct texts.  No text is shuffled."""
    listed = docs.select(_key(F.col(text_col)).alias("key"), words(F.col(text_col)).alias("_words"))
    none = docs.sparkSession.createDataFrame([], "key binary, value bigint, first int, last int, _words array<string>")
    runs = _union([_runs(listed, g, s, max(benchmark.lengths), ["key"]) for g, s in benchmark.passes], none)
    hits = runs.join(benchmark.values, "value", "left_semi").select("key", "first", "last", "_words").distinct()
    spans = _union([hits.select("key", F.lit(n).alias("length"), F.inline(F.transform(
        _upto(F.least(F.col("last") - F.col("first"), F.size("_words") - n)),
        lambda i: F.struct((F.col("first") + i).alias("start"), F.array_join(F.slice("_words", i + F.lit(1), n), " ").alias("window")))))
        for n in benchmark.lengths], docs.sparkSession.createDataFrame([], "key binary, length int, start int, window string"))
    known = benchmark.windows.select("length", "window").distinct()
    return spans.join(known, ["length", "window"], "left_semi").select("key", "start", "length", "window").distinct()


def shared_spans(found: DataFrame) -> DataFrame:
    """(key, begin, end): the maximal runs of words that are inside occurrences; at most one row per word of a text."""
    before = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("start", "length")
    ends = found.withColumn("_reach", F.max(F.col("start") + F.col("length")).over(before))
    opened = ends.withColumn("_new", (F.col("_reach").isNull() | (F.col("start") > F.col("_reach"))).cast("int"))
    return opened.withColumn("_span", F.sum("_new").over(upto)).groupBy("key", "_span") \
        .agg(F.min("start").alias("begin"), F.max(F.col("start") + F.col("length")).alias("end")).drop("_span")


def _classed(pairs: DataFrame, group: str, member: str) -> DataFrame:
    """(group, same): ``same`` is the least group with exactly the same set of members.  Members must be distinct."""
    sign = pairs.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(member)).alias("_a"),
                                    F.bit_xor(F.xxhash64(F.lit(1), member)).alias("_b"))
    least = sign.groupBy("_n", "_a", "_b").agg(F.min(group).alias("same"))
    return sign.join(least, ["_n", "_a", "_b"]).select(group, "same")


def items_of(found: DataFrame, benchmark: Benchmark) -> tuple[DataFrame, DataFrame]:
    """(key, same) and (same, item_id): texts with the same items share a class, whose items are listed once."""
    alike = written(_classed(benchmark.windows.withColumn("window", F.struct("length", "window")).select("window", "item_id"),
                             "window", "item_id"), "benchmark-classes")
    held = found.select("key", F.struct("length", "window").alias("window")).join(alike, "window") \
        .select("key", F.col("same").alias("window")).distinct()
    held = written(held, "benchmark-held")
    texts = written(_classed(held, "key", "window"), "benchmark-texts")
    listed = held.join(texts.where("key = same").select("key"), "key", "left_semi").withColumnRenamed("key", "same") \
        .join(benchmark.windows.select(F.struct("length", "window").alias("window"), "item_id"), "window") \
        .select("same", "item_id").distinct()
    return texts, listed


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", span: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every row; ``items`` is the sorted list of item ids."""
    benchmark = Benchmark(items, item_id_col, item_text_col, span)
    found = written(occurrences(docs, benchmark, text_col), "benchmark-occurrences")
    hit = shared_spans(found).groupBy("key").agg(F.sum(F.col("end") - F.col("begin")).cast("bigint").alias("n_hit"))
    texts, listed = items_of(found, benchmark)
    lists = listed.groupBy("same").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    known = written(hit.join(texts.join(lists, "same"), "key").select(F.col("key").alias("hit_key"), "n_hit", "items"), "benchmark-texts-hit")
    rows = docs.select(F.col(id_col).alias("doc_id"), _key(F.col(text_col)).alias("key"),
                       F.size(words(F.col(text_col))).cast("bigint").alias("n_words"))
    return rows.join(known, F.col("key") == F.col("hit_key"), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))
