"""Corpus pipeline: language ID, near-duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; :func:`run` writes every stage's
result as Parquet to the shared folder and reads it back as the next one's input.  All stages but the
last return the columns of ``documents``.

Defined cases: an empty table gives an empty result of the same columns; null texts are rejected by the
first stage; columns beyond those of ``documents`` travel along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ticklake.llm import langid, packing, pii, simhash
from ticklake.llm.common import released, scratch, sifted, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a language learned from the labelled ones.

    Rejected: null texts, texts without letters, and texts that score below what training texts with as many
    distinct n-grams score at least (noise in the same letters, languages not learned).
    """
    names = docs.columns
    kept = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(names)])
    learned = docs.where(~langid.held_out())
    model = langid.train(learned)
    least = langid.least_scores(learned, model) if model else None
    found = langid.predict(kept, model, kept.columns, f"kept_{names.index('text')}", least=least)
    if model:
        found = found.where(F.col("lang_pred") != langid.UNKNOWN)
    else:  # nothing to learn from: no document can be judged
        found = found.where(F.col(f"kept_{names.index('text')}").isNotNull())
    return found.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(names)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: that with the smallest id, of those the one with the least text digest.

    Rows are told apart by id and text, so a text whose id is also that of a copy stays.  Rows that repeat both are one
    document; of them the one least as JSON stays.  Rows without an id belong to no group that could name them and stay.
    Texts that stay are not shuffled, but for those that share a bit of a bitmap with a row that goes.
    """
    names = docs.columns
    rows = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(names)])
    id_, text = (f"kept_{names.index(c)}" for c in ("doc_id", "text"))
    found = written(simhash.near_duplicates(rows, id_, text).where("doc_id is not null").groupBy("component", "doc_id", "digest")
                    .agg(F.count(F.lit(1)).alias("times")), "near-duplicates")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
    judged = found.join(first, "component").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "times",
                                                   (F.struct("doc_id", "digest") == F.col("first")).alias("stays"))
    marked = written(judged.where("not stays or times > 1").groupBy("_id", "_digest").agg(F.min("stays").alias("stays")), "marked-rows")
    clear, rest = sifted(rows, F.xxhash64(F.col(id_).cast("bigint"), simhash.text_digest(F.col(text))), marked, F.xxhash64("_id", "_digest"))
    told = (F.col(id_) == F.col("_id")) & (simhash.text_digest(F.col(text)) == F.col("_digest"))
    judged = rest.join(marked, told, "left")  # Spark would move a semi or anti join below the sifting, where all texts are shuffled
    kept = clear.unionByName(judged.where("stays is null").select(rows.columns))
    if not marked.where("stays").isEmpty():
        whole = F.struct(*rows.columns)
        once = judged.where("stays").groupBy("_id", "_digest").agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*")
        kept = kept.unionByName(once)
    return kept.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(names)])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind in brackets; n_chars follows the text."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of 2048 tokens: one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=1)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", pack)]

#: No SQL can express the profiles, the fingerprints or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  What a stage wrote on its way is deleted when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        target = scratch(spark, f"pipeline-{name}")
        with released(spark):
            docs = written(stage(spark, docs, sf_dir), name, target)
    return docs
