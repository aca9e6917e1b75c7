"""The registered queries of this subpackage: thin, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ticklake.llm import (ann, chat, decontamination, langid, manifest, merkle, packing, pii, repair,
                          sentencepiece_codec, simhash, token_files, warc)
from ticklake.llm.common import scratch, table

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, schemas = chat.derived(table(spark, sf_dir, "conversations"))
    return chat.link(calls, results, schemas)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_warc(warc.prepared(table(spark, sf_dir, "pages")), path)
    records = warc.resolve(warc.read_warc(spark, path))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), PIECES)
    return sentencepiece_codec.decode(coded, PIECES).select(
        "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.length("text").cast("bigint").alias("decoded_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORDS, capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, WORDS, end_id=2)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_likeness(table(spark, sf_dir, "documents"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index = ann.build(vectors)
    return ann.search(index, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tampering(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))[0]


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_warc_revisits, op3_pii, op4_sentencepiece, op5_language_id, op6_packing, op7_simhash, op8_token_files,
    op9_merkle, op10_permutation_index, op11_decontamination, op12_manifest, op13_repair)}
