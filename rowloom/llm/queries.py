"""The operators over the given tables, one query each, with their production parameters."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import (
    bin_packing, compression_classifier, fingerprints, hard_negatives, line_dedup, minhash, mixing, oracles, pii, piece_encoding, quality_rules, sharding, token_alignment, token_counts,
)
from rowloom.llm.common import repeat_rows
from rowloom.sources.shared import materialize

#: Vocabulary files.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Bytes of a shard, small enough for a loader to fetch shards in random order.
SHARD_BYTES = 1 << 20

#: Key of the surrogates; one per release of the data, kept secret.
PII_KEY = os.environ.get("ROWLOOM_PII_KEY", "rowloom")

#: Labels of this fold (crc32 of the id modulo 5) are never learnt from.
HELD_OUT_FOLD = 0
#: Score from which a document counts as good.
LEAST_SCORE = 0.3

#: Tokens a document may have.
TOKEN_LIMIT = 2048

#: A training sequence: its tokens decide, as many documents as it has tokens and attention over all of them are allowed.
SEQUENCE = bin_packing.Capacity(tokens=2048, documents=2048, cost=2048 * 2048)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(documents(spark, sf_dir).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes")), "sizes")
    return sharding.assign_shards(rows, SHARD_BYTES, size=F.col("n_bytes"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_exact", "n_near", F.sha2("text", 256).alias("text_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return token_counts.count_tokens(docs, "text", WORD_VOCABULARY).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    measured = materialize(quality_rules.measure(docs).drop("text"), "measured")
    judged = quality_rules.judge(measured, quality_rules.host_verdicts(measured))
    return judged.select(
        "doc_id", *quality_rules.MEASURES, "base_failed", "kept", F.round("host_rate", 6).alias("host_rate"), "host_failed"
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.plan_copies(documents(spark, sf_dir).select("doc_id", "source", "text"))
    rows = copies.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "n_rows")
    return repeat_rows(rows, "n_rows")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_changes(documents(spark, sf_dir))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(compression_classifier.fold("doc_id") != HELD_OUT_FOLD)
    scored = compression_classifier.score(docs, compression_classifier.fit(docs, labels))
    held_out = F.coalesce(compression_classifier.fold("doc_id") == HELD_OUT_FOLD, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return piece_encoding.digests(docs, "text", PIECE_VOCABULARY).select("doc_id", "encoded.*")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id"), label, F.col("embedding"), F.col("vec_id") % 100 == 0)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bin_packing.pack_documents(docs, "text", BYTE_VOCABULARY, SEQUENCE)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_alignment.align_documents(docs, "text", BYTE_VOCABULARY, PIECE_VOCABULARY)[0]


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_minhash": op6_minhash,
    "op7_mixing": op7_mixing,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_packing": op12_packing,
    "op13_alignment": op13_alignment,
}

#: The others have no SQL; tests hold them against the libraries, brute force or held-out labels.
ORACLE: dict[str, str] = {
    "op1_sharding": oracles.SHARDING.format(limit=SHARD_BYTES),
    "op2_line_dedup": oracles.LINE_DEDUP,
    "op5_quality_rules": oracles.QUALITY_RULES,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
}
