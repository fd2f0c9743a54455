"""From raw documents to encoded training data, stage by stage.

Every stage takes and returns whole tables; all but the last keep the columns of documents. NULLs, empty
texts, repeated rows and empty tables are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import line_dedup, minhash, mixing, piece_encoding, quality_rules
from rowloom.llm.common import WORD, fresh, row_key
from rowloom.llm.queries import PIECE_VOCABULARY, documents
from rowloom.session import configure
from rowloom.sources.shared import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, on hosts that do."""
    configure(spark)
    # every text is measured once; what is written has keys and flags only, and texts that fail are told by their key
    rules = quality_rules.HOST_RULES
    measured = quality_rules.measure(docs).select(row_key(F.col("text")).alias("key"), "source", *rules, "base_failed")
    measured = materialize(measured, "measured")
    verdicts = quality_rules.host_verdicts(measured, rules=rules)
    key = fresh(docs, "key")
    failed = materialize(measured.filter("base_failed").select(F.col("key").alias(key)).distinct(), "failed")
    passed = docs.withColumn(key, row_key(F.col("text"))).join(failed, key, "left_anti")
    judged = quality_rules.judge(passed.withColumn("base_failed", F.lit(False)), verdicts)
    return judged.filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier, as they are or a few edits apart; documents of which no word is left go."""
    configure(spark)
    found = line_dedup.dedup_lines(docs, most_edits=line_dedup.MOST_EDITS)
    found = found.filter((F.col("n_exact") + F.col("n_near") == 0) | F.col("text").rlike(WORD))
    return found.withColumn("n_chars", F.when(F.col("n_exact") + F.col("n_near") == 0, F.col("n_chars")).otherwise(F.char_length("text"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    configure(spark)
    return minhash.keep_first(docs, size=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights ask for."""
    configure(spark)
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    configure(spark)
    name = fresh(docs, "encoded")
    encoded = piece_encoding.encode(docs, "text", PIECE_VOCABULARY, name)
    return encoded.select(
        "doc_id", "lang", "source",
        F.size(f"{name}.ids").cast("long").alias("n_tokens"),
        F.col(f"{name}.ids").alias("ids"),
        F.sha2(f"{name}.decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mixture),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Similarity joins and encoding have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
