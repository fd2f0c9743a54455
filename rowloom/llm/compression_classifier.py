"""A quality classifier made of two zstandard dictionaries.

One dictionary is trained on blocks of texts labelled good, one on blocks of texts labelled bad. A text is cut
into blocks and compressed with either; the difference of the two sizes over the larger one says which
kind it is like, and the smaller size over the text's length how repetitive it is. A weighted logistic
regression on labelled texts that no dictionary has seen turns both into the probability of label 1.

Bounds of the training sample (parameters): DICTIONARY_DOCS texts and BLOCKS blocks per label for the
dictionaries, CALIBRATION_DOCS texts for the probability, all chosen by a hash of the id. Every text is scored in whole.

NULL texts are scored like empty ones, by the calibration alone. Rows with equal texts have equal scores.
Ids labelled twice count as bad if any label says so; NULL labels and ids are left out. Without labels every score
is 0.5. An empty table gives an empty result; a column named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import row_hash

BLOCK = 1000
DICTIONARY_BYTES = 112_640
DICTIONARY_DOCS = 1_200
BLOCKS = 5_000
CALIBRATION_DOCS = 4_000
LEVEL = 6


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    weights: tuple[float, ...] = (0.0,)


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if own:
        own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)


class Sizes:
    """(difference of sizes over the larger, smaller size over length) of texts."""

    def __init__(self, model: Model):
        self.good, self.bad = _compressor(model.good), _compressor(model.bad)

    def __call__(self, text: str | None) -> tuple[float, float]:
        cut = blocks(text)
        if not cut:
            return 0.0, 1.0
        good, bad = (sum(len(c.compress(b)) for b in cut) for c in (self.good, self.bad))
        return (bad - good) / max(bad, good), min(bad, good) / sum(map(len, cut))


def _terms(sizes: np.ndarray) -> np.ndarray:
    z, r = sizes[:, 0], sizes[:, 1]
    return np.stack([z, r, z * z, z * r, r * r], axis=1)


def calibrate(model: Model, sizes: np.ndarray, label: np.ndarray, ridge: float = 1e-3) -> Model:
    """Logistic regression by Newton's method, with a small ridge so that separable labels do no harm."""
    if not len(label):
        return model
    terms = _terms(sizes)
    mean, spread = terms.mean(axis=0), terms.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(label)), (terms - mean) / spread])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - label) + ridge * len(label) * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(label) * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return Model(model.good, model.bad, tuple(mean.tolist()), tuple(spread.tolist()), tuple(w.tolist()))


def probabilities(model: Model, sizes: np.ndarray) -> np.ndarray:
    if not model.mean:
        return np.full(len(sizes), 0.5)
    w = np.array(model.weights)
    x = (_terms(sizes) - np.array(model.mean)) / np.array(model.spread)
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of blocks; too few for training, they are the dictionary as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(q, b) for q, t in zip(batch.column("quality").to_pylist(), batch.column("text").to_pylist()) for b in blocks(t)]
        yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["quality", "block"])


def _least(df: DataFrame, n: int, *by: str, seed: int) -> DataFrame:
    """n rows with the least hashes: the same ones at every run."""
    return df.withColumn("chance", row_hash(*map(F.col, by), seed=seed)).orderBy("chance", *by).limit(n).drop("chance")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from labels (doc_id, quality), of which the caller has taken out what is held out."""
    spark = docs.sparkSession
    labels = labels.select(F.col("doc_id").alias("its_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("its_id").agg(F.min("quality").alias("quality"))
    half = F.pmod(row_hash(F.col("its_id"), seed=21), F.lit(2))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def with_texts(sample: DataFrame) -> DataFrame:
        # at most a few thousand ids by the bounds above
        return texts.join(F.broadcast(sample), texts["doc_id"] == sample["its_id"])

    samples = {0: [], 1: []}
    of_label = [_least(labels.filter((half == 0) & (F.col("quality") == q)), DICTIONARY_DOCS, "its_id", seed=22) for q in (0, 1)]
    cut = with_texts(of_label[0].unionByName(of_label[1])).select("quality", "text").mapInArrow(_to_blocks, "quality int, block binary")
    for q in (0, 1):
        chosen = _least(cut.filter(F.col("quality") == q), BLOCKS, "block", seed=23)
        samples[q] = [bytes(r["block"]) for r in chosen.select("block").collect()]
    model = Model(train_dictionary(samples[1]), train_dictionary(samples[0]))

    calibration = with_texts(_least(labels.filter(half == 1), CALIBRATION_DOCS, "its_id", seed=24))
    rows = calibration.select("quality", _sizes(spark, model)("text").alias("s")).select("quality", "s.*").orderBy("quality", "z", "r").collect()
    return calibrate(model, np.array([(r["z"], r["r"]) for r in rows]).reshape(-1, 2), np.array([r["quality"] for r in rows], dtype=float))


def _sizes(spark, model: Model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("z double, r double")
    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = Sizes(shared.value)
        for texts in batches:
            yield pd.DataFrame([of(t) for t in texts], columns=["z", "r"], dtype="float64")

    return sizes


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the probability of label 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Sizes(shared.value)
        for texts in batches:
            yield pd.Series(probabilities(shared.value, np.array([of(t) for t in texts]).reshape(-1, 2)))

    return df.withColumn(name, probability(F.col(text)))


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. NULL ids are in no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
