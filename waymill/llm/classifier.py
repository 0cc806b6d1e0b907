"""Quality classifier: hashed word n-gram logistic regression, FTRL-trained, sparse scores.

Training takes a bounded sample of labelled rows: the ``SAMPLE_ROWS`` smallest by a hash of
the id, of the ids that ``may_train`` admits. The sample is cut into ``SHARDS`` by the same
hash; each shard is trained in its own task in hash order and the weights are averaged
(parameter mixing), so the model depends on the rows alone, not on their partitions. What
comes to the driver is the averaged model, of a fixed size. Scoring reads every whole text
once, without a shuffle; the score looks at the text only.

Defined cases: null and empty texts get the score of the bias alone; a very long text is
scored whole, in time proportional to its length, and one in the sample is gathered whole
(``SAMPLE_ROWS`` / ``SHARDS`` texts a task); null labels and labels
other than 0 and 1 are ignored, of conflicting labels the larger counts; no usable label at
all gives weight zero and score 0.5; a null doc_id is scored, is not held out and never
trains; rows repeated are scored alike; extra columns pass through, one named like an output
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.llm import quality_bits as bits

SAMPLE_ROWS = 8000
SHARDS = 4
FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights from a bounded sample of the labelled rows that are not held out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    sample = (
        usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
        .withColumn("__order", F.xxhash64("doc_id")).orderBy("__order", "doc_id").limit(sample_rows)
    )
    # One text an id before anything is gathered: the least of those that repeat it.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "__label", "__order").agg(F.min("text").alias("text")).withColumn("shard", F.pmod("__order", F.lit(SHARDS)))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["__order", "doc_id"])
        return pd.DataFrame({"w": [bits.train(list(zip(rows["text"], rows["__label"], strict=True))).tobytes()]})

    models = [np.frombuffer(r["w"], np.float32) for r in rows.groupBy("shard").applyInPandas(one, "w binary").collect()]
    return np.sort(np.array(models, np.float64), axis=0).mean(axis=0).astype(np.float32) if models else np.zeros(bits.DIM + 1, np.float32)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with score (chance of label 1) and predicted (1 if score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([bits.score(shared.value, t if isinstance(t, str) else None) for t in texts], dtype="float64")

    return docs.withColumn("score", run("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    return scored(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows predicted 1, all columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    return scored(whole, fit(docs, labels)).filter("predicted = 1").select("doc.*")
