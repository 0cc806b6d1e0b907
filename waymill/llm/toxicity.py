"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A text is cut into windows (``WINDOW_WORDS`` words each). A window is compressed twice, once with
the dictionary of ordinary text and once with that of toxic text; the bytes that the toxic one
saves are the window's gain. What both need to say about ordinary wording must cost the same in
both, or the noise of two unlike dictionaries hides a single word: so the ordinary dictionary is
the base of either, and the toxic one goes on with what is trained from toxic text. A carrier, the
end of the base, follows each window, since the compressor neither looks for matches in a block's
last bytes nor keeps a block that it cannot shorten.

Training takes a bounded sample: the ``SAMPLE_ROWS`` labelled rows smallest by a hash of the id,
of the ids that may train.

* The ordinary dictionary is trained on ``BASE_SPANS`` spans of ordinary documents, chosen by hash.
* A toxic document is ordinary for the most part. The toxic dictionary is trained on the windows
  and beginnings of windows (``STEMS`` bytes) that set toxic documents apart: met in at least
  ``MIN_CONTEXTS`` different contexts (the windows before and after, so that copies of a passage
  count once), in more than one document and ``MIN_RATIO`` times as often as in ordinary ones; the
  ``MOST_SAMPLES`` with most contexts, each repeated once a context.
* The thresholds are calibrated on documents that the dictionaries have not seen, a third of the
  sample by hash: a logistic regression weighs how many windows reach each of the gains ``LEVELS``
  against the number of windows. (A dictionary trained again on all of the sample would be a
  little larger, so find more chance matches than it was calibrated for.)

Contexts are counted and documents scored by Spark jobs; to the driver come the chosen samples and
spans and a few numbers a document of the sample. Scoring reads every whole text once,
without a shuffle, and looks at the text only. A task remembers the gains of ``MEMO`` windows.

Defined cases: null and empty texts have no window and get the score of that; a very long text is
scored whole, in time proportional to its length; null labels and labels other than 0 and 1 are
ignored, of conflicting labels the larger counts; without labels of both classes in either part of the
sample every score is 0.0; with too few samples to train from, they themselves are the dictionary; a null doc_id is
scored, is not held out and never trains; repeated rows are scored alike; extra columns pass
through ``scored``, one named like an output is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

SAMPLE_ROWS = 8000
FOLDS, HELD_OUT = 5, 0
WINDOW_WORDS = 1
STEMS = (4, 5, 6, 7, 8)
MIN_CONTEXTS, MIN_RATIO, MOST_SAMPLES, MOST_BYTES = 4, 8.0, 4096, 48
SPAN_WORDS, BASE_SPANS = 8, 16384
BASE_BYTES, TOXIC_BYTES, CARRIER_BYTES = 8192, 4096, 64
LEVELS = (3, 4, 5, 6, 7)  # bytes saved
RIDGE, BALANCE = 0.01, 0.75
PARTS, CALIBRATION = 3, 2  # of the sample by hash, the part that calibrates
MEMO = 1 << 18
EDGES = b".,;:!?\"'()[]{}<>*"


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split on ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


def windows_of(text: str | None) -> list[bytes]:
    words = words_of(text)
    return words if WINDOW_WORDS == 1 else [b" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words), WINDOW_WORDS)]


def dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary; the samples themselves where the trainer finds them too few."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=15, chain_log=15, search_log=4, min_match=5, target_length=64, strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=how)


class Gains(dict):
    """window -> bytes saved by the toxic dictionary; remembers ``MEMO`` windows."""

    def __init__(self, base: bytes, toxic: bytes):
        super().__init__()
        self.carrier = base[-CARRIER_BYTES:]
        self.ordinary, self.toxic = _compressor(base), _compressor(base + toxic + self.carrier)

    def __missing__(self, window: bytes) -> int:
        block = b" " + window.strip(EDGES) + b" " + self.carrier
        gain = len(self.ordinary.compress(block)) - len(self.toxic.compress(block))
        if len(self) < MEMO and len(window) <= MOST_BYTES:
            self[window] = gain
        return gain

    def features(self, text: str | None) -> list[float]:
        """1, then logs of 1 + the windows of each gain of ``LEVELS`` or more, and of 1 + all windows."""
        found = list(map(self.__getitem__, windows_of(text)))
        high = [g for g in found if g >= LEVELS[0]]
        return [1.0, *[math.log1p(sum(g >= level for g in high)) for level in LEVELS], math.log1p(len(found))]


class Model(NamedTuple):
    base: bytes
    toxic: bytes
    weights: tuple[float, ...]  # empty: no labels of both classes


def logistic(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the power ``BALANCE`` of the classes' ratio weighs the rare one up."""
    ones = max(int(labels.sum()), 1)
    each = np.where(labels == 1, (max(len(labels) - ones, 1) / ones) ** BALANCE, 1.0)
    w = np.zeros(rows.shape[1])

    def loss(w: np.ndarray) -> float:
        margin = np.where(labels == 1, 1, -1) * (rows @ w)
        return float((each * np.logaddexp(0, -margin)).sum() + RIDGE / 2 * w @ w)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (each * (p - labels)) + RIDGE * w
        step = np.linalg.solve((rows.T * (each * p * (1 - p))) @ rows + RIDGE * np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def sample_of(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """no, text, label and calibrates of the rows that train, written out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    few = (
        usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
        .withColumn("__order", F.xxhash64("doc_id")).orderBy("__order", "doc_id").limit(sample_rows)
    )
    # One text an id before anything is gathered: the least of those that repeat it.
    met = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "__label", "__order").agg(F.min("text").alias("text"))
    part = F.pmod(F.shiftright("__order", 7), F.lit(PARTS))
    return materialize(met.select(F.col("__order").alias("no"), "text", F.col("__label").alias("label"), (part == CALIBRATION).alias("calibrates")), "toxicity")


def contrast_samples(sample: DataFrame) -> list[tuple[bytes, int]]:
    """What sets toxic documents apart, with its contexts there, most first.

    A sample is a window between spaces, or a beginning of windows after a space.
    """

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, text, label in zip(*(batch.column(c).to_pylist() for c in ("no", "text", "label")), strict=True):
                found = [w.strip(EDGES) for w in windows_of(text)]
                parts, around = [], []
                for before, w, after in zip([b"", *found], found, [*found[1:], b""], strict=False):
                    if 0 < len(w) <= MOST_BYTES:
                        own = [b" " + w[:n] for n in STEMS if n < len(w)] + [b" " + w + b" "]
                        parts += own
                        around += [_hash(before + b" " + after)] * len(own)
                columns = [pa.array(parts, pa.binary()), pa.array([no] * len(parts), pa.int64()), pa.array([label] * len(parts), pa.int32()), pa.array(around, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "no", "label", "around"])

    each = sample.filter("not calibrates").select("no", "text", "label").mapInArrow(contexts, "part binary, no long, label int, around long")
    # A context that both classes share is a copied passage: it speaks for neither.
    once = each.groupBy("part", "around").agg(F.max("label").alias("label"), F.min("label").alias("least"), F.min("no").alias("no")).filter("label = least")
    toxic = F.col("label") == 1
    counted = materialize(once.groupBy("part").agg(F.count_if(toxic).alias("t"), F.count_if(~toxic).alias("o"), F.min(F.when(toxic, F.col("no"))).alias("first"), F.max(F.when(toxic, F.col("no"))).alias("last")), "contrast")
    totals = counted.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    often = F.col("t") * F.lit(float(totals["o"] or 0)) > MIN_RATIO * (F.col("o") + 1) * F.lit(float(totals["t"] or 0))
    rows = counted.filter((F.col("t") >= MIN_CONTEXTS) & (F.col("first") < F.col("last")) & often).orderBy(F.desc("t"), "part").limit(MOST_SAMPLES).collect()
    return [(bytes(r["part"]), r["t"]) for r in rows]


def base_spans(sample: DataFrame) -> list[bytes]:
    """``BASE_SPANS`` spans of ordinary documents, by hash."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                found = [b" " + b" ".join(words[i : i + SPAN_WORDS]) for i in range(0, len(words), SPAN_WORDS)]
                found = [x for x in found if len(x) <= SPAN_WORDS * MOST_BYTES]
                yield pa.RecordBatch.from_arrays([pa.array(list(map(_hash, found)), pa.int64()), pa.array(found, pa.binary())], ["h", "span"])

    rows = sample.filter("label = 0 and not calibrates").select("text").mapInArrow(spans, "h long, span binary")
    return [bytes(r["span"]) for r in rows.distinct().orderBy("h", "span").limit(BASE_SPANS).collect()]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    sample = sample_of(docs, labels, label, sample_rows)
    if sample.select("label", "calibrates").distinct().count() < 4:
        return Model(b"", b"", ())
    base = dictionary(base_spans(sample), BASE_BYTES, 32)
    repeated = sorted((_hash(p + i.to_bytes(8, "little")), p) for p, n in contrast_samples(sample) for i in range(n))
    toxic = dictionary([p for _, p in repeated], TOXIC_BYTES, 16)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(base, toxic)
        for batch in batches:
            rows = [gains.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    unseen = sample.filter("calibrates").select("text", "label")
    known = unseen.mapInArrow(features, "x array<double>, label int").orderBy("label", "x").collect()  # SAMPLE_ROWS rows of a few numbers
    weights = logistic(np.array([r["x"] for r in known], np.float64), np.array([r["label"] for r in known], np.int64))
    return Model(base, toxic, tuple(weights.tolist()))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (chance of label 1) and predicted (1 if score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        base, toxic, weights = shared.value
        gains = Gains(base, toxic) if weights else None
        for texts in batches:
            if gains is None:
                yield pd.Series(np.zeros(len(texts)))
            else:
                margin = [sum(a * b for a, b in zip(weights, gains.features(t), strict=True)) for t in texts]
                yield pd.Series([1 / (1 + math.exp(-min(max(m, -30), 30))) for m in margin], dtype="float64")

    return docs.withColumn("score", run("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    return scored(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
