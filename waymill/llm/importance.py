"""Importance resampling towards a target corpus, ranked by parallel sorting by regular sampling.

Weights. Features are hashed word n-grams in ``BUCKETS`` buckets. One pass counts them over all
documents and over all target texts; a table of ``BUCKETS`` integer gains, so of a fixed size,
goes to every task and a second pass sums each document's gains from that array. The sampling
key adds Gumbel noise from a hash of the id, so the highest keys are a draw without replacement
in proportion to the weights.

Ranks. The keys are sorted without a global sort in one place:

1. every task sorts its own rows (a run) and gives keys at regular positions of it;
2. all samples together, ``SAMPLES`` at most, are sorted and cut regularly into splitters, one
   less than there are segments;
3. every run is cut at the splitters and its pieces, already sorted arrays, go to the task of
   their segment, which merges them (a stable merge of sorted runs);
4. the sizes of the segments, summed up from the first, are the rank before each segment.

With s samples a run no segment holds more than 1 / segments + 2 / s of the rows, whatever the
keys: ties of score and id are broken by the row's number, so no group of equal keys stays
together. A task holds its run or its segment as arrays of a few numbers a document.

Defined cases: null and word-less texts have no features, weight 0 and are never drawn; very
long texts are read whole, in proportion to their length; a null doc_id is hashed as the empty
string and sorts after all others; rows repeated are ranked one after the other in the order of
the table; no target text makes T zero (each gain then compares with the uniform table); an empty
table gives an empty result; extra columns are ignored. doc_id is an integer.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

BUCKETS = 10_000
MAX_WORDS = 1  # of a feature
SEED = 2024
LEAST_WORDS, PERCENT = 20, 10
SAMPLES = 1 << 20  # sampled keys that come to the driver, at most
MEMO = 1 << 18  # features whose bucket a task remembers

#: A-Z to lower case, all other ASCII but digits and a-z to spaces; bytes of longer characters stay.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


class _Buckets(dict):
    """feature -> bucket; remembers ``MEMO`` features."""

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % BUCKETS
        if len(self) < MEMO:
            self[feature] = bucket
        return bucket


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if isinstance(text, str) else []


def feature_buckets(text: str | None, known: dict[bytes, int], max_words: int = MAX_WORDS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to ``max_words`` words, repeats included."""
    words = words_of(text)
    found = [known[w] for w in words]
    for n in range(2, max_words + 1):
        found += [known[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
    return len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, max_words: int = MAX_WORDS) -> np.ndarray:
    """Features of all ``text`` by bucket: one number a bucket and task comes together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = _Buckets(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                sums += np.bincount(feature_buckets(text, known, max_words)[1], minlength=BUCKETS)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(sums[some])})

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, seed: int = SEED, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets()
        for batch in batches:
            rows = [(n, len(b), int(shared.value[b].sum())) for n, b in (feature_buckets(t, known, max_words) for t in batch.column(1).to_pylist())]
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sums, "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of the rows by score downwards, then null ids last, then id, then row."""
    score, missing, ids, row = columns
    return np.lexsort((row, ids, missing, -score))


def _keys(table: pa.Table) -> list[np.ndarray]:
    ids = table.column("doc_id")
    return [
        table.column("score").to_numpy(), np.asarray(ids.is_null()).astype(np.int64), np.asarray(ids.fill_null(0)), table.column("row").to_numpy()
    ]


_ROW = ["doc_id", "n_features", "weight", "score", "row"]


def _run(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """The rows of one task, sorted."""
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return None
    table = pa.Table.from_batches(held)
    return table.take(pa.array(_order(_keys(table))))


def ranked(rows: DataFrame, segments: int) -> DataFrame:
    """``rows`` (doc_id, n_features, weight, score, row), written out, with their exact ``rank`` from 1."""
    spark = rows.sparkSession
    n_runs = max(1, rows.groupBy(F.spark_partition_id().alias("run")).count().count())
    each = max(1, min(segments, SAMPLES // n_runs))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _run(batches)
        if run is not None:
            at = np.unique((np.arange(1, each + 1) * run.num_rows) // (each + 1))
            picked = _keys(run.take(pa.array(at)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in picked], ["score", "missing", "doc_id", "row"])

    keys = rows.mapInArrow(sample, "score long, missing long, doc_id long, row long").toArrow()  # SAMPLES rows at most
    columns = [keys.column(c).to_numpy() for c in ("score", "missing", "doc_id", "row")]
    at = np.unique(np.arange(1, segments) * keys.num_rows // segments) if keys.num_rows else np.zeros(0, np.int64)
    chosen = _order(columns)[at] if keys.num_rows else at
    splitters = spark.sparkContext.broadcast([c[chosen] for c in columns])

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _run(batches)
        if run is None:
            return
        cut = splitters.value
        both = [np.concatenate([a, b]) for a, b in zip(_keys(run), cut, strict=True)]
        order = _order(both)  # a splitter is a row of some run: its own row stays behind it
        place = np.flatnonzero(order >= run.num_rows)
        ends = np.concatenate([[0], place - np.arange(len(place)), [run.num_rows]])
        for segment in range(len(ends) - 1):
            piece = run.slice(ends[segment], ends[segment + 1] - ends[segment]).combine_chunks()
            if piece.num_rows:
                arrays = [pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column(c).combine_chunks()) for c in _ROW]
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([piece.num_rows], pa.int64()), *arrays], ["segment", "n", *_ROW])

    lists = ", ".join(f"{c} array<long>" for c in _ROW)
    pieces = rows.mapInArrow(exchange, f"segment int, n long, {lists}")
    sizes = np.zeros(segments + 1, np.int64)
    for r in pieces.groupBy("segment").agg(F.sum("n").alias("n")).collect():  # a row a segment
        sizes[r["segment"] + 1] = r["n"]
    before = spark.sparkContext.broadcast(np.cumsum(sizes))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Table]] = {}
        for batch in batches:
            for i, segment in enumerate(batch.column("segment").to_pylist()):
                held.setdefault(segment, []).append(pa.table([batch.column(c)[i].values for c in _ROW], names=_ROW))
        for segment in sorted(held):
            table = pa.concat_tables(held.pop(segment))
            table = table.take(pa.array(_order(_keys(table))))
            ranks = pa.array(np.arange(1, table.num_rows + 1) + before.value[segment])
            yield from table.append_column("rank", ranks).combine_chunks().to_batches()

    return pieces.repartitionById(segments, "segment").mapInArrow(merge, ", ".join(f"{c} long" for c in [*_ROW, "rank"]))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row; rank is null where a row is not drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, max_words), bucket_counts(target, max_words))
    rows = materialize(weighted(docs, gain, seed, max_words).withColumn("row", F.monotonically_increasing_id()), "weighted")
    enough = F.col("n_words") >= least_words
    drawn = rows.filter(enough).count() * percent // 100
    sorted_rows = ranked(rows.filter(enough).select(*_ROW), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    out = ["doc_id", "n_features", "weight", "score"]
    return sorted_rows.select(*out, rank.alias("rank")).unionByName(rows.filter(~enough).select(*out, F.lit(None).cast("long").alias("rank")))
