"""Cross-entropy difference of a target and a background n-gram model.

Background: every document; target: those whose label is 1. Both are bigram models over one
vocabulary of hashed words (44 bits), in contexts that are the previous word's class (one of
``CLASSES``, by hash; begin-of-text is a context of its own). Every pair of context and word of
every whole text is counted, none is left out or capped:

    P(b | a) = (n(a, b) + PRIOR * P(class of b)) / (n(a) + PRIOR)

with P(class) = (n(class) + 1) / (all + CLASSES). Class and context counts are tables of a fixed
size, so broadcast; the pair counts grow with the corpus and stay distributed. Each document
sends its pairs once to the task that holds the pair's bucket, where a window counts the pair
over the whole corpus and turns it into a gain; gains are summed back by document. Pairs travel
in arrays, one a block of documents and bucket, so that one costs little more than its key.

Hot pairs would fill one bucket. A pair with 2 / HOT of all (document, pair) rows has 1 / HOT of
them in some block, so the pairs that blocks report at that share, if the reports sum to
1 / (2 * HOT) of all rows, hold every such pair and are 2 * HOT at most. They are counted
exactly in a pass of their own and looked up in place.

The score of a document is the mean over its words of background minus target log loss: above
0 means that it looks more like the target.

Defined cases: null and word-less texts score 0.0 with n_words 0; a very long text is a block of
its own; a null doc_id is scored and belongs to the background; rows repeated count each time; of
conflicting labels the larger holds; with no target document every score is 0.0; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

CLASS_BITS, WORD_BITS = 18, 44
CLASSES = 1 << CLASS_BITS
PRIOR = 20.0
HOT = 1 << 12
BLOCK_WORDS = 1 << 18
BLOCK_DOCS = 1 << 14  # places in a block fit two bytes
TARGET_IDS = 1 << 22  # as many target ids are broadcast; more are joined by sort-merge


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split on ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


def flagged(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, text, target (0 or 1) for every row, in an order that a task run again repeats."""
    named = materialize(labels.filter(F.col("doc_id").isNotNull() & (F.col(label) == 1)).select(F.col("doc_id").alias("target_id")).distinct(), "targets")
    few = named.count() <= TARGET_IDS
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").join(F.broadcast(named) if few else named.hint("merge"), F.col("doc_id") == F.col("target_id"), "left")
    ordered = rows if few else rows.sortWithinPartitions("row")  # a broadcast keeps the order of the scan, an exchange has none
    return ordered.select("doc_id", "text", F.col("target_id").isNotNull().cast("int").alias("target"))


def word_codes(words: list[bytes]) -> np.ndarray:
    flat = np.empty(len(words), object)
    flat[:] = words
    return (pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)).view(np.int64) & ((1 << WORD_BITS) - 1)


def coded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text; then a key for every word, in order: its context above its own code.

    A context is the class of the word before plus 1, or 0 at the begin of a text.
    """
    words = [words_of(t) for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = word_codes([w for d in words for w in d])
    context = np.concatenate([np.zeros(1, np.int64), (codes[:-1] & (CLASSES - 1)) + 1])[: len(codes)]
    context[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    return lengths, context << WORD_BITS | codes


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch part, lengths, keys, counts, owners) of blocks of rows (doc_id, text, target): each document's distinct keys, with their counts."""
    for batch in batches:
        texts, begin, size = batch.column("text").to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t) // 6 if isinstance(t, str) else 0
            if size > BLOCK_WORDS or i + 1 - begin == BLOCK_DOCS or i + 1 == len(texts):
                lengths, keys = coded(texts[begin : i + 1])
                owners = np.repeat(np.arange(len(lengths)), lengths)
                order = np.argsort(keys, kind="stable")  # owners ascend within a key
                keys, owners = keys[order], owners[order]
                first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]))
                yield batch.slice(begin, i + 1 - begin), lengths, keys[first], np.diff(first, append=len(keys)), owners[first]
                begin, size = i + 1, 0


def target_of(part: pa.RecordBatch) -> np.ndarray:
    return part.column("target").to_numpy(zero_copy_only=False).astype(np.int64)


def statistics(rows: DataFrame) -> DataFrame:
    """kind, key and counts, written out.

    kind 0: a class (or, at ``CLASSES``, the begin of texts) with n and t as a word, cn and ct as a
    context; kind 1: a pair that blocks report as hot, with its rows; kind 2: all rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = np.zeros((4, CLASSES + 1), np.int64), 0

        def out(kind, key, *counts):
            columns = {"kind": np.full(len(key), kind, np.int32), "key": key} | dict(zip(("n", "t", "cn", "ct"), [*counts, *[np.zeros(len(key), np.int64)] * 4], strict=False))
            return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

        for part, _, keys, n, owners in blocks(batches):
            flags = target_of(part)[owners] * n
            word, context = keys & (CLASSES - 1), keys >> WORD_BITS
            for at, (where, weight) in enumerate(((word, n), (word, flags), (np.where(context, context - 1, CLASSES), n), (np.where(context, context - 1, CLASSES), flags))):
                sums[at] += np.bincount(where, weights=weight, minlength=CLASSES + 1).astype(np.int64)
            total += len(keys)
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
            held = np.diff(first, append=len(keys))
            hot = held * HOT >= len(keys)
            if hot.any():
                yield out(1, keys[first][hot], held[hot])
        some = np.flatnonzero(sums.any(axis=0))
        yield out(0, some, *[s[some] for s in sums])
        yield out(2, np.zeros(1, np.int64), np.array([total]))

    counted = rows.mapInArrow(count, "kind int, key long, n long, t long, cn long, ct long")
    return materialize(counted.groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in ("n", "t", "cn", "ct")]), "statistics")


def gain(n: Column, t: Column, stats: DataFrame, pairs: DataFrame, key: str, all_words: tuple[int, int]) -> DataFrame:
    """``pairs`` with gain, background minus target log loss, from the pair's counts n and t."""
    classes = stats.filter("kind = 0")
    context = F.broadcast(classes.select(F.col("key").alias("context key"), F.col("cn").alias("context n"), F.col("ct").alias("context t")))  # CLASSES + 1 rows at most
    word = F.broadcast(classes.select(F.col("key").alias("word key"), F.col("n").alias("word n"), F.col("t").alias("word t")))
    at = F.shiftright(key, WORD_BITS)
    met = pairs.join(context, F.when(at > 0, at - 1).otherwise(F.lit(CLASSES)) == F.col("context key"), "left").join(word, F.col(key).bitwiseAND(F.lit(CLASSES - 1)) == F.col("word key"), "left")

    def chance(pair: Column, side: str, total: int) -> Column:
        return (pair + F.lit(PRIOR) * (F.col(f"word {side}") + 1) / F.lit(float(total + CLASSES))) / (F.col(f"context {side}") + F.lit(PRIOR))

    found = met.withColumn("gain", F.log(chance(t, "t", all_words[1])) - F.log(chance(n, "n", all_words[0])))
    return found.drop("context key", "context n", "context t", "word key", "word n", "word t")


def hot_gains(rows: DataFrame, stats: DataFrame, all_words: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and gains of the hot pairs; 2 * HOT at most."""
    total = stats.filter("kind = 2").select("n").first()
    keys = np.sort([r["key"] for r in stats.filter((F.col("kind") == 1) & (F.col("n") * (2 * HOT) >= F.lit(total["n"] if total else 0))).select("key").collect()]).astype(np.int64)
    if not len(keys):
        return keys, np.zeros(0)
    shared = rows.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        sums = np.zeros((2, len(wanted)), np.int64)
        for part, _, found, n, owners in blocks(batches):
            at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
            hit = wanted[at] == found
            sums[0] += np.bincount(at[hit], weights=n[hit], minlength=len(wanted)).astype(np.int64)
            sums[1] += np.bincount(at[hit], weights=(n * target_of(part)[owners])[hit], minlength=len(wanted)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"key": pa.array(wanted), "n": pa.array(sums[0]), "t": pa.array(sums[1])})

    counted = rows.mapInArrow(count, "key long, n long, t long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    gains = {r["key"]: r["gain"] for r in gain(F.col("n"), F.col("t"), stats, counted, "key", all_words).collect()}
    return keys, np.array([gains[k] for k in keys.tolist()])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, score for every row."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = flagged(docs, labels)
    stats = statistics(rows)
    all_words = tuple(x or 0 for x in stats.filter("kind = 0").agg(F.sum("n"), F.sum("t")).first())
    shared = spark.sparkContext.broadcast(hot_gains(rows, stats, all_words))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # smaller than usual: a pair unfolds to a wide row
    buckets = 4 * parts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a document (key -1) with its words and what its hot pairs gain; then arrays of the other pairs by bucket."""
        hot, hot_gain = shared.value
        named = TaskContext.get().partitionId() << 40  # rows are named by task and place, whatever order they come in
        for part, lengths, keys, n, owners in blocks(batches):
            docs_, flags = len(lengths), target_of(part)
            row = named + np.arange(docs_)
            named += docs_
            at = np.minimum(np.searchsorted(hot, keys), max(len(hot) - 1, 0))
            hit = hot[at] == keys if len(hot) else np.zeros(len(keys), bool)
            known = np.bincount(owners[hit], weights=(n[hit] * hot_gain[at[hit]]) if len(hot) else None, minlength=docs_).astype(np.float64)
            keys, owners, packed = keys[~hit], owners[~hit], (2 * n + flags[owners])[~hit]
            bucket = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            bucket, keys, owners, packed = bucket[order], keys[order], owners[order], packed[order]
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(bucket)), bool), bucket[1:] != bucket[:-1]]))
            cuts = np.concatenate([np.arange(docs_), docs_ + first, [docs_ + len(keys)]]).astype(np.int32)
            lists = lambda own, other, type_: pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([own, other]), type_))
            more = len(first)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(np.concatenate([row % buckets, bucket[first]]), pa.int32()),
                    "base": pa.array(np.concatenate([row, np.full(more, named - docs_)]), pa.int64()),
                    "doc_id": pa.concat_arrays([part.column("doc_id"), pa.nulls(more, part.column("doc_id").type)]),
                    "n_words": pa.concat_arrays([pa.array(lengths), pa.nulls(more, pa.int64())]),
                    "known": pa.concat_arrays([pa.array(known), pa.nulls(more, pa.float64())]),
                    "key": lists(np.full(docs_, -1), keys, pa.int64()),
                    "place": lists(np.zeros(docs_, np.int64), owners, pa.int16()),
                    "packed": lists(np.zeros(docs_, np.int64), packed, pa.int32()),
                }
            )

    schema = f"bucket int, base long, doc_id {kind}, n_words long, known double, key array<long>, place array<smallint>, packed array<int>"
    sent = rows.mapInArrow(send, schema).repartition(parts, "bucket")
    each = sent.select("bucket", "base", "doc_id", "n_words", "known", F.inline(F.arrays_zip("key", "place", "packed")))
    each = each.select("bucket", "key", (F.col("base") + F.col("place")).alias("row"), "packed", "doc_id", "n_words", "known")
    pair = Window.partitionBy("bucket", "key")  # a bucket is a function of the key: no second exchange
    count = F.shiftright("packed", 1)
    counted = each.withColumns({"n": F.sum(count).over(pair), "t": F.sum(F.when(F.col("packed").bitwiseAND(F.lit(1)) == 1, count)).over(pair)})
    gained = gain(F.col("n"), F.coalesce("t", F.lit(0)), stats, counted, "key", all_words)
    own = gained.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.sum(F.when(F.col("key") < 0, F.col("known")).otherwise(count * F.col("gain"))).alias("s"),
    )
    mean = F.when(F.col("n_words") > 0, F.col("s") / F.col("n_words")).otherwise(0.0) if all_words[1] else F.lit(0.0)
    return own.select("doc_id", "n_words", mean.alias("score"))
