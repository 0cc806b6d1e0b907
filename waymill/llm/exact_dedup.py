"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

``DigestIndex`` is a folder of generations, one a batch. A batch is digested and aggregated to
one row a digest (partial aggregation first, so a text that a third of the rows share is a few
rows after the map side). Its digests are anti-joined by sort-merge, bucket against bucket, to
those of every earlier generation; the new ones are appended to the index, bucketed and sorted
by digest, and so are the counts of those known before. A text's size is the sum over all
generations. Column functions only.

``exact_dedup`` deals its rows by descending doc_id into ``BATCHES`` batches, newest ids first,
and adds one after the other, so that the first document that the index meets of equal texts
is the one with the largest doc_id.

Defined cases: a null text is the empty text; a very long text is one digest like any other; a
null doc_id never wins against another; if every doc_id of a group is null, keep_id is null.
Rows repeated with one doc_id and one text share the decision of that doc_id. Extra input
columns are ignored, whatever their names. An empty batch appends nothing and returns no row.
A generation counts only if both of its tables were written to the end; a half-written one is
replaced by the next batch.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators.shared import materialize, shared_path
from waymill.operators.skew import salted_lookup

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INDEX_SCHEMA = "digest string, keep_id long, group_size long"
BUCKETS = 64
BATCHES = 3
GENERATIONS = 16


def normalised(text: Column) -> Column:
    """A-Z lower-cased only. Pure ASCII takes the byte-wise lower(), which is the same there."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def digest_of(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest and a number for each row, written out: the only look at the texts."""
    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")


class DigestIndex:
    """Generations of two bucketed tables under one folder: texts first met, and counts of texts met again.

    A batch is held against each generation bucket by bucket, so that only the batch is shuffled.
    Past ``GENERATIONS`` of them all are merged into one (folder ``c`` with the number of the last
    that it covers), written whole before the old ones go; so a batch meets a bounded number.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path or shared_path(spark, "digests"), buckets
        self.first: list[DataFrame] = []  # bucketed, one a generation
        self.again: list[DataFrame] = []
        self.folders: list[str] = []
        self.following = 0  # number of the next generation

    def _hold(self, folder: str, first: DataFrame, again: DataFrame) -> None:
        self.folders.append(folder)
        self.first.append(first)
        self.again.append(again)
        self.following = int(folder[1:]) + 1

    def rows(self, of: DataFrame | None = None) -> DataFrame | None:
        """One entry a text: digest, the document that stays, the rows seen so far; with ``of``, of its digests only."""
        if not self.folders:
            return None
        if of is None:  # read as plain files: this look needs no buckets
            every = self.spark.read.schema(INDEX_SCHEMA).parquet(*[f"{self.path}/{folder}/{part}" for folder in self.folders for part in ("first", "again")])
        else:
            wanted = of.select("digest").hint("merge")
            every = reduce(DataFrame.unionByName, [known.join(wanted, "digest", "left_semi") for known in [*self.first, *self.again]])
        return every.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))

    def _files(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def open(self) -> DigestIndex:
        """Attach the whole generations that an earlier session left under the folder."""
        path, fs = self._files()
        self.first, self.again, self.folders, self.following = [], [], [], 0
        names = {s.getPath().getName() for s in fs.listStatus(path(self.path))} if fs.exists(path(self.path)) else set()
        whole = {n for n in names if re.fullmatch(r"[cg]\d{6}", n) and all(fs.exists(path(f"{self.path}/{n}/{part}/_SUCCESS")) for part in ("first", "again"))}
        merged = max((n for n in whole if n[0] == "c"), default=None)
        folder = merged or "g000000"
        while folder in whole:  # what follows a gap was written after a failure
            self._hold(folder, *[self._attached(f"{self.path}/{folder}/{part}") for part in ("first", "again")])
            folder = f"g{self.following:06d}"
        return self

    def compact(self) -> None:
        """Merge all generations into one and delete them."""
        old, folder = self.folders, f"c{self.following - 1:06d}"
        every = self.rows()
        first = self._written(every, f"{self.path}/{folder}/first")
        again = self._written(every.limit(0), f"{self.path}/{folder}/again")
        self.first, self.again, self.folders = [], [], []
        self._hold(folder, first, again)
        path, fs = self._files()
        for name in old:
            fs.delete(path(f"{self.path}/{name}"), True)

    def _attached(self, location: str) -> DataFrame:
        """The bucketed table there; its catalog entry goes as soon as the plan holds its layout."""
        name = f"waymill_digest_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} ({INDEX_SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{location}'")
        return self._taken(name)

    def _taken(self, name: str) -> DataFrame:
        frame = self.spark.table(name)
        frame.schema  # resolved here
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        return frame

    def _written(self, rows: DataFrame, location: str) -> DataFrame:
        name = f"waymill_digest_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets))).sortWithinPartitions("digest")
        dealt.select("digest", "keep_id", "group_size").write.mode("overwrite").bucketBy(self.buckets, "digest").sortBy("digest").option("path", location).saveAsTable(name)
        return self._taken(name)

    def append(self, rows: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, digest) rows as a generation; returns its texts."""
        if len(self.folders) >= GENERATIONS:
            self.compact()
        groups = materialize(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "batch")
        new = groups
        for known in self.first:
            new = new.join(known.select("digest").hint("merge"), "digest", "left_anti")
        folder = f"g{self.following:06d}"
        first = self._written(new, f"{self.path}/{folder}/first")
        met = groups.join(first.select("digest").hint("merge"), "digest", "left_anti").withColumn("keep_id", F.lit(None).cast("long"))
        self._hold(folder, first, self._written(met, f"{self.path}/{folder}/again"))
        return groups

    def decide(self, rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
        """doc_id, digest, keep_id, group_size, kept of indexed rows (doc_id, digest, row), whose texts are ``of`` (all if none)."""
        entries = materialize(self.rows(of), "entries")
        decided = salted_lookup(rows, entries, "digest", "group_size", rows.count(), F.col("row"))
        return decided.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "digest", "keep_id", "group_size", "kept")

    def add(self, docs: DataFrame) -> DataFrame:
        """Index the batch; return doc_id, digest, keep_id, group_size, kept for each of its rows.

        A text that the index holds already keeps its earlier document and none of the batch
        stays, save for rows of that same doc_id; among new equal texts the largest doc_id
        stays. group_size counts the rows of the text over all generations.
        """
        rows = digests(docs)
        return self.decide(rows, self.append(rows))


def batches(rows: DataFrame, parts: int = BATCHES) -> list[DataFrame]:
    """Rows by descending doc_id in ranges of equal width; null ids come last."""
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return [rows]
    cuts = [low + (high + 1 - low) * i // parts for i in range(parts + 1)]
    dealt = [rows.filter((F.col("doc_id") >= a) & (F.col("doc_id") < b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [*dealt[:0:-1], rows.filter(F.col("doc_id").isNull() | (F.col("doc_id") < cuts[1]))]


def _dealt_out(docs: DataFrame) -> DataFrame:
    rows, index = digests(docs), DigestIndex(docs.sparkSession)
    for batch in batches(rows):
        index.append(batch)
    return index.decide(rows)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, digest, keep_id, group_size and kept for every row, against an index that starts empty."""
    return _dealt_out(docs)


def keep_first_of_equal(docs: DataFrame) -> DataFrame:
    """Only the staying rows, all columns; rows repeated with one doc_id and text stay once."""
    key = lambda digest: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)
    stay = materialize(exact_dedup(docs).filter("kept").groupBy(key(F.col("digest")).alias("key")).agg(F.count(F.lit(1)).alias("n")), "stay")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key(digest_of(F.col("text"))).alias("key"))
    left = salted_lookup(whole, stay, "key", "n", stay.agg(F.sum("n")).first()[0] or 0, F.monotonically_increasing_id())
    return left.filter("n = 1").select("doc.*").unionByName(left.filter("n > 1").dropDuplicates(["key"]).select("doc.*"))
