"""Feeds as streams: changed content only, late rows dropped, change lists applied, failure runs kept.

Each run takes what there is (availableNow) and ends. A caller that names ``path`` can stop and
come back: the log of what was read and the tables made so far lie there, and the next run
goes on from them. Without a path a run stands alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators.shared import shared_path
from waymill.plans import changes as plan


def read_stream(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A file-source stream over one table's files."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run(stream: DataFrame, mode: str = "append", path: str | None = None) -> DataFrame:
    """Drain a stream into a table below ``path`` and read it."""
    spark, path = stream.sparkSession, path or shared_path(stream.sparkSession, "stream")
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/rows").option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def newest(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The last whole generation g0, g1, ... below a path, of those before a number if one is given."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    whole = [int(n[1:]) for n in names if re.fullmatch(r"g\d+", n) and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return max((n for n in whole if before is None or n < before), default=None)


def fold(stream: DataFrame, start: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], path: str | None = None) -> DataFrame:
    """A table kept up to date with a stream: each batch makes the next generation from the last one before it.

    Generation 0 is ``start``, batch n makes generation n + 1. A batch that is given again after
    a failure starts from the same generation and replaces its own, so it counts once.
    """
    spark, path = stream.sparkSession, path or shared_path(stream.sparkSession, "fold")
    if newest(spark, path) is None:
        start.write.mode("overwrite").parquet(f"{path}/g0")

    def step(batch: DataFrame, number: int) -> None:
        held = spark.read.parquet(f"{path}/g{newest(spark, path, number + 1)}")
        merge(held, batch).write.mode("overwrite").parquet(f"{path}/g{number + 1}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/g{newest(spark, path)}")


def changed_only(stream: DataFrame, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark: unchanged content is passed over."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def counts_by_window(stream: DataFrame, ts: str, width: str, delay: str, *keys: str) -> DataFrame:
    """Closed windows only: rows later than ``delay`` are out of retention."""
    made = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return made.select(F.col("window.start").alias("start"), *keys, "n")


def failure_runs(stream: DataFrame, path: str | None = None) -> DataFrame:
    """provider, fails in a row, hold seconds, rows seen: the table form's runs of each batch, merged into the state.

    A batch that only failed adds to the run before it, any other starts the run anew.
    """
    c = F.col

    def merge(held: DataFrame, batch: DataFrame) -> DataFrame:
        own = plan.failure_runs(batch).select("provider", c("fails").alias("new"))
        own = own.join(batch.groupBy("provider").agg(F.count(F.lit(1)).alias("rows")), "provider")
        both = held.select("provider", "fails", "n").join(own, "provider", "full_outer")
        before = F.coalesce("fails", F.lit(0))
        fails = F.when(c("rows").isNull(), before).when(c("new") == c("rows"), before + c("new")).otherwise(c("new"))
        return both.select("provider", fails.alias("fails"), plan.hold(fails).cast("long").alias("hold_s"), (F.coalesce("n", F.lit(0)) + F.coalesce("rows", F.lit(0))).alias("n"))

    none = stream.sparkSession.createDataFrame([], "provider long, fails long, hold_s long, n long")
    return fold(stream, none, merge, path)


def apply_change_stream(changes: DataFrame, base: DataFrame, key: str = "id", seq: str = "seq", path: str | None = None) -> DataFrame:
    """Base table plus a stream of numbered changes, merged batch by batch into generations."""

    def merge(held: DataFrame, batch: DataFrame) -> DataFrame:
        rows = held.select(key, F.col(seq), F.when(F.col("gone"), "delete").otherwise("create").alias("action"), "payload").unionByName(batch.select(key, F.col(seq).cast("long"), "action", "payload"))
        last = rows.groupBy(key).agg(F.max_by(F.struct("action", "payload", seq), seq).alias("l"))
        return last.select(key, "l.payload", F.col(f"l.{seq}").alias(seq), (F.col("l.action") == "delete").alias("gone"))

    start = base.select(key, "payload", F.lit(-1).cast("long").alias(seq), F.lit(False).alias("gone"))
    return fold(changes, start, merge, path).filter("not gone").drop("gone")
