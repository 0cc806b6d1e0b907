"""The folder that the driver and every executor share, and tables written to it.

Iterative and multi-pass operators cut their lineage here: the rows go to Parquet and
are read again, so a lost executor costs one stage and never the whole history.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession


_WRITTEN: list[str] = []  # steps that are still there


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh one for local tests only."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/waymill-{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    """Actions in here delete their shuffle files when they end, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start there, so its shuffles go at once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with _freed(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    _WRITTEN.append(path)
    return back


def observed(df: DataFrame, name: str, **sums: Column) -> tuple[DataFrame, dict]:
    """``materialize``, with aggregates of the rows taken while they are written."""
    seen = Observation()
    back = materialize(df.observe(seen, *[v.alias(k) for k, v in sums.items()]), name)
    return back, seen.get


def release_all(spark: SparkSession) -> int:
    """Delete every step that this driver has materialized so far; returns their number.

    A result that an operator returns may still read its steps, so only the caller knows when they
    can go: call this when the results have been written or collected.
    """
    gone = list(_WRITTEN)
    for path in gone:
        _delete(spark, path)
    return len(gone)


def _delete(spark: SparkSession, location: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if location in _WRITTEN:
        _WRITTEN.remove(location)


def release(step: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once no plan that is still to run reads it."""
    _delete(step.sparkSession, step.written_to)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
