"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds at least this share of the rows; so at most
#: 1 / HOT_SHARE keys are hot and a broadcast of them has a proven bound.
HOT_SHARE = 1 / 1000
HOT_ROWS = 2000
HOT_SPLITS = 512


def salted_lookup(rows: DataFrame, lookup: DataFrame, key: str, size: str, total: int, spread: Column) -> DataFrame:
    """Inner join of ``rows`` to ``lookup`` (one row a key, with its row count in ``size``).

    Hot keys, at most 1/HOT_SHARE of them, are broadcast with the number of parts each is
    cut into; their lookup rows are repeated once a part and their rows are dealt over the
    parts by ``spread``. Every other key has one part. ``spread`` must be deterministic.
    """
    at_least = max(HOT_ROWS, int(total * HOT_SHARE) + 1)
    hot = lookup.filter(F.col(size) >= at_least).select(
        F.col(key).alias("__hot_key"), F.least(F.lit(HOT_SPLITS), F.ceil(F.col(size) / F.lit(at_least)) + 1).cast("int").alias("__parts")
    )
    parts = F.coalesce(F.col("__parts"), F.lit(1))
    left = (
        rows.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left")
        .withColumn("__salt", F.pmod(F.xxhash64(spread), parts).cast("int"))
        .drop("__hot_key", "__parts")
    )
    own = F.when(F.col(size) >= at_least, F.least(F.lit(HOT_SPLITS), F.ceil(F.col(size) / F.lit(at_least)) + 1)).otherwise(F.lit(1)).cast("int")
    right = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), own - 1)))
    return left.join(right, [key, "__salt"]).drop("__salt")
