"""Exact order statistics without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def at_rank(df: DataFrame, column: str, rank: int, width: float = 1e-3):
    """The value at a zero-based rank of ``column``, nulls left out; None past the end.

    Counts by bucket of ``width`` find the bucket (for degrees at most 360 / width rows),
    then counts by value inside that one bucket find the value.
    """
    value = F.col(column)
    some = df.filter(value.isNotNull())
    buckets = some.groupBy(F.floor(value / width).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    upto = buckets.withColumn("upto", F.sum("n").over(Window.orderBy("b")))
    at = upto.filter(F.col("upto") > rank).orderBy("b").first()
    if at is None:
        return None
    inside = some.filter(F.floor(value / width) == at["b"]).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranked = inside.withColumn("upto", F.sum("n").over(Window.orderBy("v")))
    return ranked.filter(F.col("upto") > rank - (at["upto"] - at["n"])).agg(F.min("v")).first()[0]
