"""Incremental data: change lists, versions, retention, reuse, promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators.shared import materialize


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first by ``order``."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__r = 1").drop("__r")


def apply_changes(base: DataFrame, changes: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """Base and numbered changes to the current state: the last change of a key wins, deletes go.

    ``base`` has key and payload; ``changes`` also action and seq. Partial aggregation by
    max_by keeps a much-changed key from gathering its history in one task.
    """
    rows = base.select(key, F.lit(-1).cast("long").alias(seq), F.lit("create").alias("action"), "payload").unionByName(changes.select(key, F.col(seq).cast("long").alias(seq), "action", "payload"))
    last = rows.groupBy(key).agg(F.max_by(F.struct("action", "payload", seq), seq).alias("l"))
    return last.filter("l.action <> 'delete'").select(key, "l.payload", F.col(f"l.{seq}").alias(seq))


def gaps(seqs: DataFrame, seq: str = "seq", bucket: int = 100_000) -> DataFrame:
    """Missing ranges in a sequence: start, end. Neighbours are found by bucket, not in one task."""
    s = seqs.select(F.col(seq).cast("long").alias("s")).distinct().withColumn("b", F.floor(F.col("s") / bucket))
    inner = s.withColumn("n", F.lead("s").over(Window.partitionBy("b").orderBy("s")))
    ends = s.groupBy("b").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    order = Window.orderBy("b")  # one row a bucket of sequence numbers
    across = ends.withColumn("n", F.lead("lo").over(order)).select(F.col("hi").alias("s"), "n")
    both = inner.filter("n is not null").select("s", "n").unionByName(across.filter("n is not null"))
    return both.filter("n > s + 1").select((F.col("s") + 1).alias("start"), (F.col("n") - 1).alias("end"))


def hold(fails: Column) -> Column:
    """Seconds to wait after so many failures in a row."""
    return F.when(fails > 0, F.least(F.lit(3600), (5 * F.pow(F.lit(2), F.least(fails, F.lit(8)))).cast("int"))).otherwise(0)


def failure_runs(log: DataFrame) -> DataFrame:
    """provider, fails in a row at the end of its log, hold seconds, last status.

    Hold is 5 x 2^min(fails, 8) seconds, at most 3600, and 0 without a failure.
    """
    done = log.groupBy("provider").agg(F.max(F.when(F.col("status") != "fail", F.struct("ts", "event_id"))).alias("good"), F.max_by("status", F.struct("ts", "event_id")).alias("last_status"))
    runs = log.join(done, "provider").groupBy("provider", "last_status").agg(F.count_if((F.col("status") == "fail") & (F.col("good").isNull() | (F.struct("ts", "event_id") > F.col("good")))).alias("fails"))
    return runs.withColumn("hold_s", hold(F.col("fails")))


def retained(files: DataFrame, budget: int, largest: int, path: str = "path", size: str = "size", bucket: int = 1 << 20) -> DataFrame:
    """Files that stay: none above ``largest``, then the smallest while their sum is within ``budget``.

    The running sum is by size bucket and then inside the bucket, so no task sees all files.
    """
    fit = files.filter(F.col(size) <= largest).withColumn("__b", F.floor(F.col(size) / bucket))
    before = fit.groupBy("__b").agg(F.sum(size).alias("__sum")).withColumn("__before", F.sum("__sum").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("__b").orderBy(size, path)
    summed = fit.withColumn("__run", F.sum(size).over(inside)).join(before, "__b")
    return summed.filter(F.col("__run") + F.coalesce("__before", F.lit(0)) <= budget).select(*files.columns)


def within_budget(candidates: DataFrame, group: str, hours: float) -> DataFrame:
    """Greedy in rank order: a candidate that would pass the budget is deferred and does not use it.

    Each round takes the candidates up to the first that does not fit, and drops those that cost
    more than is left; what a group has left only shrinks, so rounds are few. The running sum
    goes through a sorted window, which spills; no group is gathered, and what is taken of a group
    has the budget's size.
    """
    c = F.col
    rest = materialize(candidates.select(group, "rank", "id", "cost_h"), "candidates")
    sizes = rest.groupBy(group).agg(F.count(F.lit(1)).cast("int").alias("n"))
    taken = None
    used = materialize(sizes.select(group, F.lit(0.0).alias("used")), "used")
    upto = Window.partitionBy(group).orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        fit = rest.join(used, group).filter(c("used") + c("cost_h") <= hours).drop("used")
        if fit.isEmpty():
            break
        summed = fit.withColumn("run", F.sum("cost_h").over(upto)).join(used, group)
        # Costs of 0 or more: the sum passes the budget once and stays beyond it.
        inside = materialize(summed.filter(c("used") + c("run") <= hours).select(group, "rank", "id", "cost_h"), "taken")
        taken = inside if taken is None else materialize(taken.unionByName(inside), "taken")
        rest = materialize(fit.join(inside.select(group, "rank", "id"), [group, "rank", "id"], "left_anti"), "candidates")
        used = materialize(used.join(inside.groupBy(group).agg(F.sum("cost_h").alias("more")), group, "left").select(group, (c("used") + F.coalesce("more", F.lit(0.0))).alias("used")), "used")
    ids = (candidates.limit(0) if taken is None else taken).groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("taken"))
    return sizes.join(used, group).join(ids, group, "left").select(group, F.coalesce("taken", F.array().cast("array<bigint>")).alias("taken"), "n", c("used").alias("used_h"))


def reuse(wanted: DataFrame, cache: DataFrame, epoch: str) -> tuple[DataFrame, DataFrame]:
    """(hits with cached values, misses to compute) by geometry hash within an epoch."""
    live = cache.filter(F.col("epoch") == epoch).drop("epoch")
    return wanted.join(live, "hash"), wanted.join(live, "hash", "left_anti")


def promote(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Pointer by key: the new generation where it passed, else the one before."""
    good = new.filter("passed").select("key", F.col("generation").alias("fresh"))
    return previous.join(good, "key", "full_outer").select("key", F.coalesce("fresh", "generation").alias("generation"), F.col("fresh").isNotNull().alias("promoted"))
