"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the rows over its real share. A
document's count is the inverse of the Poisson distribution with that mean at a uniform
number from a hash of (seed, doc_id, digest of the text, part); a mean above ``PART_MEAN`` is the sum of equal
parts, so no exponential underflows and no tail is cut (the table of the distribution goes
on to where 52 bits cannot tell it from 1). Each document is exploded by its count and all
copies are dealt to partitions and ordered by a hash of (seed, doc_id, digest, copy): a global
shuffle in one exchange. Column functions only.

Rates are one row a source. Sources with at least one in ``BROADCAST_SOURCES`` of the rows, so
at most that many, are broadcast and met in place; the rows of all smaller sources meet theirs
by sort-merge, none of which can be hot. The plan is the same at every size.

Defined cases: a null source is the source ''; a source without a target weight has weight
0 and goes; weights that are null or negative count as 0; all weights 0 give no rows; rows
repeated with one doc_id and one text share a count, as copies of one document, but not a partition
of the shuffle; other rows of one doc_id draw apart; rows without doc_id each draw by the digest of their text and their place in the input;
null, empty and very long texts are rows like any other; extra columns pass through whatever
their names, and ``copy_no`` and ``mix_key`` are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

SEED = 42
PART_MEAN = 16.0
BROADCAST_SOURCES = 4096
SPREAD = 1024  # partitions that rows of one key can be dealt to


def uniform(*parts: Column) -> Column:
    """52 bits of MD5 as a number in [0, 1)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cumulative(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... to where the tail is below 2^-52."""
    steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int"))
    first = F.exp(-mean)
    table = F.aggregate(
        steps,
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * mean / k)).alias("c")),
        lambda s: s["c"],
    )
    return table


def tempered(counts: DataFrame, power: float = 0.5) -> DataFrame:
    """Target weights: rows of a source to the power."""
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def source_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def rates(counts: DataFrame, weights: DataFrame, rows: int) -> DataFrame:
    """source, n, mean: copies per document so that ``rows`` copies are expected in all."""
    weighed = counts.join(weights.select("source", F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight")), "source")
    total = weighed.agg(F.sum("weight")).first()[0] or 0.0
    mean = F.col("weight") / F.lit(total) * F.lit(float(rows)) / F.col("n") if total > 0 else F.lit(0.0)
    return weighed.select("source", "n", mean.alias("mean"))


def mix(docs: DataFrame, weights: DataFrame | None = None, rows: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` replicated to the target mix and shuffled, with copy_no (from 1) and mix_key."""
    c = F.col
    counts = materialize(source_counts(docs), "sources")
    total = counts.agg(F.sum("n")).first()[0] or 0
    table = rates(counts, tempered(counts) if weights is None else weights, total if rows is None else rows)
    parts = F.greatest(F.lit(1), F.ceil(c("mean") / PART_MEAN)).cast("int")
    table = materialize(table.filter("mean > 0").select("source", "n", parts.alias("parts"), cumulative(c("mean") / parts).alias("table")), "rates")
    large = c("n") * BROADCAST_SOURCES >= total
    place = F.monotonically_increasing_id()
    whole = docs.select(
        F.struct(*[c(f"`{x}`") for x in docs.columns if x.lower() not in ("copy_no", "mix_key")]).alias("doc"), F.coalesce("source", F.lit("")).alias("source"), place.alias("place"),
        F.concat_ws(":", F.coalesce(c("doc_id").cast("string"), F.lit("none")), F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.when(c("doc_id").isNull(), place)).alias("name"),
    )
    near = whole.join(F.broadcast(table.filter(large).drop("n")), "source")
    far = whole.join(F.broadcast(counts.filter(large).select("source")), "source", "left_anti").join(table.filter(~large).drop("n").hint("merge"), "source")
    draws = F.transform(F.sequence(F.lit(1), c("parts")), lambda part: uniform(F.lit(str(seed)), c("name"), part.cast("string")))
    copies = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("table", lambda x: x <= u)))
    counted = near.unionByName(far).select("doc", "name", "place", copies.alias("copies")).filter("copies > 0")
    each = counted.select("doc", "name", "place", F.explode(F.sequence(F.lit(1), c("copies"))).alias("copy_no"))
    keyed = each.select("doc", "copy_no", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), "name", c("copy_no").cast("string")).cast("binary")).alias("mix_key"), F.pmod("place", F.lit(SPREAD)).alias("spread"))
    return keyed.repartition("mix_key", "spread").sortWithinPartitions("mix_key").select("doc.*", "copy_no", "mix_key")
