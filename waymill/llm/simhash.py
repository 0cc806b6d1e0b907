"""SimHash near-dedup by a segment-popcount embedding.

The 64-bit fingerprint is cut into 32 segments of two bits; the embedding is the bit count
of each segment, 0 to 2, packed two bits apiece. Bits that differ move a
segment's count by at most as many, so the Manhattan distance of two embeddings is never
above their Hamming distance: it is the lower bound that the grid join filters by, before
the exact check.

Grid: the segments are dealt into G groups. A pair within distance k leaves at least G - k
groups with equal counts, so each fingerprint goes to one cell for each choice of G - k
groups, and partners meet in a cell. G follows from the number of fingerprints alone
(``grid_groups``): every G is exact, larger ones trade more cells for fewer chance meetings.

A dense group of near copies would fill whole cells, so a cell is first linked to its
smallest fingerprint only (a star, linear in the cell), the stars are joined to components,
and the pair join then meets only rows whose component differs from that of the cell's
head. A cell where that would still be over ``CROWD`` pairs, as several large components meet
in it, is not joined: its fingerprints go to a finer grid (8 of 12 groups), where only those
share a cell that agree in two thirds of the segments. No link between different components is
lost.

Segments are narrow because the bound must tell: of two random fingerprints it lets through one
pair in 3 * 10^8 with 32 segments of two bits, one in 5 * 10^4 with 16 of four and one in 220
with 8 of eight, whatever the grid.

Defined cases: null and word-less texts have fingerprint 0 and link like any other; repeated
rows share a fingerprint; a very long text is read whole, in time and memory in proportion to its
length, and is one fingerprint like any other; a null doc_id gets the component of its fingerprint and is never
its name unless no other id is there (then null); extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from waymill.llm.simhash_bits import fingerprint
from waymill.operators.components import connected_components
from waymill.operators.shared import materialize, observed
from waymill.operators.skew import salted_lookup

MAX_BITS = 4
SEGMENTS = 32
LOW = 0x5555555555555555
CROWD = 1 << 20  # pairs of a cell
FINE_GROUPS = 12
SAME_COUNT = 0.375  # chance that two random two-bit segments have equal counts


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint as a signed 64-bit integer with the same bits."""
    return pd.Series([f - (1 << 64) if (f := fingerprint(t)) >> 63 else f for t in texts], dtype="int64")


def embedding(fp: Column) -> Column:
    """Both bits of a segment: 10; one of them: 01 (the sum of the two, without a carry)."""
    low, high = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))


def manhattan(a: Column, b: Column) -> Column:
    """Of two packed embeddings: counts 0-1 and 1-2 differ by one, 0-2 (xor 10) by two."""
    low, high = a.bitwiseXOR(b).bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(a.bitwiseXOR(b), 1).bitwiseAND(F.lit(LOW))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def grid_groups(n: int, k: int = MAX_BITS) -> int:
    """Groups that make cells times (1 + chance partners / 32) least for n fingerprints."""
    cost = {g: comb(g, k) * (1 + n * SAME_COUNT ** (SEGMENTS * (g - k) / g) / 32) for g in range(k + 1, 13)}
    return min(cost, key=cost.get)


def _masks(groups: int) -> list[int]:
    cut = [round(SEGMENTS * i / groups) for i in range(groups + 1)]
    return [((1 << 2 * (cut[i + 1] - cut[i])) - 1) << 2 * cut[i] for i in range(groups)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cells(fps: DataFrame, groups: int, k: int) -> DataFrame:
    """A row for each cell of each fingerprint: cell = which groups, and their counts."""
    masks = _masks(groups)
    choices = [_signed(sum(masks[i] for i in c)) for c in combinations(range(groups), groups - k)]
    table = F.array(*[F.struct(F.lit(i).alias("no"), F.lit(m).alias("mask")) for i, m in enumerate(choices)])
    return (
        fps.withColumn("e", embedding(F.col("fp")))
        .withColumn("__c", F.explode(table))
        .withColumn("cell", F.col("e").bitwiseAND(F.col("__c.mask")))
        .withColumn("no", F.col("__c.no"))
        .drop("__c")
    )


def near_components(fps: DataFrame, k: int = MAX_BITS, groups: int | None = None) -> DataFrame:
    """``fps``, of distinct fingerprints, with comp: the exact components of links at <= k bits."""
    groups = groups or grid_groups(fps.count(), k)

    def close(a: str, b: str) -> Column:
        return (manhattan(F.col(f"{a}.e"), F.col(f"{b}.e")) <= k) & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= k)

    cells = _cells(fps.select("fp"), groups, k)
    heads = cells.groupBy("no", "cell").agg(F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("e", embedding(F.col("fp")))
    same_cell = lambda a, b: (F.col(f"{a}.no") == F.col(f"{b}.no")) & (F.col(f"{a}.cell") == F.col(f"{b}.cell"))
    stars = cells.alias("a").join(heads.alias("h"), same_cell("a", "h") & (F.col("a.fp") != F.col("h.fp")) & close("a", "h"))

    labels = connected_components(stars.select(F.col("a.fp").alias("src"), F.col("h.fp").alias("dst")))
    labelled = fps.join(labels, fps["fp"] == labels["node"], "left").select(*fps.columns, F.coalesce("component", "fp").alias("comp"))
    labelled = materialize(labelled, "labels")

    def cell_heads(cells: DataFrame) -> DataFrame:
        """Cells with more than one component; ``full``: more than ``CROWD`` pairs to look at."""
        sizes = cells.groupBy("no", "cell", "comp").agg(F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n"))
        heads = sizes.groupBy("no", "cell").agg(F.min_by("comp", "fp").alias("head"), F.min_by("n", "fp").alias("n_head"), F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
        return heads.select("no", "cell", "head", ((F.col("n_all") - F.col("n_head")) * F.col("n_all") > F.lit(CROWD)).alias("full"))

    def apart_pairs(cells: DataFrame, heads: DataFrame) -> DataFrame:
        """Close pairs of different components."""
        apart = cells.alias("a").join(heads.alias("h"), same_cell("a", "h") & (F.col("a.comp") != F.col("h.head"))).select("a.*")
        pairs = apart.alias("a").join(cells.alias("b"), same_cell("a", "b") & (F.col("a.comp") != F.col("b.comp")) & close("a", "b"))
        return pairs.select(F.col("a.comp").alias("src"), F.col("b.comp").alias("dst"))

    cells = _cells(labelled.select("fp", "comp"), groups, k)
    heads, crowded = observed(cell_heads(cells), "heads", full=F.count_if("full"))
    pairs = apart_pairs(cells, heads.filter("not full"))
    if crowded["full"]:
        dense = materialize(cells.join(heads.filter("full").select("no", "cell"), ["no", "cell"], "left_semi").select("fp", "comp").distinct(), "dense")
        fine = _cells(dense, FINE_GROUPS, k)
        pairs = pairs.unionByName(apart_pairs(fine, cell_heads(fine)))
    # What the stars left apart: a graph of components, with few edges.
    merged = connected_components(pairs)
    sizes = labelled.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    names = materialize(sizes.join(merged, sizes["comp"] == merged["node"], "left").select("comp", "size", F.coalesce("component", "comp").alias("final")), "merged")
    return salted_lookup(labelled, names, "comp", "size", labelled.count(), F.col("fp")).select(*fps.columns, F.col("final").alias("comp"))


def near_groups(docs: DataFrame, k: int = MAX_BITS, groups: int | None = None) -> DataFrame:
    """doc_id, fp (long), component_id for each row of ``docs``."""
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_of("text").alias("fp"), F.monotonically_increasing_id().alias("row")), "fingerprints")
    return _grouped(rows, k, groups)


def _grouped(rows: DataFrame, k: int, groups: int | None) -> DataFrame:
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    named = materialize(near_components(fps, k, groups), "named")
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    by_fp = materialize(salted_lookup(named, names, "comp", "size", named.count(), F.col("fp")).select("fp", "n", "component_id"), "components")
    return salted_lookup(rows, by_fp, "fp", "n", rows.count(), F.col("row")).select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest doc_id; all columns.

    Rows repeated with the staying doc_id stay once; if a group has only null ids, one row
    of each of its fingerprints stays.
    """
    found = near_groups(docs)
    key = lambda i, fp: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("")), fp.cast("string"))
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(key(F.col("doc_id"), F.col("fp")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    stay = materialize(stay, "stay")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key(F.col("doc_id").cast("long"), fingerprint_of("text")).alias("key"))
    left = salted_lookup(whole, stay, "key", "n", stay.agg(F.sum("n")).first()[0] or 0, F.monotonically_increasing_id())
    return left.filter("n = 1").select("doc.*").unionByName(left.filter("n > 1").dropDuplicates(["key"]).select("doc.*"))
