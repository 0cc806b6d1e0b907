"""Quality gates: results are tables of checks with a status, never exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed limits: (least, most) ratio of a pack to its source; widened by terrain class.
BANDS = {"graph": (0.05, 28.0), "poi": (0.005, 2.0), "wetland": (0.0, 0.75), "total": (0.03, 35.0)}
TERRAIN = {"polar_sparse": ("graph", 0, 0.001), "dense_network": ("graph", 1, 35.0), "wetland_heavy": ("wetland", 1, 1.5)}
MAX_CHANGE = 3.0
FIRST_SHARE, FIRST_ABS = 0.05, 50_000


def long_form(packs: DataFrame) -> DataFrame:
    """region_id, generation, source_b, kind, size."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_b").alias("size")) for k in ("graph", "poi", "wetland")], F.struct(F.lit("total").alias("kind"), (F.col("graph_b") + F.col("poi_b") + F.col("wetland_b")).alias("size")))
    return packs.select("region_id", "generation", "source_b", F.explode(kinds).alias("k")).select("region_id", "generation", "source_b", "k.kind", "k.size")


def size_bands(packs: DataFrame, terrain: DataFrame) -> DataFrame:
    """Ratio of each pack size to its source against the band; zero sizes are skipped."""
    rows = long_form(packs).filter("size > 0 and source_b > 0").join(terrain, "region_id", "left")
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for kind, (a, b) in BANDS.items():
        low, high = F.when(F.col("kind") == kind, a).otherwise(low), F.when(F.col("kind") == kind, b).otherwise(high)
    for name, (kind, side, value) in TERRAIN.items():
        hit = (F.col("kind") == kind) & (F.col("terrain") == name)
        low, high = (F.when(hit, value).otherwise(low), high) if side == 0 else (low, F.when(hit, value).otherwise(high))
    ratio = F.col("size") / F.col("source_b")
    return rows.withColumns({"ratio": ratio, "status": F.when((ratio < low) | (ratio > high), "out_of_band").otherwise("ok")})


def size_changes(packs: DataFrame) -> DataFrame:
    """Change of each size against the generation before, in either direction."""
    order = Window.partitionBy("region_id", "kind").orderBy("generation")
    rows = long_form(packs).filter("kind <> 'total'").withColumn("before", F.lag("size").over(order)).filter("size > 0 and before > 0")
    factor = F.greatest(F.col("size") / F.col("before"), F.col("before") / F.col("size"))
    return rows.withColumns({"factor": factor, "status": F.when(factor > MAX_CHANGE, "changed").otherwise("ok")})


def missing_heights(packs: DataFrame, factor: float = 1.5, floor: int = 100) -> DataFrame:
    """First generation by share (or count without edges), later ones against the one before."""
    order = Window.partitionBy("region_id").orderBy("generation")
    rows = packs.select("region_id", "generation", "missing", "edges", F.lag("missing").over(order).alias("before"))
    limit = F.greatest(F.floor(F.col("before") * factor), F.col("before") + floor)
    first = F.when(F.col("edges") > 0, F.col("missing") / F.col("edges") > FIRST_SHARE).otherwise(F.col("missing") >= FIRST_ABS)
    return rows.withColumn("status", F.when(F.when(F.col("before").isNull(), first).otherwise(F.col("missing") > limit), "fail").otherwise("ok"))


def record_counts(packs: DataFrame, low: float = 0.5, high: float = 2.0) -> DataFrame:
    order = Window.partitionBy("region_id").orderBy("generation")
    rows = packs.select("region_id", "generation", "n", F.lag("n").over(order).alias("before"))
    bad = (F.col("n") <= 0) | ((F.col("before") > 0) & ((F.col("n") < F.col("before") * low) | (F.col("n") > F.col("before") * high)))
    return rows.withColumn("status", F.when(F.coalesce(bad, F.lit(False)), "refused").otherwise("ok"))


def catalogue(packs: DataFrame) -> DataFrame:
    """Newest complete generation of each region: it has a manifest and is not in progress."""
    return packs.filter("has_manifest and not in_progress").groupBy("region_id").agg(F.max("generation").alias("generation"))


def kept_generations(packs: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("region_id").orderBy(F.desc("generation"))
    return packs.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= n).drop("__r")


def upsert(old: DataFrame, new: DataFrame, source: str, key: str = "slug") -> DataFrame:
    """Rows of the sources in ``new`` replaced as a whole, other sources kept."""
    gone = new.select(source).distinct()
    return old.join(gone, source, "left_anti").unionByName(new.dropDuplicates([source, key]))


def manifest_status(manifests: DataFrame, sources: DataFrame, version: int) -> DataFrame:
    """missing, stale (size differs), version_mismatch or ready, in that order."""
    both = sources.join(manifests, "region_id", "left")
    status = F.when(F.col("format").isNull(), "missing").when(F.col("recorded_b") != F.col("source_b"), "stale").when(F.col("format") != version, "version_mismatch").otherwise("ready")
    return both.select("region_id", status.alias("status"))


def identical(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of rows on one side only, repeats included."""
    return a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_a")).join(b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_b")))
