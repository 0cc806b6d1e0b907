"""Segment annotations: limits matched to features, wetland triangles hit, reports on both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions import geo
from waymill.operators import cells
from waymill.plans import measures

# Fixed limits of the match.
TOLERANCE_M, BEARING_DEG, BEARING_FROM_M = 8.0, 45.0, 2.0
OVERLAP, OVERLAP_SHORT, SHORT_WAY_M, TINY_M = 0.70, 0.50, 40.0, 0.5
CELL = 40 * geo.QUANTUM
REACH, BLOCK = 2, 5  # cells
COARSE = 64
ALIASES = {
    "cycleway": ("cycleway", "footway-bicycle", "path-bicycle"), "footway": ("footway", "footway-bicycle", "footway-sidewalk", "footway-crossing"),
    "path": ("path", "path-bicycle", "path-difficult", "path-expert"), "service": ("service", "service-driveway", "service-parking_aisle"),
}


def _plane(lat0: Column) -> tuple[Column, Column]:
    """Metres a degree of latitude and of longitude."""
    return F.lit(geo.METRES_A_DEGREE), F.cos(F.radians(lat0)) * geo.METRES_A_DEGREE


def step_m(a: Column, b: Column) -> Column:
    y, x = _plane((a["lat"] + b["lat"]) / 2)
    return F.sqrt(F.pow((b["lon"] - a["lon"]) * x, 2) + F.pow((b["lat"] - a["lat"]) * y, 2))


def heading(a: Column, b: Column) -> Column:
    y, x = _plane((a["lat"] + b["lat"]) / 2)
    return F.pmod(F.degrees(F.atan2((b["lon"] - a["lon"]) * x, (b["lat"] - a["lat"]) * y)), F.lit(360.0))


def legs(path: Column) -> Column:
    """Consecutive pairs of a path's points."""
    n = F.greatest(F.size(path) - 1, F.lit(0))
    return F.arrays_zip(F.slice(path, 1, n).alias("a"), F.slice(path, 2, n).alias("b"))


def path_m(path: Column) -> Column:
    return F.aggregate(legs(path), F.lit(0.0), lambda s, l: s + step_m(l["a"], l["b"]))


def projected(p: Column, path: Column) -> Column:
    """struct(d, along, heading) of the closest place on a path: distance, arc position, the leg's heading."""
    start = F.struct(F.lit(1e18).alias("d"), F.lit(0.0).alias("along"), F.lit(0.0).alias("heading"), F.lit(0.0).alias("done"))

    def step(s: Column, l: Column) -> Column:
        a, b = l["a"], l["b"]
        y, x = _plane((p["lat"] + a["lat"] + b["lat"]) / 3)
        bx, by, px, py = (b["lon"] - a["lon"]) * x, (b["lat"] - a["lat"]) * y, (p["lon"] - a["lon"]) * x, (p["lat"] - a["lat"]) * y
        square = bx * bx + by * by
        t = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * bx + py * by) / square))).otherwise(0.0)
        d, long = F.sqrt(F.pow(px - t * bx, 2) + F.pow(py - t * by, 2)), step_m(a, b)
        near = d < s["d"]
        return F.struct(
            F.when(near, d).otherwise(s["d"]).alias("d"), F.when(near, s["done"] + t * long).otherwise(s["along"]).alias("along"), F.when(near, heading(a, b)).otherwise(s["heading"]).alias("heading"), (s["done"] + long).alias("done")
        )

    return F.aggregate(legs(path), start, step)


def compatible(osm: Column, base: Column) -> Column:
    alias = F.lit(False)
    for k, values in ALIASES.items():
        alias = alias | ((osm == k) & base.isin(*values))
    return F.coalesce((osm == base) | alias | base.startswith(F.concat(osm, F.lit("-"))) | osm.startswith(F.concat(base, F.lit("-"))), F.lit(True))


def candidates(ways: DataFrame, features: DataFrame, keep_all: bool = False) -> DataFrame:
    """Every near (way, feature segment) with the first guard that rejects it, or null.

    ways: way_id, highway, name, is_bridge, is_tunnel, nodes array<struct<lat, lon>>;
    features: feature_id, base, name, is_bridge, is_tunnel, points of the same form; a feature
    may come in several entries. ``keep_all`` adds the projections of both ends and the overlap.
    """
    def placed(df: DataFrame, key: str, points: str) -> DataFrame:
        at = df.select(key, F.explode(points).alias("p")).select(key, F.col("p.lat").alias("la"), F.col("p.lon").alias("lo"))
        return cells.own_cell(at, "la", "lo", CELL).select(key, F.col("cy").alias(f"{key}_y"), F.col("cx").alias(f"{key}_x")).distinct()

    # Cells at most REACH apart meet in blocks of several cells: a feature's cell lies in one, a way's cell reaches into four at most.
    block = lambda v: F.floor(F.col(v) / BLOCK)
    span = lambda v: F.explode(F.sequence(F.floor((F.col(v) - REACH) / BLOCK), F.floor((F.col(v) + REACH) / BLOCK)))
    near = placed(ways, "way_id", "nodes").withColumn("by", span("way_id_y")).withColumn("bx", span("way_id_x"))
    at = placed(features, "feature_id", "points").withColumns({"by": block("feature_id_y"), "bx": block("feature_id_x")})
    close = (F.abs(F.col("way_id_y") - F.col("feature_id_y")) <= REACH) & (F.abs(F.col("way_id_x") - F.col("feature_id_x")) <= REACH)
    pairs = near.join(at, ["by", "bx"]).filter(close).select("way_id", "feature_id").distinct()
    side = features.select("feature_id", "base", F.col("name").alias("f_name"), F.col("is_bridge").alias("f_bridge"), F.col("is_tunnel").alias("f_tunnel"), "points")
    both = pairs.join(ways, "way_id").join(side, "feature_id")
    layer = (
        F.when(~compatible(F.col("highway"), F.col("base")), "class_incompatible").when(F.col("is_bridge") & ~F.col("f_bridge"), "bridge_layer").when(F.col("is_tunnel") & ~F.col("f_tunnel"), "tunnel_layer")
        .when(~F.col("is_bridge") & ~F.col("is_tunnel") & F.col("f_bridge"), "nonbridge_to_bridge").when(~F.col("is_bridge") & ~F.col("is_tunnel") & F.col("f_tunnel"), "nontunnel_to_tunnel")
    )
    same_layer = (F.col("is_bridge") & F.col("f_bridge")) | (F.col("is_tunnel") & F.col("f_tunnel"))
    mismatch = F.coalesce((F.col("name") != "") & (F.col("f_name") != "") & (F.col("name") != F.col("f_name")), F.lit(False))
    rows = both.select("way_id", "feature_id", layer.alias("layer"), same_layer.alias("same_layer"), mismatch.cast("int").alias("mismatch"), "nodes", "points")
    kinds = dict(rows.dtypes)
    segs = rows.mapInArrow(measures.segments, ", ".join([f"{k} {kinds[k]}" for k in rows.columns if k not in ("nodes", "points")] + ["segment int"] + [f"{k} double" for k in measures.MEASURES]))
    ratio = F.abs(F.col("along_a") - F.col("along_b")) / F.greatest(F.least(F.col("seg_m"), F.col("way_m")), F.lit(TINY_M))
    least = F.when(F.col("way_m") <= SHORT_WAY_M, OVERLAP_SHORT).otherwise(OVERLAP)
    turned = lambda other: geo.undirected_angle(F.col("own"), F.col(other)) <= BEARING_DEG
    straight = turned("way_heading") | ((F.col("chord_m") >= TINY_M) & turned("chord"))
    reject = (
        F.when(F.col("layer").isNotNull(), F.col("layer")).when((F.col("d_a") > TOLERANCE_M) | (F.col("d_b") > TOLERANCE_M), "too_far").when((F.col("seg_m") >= TINY_M) & (ratio < least), "overlap")
        .when(~F.col("same_layer") & (F.col("seg_m") >= BEARING_FROM_M) & ~straight, "bearing")
    )
    more = ["along_a", "along_b", "d_a", "d_b", ratio.alias("ratio")] if keep_all else []
    return segs.select("way_id", "feature_id", "segment", "seg_m", *more, "mismatch", ((F.col("d_a") + F.col("d_b")) / 2).alias("mean_m"), reject.alias("reject"))


def best_entries(found: DataFrame) -> DataFrame:
    """Of the accepted entries of a (way, feature, segment) the one with the least (name mismatch, mean distance)."""
    order = Window.partitionBy("way_id", "feature_id", "segment").orderBy("mismatch", "mean_m", "seg_m")
    return found.filter("reject is null").withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")


def matched(found: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Kept rows: stubs off a way's primary feature go; the primary has the most long segments,
    then the most, then the longest; a (feature, segment) claimed twice goes to the larger way.
    With ``limits`` (way_id and limit columns) each row carries those of its way."""
    ok = best_entries(found)
    score = ok.groupBy("way_id", "feature_id").agg(F.struct(F.count_if(F.col("seg_m") >= TINY_M).alias("long"), F.count(F.lit(1)).alias("n"), F.round(F.sum("seg_m"), 6).alias("m"), (-F.col("feature_id")).alias("tie")).alias("score"))
    best = score.groupBy("way_id").agg(F.max_by("feature_id", "score").alias("primary"))
    kept = ok.join(best, "way_id").filter((F.col("feature_id") == F.col("primary")) | (F.col("seg_m") >= BEARING_FROM_M))
    claimed = kept.groupBy("feature_id", "segment").agg(F.max("way_id").alias("way_id"), F.count(F.lit(1)).alias("claims"), F.max_by(F.round("mean_m", 4), "way_id").alias("mean_m"), F.max_by("mismatch", "way_id").alias("mismatch"))
    return claimed if limits is None else claimed.join(limits, "way_id")


def match_report(ways: DataFrame, found: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows rejected by each guard, ways matched and not."""
    guards = found.groupBy(F.coalesce("reject", F.lit("accepted")).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    hit = found.filter("reject is null").select("way_id").distinct()
    totals = ways.select("way_id").join(hit.withColumn("hit", F.lit(True)), "way_id", "left").groupBy(F.when(F.col("hit"), "ways_matched").otherwise("ways_unmatched").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    rows = kept.agg(F.lit("rows").alias("item"), F.count(F.lit(1)).alias("n"))
    return guards.unionByName(totals).unionByName(rows)


def wet_segments(segments: DataFrame, triangles: DataFrame, size: float = 0.001) -> DataFrame:
    """Worst class of the triangles that a segment hits: an end, its middle, or a crossing. Cells are about as wide as both.

    segments: key columns and lat1, lon1, lat2, lon2; triangles: class, y0, x0, y1, x1, y2, x2.
    """
    keys = [c for c in segments.columns if c not in ("lat1", "lon1", "lat2", "lon2")]
    low, high = lambda *c: F.least(*map(F.col, c)), lambda *c: F.greatest(*map(F.col, c))
    box = ("min_lat", "min_lon", "max_lat", "max_lon")

    def placed(df: DataFrame, limits: tuple[Column, ...], small: tuple[int, ...], large: tuple[int, ...]) -> DataFrame:
        """Small boxes on the fine grid (kind 0); what is wide, and what may meet it, on one COARSE times as wide."""
        made = df.withColumns(dict(zip(box, limits, strict=True)))
        wide = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon")) > 8 * size
        on = lambda kind: F.transform(geo.box_cells(*[F.col(x) for x in box], size * (COARSE if kind else 1)), lambda x: F.struct(F.lit(kind).alias("kind"), x["cy"].alias("cy"), x["cx"].alias("cx")))
        both = F.when(wide, F.concat(*map(on, large))).otherwise(F.concat(*map(on, small)))
        return made.withColumn("__c", F.explode(both)).select(*df.columns, "__c.*")

    # Kind 1: wide segments and all triangles; kind 2: small segments and wide triangles.
    s = placed(segments, (low("lat1", "lat2"), low("lon1", "lon2"), high("lat1", "lat2"), high("lon1", "lon2")), (0, 2), (1,))
    t = placed(triangles, (low("y0", "y1", "y2"), low("x0", "x1", "x2"), high("y0", "y1", "y2"), high("x0", "x1", "x2")), (0, 1), (1, 2))
    v = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(3)]
    p, q = (F.col("lon1"), F.col("lat1")), (F.col("lon2"), F.col("lat2"))
    mid = ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)
    hit = F.lit(False)
    for at in (p, q, mid):
        hit = hit | geo.in_triangle(*at, *v)
    for i in range(3):
        hit = hit | geo.segments_meet(p, q, v[i], v[(i + 1) % 3], touching=False)
    reach = lambda a, b: (F.least(*a) <= F.greatest(*b)) & (F.least(*b) <= F.greatest(*a))
    boxes = reach([p[0], q[0]], [x for x, _ in v]) & reach([p[1], q[1]], [y for _, y in v])
    met = s.join(t, ["kind", "cy", "cx"]).filter(boxes)
    return met.filter(hit).groupBy(*keys).agg(F.max("class").alias("class"))
