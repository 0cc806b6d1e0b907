"""From ways and nodes to directed edges, and what is counted on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions import geo, tags

ACCESS = ("motor_vehicle", "access", "foot", "bicycle")


PROFILES = ("car", "truck", "foot", "bicycle")


def _is_ferry() -> Column:
    return tags.is_ferry(F.col("route"), F.col("highway"), F.col("ferry"))


def admitted(profile: str) -> Column:
    """Is a way of the profile: by class or as a ferry, not skipped by access, and for foot and bicycle without a minimum speed."""
    col = F.col
    admits = tags.ferry_admits(profile, col("motorcar"), col("motor_vehicle"), col("vehicle"), col("access"), col("ferry"), col("foot"), col("bicycle"), F.lit(False))
    plain = tags.road_admits(col("highway"), profile) & ~tags.access_forbids(profile, *[col(x) for x in ACCESS])
    if profile not in tags.MOTOR:
        plain = plain & tags.speed_kmh(col("minspeed")).isNull()
    return F.when(_is_ferry(), admits).otherwise(plain)


def included(ways: DataFrame, profile: str = "car", promoted: DataFrame | None = None) -> DataFrame:
    """Ways of a profile with their edge attributes. Promoted boarding ways join in as they are."""
    keep = ways.filter(admitted(profile))
    if promoted is not None:
        keep = keep.unionByName(ways.join(promoted, "way_id", "left_semi").join(keep.select("way_id"), "way_id", "left_anti"))
    return keep.select("way_id", *attributes())


def attributes() -> list[Column]:
    """What an edge takes from its way."""
    col, ferry = F.col, _is_ferry()
    forward = tags.yes(col("junction") == "roundabout") | tags.yes(col("oneway").isin("yes", "true", "1"))
    return [
        col("highway"), col("name"), ferry.alias("is_ferry"), forward.alias("forward_only"), tags.speed_kmh(col("maxspeed")).alias("kmh"), tags.speed_kmh(col("maxspeed_practical")).alias("practical_kmh"),
        tags.speed_kmh(col("maxspeed_advisory")).alias("advisory_kmh"), tags.speed_kmh(col("minspeed")).alias("min_kmh"), tags.surface_rank(col("highway"), col("surface"), col("tracktype")).alias("surface_rank"),
        tags.duration_seconds(col("duration")).alias("ferry_s"), tags.is_tunnel(col("tunnel")).alias("is_tunnel"), tags.boardwalk(col("bridge"), col("surface")).alias("is_boardwalk"),
        tags.motorway_grade(col("highway"), tags.truthy(col("motorroad")), tags.truthy(col("expressway")), tags.oneway_yes(col("oneway")), tags.lanes(col("lanes")), tags.speed_kmh(col("maxspeed"))).alias("motorway_grade"),
    ]


def junctions(refs: DataFrame) -> DataFrame:
    """node_id, uses: ends of a way count twice; a junction has more than one use."""
    order = Window.partitionBy("way_id")
    ends = refs.withColumns({"first": F.min("pos").over(order), "last": F.max("pos").over(order)})
    return ends.groupBy("node_id").agg(F.sum(F.when(F.col("pos").isin(F.col("first"), F.col("last")), 2).otherwise(1)).alias("uses"))


def resolved(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Refs with coordinates, in order; a ref to a missing node is skipped."""
    return refs.join(nodes.select("node_id", "lat", "lon"), "node_id")


def segments(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """way_id, seg, src, dst, their coordinates, length_m, shape: refs cut at junctions.

    One window by way gives the steps and the number of the current junction; grouping by
    (way, number) needs no further shuffle. Loops and zero lengths are dropped before the
    segments are numbered.
    """
    way = Window.partitionBy("way_id").orderBy("pos")
    points = (
        resolved(refs, nodes).join(junctions(refs), "node_id")
        .withColumns({"step": geo.haversine(F.col("lat"), F.col("lon"), F.lead("lat").over(way), F.lead("lon").over(way)), "cut": F.sum((F.col("uses") > 1).cast("int")).over(way)})
        .filter("cut > 0")
    )
    head = F.min_by(F.struct("node_id", "lat", "lon"), "pos")
    shape = F.transform(F.array_sort(F.collect_list(F.when(F.col("uses") == 1, F.struct("pos", "lat", "lon")))), lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    parts = points.groupBy("way_id", "cut").agg(head.alias("a"), F.sum("step").alias("length_m"), shape.alias("shape"))
    order = Window.partitionBy("way_id").orderBy("cut")
    parts = parts.withColumn("b", F.lead("a").over(order)).filter("b is not null and a.node_id <> b.node_id and length_m > 0")
    return parts.select(
        "way_id", (F.row_number().over(order) - 1).alias("seg"), F.col("a.node_id").alias("src"), F.col("b.node_id").alias("dst"), F.col("a.lat").alias("src_lat"), F.col("a.lon").alias("src_lon"),
        F.col("b.lat").alias("dst_lat"), F.col("b.lon").alias("dst_lon"), "length_m", "shape",
    )


def edges(ways: DataFrame, refs: DataFrame, nodes: DataFrame, profile: str = "car") -> DataFrame:
    """Directed edges: each segment forward, and back unless its way is forward-only."""
    keep = included(ways, profile)
    cut = segments(refs.join(keep.select("way_id"), "way_id", "left_semi"), nodes)
    both = cut.join(keep, "way_id").withColumn("back", F.explode(F.when(F.col("forward_only"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    turn = lambda a, b: F.when(F.col("back"), F.col(b)).otherwise(F.col(a))
    weight = F.when(F.col("is_ferry"), tags.ferry_weight(F.col("length_m"), F.col("ferry_s"), profile)).otherwise(F.col("length_m"))
    rest = [c for c in both.columns if c not in ("src", "dst", "src_lat", "src_lon", "dst_lat", "dst_lon", "shape", "back", "seg")]
    return both.select(
        F.concat_ws("-", "way_id", "seg", F.when(F.col("back"), "rev")).alias("edge_id"), turn("src", "dst").alias("src"), turn("dst", "src").alias("dst"), turn("src_lat", "dst_lat").alias("src_lat"), turn("src_lon", "dst_lon").alias("src_lon"),
        turn("dst_lat", "src_lat").alias("dst_lat"), turn("dst_lon", "src_lon").alias("dst_lon"), F.when(F.col("back"), F.reverse("shape")).otherwise(F.col("shape")).alias("shape"), weight.alias("weight"), *rest,
    )


def profile_edges(ways: DataFrame, refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges of every profile, with ``profile``, from one build.

    A way has a bit for each profile that admits it. A node's uses are counted for all profiles in
    one shuffle; each profile then has cuts of its own along a way, all by one window. Grouping by
    way, profile and cut needs no further shuffle.
    """
    mask = sum((F.when(F.coalesce(admitted(p), F.lit(False)), 1 << i).otherwise(0) for i, p in enumerate(PROFILES)), F.lit(0))
    keep = ways.withColumn("mask", mask).filter("mask > 0").select("way_id", "mask", *attributes())
    bit = lambda i: F.col("mask").bitwiseAND(F.lit(1 << i)) > 0
    used = refs.join(keep.select("way_id", "mask"), "way_id")
    whole = Window.partitionBy("way_id")
    ends = used.withColumns({"first": F.min("pos").over(whole), "last": F.max("pos").over(whole)})
    one = F.when(F.col("pos").isin(F.col("first"), F.col("last")), 2).otherwise(1)
    uses = ends.groupBy("node_id").agg(*[F.sum(F.when(bit(i), one).otherwise(0)).alias(f"uses_{i}") for i in range(len(PROFILES))])
    way = Window.partitionBy("way_id").orderBy("pos")
    points = resolved(used, nodes).join(uses, "node_id").withColumns(
        {"step": geo.haversine(F.col("lat"), F.col("lon"), F.lead("lat").over(way), F.lead("lon").over(way))} | {f"cut_{i}": F.sum((F.col(f"uses_{i}") > 1).cast("int")).over(way) for i in range(len(PROFILES))}
    )
    own = F.array(*[F.when(bit(i) & (F.col(f"cut_{i}") > 0), F.struct(F.lit(p).alias("profile"), F.col(f"cut_{i}").alias("cut"), F.col(f"uses_{i}").alias("uses"))) for i, p in enumerate(PROFILES)])
    each = points.select("way_id", "pos", "node_id", "lat", "lon", "step", F.explode(F.filter(own, lambda x: x.isNotNull())).alias("o")).select("*", "o.*").drop("o")
    shape = F.transform(F.array_sort(F.collect_list(F.when(F.col("uses") == 1, F.struct("pos", "lat", "lon")))), lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    parts = each.groupBy("way_id", "profile", "cut").agg(F.min_by(F.struct("node_id", "lat", "lon"), "pos").alias("a"), F.sum("step").alias("length_m"), shape.alias("shape"))
    order = Window.partitionBy("way_id", "profile").orderBy("cut")
    parts = parts.withColumn("b", F.lead("a").over(order)).filter("b is not null and a.node_id <> b.node_id and length_m > 0").withColumn("seg", F.row_number().over(order) - 1)
    both = parts.join(keep.drop("mask"), "way_id").withColumn("back", F.explode(F.when(F.col("forward_only"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    turn = lambda x, y: F.when(F.col("back"), F.col(y)).otherwise(F.col(x))
    ferry = F.coalesce(*[F.when(F.col("profile") == p, tags.ferry_weight(F.col("length_m"), F.col("ferry_s"), p)) for p in PROFILES])
    rest = [c for c in both.columns if c not in ("a", "b", "shape", "back", "seg", "cut")]
    return both.select(
        F.concat_ws("-", "way_id", "seg", F.when(F.col("back"), "rev")).alias("edge_id"), turn("a.node_id", "b.node_id").alias("src"), turn("b.node_id", "a.node_id").alias("dst"), turn("a.lat", "b.lat").alias("src_lat"), turn("a.lon", "b.lon").alias("src_lon"),
        turn("b.lat", "a.lat").alias("dst_lat"), turn("b.lon", "a.lon").alias("dst_lon"), F.when(F.col("back"), F.reverse("shape")).otherwise(F.col("shape")).alias("shape"), F.when(F.col("is_ferry"), ferry).otherwise(F.col("length_m")).alias("weight"), *rest,
    )


def cheapest(edges_: DataFrame, before: Column | None = None) -> DataFrame:
    """The cheapest of parallel edges, given the surface before; ties to the smallest id."""
    cost = F.col("weight") if before is None else F.col("weight") + tags.transition_cost(before, F.col("surface_rank"))
    order = Window.partitionBy("src", "dst").orderBy(F.round(cost * 1000), "edge_id")
    return edges_.withColumn("__r", F.row_number().over(order)).filter("__r = 1").drop("__r")


def parallel_census(edges_: DataFrame) -> DataFrame:
    pairs = edges_.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("highway").alias("classes"), F.min("edge_id").alias("first"), F.min_by("edge_id", F.struct("weight", "edge_id")).alias("best"))
    some = F.col("n") > 1
    return pairs.agg(
        F.sum("n").alias("edges"), F.count_if(some).alias("pairs"), F.sum(F.when(some, F.col("n") - 1).otherwise(0)).alias("extra"), F.count_if(some & (F.col("classes") > 1)).alias("mixed"),
        F.count_if(some & (F.col("first") != F.col("best"))).alias("mismatch"),
    )


def incident_surface(edges_: DataFrame) -> DataFrame:
    ends = edges_.select(F.explode(F.array("src", "dst")).alias("node_id"), "surface_rank")
    return ends.groupBy("node_id").agg(F.max("surface_rank").alias("worst"), F.min("surface_rank").alias("best"))


def minutes() -> Column:
    kmh = tags.travel_speed(F.col("practical_kmh"), F.col("kmh"), F.col("advisory_kmh"), F.col("min_kmh"), F.col("highway"))
    return tags.travel_hours(F.col("length_m"), kmh) * 60


def way_tiles(refs: DataFrame, nodes: DataFrame, size: float = 1.0, pad: float = 0.05) -> DataFrame:
    """Each way with every padded tile that one of its nodes is in."""
    at = resolved(refs, nodes)
    ys = F.array_distinct(F.array(F.floor((F.col("lat") - pad) / size), F.floor(F.col("lat") / size), F.floor((F.col("lat") + pad) / size)))
    xs = F.array_distinct(F.array(F.floor((F.col("lon") - pad) / size), F.floor(F.col("lon") / size), F.floor((F.col("lon") + pad) / size)))
    return at.select("way_id", F.explode(ys).alias("tile_row"), xs.alias("xs")).select("way_id", "tile_row", F.explode("xs").alias("tile_col")).distinct()


def merge_tiles(graphs: DataFrame) -> DataFrame:
    """Union of tile graphs: an edge seen from several tiles once, parallel edges kept."""
    key = ["src", "dst", "length_m", "src_lat", "src_lon", "dst_lat", "dst_lon", "is_tunnel"]
    return graphs.dropDuplicates(key)
