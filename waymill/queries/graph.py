"""Queries on the road graph: joins J1-J7, aggregates A1-A5 and A31, windows W1-W4, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.functions import geo, tags
from waymill.operators.components import connected_components
from waymill.operators.shared import materialize, shared_path
from waymill.plans import graph
from waymill.queries import tag_rules as t
from waymill.queries.views import view, with_views


def parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return view(spark, sf, "v_ways"), view(spark, sf, "v_way_nodes"), view(spark, sf, "v_nodes")


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edges(*parts(spark, sf))


HAV = "2 * {r} * asin(CASE WHEN {c} IS NOT NULL THEN least(1.0::DOUBLE, sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))) END)"


def hav(a, b, c, d, r="6378100.0::DOUBLE"):
    return HAV.format(a=a, b=b, c=c, d=d, r=r)


_ROADS, _TS = t.ROADS, t._TS
E_SQL = with_views("v_ways", "v_way_nodes", "v_nodes") + f"""
kept AS (SELECT *, {t.SQL_FERRY} AS is_ferry, {t.SQL_RANK} AS surface_rank, {t.SQL_SECONDS} AS ferry_s, {_TS} AS speed, {t.SQL_GRADE} AS grade,
  coalesce(junction = 'roundabout', false) OR coalesce(oneway IN ('yes', 'true', '1'), false) AS fwd FROM v_ways
  WHERE CASE WHEN {t.SQL_FERRY} THEN {t.SQL_CAR_FERRY} ELSE coalesce(highway IN ({_ROADS}), false) AND NOT ({t.sql_forbidden('car')}) END),
refs AS (SELECT r.* FROM v_way_nodes r SEMI JOIN kept USING (way_id)),
uses AS (SELECT node_id, sum(CASE WHEN pos IN (a, z) THEN 2 ELSE 1 END) AS uses FROM (SELECT *, min(pos) OVER (PARTITION BY way_id) AS a, max(pos) OVER (PARTITION BY way_id) AS z FROM refs) GROUP BY 1),
pts AS (SELECT way_id, pos, node_id, lat, lon, uses, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon, sum((uses > 1)::INT) OVER w AS cut FROM refs JOIN v_nodes USING (node_id) JOIN uses USING (node_id) WINDOW w AS (PARTITION BY way_id ORDER BY pos)),
grp AS (SELECT way_id, cut, arg_min(node_id, pos) AS a, arg_min(lat, pos) AS alat, arg_min(lon, pos) AS alon, sum({hav('lat', 'lon', 'nlat', 'nlon')}) AS length_m, count(*) FILTER (uses = 1) AS n_shape FROM pts WHERE cut > 0 GROUP BY 1, 2),
nxt AS (SELECT *, lead(a) OVER w AS b, lead(alat) OVER w AS blat, lead(alon) OVER w AS blon FROM grp WINDOW w AS (PARTITION BY way_id ORDER BY cut)),
seg AS (SELECT *, row_number() OVER (PARTITION BY way_id ORDER BY cut) - 1 AS seg FROM nxt WHERE b IS NOT NULL AND a <> b AND length_m > 0),
edges AS (SELECT way_id || '-' || seg || CASE WHEN back THEN '-rev' ELSE '' END AS edge_id, CASE WHEN back THEN b ELSE a END AS src, CASE WHEN back THEN a ELSE b END AS dst, alat, alon, blat, blon, s.length_m, s.n_shape, k.*, back,
  CASE WHEN is_ferry THEN coalesce(ferry_s * 80000 / 3600, s.length_m * 8) + 600 * 80000 / 3600.0::DOUBLE ELSE s.length_m END AS weight
  FROM seg s JOIN kept k USING (way_id), (SELECT unnest([false, true]) AS back) WHERE NOT (fwd AND back))
"""


def s1_element_scan(spark, sf):
    """Every element with the number of its refs or members and of its tags, by kind: nodes, ways and relations in one pass each."""
    ways, refs, nodes = parts(spark, sf)
    count = lambda df, *keys: sum((F.when(F.col(k).isNotNull(), 1).otherwise(0) for k in keys), F.lit(0))
    per = refs.groupBy(F.col("way_id").alias("id")).agg(F.count(F.lit(1)).alias("refs"))
    members = view(spark, sf, "v_members").groupBy(F.col("relation_id").alias("id")).agg(F.count(F.lit(1)).alias("refs"))
    rows = nodes.select(F.lit("node").alias("kind"), F.col("node_id").alias("id"), F.lit(0).cast("long").alias("refs"), count(nodes, "name", "barrier", "amenity").alias("tags"))
    rows = rows.unionByName(ways.select(F.lit("way").alias("kind"), F.col("way_id").alias("id"), count(ways, "name", "highway", "route").alias("tags")).join(per, "id", "left").select("kind", "id", F.coalesce("refs", F.lit(0)).alias("refs"), "tags"))
    rel = view(spark, sf, "v_relations")
    rows = rows.unionByName(rel.select(F.lit("relation").alias("kind"), F.col("relation_id").alias("id"), count(rel, "name", "type").alias("tags")).join(members, "id", "left").select("kind", "id", F.coalesce("refs", F.lit(0)).alias("refs"), "tags"))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.sum("refs").alias("refs"), F.sum("tags").cast("long").alias("tags"))


O_S1 = with_views("v_ways", "v_way_nodes", "v_nodes", "v_relations", "v_members") + """ x AS (SELECT 'node' AS kind, node_id AS id, 0 AS refs, (name IS NOT NULL)::INT + (barrier IS NOT NULL)::INT + (amenity IS NOT NULL)::INT AS tags FROM v_nodes
UNION ALL SELECT 'way', way_id, (SELECT count(*) FROM v_way_nodes r WHERE r.way_id = w.way_id), (name IS NOT NULL)::INT + (highway IS NOT NULL)::INT + (route IS NOT NULL)::INT FROM v_ways w
UNION ALL SELECT 'relation', relation_id, (SELECT count(*) FROM v_members m WHERE m.relation_id = r.relation_id), (name IS NOT NULL)::INT + (type IS NOT NULL)::INT FROM v_relations r)
SELECT kind, count(*) AS n, sum(id)::BIGINT AS ids, sum(refs)::BIGINT AS refs, sum(tags)::BIGINT AS tags FROM x GROUP BY 1"""


def w1_w2_edges(spark, sf):
    """The slice: ways, refs and nodes to directed edges."""
    return edges(spark, sf).select("edge_id", "src", "dst", F.round("length_m", 3).alias("length_m"), F.round("weight", 3).alias("weight"), F.size("shape").alias("n_shape"), "surface_rank")


O_W1 = E_SQL + "SELECT edge_id, src, dst, round(length_m, 3) AS length_m, round(weight, 3) AS weight, n_shape::INT AS n_shape, surface_rank FROM edges"


def edges_by_class(spark, sf):
    """Flagship: edges, length and hours by road class."""
    return edges(spark, sf).groupBy("highway").agg(F.count(F.lit(1)).alias("n_edges"), F.round(F.sum("length_m") / 1000, 3).alias("km"), F.round(F.sum(graph.minutes()) / 60, 4).alias("hours"))


O_CLASS = E_SQL + "SELECT highway, count(*) AS n_edges, round(sum(length_m) / 1000, 3) AS km, round(sum(length_m / 1000 / greatest(speed, 1)), 4) AS hours FROM edges GROUP BY 1"


def j1_m2_way_lengths(spark, sf):
    """Refs to coordinates in order, and the length of each way by the array form."""
    ways, refs, nodes = parts(spark, sf)
    at = graph.resolved(refs, nodes).groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "lat", "lon"))).alias("p"))
    return at.select("way_id", F.size("p").alias("n"), F.round(geo.path_length(F.col("p")), 3).alias("graph_m"), F.round(geo.path_length(F.col("p"), geo.TOOL_RADIUS), 3).alias("tool_m"))


O_J1 = with_views("v_way_nodes", "v_nodes") + f"""s AS (SELECT way_id, {hav('lat', 'lon', 'nlat', 'nlon', '1')} AS d FROM (SELECT way_id, lat, lon, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon FROM v_way_nodes JOIN v_nodes USING (node_id) WINDOW w AS (PARTITION BY way_id ORDER BY pos)))
SELECT way_id, count(*)::INT AS n, round(coalesce(sum(d), 0) * 6378100.0::DOUBLE, 3) AS graph_m, round(coalesce(sum(d), 0) * 6371000.0::DOUBLE, 3) AS tool_m FROM s GROUP BY 1"""


def a1_junctions(spark, sf):
    _, refs, _ = parts(spark, sf)
    return graph.junctions(refs)


O_A1 = with_views("v_way_nodes") + """ e AS (SELECT *, min(pos) OVER (PARTITION BY way_id) AS a, max(pos) OVER (PARTITION BY way_id) AS z FROM v_way_nodes)
SELECT node_id, sum(CASE WHEN pos IN (a, z) THEN 2 ELSE 1 END)::BIGINT AS uses FROM e GROUP BY 1"""


def a2_parallel_census(spark, sf):
    return graph.parallel_census(edges(spark, sf))


O_A2 = E_SQL + """, p AS (SELECT src, dst, count(*) AS n, count(DISTINCT highway) AS c, min(edge_id) AS f, arg_min(edge_id, (weight, edge_id)) AS b FROM edges GROUP BY 1, 2)
SELECT sum(n)::BIGINT AS edges, count(*) FILTER (n > 1) AS pairs, coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS extra, count(*) FILTER (n > 1 AND c > 1) AS mixed, count(*) FILTER (n > 1 AND f <> b) AS mismatch FROM p"""


def a3_a4_shares_and_minutes(spark, sf):
    """Motorway share and minutes of each way taken as a path; pace for walking and cycling."""
    e = edges(spark, sf).filter(~F.col("edge_id").endswith("-rev"))
    made = e.groupBy("way_id").agg(F.sum("length_m").alias("m"), F.sum(F.when(F.col("motorway_grade"), F.col("length_m")).otherwise(0.0)).alias("fast"), F.sum(graph.minutes()).alias("minutes"))
    return made.select("way_id", F.round(100 * F.col("fast") / F.col("m"), 4).alias("motorway_pct"), F.round(F.greatest(F.lit(0.0), 100 - 100 * F.col("fast") / F.col("m")), 4).alias("other_pct"), F.round("minutes", 4).alias("motor_min"), F.round(F.col("m") / 1000 * 16, 4).alias("hiking_min"), F.round(F.col("m") / 1000 * 4, 4).alias("cycling_min"))


O_A3 = E_SQL + """ SELECT way_id, round(100 * sum(CASE WHEN grade THEN length_m ELSE 0 END) / sum(length_m), 4) AS motorway_pct, round(greatest(0.0::DOUBLE, 100 - 100 * sum(CASE WHEN grade THEN length_m ELSE 0 END) / sum(length_m)), 4) AS other_pct,
round(sum(length_m / 1000 / greatest(speed, 1)) * 60, 4) AS motor_min, round(sum(length_m) / 1000 * 16, 4) AS hiking_min, round(sum(length_m) / 1000 * 4, 4) AS cycling_min FROM edges WHERE NOT back GROUP BY 1"""


def a31_incident_surface(spark, sf):
    return graph.incident_surface(edges(spark, sf))


O_A31 = E_SQL + "SELECT node_id, max(surface_rank) AS worst, min(surface_rank) AS best FROM (SELECT unnest([src, dst]) AS node_id, surface_rank FROM edges) GROUP BY 1"


def w3_cheapest_parallel(spark, sf):
    return graph.cheapest(edges(spark, sf), F.lit(0)).select("src", "dst", "edge_id", F.round("weight", 2).alias("weight"))


O_W3 = E_SQL + """ SELECT src, dst, edge_id, round(weight, 2) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY round((weight + CASE WHEN surface_rank > 1 THEN 500 ELSE 0 END) * 1000), edge_id) AS r FROM edges) WHERE r = 1"""


def w4_m19_surface_along_ways(spark, sf):
    """Edges of each way in order with the transition cost from the edge before; the first follows a good surface."""
    e = edges(spark, sf).filter(~F.col("edge_id").endswith("-rev")).withColumn("seg", F.element_at(F.split("edge_id", "-"), 2).cast("int"))
    nxt = e.withColumn("rank", (F.col("surface_rank") + F.col("seg")) % 3)
    before = F.coalesce(F.lag("rank").over(Window.partitionBy("way_id").orderBy("seg")), F.lit(0))
    return nxt.withColumn("cost", tags.transition_cost(before, F.col("rank"))).groupBy("way_id").agg(F.sum("cost").alias("transition_m"), F.count(F.lit(1)).alias("n"))


O_W4 = E_SQL + """, o AS (SELECT way_id, seg, (surface_rank + seg) % 3 AS r FROM (SELECT *, split_part(edge_id, '-', 2)::INT AS seg FROM edges WHERE NOT back)),
l AS (SELECT *, coalesce(lag(r) OVER (PARTITION BY way_id ORDER BY seg), 0) AS b FROM o) SELECT way_id, sum(CASE WHEN r - b > 1 THEN 500.0::DOUBLE ELSE 0 END) AS transition_m, count(*) AS n FROM l GROUP BY 1"""


def w10_path_vertices(spark, sf):
    """Each way's path as text: start, shape and end in order, repeated vertices dropped."""
    _, refs, nodes = parts(spark, sf)
    at = graph.resolved(refs, nodes).withColumn("v", F.concat_ws(",", F.format_number("lat", 4), F.format_number("lon", 4)))
    order = Window.partitionBy("way_id").orderBy("pos")
    kept = at.withColumn("p", F.lag("v").over(order)).filter("p is null or p <> v")
    return kept.groupBy("way_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]), " ").alias("path"))


O_W10 = with_views("v_way_nodes", "v_nodes") + """ a AS (SELECT way_id, pos, printf('%.4f', lat) || ',' || printf('%.4f', lon) AS v FROM v_way_nodes JOIN v_nodes USING (node_id)),
l AS (SELECT *, lag(v) OVER (PARTITION BY way_id ORDER BY pos) AS p FROM a) SELECT way_id, string_agg(v, ' ' ORDER BY pos) AS path FROM l WHERE p IS NULL OR p <> v GROUP BY 1"""


def j2_way_tiles(spark, sf):
    _, refs, nodes = parts(spark, sf)
    return graph.way_tiles(refs, nodes, 0.25, 0.05)


O_J2 = with_views("v_way_nodes", "v_nodes") + """ a AS (SELECT way_id, lat, lon FROM v_way_nodes JOIN v_nodes USING (node_id)), o AS (SELECT unnest([-0.05::DOUBLE, 0, 0.05::DOUBLE]) AS d), p AS (SELECT d AS e FROM o)
SELECT DISTINCT way_id, floor((lat + d) / 0.25::DOUBLE)::BIGINT AS tile_row, floor((lon + e) / 0.25::DOUBLE)::BIGINT AS tile_col FROM a, o, p"""


def k1_tiled_graph_sink(spark, sf):
    """Edges written by profile and tile, then read back with the tile pruned: rows by tile."""
    made = edges(spark, sf).withColumns({"profile": F.lit("car"), "tile_row": F.floor("src_lat"), "tile_col": F.floor("src_lon")})
    path = shared_path(spark, "tiles")
    made.repartition("profile", "tile_row", "tile_col", F.pmod(F.xxhash64("way_id"), F.lit(8))).write.partitionBy("profile", "tile_row", "tile_col").parquet(path)
    return spark.read.parquet(path).filter("profile = 'car' and tile_row = 59").groupBy("tile_col").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("length_m"), 2).alias("m"))


O_K1 = E_SQL + """ SELECT floor(CASE WHEN back THEN blon ELSE alon END)::INT AS tile_col, count(*) AS n, round(sum(length_m), 2) AS m FROM edges WHERE floor(CASE WHEN back THEN blat ELSE alat END) = 59 GROUP BY 1"""


def k1_all_profiles(spark, sf):
    """The graphs of all four profiles from one build, written by profile and tile; tiles without an edge have no folder."""
    made = graph.profile_edges(*parts(spark, sf)).withColumns({"tile_row": F.floor("src_lat"), "tile_col": F.floor("src_lon")})
    path = shared_path(spark, "tiles")
    made.repartition("profile", "tile_row", "tile_col", F.pmod(F.xxhash64("way_id"), F.lit(8))).write.partitionBy("profile", "tile_row", "tile_col").parquet(path)
    back = spark.read.schema("edge_id string, weight double, length_m double, profile string, tile_row int, tile_col int").parquet(path)
    return back.groupBy("profile", "tile_row", "tile_col").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("length_m"), 2).alias("m"), F.round(F.sum("weight"), 2).alias("weight"))


def u1_merged_tile_graphs(spark, sf):
    """Edges of overlapping tiles united again: as many as there were, if endpoints tell them apart."""
    made = edges(spark, sf)
    tiles = made.filter("src_lat < 60.05").unionByName(made.filter("src_lat >= 59.95"))
    return graph.merge_tiles(tiles).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src", "dst").alias("pairs"))


O_U1 = E_SQL + """ SELECT (SELECT count(*) FROM (SELECT DISTINCT src, dst, length_m, is_tunnel FROM (SELECT *, coalesce(tunnel <> 'no', false) AS is_tunnel FROM edges))) AS n, (SELECT count(*) FROM (SELECT DISTINCT src, dst FROM edges)) AS pairs"""


def j5_barriers_on_graph(spark, sf):
    """Blocked barrier nodes that are nodes of the car graph."""
    nodes = view(spark, sf, "v_nodes")
    blocked = nodes.filter(tags.barrier_blocks(F.col("barrier"), "car", *[F.col(x) for x in graph.ACCESS]))
    e = edges(spark, sf)
    on = e.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct()
    return blocked.join(on, "node_id", "left_semi").select("node_id", "barrier")


O_J5 = E_SQL + f""" SELECT node_id, barrier FROM v_nodes WHERE barrier IS NOT NULL AND ({t.sql_forbidden('car')}) AND node_id IN (SELECT unnest([src, dst]) FROM edges)"""


def f17_box_clip(spark, sf):
    """Edges with either end in a box, and the nodes still used."""
    inside = lambda a, o: F.col(a).between(59.4, 60.1) & F.col(o).between(10.5, 11.5)
    e = materialize(edges(spark, sf).filter(inside("src_lat", "src_lon") | inside("dst_lat", "dst_lon")).select("src", "dst", "length_m"), "box")
    return e.agg(F.count(F.lit(1)).alias("n_edges"), F.round(F.sum("length_m"), 2).alias("m")).join(e.select(F.explode(F.array("src", "dst")).alias("n")).agg(F.count_distinct("n").alias("n_nodes")))


O_F17 = E_SQL + """, x AS (SELECT * FROM edges WHERE (alat BETWEEN 59.4 AND 60.1 AND alon BETWEEN 10.5 AND 11.5) OR (blat BETWEEN 59.4 AND 60.1 AND blon BETWEEN 10.5 AND 11.5))
SELECT count(*) AS n_edges, round(sum(length_m), 2) AS m, (SELECT count(DISTINCT n) FROM (SELECT unnest([src, dst]) AS n FROM x)) AS n_nodes FROM x"""


def f35_box_extract(spark, sf):
    """The graph of a box: ways with a node in it, kept whole, then cut into edges; junctions are those of the kept ways."""
    ways, refs, nodes = parts(spark, sf)
    inside = nodes.filter(F.col("lat").between(59.4, 60.1) & F.col("lon").between(10.5, 11.5)).select("node_id")
    touching = refs.join(inside, "node_id", "left_semi").select("way_id").distinct()
    made = graph.edges(ways.join(touching, "way_id", "left_semi"), refs.join(touching, "way_id", "left_semi"), nodes)
    return made.select("edge_id", "src", "dst", F.round("length_m", 3).alias("length_m"), F.round("weight", 3).alias("weight"))


O_F35 = E_SQL.replace("FROM v_ways\n  WHERE CASE", "FROM v_ways\n  WHERE way_id IN (SELECT way_id FROM v_way_nodes JOIN v_nodes USING (node_id) WHERE lat BETWEEN 59.4 AND 60.1 AND lon BETWEEN 10.5 AND 11.5) AND CASE", 1) + "SELECT edge_id, src, dst, round(length_m, 3) AS length_m, round(weight, 3) AS weight FROM edges"


def m20_m21_energy(spark, sf):
    """Height at both ends by grid post, the difference and the energy for two drives."""
    e = edges(spark, sf)
    height = lambda lat, lon: F.when(F.floor(F.col(lat) * 100 + F.col(lon) * 10) % 7 != 0, F.floor(F.col(lat) * 5000 + F.col(lon) * 3000) % 400)
    made = e.withColumn("climb", (height("dst_lat", "dst_lon") - height("src_lat", "src_lon")).cast("double"))
    return made.select("edge_id", "climb", *[F.round(geo.segment_energy(F.col("length_m"), F.col("climb"), d) / 1000, 2).alias(d) for d in geo.DRIVES])


def _energy(d):
    r, cd, a, m, v, back = geo.DRIVES[d]
    flat = f"(length_m * {r * m * geo.GRAVITY + 0.5 * geo.AIR * cd * a * v * v!r}::DOUBLE)"
    return f"round(CASE WHEN climb IS NULL THEN {flat} ELSE greatest({flat} + climb * {m * geo.GRAVITY!r}::DOUBLE * CASE WHEN climb >= 0 THEN 1 ELSE {back} END, {flat} * 0.01) END / 1000, 2) AS {d}"


_H = "CASE WHEN floor({a} * 100 + {o} * 10)::BIGINT % 7 <> 0 THEN floor({a} * 5000 + {o} * 3000)::BIGINT % 400 END"
O_M20 = E_SQL + f""", h AS (SELECT *, {_H.format(a='alat', o='alon')} AS ha, {_H.format(a='blat', o='blon')} AS hb FROM edges), c AS (SELECT *, (CASE WHEN back THEN ha - hb ELSE hb - ha END)::DOUBLE AS climb FROM h)
SELECT edge_id, climb, {", ".join(_energy(d) for d in geo.DRIVES)} FROM c"""


def i1_a10_components(spark, sf):
    """Weak components of the car graph: size of each, and whether it is the giant (smallest root of a tie)."""
    e = materialize(edges(spark, sf).select("src", "dst"), "edges")
    sizes = connected_components(e).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    giant = sizes.agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("giant"))
    return sizes.join(F.broadcast(giant)).select("component", "n", (F.col("component") == F.col("giant")).alias("is_giant"))


O_I1 = E_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """, b AS MATERIALIZED (SELECT src AS x, dst AS y FROM edges UNION SELECT dst, src FROM edges),
r(x, root) USING KEY (x) AS (SELECT DISTINCT x, x FROM b UNION SELECT b.y, min(r.root) FROM r JOIN b ON b.x = r.x JOIN recurring.r AS o ON o.x = b.y WHERE r.root < o.root GROUP BY b.y),
s AS (SELECT root AS component, count(*) AS n FROM r GROUP BY 1) SELECT component, n, row_number() OVER (ORDER BY n DESC, component) = 1 AS is_giant FROM s"""


def a15_i4_ferry_terminals(spark, sf):
    """Ends of car ferries by what the road graph without ferries offers there."""
    e = materialize(edges(spark, sf).select("way_id", "src", "dst", "is_ferry", "edge_id"), "edges")
    road = e.filter(~F.col("is_ferry"))
    comps = connected_components(road)
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    biggest = sizes.agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("giant"))
    at = comps.join(sizes, "component").join(F.broadcast(biggest))
    ends = e.filter("is_ferry").select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    kind = F.when(F.col("n").isNull(), "no_road").when(F.col("component") == F.col("giant"), "ok").when(F.col("n") < 10, "tiny").otherwise("other_comp")
    return ends.join(at, "node", "left").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


O_A15 = E_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """, b AS MATERIALIZED (SELECT src AS x, dst AS y FROM edges WHERE NOT is_ferry UNION SELECT dst, src FROM edges WHERE NOT is_ferry),
r(x, root) USING KEY (x) AS (SELECT DISTINCT x, x FROM b UNION SELECT b.y, min(r.root) FROM r JOIN b ON b.x = r.x JOIN recurring.r AS o ON o.x = b.y WHERE r.root < o.root GROUP BY b.y),
s AS (SELECT root, count(*) AS n FROM r GROUP BY 1), g AS (SELECT root AS giant FROM s ORDER BY n DESC, root LIMIT 1),
f AS (SELECT DISTINCT unnest([src, dst]) AS node FROM edges WHERE is_ferry)
SELECT CASE WHEN n IS NULL THEN 'no_road' WHEN s.root = giant THEN 'ok' WHEN n < 10 THEN 'tiny' ELSE 'other_comp' END AS kind, count(*) AS n FROM f LEFT JOIN r ON r.x = f.node LEFT JOIN s USING (root), g GROUP BY 1"""

PAIRS = [
    (edges_by_class, O_CLASS), (s1_element_scan, O_S1), (w1_w2_edges, O_W1), (j1_m2_way_lengths, O_J1), (a1_junctions, O_A1), (a2_parallel_census, O_A2), (a3_a4_shares_and_minutes, O_A3), (a31_incident_surface, O_A31), (w3_cheapest_parallel, O_W3),
    (w4_m19_surface_along_ways, O_W4), (w10_path_vertices, O_W10), (j2_way_tiles, O_J2), (k1_tiled_graph_sink, O_K1), (k1_all_profiles, None), (u1_merged_tile_graphs, O_U1), (j5_barriers_on_graph, O_J5), (f17_box_clip, O_F17), (f35_box_extract, O_F35), (m20_m21_energy, O_M20),
    (i1_a10_components, O_I1), (a15_i4_ferry_terminals, O_A15),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS if sql}
