"""Queries on spatial joins and geometry: J3, J6-J23, J31, J35, A9, F16, F18, F26, M3-M27, S19."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.functions import geo, tags
from waymill.operators import around, cells
from waymill.operators.ranks import at_rank
from waymill.operators.shared import materialize
from waymill.plans import graph as plan
from waymill.plans import overlap, snap
from waymill.queries import graph as g
from waymill.queries.views import pick, view, with_views

BOX = ("min_lat", "min_lon", "max_lat", "max_lon")


def c(name):
    return F.col(name)


def rings(spark: SparkSession, sf: str) -> DataFrame:
    """region_id, class, ring: vertices in order, one row a ring."""
    points = view(spark, sf, "v_ring_points")
    return points.groupBy("region_id", "class").agg(F.transform(F.array_sort(F.collect_list(F.struct("vertex", "lat", "lon"))), lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("ring"))


def ring_cells(r: DataFrame, size: float = 0.1) -> DataFrame:
    return cells.box_in_cells(r.withColumns({f"b_{k}": v for k, v in geo.ring_bounds(c("ring")).items()}), size, ("b_min_lat", "b_min_lon", "b_max_lat", "b_max_lon"))


def points_in_rings(points: DataFrame, r: DataFrame, size: float = 0.1) -> DataFrame:
    """J15: inner join of points to the rings that hold them."""
    return cells.own_cell(points, "lat", "lon", size).join(ring_cells(r, size), ["cy", "cx"]).filter(geo.in_ring(c("lat"), c("lon"), c("ring"))).drop("cy", "cx")


RING_EDGES = "re AS (SELECT region_id, class, vertex, lat AS alat, lon AS alon, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS blat, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS blon FROM v_ring_points WINDOW w AS (PARTITION BY region_id ORDER BY vertex))"


def sql_inside(points: str, key: str) -> str:
    """Oracle: (key, region_id, class) for points inside rings, by crossings."""
    return f"""SELECT p.{key}, region_id, class FROM {points} p, re WHERE (alat > p.lat) <> (blat > p.lat) AND p.lon < (blon - alon) * (p.lat - alat) / (blat - alat + 2.220446049250313e-16) + alon GROUP BY ALL HAVING count(*) % 2 = 1"""


def j15_points_in_rings(spark, sf):
    return points_in_rings(view(spark, sf, "v_points"), rings(spark, sf)).groupBy("region_id").agg(F.count(F.lit(1)).alias("n"), F.sum("point_id").alias("ids"))


O_J15 = with_views("v_points", "v_ring_points") + RING_EDGES + f", i AS ({sql_inside('v_points', 'point_id')}) SELECT region_id, count(*) AS n, sum(point_id)::BIGINT AS ids FROM i GROUP BY 1"


def j15_ferry_regions(spark, sf):
    """Regions of each ferry by samples of its path (both ends and about eight points), and whether its ends lie in different ones."""
    ways, refs, nodes = g.parts(spark, sf)
    ferry = ways.filter(tags.is_ferry(c("route"), c("highway"), c("ferry"))).select("way_id")
    whole = Window.partitionBy("way_id").orderBy("pos")
    at = plan.resolved(refs.join(ferry, "way_id", "left_semi"), nodes).withColumns({"i": F.row_number().over(whole) - 1, "n": F.count(F.lit(1)).over(Window.partitionBy("way_id"))})
    some = at.filter((c("i") == 0) | (c("i") == c("n") - 1) | (c("i") % F.greatest(F.floor(c("n") / 8), F.lit(1)) == 0))
    hit = points_in_rings(some.select("way_id", "i", "n", "lat", "lon"), rings(spark, sf))
    ends = lambda last: F.array_sort(F.collect_set(F.when(c("i") == (c("n") - 1 if last else 0), c("region_id"))))
    by = hit.groupBy("way_id").agg(F.array_sort(F.collect_set("region_id")).alias("all"), ends(False).alias("a"), ends(True).alias("b"))
    crossing = (F.size("a") > 0) & (F.size("b") > 0) & (c("a") != c("b"))
    found = by.select("way_id", F.array_join(c("all").cast("array<string>"), ",").alias("regions"), crossing.alias("cross_region"))
    return ferry.join(found, "way_id", "left").select("way_id", F.coalesce("regions", F.lit("")).alias("regions"), F.coalesce("cross_region", F.lit(False)).alias("cross_region"))


O_J15F = with_views("v_ways", "v_way_nodes", "v_nodes", "v_ring_points") + RING_EDGES + f""", a AS (SELECT way_id, lat, lon, row_number() OVER (PARTITION BY way_id ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY way_id) AS n FROM v_way_nodes JOIN v_nodes USING (node_id) WHERE way_id IN (SELECT way_id FROM v_ways WHERE {g.t.SQL_FERRY})),
s AS (SELECT *, way_id * 1000 + i AS id FROM a WHERE i = 0 OR i = n - 1 OR i % greatest(n // 8, 1) = 0), h AS ({sql_inside('s', 'id')}), j AS (SELECT way_id, i, n, region_id FROM h JOIN s USING (id)),
k AS (SELECT way_id, list_sort(list(DISTINCT region_id)) AS x, coalesce(list_sort(list(DISTINCT region_id) FILTER (i = 0)), []) AS a, coalesce(list_sort(list(DISTINCT region_id) FILTER (i = n - 1)), []) AS b FROM j GROUP BY 1)
SELECT way_id, coalesce(array_to_string(x, ','), '') AS regions, coalesce(len(a) > 0 AND len(b) > 0 AND a <> b, false) AS cross_region FROM v_ways LEFT JOIN k USING (way_id) WHERE {g.t.SQL_FERRY}"""


def j3_k3_ring_tiles(spark, sf):
    """Rings by the tiles that hold one of their vertices."""
    p = view(spark, sf, "v_ring_points")
    return p.select("region_id", F.floor(c("lat") / 0.25).alias("tile_row"), F.floor(c("lon") / 0.25).alias("tile_col")).distinct()


O_J3 = with_views("v_ring_points") + " x AS (SELECT 1) SELECT DISTINCT region_id, floor(lat / 0.25::DOUBLE)::BIGINT AS tile_row, floor(lon / 0.25::DOUBLE)::BIGINT AS tile_col FROM v_ring_points"


def j7_a7_wetland_hazards(spark, sf):
    """Edge midpoints in wetland rings: hard beats soft; hard goes unless boardwalk, soft costs five times."""
    e = g.edges(spark, sf).withColumns({"lat": (c("src_lat") + c("dst_lat")) / 2, "lon": (c("src_lon") + c("dst_lon")) / 2})
    hit = points_in_rings(e.select("edge_id", "lat", "lon"), rings(spark, sf)).groupBy("edge_id").agg(F.max("class").alias("class"))
    joined = e.join(hit, "edge_id", "left")
    fate = F.when(c("class").isNull(), "clear").when(c("class") == 1, "soft").when(c("is_boardwalk"), "boardwalk").otherwise("removed")
    weight = F.when(fate == "removed", 0.0).when(fate == "soft", c("weight") * 5).otherwise(c("weight"))
    return joined.groupBy(fate.alias("fate")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(weight), 1).alias("weight"))


O_J7 = g.E_SQL.replace("WITH v_ways AS", with_views("v_ring_points").removesuffix(",") + ", v_ways AS", 1) + f""", {RING_EDGES}, p AS (SELECT edge_id, (alat + blat) / 2 AS lat, (alon + blon) / 2 AS lon FROM edges), i AS ({sql_inside('p', 'edge_id')}), m AS (SELECT edge_id, max(class) AS k FROM i GROUP BY 1),
f AS (SELECT weight, CASE WHEN k IS NULL THEN 'clear' WHEN k = 1 THEN 'soft' WHEN coalesce(lower(bridge) = 'boardwalk', false) OR coalesce(surface = 'wood', false) THEN 'boardwalk' ELSE 'removed' END AS fate FROM edges LEFT JOIN m USING (edge_id))
SELECT fate, count(*) AS n, round(sum(CASE fate WHEN 'removed' THEN 0 WHEN 'soft' THEN weight * 5 ELSE weight END), 1) AS weight FROM f GROUP BY 1"""


def j17_j18_smallest_region(spark, sf):
    """Each point's smallest covering region, one that spans 120 degrees or more only if no other does."""
    r = view(spark, sf, "v_regions").withColumns({"coarse": (c("max_lon") - c("min_lon") >= 120), "area": (c("max_lat") - c("min_lat")) * (c("max_lon") - c("min_lon"))})
    p = view(spark, sf, "v_points")
    fine = cells.own_cell(p, "lat", "lon", 0.25).join(cells.box_in_cells(r.filter("not coarse"), 0.25), ["cy", "cx"]).filter(cells.contains(c("lat"), c("lon")))
    wide = cells.own_cell(p, "lat", "lon", 30.0).join(cells.box_in_cells(r.filter("coarse"), 30.0), ["cy", "cx"]).filter(cells.contains(c("lat"), c("lon")))
    cols = ["point_id", "region_id", "coarse", "area"]
    best = fine.select(*cols).unionByName(wide.select(*cols)).groupBy("point_id").agg(F.min_by("region_id", F.struct("coarse", "area", "region_id")).alias("region_id"), F.count(F.lit(1)).alias("n_covering"))
    return best


O_J17 = with_views("v_points", "v_regions") + """ j AS (SELECT point_id, region_id, max_lon - min_lon >= 120 AS coarse, (max_lat - min_lat) * (max_lon - min_lon) AS area FROM v_points, v_regions WHERE lat BETWEEN min_lat AND max_lat AND lon BETWEEN min_lon AND max_lon)
SELECT point_id, arg_min(region_id, (coarse, area, region_id)) AS region_id, count(*) AS n_covering FROM j GROUP BY 1"""


def j19_pois_within_radius(spark, sf):
    """POIs within 2 km of each point: how many, the nearest and its distance."""
    q = view(spark, sf, "v_points")
    p = materialize(view(spark, sf, "v_pois").select(c("poi_id").alias("name"), c("lat").alias("to_lat"), c("lon").alias("to_lon")), "pois")
    found = around.around(q.select(c("point_id").alias("name"), "lat", "lon"), p, 2000.0)
    return found.select(c("name").alias("point_id"), "n", c("first").alias("nearest"), F.round("metres", 3).alias("metres"))


O_J19 = with_views("v_points", "v_pois") + f""" d AS (SELECT point_id, poi_id, {g.hav('a.lat', 'a.lon', 'b.lat', 'b.lon', '6371000.0::DOUBLE')} AS m FROM v_points a JOIN v_pois b ON abs(a.lat - b.lat) < 0.02)
SELECT point_id, count(*) AS n, arg_min(poi_id, (m, poi_id)) AS nearest, round(min(m), 3) AS metres FROM d WHERE m <= 2000 GROUP BY 1"""


def corridor(spark, sf) -> DataFrame:
    """Legs between the centres of a group's regions in order."""
    r = view(spark, sf, "v_regions").filter(c("max_lon") - c("min_lon") < 120)
    order = Window.partitionBy("group_id").orderBy("region_id")
    mid = r.select("group_id", "region_id", ((c("min_lat") + c("max_lat")) / 2).alias("lat1"), ((c("min_lon") + c("max_lon")) / 2).alias("lon1"))
    return mid.withColumns({"lat2": F.lead("lat1").over(order), "lon2": F.lead("lon1").over(order)}).filter("lat2 is not null")


def j20_m24_corridor_band(spark, sf):
    """Points within 1500 m of a polyline: 200 m samples find the legs, the segment decides."""
    legs = corridor(spark, sf)
    samples = legs.withColumn("s", F.explode(geo.densified(c("lat1"), c("lon1"), c("lat2"), c("lon2")))).select("*", c("s.lat").alias("to_lat"), c("s.lon").alias("to_lon")).drop("s")
    near = cells.within(view(spark, sf, "v_points"), samples, 1500.0 + 200.0)
    d = geo.segment_distance(*[c(x) for x in ("lat", "lon", "lat1", "lon1", "lat2", "lon2")])
    return near.withColumn("d", d).filter("d <= 1500").groupBy("group_id", "point_id").agg(F.round(F.min("d"), 3).alias("metres"))


_SEG = """sqrt(pow(ax + t * dx, 2) + pow(ay + t * dy, 2))"""


def sql_segdist(source: str, keys: str) -> str:
    """Oracle: distance of (lat, lon) to (lat1, lon1)-(lat2, lon2) rows."""
    return f"""SELECT {keys}, {_SEG} AS d FROM (SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN greatest(0, least(1, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) ELSE 0 END AS t FROM (SELECT *, bx - ax AS dx, by0 - ay AS dy FROM
(SELECT *, (lon1 - lon) * cos(radians(lat)) * 111320 AS ax, (lat1 - lat) * 111320 AS ay, (lon2 - lon) * cos(radians(lat)) * 111320 AS bx, (lat2 - lat) * 111320 AS by0 FROM {source})))"""


_LEGS = """mid AS (SELECT group_id, region_id, (min_lat + max_lat) / 2 AS lat1, (min_lon + max_lon) / 2 AS lon1 FROM v_regions WHERE max_lon - min_lon < 120),
legs AS (SELECT * FROM (SELECT *, lead(lat1) OVER w AS lat2, lead(lon1) OVER w AS lon2 FROM mid WINDOW w AS (PARTITION BY group_id ORDER BY region_id)) WHERE lat2 IS NOT NULL)"""
O_J20 = with_views("v_points", "v_regions") + _LEGS + f""", x AS (SELECT * FROM v_points, legs), d AS ({sql_segdist('x', 'group_id, point_id')}) SELECT group_id, point_id, round(min(d), 3) AS metres FROM d WHERE d <= 1500 GROUP BY ALL"""


def m24_densified_legs(spark, sf):
    return corridor(spark, sf).select("region_id", F.size(geo.densified(c("lat1"), c("lon1"), c("lat2"), c("lon2"))).alias("n"), F.round(geo.haversine(c("lat1"), c("lon1"), c("lat2"), c("lon2"), geo.TOOL_RADIUS), 3).alias("metres"))


O_M24 = with_views("v_regions") + _LEGS + f""", l AS (SELECT region_id, {g.hav('lat1', 'lon1', 'lat2', 'lon2', '6371000.0::DOUBLE')} AS m FROM legs) SELECT region_id, CASE WHEN m < 1 THEN 0 ELSE greatest(1, ceil(m / 200)) END::INT AS n, round(m, 3) AS metres FROM l"""


PLACES = ["viewpoint", None, "cabin", "shelter", "network_hut", None, "overnight"]


def j21_m11_overnight_safety(spark, sf):
    """A point fails within 150 m of a building or, unless it is an established place, within 1000 m of a hard ring; the first reason counts."""
    p = view(spark, sf, "v_points")
    houses = view(spark, sf, "v_nodes").filter("building is not null").select(c("lat").alias("to_lat"), c("lon").alias("to_lon"))
    near = cells.within(p, houses, 150.0).groupBy("point_id").agg(F.min("distance_m").alias("house_m"))
    hard = rings(spark, sf).filter("class = 2")
    pad = 1000.0 / (geo.METRES_A_DEGREE * 0.45)
    b = geo.ring_bounds(c("ring"))
    boxed = cells.box_in_cells(hard.select("ring", (b["min_lat"] - pad).alias("min_lat"), (b["min_lon"] - pad).alias("min_lon"), (b["max_lat"] + pad).alias("max_lat"), (b["max_lon"] + pad).alias("max_lon")), 0.1)
    ice = cells.own_cell(p, "lat", "lon", 0.1).join(boxed, ["cy", "cx"]).withColumn("d", geo.ring_distance(c("lat"), c("lon"), c("ring"))).groupBy("point_id").agg(F.min("d").alias("ice_m"))
    established = F.expr(pick("point_id", PLACES)).isin("cabin", "network_hut", "overnight")
    reason = F.when(c("house_m") < 150, "building").when((c("ice_m") < 1000) & ~F.coalesce(established, F.lit(False)), "glacier").otherwise("ok")
    return p.select("point_id").join(near, "point_id", "left").join(ice, "point_id", "left").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum("point_id").alias("ids"))


O_J21 = with_views("v_points", "v_nodes", "v_ring_points") + RING_EDGES + f""", h AS (SELECT DISTINCT point_id FROM v_points a JOIN v_nodes b ON b.building IS NOT NULL AND abs(a.lat - b.lat) < 0.002 WHERE {g.hav('a.lat', 'a.lon', 'b.lat', 'b.lon', '6371000.0::DOUBLE')} < 150),
i AS ({sql_inside('v_points', 'point_id')}), x AS (SELECT point_id, p.lat, p.lon, alat AS lat1, alon AS lon1, blat AS lat2, blon AS lon2 FROM v_points p, re WHERE class = 2), d AS ({sql_segdist('x', 'point_id')}),
n AS (SELECT point_id FROM d WHERE d < 1000 UNION SELECT point_id FROM i WHERE class = 2)
SELECT CASE WHEN point_id IN (SELECT point_id FROM h) THEN 'building' WHEN point_id IN (SELECT point_id FROM n) AND NOT coalesce({pick('point_id', PLACES)} IN ('cabin', 'network_hut', 'overnight'), false) THEN 'glacier' ELSE 'ok' END AS reason, count(*) AS n, sum(point_id)::BIGINT AS ids FROM v_points GROUP BY 1"""


def way_chords(spark, sf, only: DataFrame | None = None) -> DataFrame:
    """First and last located node of each way, or of the ways in ``only`` (way_id)."""
    _, refs, nodes = g.parts(spark, sf)
    refs = refs if only is None else refs.join(only, "way_id", "left_semi")
    at = plan.resolved(refs, nodes).groupBy("way_id").agg(F.min_by(F.struct("lat", "lon"), "pos").alias("a"), F.max_by(F.struct("lat", "lon"), "pos").alias("b"))
    return at.select("way_id", c("a.lat").alias("lat1"), c("a.lon").alias("lon1"), c("b.lat").alias("lat2"), c("b.lon").alias("lon2"))


CHORDS = "chords AS (SELECT way_id, arg_min(lat, pos) AS lat1, arg_min(lon, pos) AS lon1, arg_max(lat, pos) AS lat2, arg_max(lon, pos) AS lon2 FROM v_way_nodes JOIN v_nodes USING (node_id) GROUP BY 1)"


def way_segments(spark, sf) -> DataFrame:
    """Each leg between located nodes of a way; a way of one located node is a point."""
    _, refs, nodes = g.parts(spark, sf)
    order = Window.partitionBy("way_id").orderBy("pos")
    after = lambda k: F.coalesce(F.lead(k).over(order), F.when(F.lag(k).over(order).isNull(), c(k)))
    at = plan.resolved(refs, nodes).filter("lat is not null and lon is not null")
    return at.select("way_id", c("lat").alias("lat1"), c("lon").alias("lon1"), after("lat").alias("lat2"), after("lon").alias("lon2")).filter("lat2 is not null")


def side_crossings(segments: DataFrame, r: DataFrame) -> DataFrame:
    """way_id, region_id of segments that meet a side of a ring, touching included; a pair may come several times."""
    after = F.concat(F.slice(c("ring"), 2, F.size("ring") - 1), F.slice(c("ring"), 1, 1))
    sides = r.select("region_id", F.explode(F.arrays_zip(c("ring").alias("p"), after.alias("q"))).alias("s")).select("region_id", *[c(f"s.{a}.{b}").alias(f"{a}_{b}") for a in "pq" for b in ("lat", "lon")])
    low = lambda a, b: F.least(c(a), c(b))
    high = lambda a, b: F.greatest(c(a), c(b))
    a = cells.box_in_cells(segments.withColumns({"min_lat": low("lat1", "lat2"), "max_lat": high("lat1", "lat2"), "min_lon": low("lon1", "lon2"), "max_lon": high("lon1", "lon2")}), 0.5).drop(*BOX)
    b = cells.box_in_cells(sides.withColumns({"min_lat": low("p_lat", "q_lat"), "max_lat": high("p_lat", "q_lat"), "min_lon": low("p_lon", "q_lon"), "max_lon": high("p_lon", "q_lon")}), 0.5).drop(*BOX)
    meet = geo.segments_meet((c("lon1"), c("lat1")), (c("lon2"), c("lat2")), (c("p_lon"), c("p_lat")), (c("q_lon"), c("q_lat")))
    return a.join(b, ["cy", "cx"]).filter(meet).select("way_id", "region_id")


def j22_m7_barrier_crossings(spark, sf):
    """Ways whose chord meets a side of a ring, touching included, or ends in a glacier (a ring of class 2)."""
    chord, r = way_chords(spark, sf), rings(spark, sf)
    ends = chord.select("way_id", F.explode(F.array(F.struct(c("lat1").alias("lat"), c("lon1").alias("lon")), F.struct(c("lat2").alias("lat"), c("lon2").alias("lon")))).alias("p")).select("way_id", "p.*")
    iced = points_in_rings(ends, r.filter("class = 2")).select("way_id", "region_id")
    return side_crossings(chord, r).unionByName(iced).groupBy("way_id").agg(F.count_distinct("region_id").alias("n_regions"))


_X = "({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax})"


def _x(a, b, p):
    pt = {"1": ("lon1", "lat1"), "2": ("lon2", "lat2"), "p": ("alon", "alat"), "q": ("blon", "blat")}
    return _X.format(ax=pt[a][0], ay=pt[a][1], bx=pt[b][0], by=pt[b][1], cx=pt[p][0], cy=pt[p][1])


def _on(d, a, b, x, y):
    return f"({d} = 0 AND {x} BETWEEN least({a}lon, {b}lon) AND greatest({a}lon, {b}lon) AND {y} BETWEEN least({a}lat, {b}lat) AND greatest({a}lat, {b}lat))"


def _on2(d, x, y):
    return f"({d} = 0 AND {x} BETWEEN least(lon1, lon2) AND greatest(lon1, lon2) AND {y} BETWEEN least(lat1, lat2) AND greatest(lat1, lat2))"


MEETS = f"((d1 * d2 < 0 AND d3 * d4 < 0) OR {_on('d1', 'a', 'b', 'lon1', 'lat1')} OR {_on('d2', 'a', 'b', 'lon2', 'lat2')} OR {_on2('d3', 'alon', 'alat')} OR {_on2('d4', 'blon', 'blat')})"


def sql_meets(segments: str, key: str) -> str:
    """Oracle: (key, region_id) of (lat1, lon1)-(lat2, lon2) rows that meet a ring's side."""
    return f"""SELECT DISTINCT {key}, region_id FROM (SELECT {key}, region_id, {_x('p', 'q', '1')} AS d1, {_x('p', 'q', '2')} AS d2, {_x('1', '2', 'p')} AS d3, {_x('1', '2', 'q')} AS d4, alat, alon, blat, blon, lat1, lon1, lat2, lon2 FROM {segments}, re) WHERE {MEETS}"""


LEGS = """located AS (SELECT way_id, pos, lat, lon FROM v_way_nodes JOIN v_nodes USING (node_id) WHERE lat IS NOT NULL AND lon IS NOT NULL), legs AS (SELECT way_id, row_number() OVER () AS leg, lat1, lon1, lat2, lon2 FROM (SELECT way_id, lat AS lat1, lon AS lon1,
coalesce(lead(lat) OVER w, CASE WHEN count(*) OVER (PARTITION BY way_id) = 1 THEN lat END) AS lat2, coalesce(lead(lon) OVER w, CASE WHEN count(*) OVER (PARTITION BY way_id) = 1 THEN lon END) AS lon2 FROM located WINDOW w AS (PARTITION BY way_id ORDER BY pos)) WHERE lat2 IS NOT NULL)"""
O_J22 = with_views("v_way_nodes", "v_nodes", "v_ring_points") + RING_EDGES + f""", {CHORDS}, m AS ({sql_meets('chords', 'way_id')}), e AS (SELECT way_id, lat1 AS lat, lon1 AS lon FROM chords), z AS (SELECT way_id, lat2 AS lat, lon2 AS lon FROM chords),
i AS ({sql_inside('e', 'way_id')}), j AS ({sql_inside('z', 'way_id')}), u AS (SELECT way_id, region_id FROM m UNION SELECT way_id, region_id FROM i WHERE class = 2 UNION SELECT way_id, region_id FROM j WHERE class = 2)
SELECT way_id, count(DISTINCT region_id) AS n_regions FROM u GROUP BY 1"""


def _snapped(spark, sf, nodes, profiles):
    found = snap.snapped(view(spark, sf, "v_points"), nodes, profiles)
    return found.select("point_id", "profile", "node", F.round("metres", 3).alias("metres"), F.round("nearest_m", 3).alias("nearest_m"), "status")


def j23_snap(spark, sf):
    """Points snapped to the motor graph for cars and trucks: in the giant component the best worst surface within the budget, else the nearest node of any component, else too far."""
    return _snapped(spark, sf, snap.linked_nodes(g.edges(spark, sf)), ("car", "truck"))


def j23_snap_slow_modes(spark, sf):
    """Points snapped to the graphs of feet and bicycles: the nearest node of the giant component within the budget, else the nearest of any."""
    one = lambda k: _snapped(spark, sf, snap.linked_nodes(plan.edges(*g.parts(spark, sf), k)), (k,))
    return one("foot").unionByName(one("bicycle"))


def _best_sql(k, m):
    return f"""SELECT point_id, '{k}' AS profile, coalesce(g, CASE WHEN near <= {m} THEN a END) AS node, round(coalesce(gm, CASE WHEN near <= {m} THEN near END), 3) AS metres, round(near, 3) AS nearest_m, CASE WHEN g IS NOT NULL THEN 'giant' WHEN near <= {m} THEN 'island' ELSE 'too_far' END AS status
FROM (SELECT point_id, arg_min(node, (m, node)) AS a, min(m) AS near, arg_min(node, (worst, m, node)) FILTER (apart = 0 AND m <= {m}) AS g, arg_min(m, (worst, m, node)) FILTER (apart = 0 AND m <= {m}) AS gm FROM d GROUP BY 1)"""


O_J23 = g.O_I1.replace("WITH RECURSIVE v_ways AS", "WITH RECURSIVE " + with_views("v_points").removeprefix("WITH ") + " v_ways AS", 1)
O_J23 = O_J23[: O_J23.rindex("SELECT component, n")].rstrip() + f""", gi AS (SELECT arg_max(component, (n, -component)) AS giant FROM s), n AS (SELECT node, any_value(lat) AS lat, any_value(lon) AS lon, max(surface_rank) AS worst FROM (SELECT src AS node, surface_rank FROM edges UNION ALL SELECT dst, surface_rank FROM edges) JOIN v_nodes ON node_id = node GROUP BY 1),
o AS (SELECT n.*, (root <> giant)::INT AS apart FROM n JOIN r ON r.x = node, gi), d AS MATERIALIZED (SELECT point_id, node, worst, apart, {g.hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS m FROM v_points a, o b)
{" UNION ALL ".join(_best_sql(k, snap.BUDGET_M[k]) for k in snap.BY_SURFACE)}"""


def j6_edge_heights(spark, sf):
    """Height at both ends of each edge from rasters: cell first, then post in the cell; voids stay missing."""
    e, dem = g.edges(spark, sf), view(spark, sf, "v_dem")
    side = F.lit(int(view(spark, sf, "embeddings").count() ** 0.5))
    keys = ["cell_row", "cell_col", "post_row", "post_col"]

    def place(lat: str, lon: str) -> dict:
        y, x = (c(lat) - 59) / 2 * side, (c(lon) - 10) / 2 * side
        return {"cell_row": F.floor(y), "cell_col": F.floor(x), "post_row": F.floor((y - F.floor(y)) * 3), "post_col": F.floor((x - F.floor(x)) * 3)}

    first = e.withColumns(place("src_lat", "src_lon")).join(dem.withColumnRenamed("elev_m", "h0"), keys, "left").drop(*keys)
    both = first.withColumns(place("dst_lat", "dst_lon")).join(dem.withColumnRenamed("elev_m", "h1"), keys, "left")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if((c("h1") - c("h0")).isNull()).alias("n_missing"), F.sum(c("h1") - c("h0")).alias("climb"), F.sum(F.greatest(c("h1") - c("h0"), F.lit(0.0))).alias("up"))


_PLACE = "v.cell_row = floor({y})::BIGINT AND v.cell_col = floor({x})::BIGINT AND v.post_row = floor(({y} - floor({y})) * 3)::BIGINT AND v.post_col = floor(({x} - floor({x})) * 3)::BIGINT"
O_J6 = g.E_SQL.replace("WITH v_ways AS", with_views("v_dem").removesuffix(",") + ", v_ways AS", 1) + f""", n AS (SELECT floor(sqrt(count(*)))::BIGINT AS side FROM embeddings), ends AS (SELECT ((CASE WHEN back THEN blat ELSE alat END) - 59) / 2 * side AS y0, ((CASE WHEN back THEN blon ELSE alon END) - 10) / 2 * side AS x0, ((CASE WHEN back THEN alat ELSE blat END) - 59) / 2 * side AS y1, ((CASE WHEN back THEN alon ELSE blon END) - 10) / 2 * side AS x1 FROM edges, n),
h AS (SELECT b.elev_m - a.elev_m AS d FROM ends LEFT JOIN v_dem a ON {_PLACE.format(y='y0', x='x0').replace('v.', 'a.')} LEFT JOIN v_dem b ON {_PLACE.format(y='y1', x='x1').replace('v.', 'b.')})
SELECT count(*) AS n, count(*) FILTER (d IS NULL) AS n_missing, sum(d) AS climb, sum(CASE WHEN d IS NULL THEN 0 ELSE greatest(d, 0) END) AS up FROM h"""


BIND_M, DRAWN = 75.0, 20.0


def j10_nearest_feature(spark, sf):
    """Each point bound to the way with the nearest middle of a segment in degrees, if that is within 75 m, on a map drawn 20 times smaller."""
    small = lambda y, x: (59 + (y - 59) / DRAWN, 10 + (x - 10) / DRAWN)
    la, lo = small((c("lat1") + c("lat2")) / 2, (c("lon1") + c("lon2")) / 2)
    mids = materialize(way_segments(spark, sf).select(c("way_id").alias("name"), la.alias("to_lat"), lo.alias("to_lon")), "middles")
    y, x = small(c("lat"), c("lon"))
    found = around.around(view(spark, sf, "v_points").select(c("point_id").alias("name"), y.alias("lat"), x.alias("lon")), mids, BIND_M, degrees=True, count=False)
    return found.select(c("name").alias("point_id"), c("first").alias("way_id"), F.round("metres", 3).alias("metres"))


O_J10 = with_views("v_points", "v_way_nodes", "v_nodes") + LEGS + f""", m AS (SELECT way_id, 59 + ((lat1 + lat2) / 2 - 59) / 20.0::DOUBLE AS my, 10 + ((lon1 + lon2) / 2 - 10) / 20.0::DOUBLE AS mx FROM legs), p AS (SELECT point_id, 59 + (lat - 59) / 20.0::DOUBLE AS lat, 10 + (lon - 10) / 20.0::DOUBLE AS lon FROM v_points),
d AS (SELECT point_id, way_id, pow(lat - my, 2) + pow(lon - mx, 2) AS q, {g.hav('lat', 'lon', 'my', 'mx', '6371000.0::DOUBLE')} AS m FROM p JOIN m ON my BETWEEN lat - 0.001 AND lat + 0.001)
SELECT point_id, arg_min(way_id, (q, way_id)) AS way_id, round(min(m), 3) AS metres FROM d WHERE m <= 75 GROUP BY 1"""


def ferries(spark, sf) -> DataFrame:
    """ferry_id, name, is_car and the two ends of each ferry way."""
    ways, _, _ = g.parts(spark, sf)
    car = tags.old_ferry_class(*[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle")]) == "car"
    some = ways.filter(tags.is_ferry(c("route"), c("highway"), c("ferry"))).select("way_id", F.lower(F.trim("name")).alias("name"), car.alias("is_car"))
    return way_chords(spark, sf, some.select("way_id")).join(some, "way_id").withColumnRenamed("way_id", "ferry_id")


def published(f: DataFrame) -> DataFrame:
    """The ferries as an earlier pack holds them: moved by up to 4 km, every other one turned, some without a name."""
    lat, odd = (c("ferry_id") % 13) * 0.003, c("ferry_id") % 2 == 1
    return f.select(
        (c("ferry_id") + 1_000_000_000).alias("pack_id"), F.when(c("ferry_id") % 4 != 0, c("name")).alias("pack_name"), (F.when(odd, c("lat2")).otherwise(c("lat1")) + lat).alias("u1"), F.when(odd, c("lon2")).otherwise(c("lon1")).alias("v1"),
        (F.when(odd, c("lat1")).otherwise(c("lat2")) + lat).alias("u2"), F.when(odd, c("lon1")).otherwise(c("lon2")).alias("v2"),
    )


def ferry_pairs(f: DataFrame, p: DataFrame, metres: float, same_name: bool = False) -> DataFrame:
    """Pairs whose ends lie at most ``metres`` apart in sum, with ``metres`` of one orientation; a pair that both admit comes twice."""
    right = p.select("pack_id", *[x for x in ("pack_name",) if x in p.columns], *[c(x).alias(f"to_{y}") for x, y in zip(("u1", "v1", "u2", "v2"), ("lat1", "lon1", "lat2", "lon2"), strict=True)])
    if same_name:
        f, right = f.filter("name <> ''"), right.filter("pack_name <> ''").withColumnRenamed("pack_name", "name")
    return cells.within_ends(f, right, metres, on=("name",) if same_name else ())


PROXIMITY_M = 2500.0


def j13_ferry_match(spark, sf):
    """Each ferry and the published ferry whose ends are nearest in sum, halved for equal names, up to twice 2500 m."""
    f = materialize(ferries(spark, sf), "ferries")
    p, f = published(f), f.drop("is_car")
    near = ferry_pairs(f, p, 2 * PROXIMITY_M).select("ferry_id", "pack_id", F.when((c("name") != "") & (c("name") == c("pack_name")), c("metres") / 2).otherwise(c("metres")).alias("score"))
    named = ferry_pairs(f, p, 4 * PROXIMITY_M, same_name=True).select("ferry_id", "pack_id", (c("metres") / 2).alias("score"))
    best = near.unionByName(named).groupBy("ferry_id").agg(F.min(F.struct("score", "pack_id")).alias("m"))
    return best.select("ferry_id", "m.pack_id", F.round("m.score", 2).alias("score"))


_H = lambda a, b, x, y: g.hav(a, b, x, y, "6371000.0::DOUBLE")
_CARS = "('yes', 'designated', 'permissive', 'true', '1')"
FERRIES = CHORDS + f""", f AS (SELECT way_id AS ferry_id, lower(trim(name)) AS name, coalesce(motorcar IN {_CARS}, false) OR coalesce(motor_vehicle IN {_CARS}, false) OR coalesce(vehicle IN {_CARS}, false) AS is_car, lat1, lon1, lat2, lon2 FROM chords JOIN v_ways USING (way_id) WHERE {g.t.SQL_FERRY}),
p AS (SELECT ferry_id + 1000000000 AS pack_id, CASE WHEN ferry_id % 4 <> 0 THEN name END AS pack_name, CASE WHEN ferry_id % 2 = 1 THEN lat2 ELSE lat1 END + (ferry_id % 13) * 0.003::DOUBLE AS u1, CASE WHEN ferry_id % 2 = 1 THEN lon2 ELSE lon1 END AS v1,
CASE WHEN ferry_id % 2 = 1 THEN lat1 ELSE lat2 END + (ferry_id % 13) * 0.003::DOUBLE AS u2, CASE WHEN ferry_id % 2 = 1 THEN lon1 ELSE lon2 END AS v2 FROM f),
d AS (SELECT *, least({_H('lat1', 'lon1', 'u1', 'v1')} + {_H('lat2', 'lon2', 'u2', 'v2')}, {_H('lat1', 'lon1', 'u2', 'v2')} + {_H('lat2', 'lon2', 'u1', 'v1')}) AS metres FROM f, p)"""
O_J13 = with_views("v_ways", "v_way_nodes", "v_nodes") + FERRIES + """, s AS (SELECT ferry_id, pack_id, CASE WHEN name <> '' AND name = pack_name THEN metres / 2 ELSE metres END AS score FROM d)
SELECT ferry_id, arg_min(pack_id, (score, pack_id)) AS pack_id, round(min(score), 2) AS score FROM s WHERE score <= 5000 GROUP BY 1"""


def j14_wrong_admissions(spark, sf):
    """Published ferries nearest to a ferry that cars may not take, ends within 1600 m in sum, and nearer to it than to any car ferry."""
    f = materialize(ferries(spark, sf), "ferries")
    near = ferry_pairs(f.drop("name"), published(f).drop("pack_name"), 1600.0)
    best = near.groupBy("pack_id").agg(F.min(F.when(~c("is_car"), F.struct("metres", "ferry_id"))).alias("other"), F.min(F.when(c("is_car"), c("metres"))).alias("car_m"))
    return best.filter("other is not null and (car_m is null or other.metres < car_m)").select("pack_id", c("other.ferry_id").alias("ferry_id"), F.round("other.metres", 1).alias("metres"))


O_J14 = with_views("v_ways", "v_way_nodes", "v_nodes") + FERRIES + """, b AS (SELECT pack_id, arg_min(ferry_id, (metres, ferry_id)) FILTER (NOT is_car AND metres <= 1600) AS ferry_id, min(metres) FILTER (NOT is_car AND metres <= 1600) AS o, min(metres) FILTER (is_car) AS k FROM d GROUP BY 1)
SELECT pack_id, ferry_id, round(o, 1) AS metres FROM b WHERE o IS NOT NULL AND (k IS NULL OR o < k)"""


def j16_lattice_overlap(spark, sf):
    """Region boxes over rings by a shared lattice: share of each region's points that a ring holds, and of their union."""
    step = 0.02
    r = view(spark, sf, "v_regions").filter(c("max_lon") - c("min_lon") < 120)
    ys = F.sequence(F.ceil(c("min_lat") / step), F.floor(c("max_lat") / step))
    xs = F.sequence(F.ceil(c("min_lon") / step), F.floor(c("max_lon") / step))
    lattice = r.select(c("region_id").alias("box_id"), F.explode(ys).alias("iy"), xs.alias("xs")).select("box_id", "iy", F.explode("xs").alias("ix")).withColumns({"lat": c("iy") * step + 0.0013, "lon": c("ix") * step + 0.0017})
    hit = points_in_rings(lattice, rings(spark, sf))
    total = lattice.groupBy("box_id").agg(F.count(F.lit(1)).alias("n"))
    union = hit.groupBy("box_id").agg(F.count_distinct("iy", "ix").alias("covered"))
    per = hit.groupBy("box_id", "region_id").agg(F.count(F.lit(1)).alias("k"))
    out = per.join(total, "box_id").join(union, "box_id")
    return out.select("box_id", "region_id", F.round(100 * c("k") / c("n"), 4).alias("pct"), F.round(100 * c("covered") / c("n"), 4).alias("union_pct")).filter("pct >= 0.5")


O_J16 = with_views("v_regions", "v_ring_points") + RING_EDGES + f""", l AS (SELECT box_id, iy, ix, iy * 0.02::DOUBLE + 0.0013::DOUBLE AS lat, ix * 0.02::DOUBLE + 0.0017::DOUBLE AS lon, box_id * 1000000000 + iy * 10000 + ix AS id FROM (SELECT box_id, iy, unnest(range(x0, x1 + 1)) AS ix FROM
(SELECT region_id::BIGINT AS box_id, unnest(range(ceil(min_lat / 0.02::DOUBLE)::BIGINT, floor(max_lat / 0.02::DOUBLE)::BIGINT + 1)) AS iy, ceil(min_lon / 0.02::DOUBLE)::BIGINT AS x0, floor(max_lon / 0.02::DOUBLE)::BIGINT AS x1 FROM v_regions WHERE max_lon - min_lon < 120))),
i AS ({sql_inside('l', 'id')}), t AS (SELECT box_id, count(*) AS n FROM l GROUP BY 1), u AS (SELECT id // 1000000000 AS box_id, count(DISTINCT id) AS covered FROM i GROUP BY 1), p AS (SELECT id // 1000000000 AS box_id, region_id, count(*) AS k FROM i GROUP BY 1, 2)
SELECT box_id::INT AS box_id, region_id, round(100 * k / n, 4) AS pct, round(100 * covered / n, 4) AS union_pct FROM p JOIN t USING (box_id) JOIN u USING (box_id) WHERE round(100 * k / n, 4) >= 0.5"""


def j16_polygon_overlap(spark, sf):
    """Leaf polygons, a diamond round each point, over the rings of regions: coverage, overspill, what is kept and why, and the union of a region's leaves."""
    r = rings(spark, sf).select("region_id", "ring")
    at = lambda y, x: F.struct((c("lat") + y * c("r")).alias("lat"), (c("lon") + x * c("r")).alias("lon"))
    leaves = view(spark, sf, "v_points").withColumn("r", (c("point_id") % 5 + 1) * 0.04).select(c("point_id").alias("leaf_id"), F.array(at(1, 0), at(0, 1), at(-1, 0), at(0, -1)).alias("ring"))
    found = overlap.overlaps(r, leaves)
    return found.select("region_id", "leaf_id", *[F.round(x, 4).alias(x) for x in ("coverage_pct", "overspill_pct", "error_pct", "union_pct")], "mostly_outside", "reason")


def j31_f16_adjacent_boxes(spark, sf):
    """Pairs of regions whose boxes touch within 0.05 degrees, and whether they share a group."""
    r = view(spark, sf, "v_regions").filter(c("max_lon") - c("min_lon") < 120)
    pad = r.select("region_id", "group_id", (c("min_lat") - 0.05).alias("min_lat"), (c("min_lon") - 0.05).alias("min_lon"), (c("max_lat") + 0.05).alias("max_lat"), (c("max_lon") + 0.05).alias("max_lon"))
    a, b = cells.box_in_cells(pad, 0.25).alias("a"), cells.box_in_cells(r, 0.25).alias("b")
    touch = (c("a.min_lat") <= c("b.max_lat")) & (c("b.min_lat") <= c("a.max_lat")) & (c("a.min_lon") <= c("b.max_lon")) & (c("b.min_lon") <= c("a.max_lon"))
    met = a.join(b, (c("a.cy") == c("b.cy")) & (c("a.cx") == c("b.cx")) & (c("a.region_id") < c("b.region_id")) & touch)
    return met.select(c("a.region_id").alias("a_id"), c("b.region_id").alias("b_id"), (c("a.group_id") == c("b.group_id")).alias("internal")).distinct()


O_J31 = with_views("v_regions") + """ r AS (SELECT * FROM v_regions WHERE max_lon - min_lon < 120) SELECT a.region_id AS a_id, b.region_id AS b_id, a.group_id = b.group_id AS internal FROM r a JOIN r b ON a.region_id < b.region_id
AND a.min_lat - 0.05::DOUBLE <= b.max_lat AND b.min_lat <= a.max_lat + 0.05::DOUBLE AND a.min_lon - 0.05::DOUBLE <= b.max_lon AND b.min_lon <= a.max_lon + 0.05::DOUBLE"""


def land_cells(r: DataFrame, size: float) -> DataFrame:
    """region_id, cy, cx, land: a cell of a ring's box is land if one of 49 samples or a corner is in the ring, a vertex in the cell, or a side of the ring meets a side of the cell."""
    spots = [((i + 0.5) / 7, (j + 0.5) / 7) for i in range(7) for j in range(7)] + [(float(y), float(x)) for y in (0, 1) for x in (0, 1)]
    spot = F.exists(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in spots]), lambda o: geo.in_ring((c("cy") + o["y"]) * size, (c("cx") + o["x"]) * size, c("ring")))
    south, north, west, east = c("cy") * size, (c("cy") + 1) * size, c("cx") * size, (c("cx") + 1) * size
    vertex = F.exists(c("ring"), lambda p: p["lat"].between(south, north) & p["lon"].between(west, east))
    corners = [(west, south), (east, south), (east, north), (west, north)]
    after = F.concat(F.slice(c("ring"), 2, F.size("ring") - 1), F.slice(c("ring"), 1, 1))

    def meets(s):
        out = F.lit(False)
        for i in range(4):
            out = out | geo.segments_meet((s["p"]["lon"], s["p"]["lat"]), (s["q"]["lon"], s["q"]["lat"]), corners[i], corners[(i + 1) % 4])
        return out

    side = F.exists(F.arrays_zip(c("ring").alias("p"), after.alias("q")), meets)
    return ring_cells(r, size).withColumn("land", spot | vertex | side).select("region_id", "cy", "cx", "land")


def j35_u7_cells_of_rings(spark, sf):
    """Cells of one degree, and of a tenth, in each ring's box, and those that are land."""
    r = rings(spark, sf)
    every = [land_cells(r, size).withColumn("size", F.lit(size)) for size in (1.0, 0.1)]
    return every[0].unionByName(every[1]).groupBy("region_id", "size").agg(F.count(F.lit(1)).alias("n_cells"), F.count_if("land").alias("n_land"))


O_J35 = with_views("v_ring_points") + RING_EDGES + f""", z AS (SELECT unnest([1.0::DOUBLE, 0.1::DOUBLE]) AS size), b AS (SELECT region_id, size, floor(min(lat) / size)::BIGINT AS y0, floor(max(lat) / size)::BIGINT AS y1, floor(min(lon) / size)::BIGINT AS x0, floor(max(lon) / size)::BIGINT AS x1 FROM v_ring_points, z GROUP BY 1, 2),
k AS (SELECT region_id AS rid, size, cy, unnest(range(x0, x1 + 1)) AS cx FROM (SELECT *, unnest(range(y0, y1 + 1)) AS cy FROM b)), o AS (SELECT (i + 0.5::DOUBLE) / 7 AS dy, (j + 0.5::DOUBLE) / 7 AS dx FROM range(7) a(i), range(7) b(j) UNION ALL SELECT i::DOUBLE, j::DOUBLE FROM range(2) a(i), range(2) b(j)),
s AS (SELECT rid, size, cy, cx, (cy + dy) * size AS lat, (cx + dx) * size AS lon FROM k, o),
h AS (SELECT rid, size, cy, cx FROM s JOIN re ON re.region_id = rid WHERE (alat > s.lat) <> (blat > s.lat) AND s.lon < (blon - alon) * (s.lat - alat) / (blat - alat + 2.220446049250313e-16) + alon GROUP BY rid, size, cy, cx, s.lat, s.lon HAVING count(*) % 2 = 1),
v AS (SELECT rid, size, cy, cx FROM k JOIN v_ring_points ON region_id = rid WHERE lat BETWEEN cy * size AND (cy + 1) * size AND lon BETWEEN cx * size AND (cx + 1) * size),
q AS (SELECT rid, size, cy, cx, cy * size AS lat1, cx * size AS lon1, cy * size AS lat2, (cx + 1) * size AS lon2 FROM k UNION ALL SELECT rid, size, cy, cx, cy * size, (cx + 1) * size, (cy + 1) * size, (cx + 1) * size FROM k
  UNION ALL SELECT rid, size, cy, cx, (cy + 1) * size, (cx + 1) * size, (cy + 1) * size, cx * size FROM k UNION ALL SELECT rid, size, cy, cx, (cy + 1) * size, cx * size, cy * size, cx * size FROM k),
m AS (SELECT q.*, alat, alon, blat, blon, {_x('p', 'q', '1')} AS d1, {_x('p', 'q', '2')} AS d2, {_x('1', '2', 'p')} AS d3, {_x('1', '2', 'q')} AS d4 FROM q JOIN re ON re.region_id = rid), l AS (SELECT rid, size, cy, cx FROM h UNION SELECT * FROM v UNION SELECT rid, size, cy, cx FROM m WHERE {MEETS})
SELECT k.rid AS region_id, k.size, count(*) AS n_cells, count(l.rid) AS n_land FROM k LEFT JOIN l ON l.rid = k.rid AND l.size = k.size AND l.cy = k.cy AND l.cx = k.cx GROUP BY 1, 2"""


def a9_region_bounds(spark, sf):
    """Order-statistic bounds of node positions, then grown to nodes within a 0.01 degree halo."""
    n = view(spark, sf, "v_nodes").select("lat", "lon")
    total = n.count()
    low, high = (int((total - 1) * p + 0.5) for p in (0.005, 0.995))
    core = {f"{edge}_{x}": at_rank(n, x, r) for x in ("lat", "lon") for edge, r in (("min", low), ("max", high))}
    halo = 0.01
    edge = lambda k: F.lit(core[k]).cast("double")
    grown = n.filter(c("lat").between(edge("min_lat") - halo, edge("max_lat") + halo) & c("lon").between(edge("min_lon") - halo, edge("max_lon") + halo))
    return grown.agg(*[F.round(F.least(F.min(x), edge(f"min_{x}")), 6).alias(f"min_{x}") for x in ("lat", "lon")], *[F.round(F.greatest(F.max(x), edge(f"max_{x}")), 6).alias(f"max_{x}") for x in ("lat", "lon")])


O_A9 = with_views("v_nodes") + """ r AS (SELECT lat, lon, row_number() OVER (ORDER BY lat) - 1 AS i, row_number() OVER (ORDER BY lon) - 1 AS j, count(*) OVER () AS n FROM v_nodes),
k AS (SELECT max(lat) FILTER (i = floor((n - 1) * 0.005::DOUBLE + 0.5)) AS a, max(lat) FILTER (i = floor((n - 1) * 0.995::DOUBLE + 0.5)) AS b, max(lon) FILTER (j = floor((n - 1) * 0.005::DOUBLE + 0.5)) AS c, max(lon) FILTER (j = floor((n - 1) * 0.995::DOUBLE + 0.5)) AS d FROM r)
SELECT round(least(min(lat), min(a)), 6) AS min_lat, round(least(min(lon), min(c)), 6) AS min_lon, round(greatest(max(lat), max(b)), 6) AS max_lat, round(greatest(max(lon), max(d)), 6) AS max_lon FROM v_nodes, k
WHERE lat BETWEEN a - 0.01::DOUBLE AND b + 0.01::DOUBLE AND lon BETWEEN c - 0.01::DOUBLE AND d + 0.01::DOUBLE"""


def f18_hash_sample(spark, sf):
    """One in 64 nodes by a hash of the position in 1e-7 degrees, whatever the order: a sampling operator."""
    place = F.concat_ws(",", F.floor(c("lat") * 1e7).cast("long"), F.floor(c("lon") * 1e7).cast("long"))
    number = F.conv(F.substring(F.md5(place.cast("binary")), 1, 8), 16, 10).cast("long")
    return view(spark, sf, "v_nodes").filter(number % 64 == 0).select("node_id")


O_F18 = with_views("v_nodes") + " h AS (SELECT node_id, ('0x' || substr(md5(floor(lat * 1e7)::BIGINT || ',' || floor(lon * 1e7)::BIGINT), 1, 8))::BIGINT AS h FROM v_nodes) SELECT node_id FROM h WHERE h % 64 = 0"


def m12_m14_grids(spark, sf):
    """Degree cells with their text form and back, web tiles, pixels, bounds, quanta of each point."""
    p = view(spark, sf, "v_points").withColumns({"la": c("lat") - 120 * (c("point_id") % 2), "lo": c("lon") - 20 * (c("point_id") % 3)})
    tile = geo.web_tile(c("la"), c("lo"), 12)
    p = p.withColumn("stem", geo.grid_stem(c("la"), c("lo"))).withColumns(geo.parse_stem(c("stem"))).withColumns(tile)
    b = geo.web_tile_bounds(c("tx"), c("ty"), 12)
    x = geo.web_pixel(c("la"), c("lo"), 12)
    return p.select("point_id", "stem", "cell_lat", "cell_lon", "tx", "ty", F.round(x["px"], 2).alias("px"), F.round(x["py"], 2).alias("py"), *[F.round(v, 6).alias(k) for k, v in b.items()], geo.quantise(c("la")).alias("q"), geo.to_e7(c("lo")).alias("e7"))


O_M12 = with_views("v_points") + """ p AS (SELECT point_id, lat - 120 * (point_id % 2) AS la, lon - 20 * (point_id % 3) AS lo FROM v_points), q AS (SELECT *, floor(la)::INT AS a, floor(lo)::INT AS o, (lo + 180) / 360 AS fx, (1 - asinh(tan(radians(greatest(least(la, 85.0511::DOUBLE), -85.0511::DOUBLE)))) / pi()) / 2 AS fy FROM p),
t AS (SELECT *, floor(fx * 4096)::INT AS tx, floor(fy * 4096)::INT AS ty FROM q)
SELECT point_id, CASE WHEN a >= 0 THEN 'N' ELSE 'S' END || lpad(abs(a)::VARCHAR, 2, '0') || CASE WHEN o >= 0 THEN 'E' ELSE 'W' END || lpad(abs(o)::VARCHAR, 3, '0') AS stem, a AS cell_lat, o AS cell_lon, tx, ty, round(fx * 2097152, 2) AS px, round(fy * 2097152, 2) AS py,
round(degrees(atan((exp(pi() * (1 - 2 * ty / 4096.0::DOUBLE)) - exp(-pi() * (1 - 2 * ty / 4096.0::DOUBLE))) / 2)), 6) AS north, round(degrees(atan((exp(pi() * (1 - 2 * (ty + 1) / 4096.0::DOUBLE)) - exp(-pi() * (1 - 2 * (ty + 1) / 4096.0::DOUBLE))) / 2)), 6) AS south,
round(tx / 4096.0::DOUBLE * 360 - 180, 6) AS west, round((tx + 1) / 4096.0::DOUBLE * 360 - 180, 6) AS east, round_even(la / 1e-5::DOUBLE, 0)::BIGINT AS q, round(lo * 1e7::DOUBLE)::BIGINT AS e7 FROM t"""


def m10_m22_m27_rings(spark, sf):
    """Bounds, mean vertex, equal-area size and a path hash of each ring."""
    r = rings(spark, sf)
    b, m = geo.ring_bounds(c("ring")), geo.ring_mean(c("ring"))
    alt = F.transform("ring", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), F.lit(1.26).alias("alt_m")))
    return r.select("region_id", *[F.round(v, 6).alias(k) for k, v in b.items()], F.round(m["lat"], 6).alias("mid_lat"), F.round(m["lon"], 6).alias("mid_lon"), F.round(geo.ring_area(c("ring")), 8).alias("area"), geo.geometry_hash(alt).alias("hash"))


O_M10 = with_views("v_ring_points") + RING_EDGES + """ SELECT region_id, round(min(alat), 6) AS min_lat, round(min(alon), 6) AS min_lon, round(max(alat), 6) AS max_lat, round(max(alon), 6) AS max_lon, round(avg(alat), 6) AS mid_lat, round(avg(alon), 6) AS mid_lon,
round(abs(sum(alon * blat - blon * alat)) / 2 * cos(radians(avg(alat))), 8) AS area, sha256(string_agg(round_even(alat / 1e-5::DOUBLE, 0)::BIGINT || ',' || round_even(alon / 1e-5::DOUBLE, 0)::BIGINT || ',13', ';' ORDER BY vertex)) AS hash FROM re GROUP BY 1"""


def m9_points_in_triangles(spark, sf):
    """Points in the triangle of a ring's first, third and fifth vertex (J8's hit test)."""
    r = ring_cells(rings(spark, sf))
    v = lambda i: (c("ring")[i]["lon"], c("ring")[i]["lat"])
    p = cells.own_cell(view(spark, sf, "v_points"), "lat", "lon", 0.1)
    return p.join(r, ["cy", "cx"]).filter(geo.in_triangle(c("lon"), c("lat"), v(0), v(2), v(4))).groupBy("region_id").agg(F.count(F.lit(1)).alias("n"), F.sum("point_id").alias("ids"))


_T = lambda a, b: f"((x{b} - x{a}) * (lat - y{a}) - (y{b} - y{a}) * (lon - x{a}))"
O_M9 = with_views("v_points", "v_ring_points") + f""" t AS (SELECT region_id, {', '.join(f'max(lat) FILTER (vertex = {i}) AS y{i}, max(lon) FILTER (vertex = {i}) AS x{i}' for i in (0, 2, 4))} FROM v_ring_points GROUP BY 1)
SELECT region_id, count(*) AS n, sum(point_id)::BIGINT AS ids FROM v_points, t WHERE NOT (least({_T(0, 2)}, {_T(2, 4)}, {_T(4, 0)}) < 0 AND greatest({_T(0, 2)}, {_T(2, 4)}, {_T(4, 0)}) > 0) GROUP BY 1"""


def m6_bearings(spark, sf):
    """Bearing of each chord and its angle to due north-east, either way round."""
    b = geo.bearing(*[c(x) for x in ("lat1", "lon1", "lat2", "lon2")])
    return way_chords(spark, sf).select("way_id", F.round(b, 4).alias("bearing"), F.round(geo.undirected_angle(b, F.lit(45.0)), 4).alias("off"), (geo.undirected_angle(b, F.lit(45.0)) <= 45).alias("accepted"))


O_M6 = with_views("v_way_nodes", "v_nodes") + CHORDS + """, d AS (SELECT way_id, degrees(atan2((lon2 - lon1) * cos(radians((lat1 + lat2) / 2)), lat2 - lat1)) AS raw FROM chords), b AS (SELECT way_id, CASE WHEN raw < 0 THEN raw + 360 ELSE raw END AS b FROM d),
o AS (SELECT *, fmod(abs(b - 45), 180) AS f FROM b) SELECT way_id, round(b, 4) AS bearing, round(least(f, 180 - f), 4) AS off, least(f, 180 - f) <= 45 AS accepted FROM o"""


def s19_pixel_heights(spark, sf):
    """Heights of red-green-blue pixels, and their integer form with voids."""
    p = view(spark, sf, "lineitem").select(c("l_orderkey").alias("k"), (c("l_partkey") % 200).alias("r"), (c("l_suppkey") * 7 % 256).alias("gr"), (c("l_linenumber") * 31 % 256).alias("b"))
    h = geo.terrarium(c("r"), c("gr"), c("b"))
    return p.groupBy("r").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(h), 3).alias("sum_m"), F.min(F.when(h < -12000, -32768).otherwise(F.least(F.round(h), F.lit(32767)))).cast("int").alias("lowest"))


O_S19 = """WITH p AS (SELECT l_partkey % 200 AS r, l_suppkey * 7 % 256 AS gr, l_linenumber * 31 % 256 AS b FROM lineitem), h AS (SELECT r, r * 256 + gr + b / 256.0::DOUBLE - 32768 AS h FROM p)
SELECT r, count(*) AS n, round(sum(h), 3) AS sum_m, min(CASE WHEN h < -12000 THEN -32768 ELSE least(round(h), 32767) END)::INT AS lowest FROM h GROUP BY 1"""

PAIRS = [
    (j15_points_in_rings, O_J15), (j15_ferry_regions, O_J15F), (j3_k3_ring_tiles, O_J3), (j7_a7_wetland_hazards, O_J7), (j17_j18_smallest_region, O_J17), (j19_pois_within_radius, O_J19), (j20_m24_corridor_band, O_J20), (m24_densified_legs, O_M24),
    (j21_m11_overnight_safety, O_J21), (j22_m7_barrier_crossings, O_J22), (j23_snap, O_J23), (j23_snap_slow_modes, None), (j16_polygon_overlap, None), (j6_edge_heights, O_J6), (j10_nearest_feature, O_J10), (j13_ferry_match, O_J13), (j14_wrong_admissions, O_J14), (j16_lattice_overlap, O_J16), (j31_f16_adjacent_boxes, O_J31),
    (j35_u7_cells_of_rings, O_J35), (a9_region_bounds, O_A9), (f18_hash_sample, O_F18), (m12_m14_grids, O_M12), (m10_m22_m27_rings, O_M10), (m9_points_in_triangles, O_M9), (m6_bearings, O_M6), (s19_pixel_heights, O_S19),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS if sql}
