"""Queries on annotation and iteration: J4, J8, J12, J36, J37, W17, F33, A8, A14, I2, I3, streams R1-R5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.functions import geo, limits, places, tags
from waymill.operators.components import connected_components
from waymill.operators.shared import materialize, table
from waymill.operators.skew import salted_lookup
from waymill.plans import annotate, routing
from waymill.plans import graph as plan
from waymill.queries import graph as g
from waymill.queries import lifecycle, records
from waymill.queries import tag_rules as t
from waymill.queries.views import pick, view, with_views
from waymill.streaming import feeds


def c(name):
    return F.col(name)


_LOCAL = """SELECT k, i, 59 + (k % 800) * 0.004e0 + floor(k / 800.0e0) * 0.00015e0 + i * 0.0002e0 + CASE WHEN i = 2 AND k % 7 = 0 THEN 0.00005e0 ELSE 0 END AS lat, 10 + (k % 900) * 0.004e0 + i * (k % 4) * 0.0001e0 AS lon
FROM (SELECT o_orderkey AS k FROM {orders}) o CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(i)"""
KINDS = ["primary", "service", "footway", "track", "cycleway"]
BASES = ["primary", "service-driveway", "footway-sidewalk", "path", "cycleway", "primary"]


def local_ways(spark: SparkSession, sf: str) -> DataFrame:
    """Short ways of four nodes, one an order."""
    p = spark.sql(_LOCAL, orders=table(spark, sf, "orders"))
    nodes = F.transform(F.array_sort(F.collect_list(F.struct("i", "lat", "lon"))), lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon")))
    w = p.groupBy(c("k").alias("way_id")).agg(nodes.alias("nodes"))
    return w.select("way_id", F.expr(pick("way_id", KINDS)).alias("highway"), F.expr(pick("way_id * 3", ["a", "", "b"])).alias("name"), (c("way_id") % 11 == 0).alias("is_bridge"), (c("way_id") % 13 == 0).alias("is_tunnel"), "nodes")


def local_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features beside those ways: shifted by up to nine metres, every other one reversed, some of another class or layer.

    Every third feature has a second entry, a little nearer or further and under another name.
    """
    w = local_ways(spark, sf)
    moved = lambda up: F.transform("nodes", lambda x: F.struct((x["lat"] + (c("way_id") % 5) * 0.00002 + up).alias("lat"), (x["lon"] - (c("way_id") % 3) * 0.00001).alias("lon")))
    entries = F.array(F.struct(F.lit(0).alias("entry"), moved(0.0).alias("points")), F.struct(F.lit(1).alias("entry"), moved(-0.00001).alias("points")))
    each = w.select("way_id", "is_tunnel", F.explode(F.slice(entries, 1, F.when(c("way_id") % 3 == 0, 2).otherwise(1))).alias("e")).select("way_id", "e.*")
    return each.select(
        (c("way_id") + 1_000_000).alias("feature_id"), F.expr(pick("way_id", KINDS[:3] + ["path", "cycleway"] + BASES)).alias("base"), F.expr(pick("way_id + entry", ["a", "b", ""])).alias("name"), (c("way_id") % 22 == 0).alias("is_bridge"), (c("way_id") % 13 == 0).alias("is_tunnel"),
        F.when(c("way_id") % 2 == 1, F.reverse("points")).otherwise(c("points")).alias("points"),
    )


LIMITS = {"maxheight": "max_height_cm", "maxwidth": "max_width_cm", "maxlength": "max_length_cm", "maxweight": "max_weight_10kg", "maxaxleload": "max_axleload_10kg", "maxbogieweight": "max_bogie_10kg"}


def way_limits(spark: SparkSession, sf: str) -> DataFrame:
    """The limits of each way that has any, as the tags state them: a row a tag is taken apart, then a row a way is put together."""
    w = view(spark, sf, "v_ways")
    tagged = w.select("way_id", F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("tag"), c(k).alias("raw")) for k in LIMITS]), lambda x: x["raw"].isNotNull())).alias("t")).select("way_id", "t.*")
    value = F.when(c("tag").isin("maxheight", "maxwidth", "maxlength"), c("length_m")).otherwise(c("weight_t"))
    values = limits.parsed(tagged, "raw").select("way_id", "tag", (c("class") == "numeric").alias("numeric"), limits.hundredths(value).alias("v"))
    own = values.groupBy("way_id").agg(F.max("numeric").alias("numeric"), *[F.coalesce(F.max(F.when(c("tag") == k, c("v"))), F.lit(0)).alias(name) for k, name in LIMITS.items()])
    # The filter stands above the aggregate: below it, it would be moved to the values and take each apart again and again.
    return materialize(own.filter("numeric").drop("numeric"), "limits")  # written: its long expressions stay out of the matching plan


def j12_w5_w7_limit_matching(spark, sf):
    """Limits of ways matched to feature segments by distance, class, layer, overlap and bearing."""
    own = way_limits(spark, sf)
    return annotate.matched(materialize(annotate.candidates(local_ways(spark, sf).join(own, "way_id", "left_semi"), local_features(spark, sf)), "candidates"), own)


def a14_match_report(spark, sf):
    """Entries by the guard that rejects them, ways matched and not, rows kept: over the ways with a numeric limit."""
    w = local_ways(spark, sf).join(way_limits(spark, sf), "way_id", "left_semi")
    found = materialize(annotate.candidates(w, local_features(spark, sf)), "candidates")
    return annotate.match_report(w, found, annotate.matched(found))


def m4_m5_projections(spark, sf):
    """Every entry within reach: arc position and distance of both segment ends on the way, and the overlap."""
    found = annotate.candidates(local_ways(spark, sf), local_features(spark, sf), keep_all=True)
    return found.groupBy("way_id", "feature_id", "segment").agg(*[F.round(F.sum(x), 3).alias(x) for x in ("along_a", "along_b", "d_a", "d_b", "ratio")])


def _dist(y1, x1, y2, x2):
    return f"sqrt(pow(({x2} - {x1}) * cos(radians(({y1} + {y2}) / 2)) * 111320, 2) + pow(({y2} - {y1}) * 111320, 2))"


def _head(y1, x1, y2, x2):
    return f"((degrees(atan2(({x2} - {x1}) * cos(radians(({y1} + {y2}) / 2)) * 111320, ({y2} - {y1}) * 111320))) + 360) % 360"


def _turn(a, b):
    return f"least(fmod(abs({a} - {b}), 180), 180 - fmod(abs({a} - {b}), 180))"


_ALIAS = " OR ".join(f"(highway = '{k}' AND base IN ({', '.join(repr(x) for x in v)}))" for k, v in annotate.ALIASES.items())


def sql_candidates(ways: str = "") -> str:
    """Oracle: p (way points), w, f (feature entries) and cand (way, entry, segment with measures and the first guard that rejects it)."""
    return f"""p AS ({_LOCAL.format(orders='orders')}), w AS (SELECT DISTINCT k AS way_id, {pick('k', KINDS)} AS highway, {pick('k * 3', ['a', '', 'b'])} AS name, k % 11 = 0 AS is_bridge, k % 13 = 0 AS is_tunnel FROM p {ways}),
fp AS (SELECT k, entry, CASE WHEN k % 2 = 1 THEN 3 - i ELSE i END AS i, lat + (k % 5) * 0.00002::DOUBLE + CASE WHEN entry = 1 THEN -0.00001::DOUBLE ELSE 0 END AS lat, lon - (k % 3) * 0.00001::DOUBLE AS lon FROM p, (VALUES (0), (1)) AS e(entry) WHERE entry = 0 OR k % 3 = 0),
f AS (SELECT DISTINCT k, entry, k + 1000000 AS feature_id, {pick('k', KINDS[:3] + ['path', 'cycleway'] + BASES)} AS base, {pick('k + entry', ['a', 'b', ''])} AS f_name, k % 22 = 0 AS f_bridge, k % 13 = 0 AS f_tunnel FROM fp),
wc AS (SELECT DISTINCT k, floor(lat / {annotate.CELL!r}::DOUBLE)::BIGINT AS cy, floor(lon / {annotate.CELL!r}::DOUBLE)::BIGINT AS cx FROM p WHERE k IN (SELECT way_id FROM w)), fc AS (SELECT DISTINCT k, floor(lat / {annotate.CELL!r}::DOUBLE)::BIGINT AS cy, floor(lon / {annotate.CELL!r}::DOUBLE)::BIGINT AS cx FROM fp),
near AS (SELECT DISTINCT wc.k AS way_id, fc.k AS fk FROM wc JOIN (SELECT unnest(range(-2, 3)) AS dy) ON true JOIN (SELECT unnest(range(-2, 3)) AS dx) ON true JOIN fc ON fc.cy = wc.cy + dy AND fc.cx = wc.cx + dx),
wl AS (SELECT k AS way_id, i, lat AS y1, lon AS x1, lead(lat) OVER o AS y2, lead(lon) OVER o AS x2 FROM p WINDOW o AS (PARTITION BY k ORDER BY i)), wm AS (SELECT *, {_dist('y1', 'x1', 'y2', 'x2')} AS m FROM wl WHERE y2 IS NOT NULL),
wa AS (SELECT *, sum(m) OVER (PARTITION BY way_id ORDER BY i) - m AS before FROM wm), wt AS (SELECT way_id, sum(m) AS way_m FROM wm GROUP BY 1), we AS (SELECT k AS way_id, arg_min(lat, i) AS wy1, arg_min(lon, i) AS wx1, arg_max(lat, i) AS wy2, arg_max(lon, i) AS wx2 FROM p GROUP BY 1),
fl AS (SELECT k, entry, i AS segment, lat AS ay, lon AS ax, lead(lat) OVER o AS bmy, lead(lon) OVER o AS bmx FROM fp WINDOW o AS (PARTITION BY k, entry ORDER BY i)), fs AS (SELECT * FROM fl WHERE bmy IS NOT NULL),
spots AS (SELECT k, entry, segment, unnest(['a', 'b', 'm']) AS what, unnest([ay, bmy, (ay + bmy) / 2]) AS py, unnest([ax, bmx, (ax + bmx) / 2]) AS px FROM fs),
plane AS (SELECT near.way_id, s.k, s.entry, s.segment, what, i, m, before, {_head('y1', 'x1', 'y2', 'x2')} AS leg_head, (px - x1) * sx AS apx, (py - y1) * 111320 AS apy, (x2 - x1) * sx AS abx, (y2 - y1) * 111320 AS aby FROM near JOIN spots s ON s.k = near.fk JOIN (SELECT * FROM wa) l ON l.way_id = near.way_id, LATERAL (SELECT cos(radians((py + y1 + y2) / 3)) * 111320 AS sx)),
foot AS (SELECT *, CASE WHEN abx * abx + aby * aby > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, (apx * abx + apy * aby) / (abx * abx + aby * aby))) ELSE 0 END AS tt FROM plane),
hit AS (SELECT way_id, k, entry, segment, what, arg_min({{'d': d, 'along': before + tt * m, 'head': leg_head}}, (d, i)) AS h FROM (SELECT *, sqrt(pow(apx - tt * abx, 2) + pow(apy - tt * aby, 2)) AS d FROM foot) GROUP BY ALL),
wide AS (SELECT way_id, k, entry, segment, any_value(h) FILTER (what = 'a') AS ha, any_value(h) FILTER (what = 'b') AS hb, any_value(h) FILTER (what = 'm') AS hm FROM hit GROUP BY ALL),
meas AS (SELECT wide.*, w.*, f.feature_id, base, f_name, f_bridge, f_tunnel, way_m, {_dist('ay', 'ax', 'bmy', 'bmx')} AS seg_m, {_head('ay', 'ax', 'bmy', 'bmx')} AS own, {_dist('wy1', 'wx1', 'wy2', 'wx2')} AS chord_m, {_head('wy1', 'wx1', 'wy2', 'wx2')} AS chord
  FROM wide JOIN w USING (way_id) JOIN f ON f.k = wide.k AND f.entry = wide.entry JOIN fs ON fs.k = wide.k AND fs.entry = wide.entry AND fs.segment = wide.segment JOIN wt USING (way_id) JOIN we USING (way_id)),
rated AS (SELECT *, abs(ha.along - hb.along) / greatest(least(seg_m, way_m), 0.5) AS ratio, coalesce(name <> '' AND f_name <> '' AND name <> f_name, false)::INT AS mismatch, (ha.d + hb.d) / 2 AS mean_m FROM meas),
cand AS (SELECT *, CASE WHEN NOT (highway = base OR {_ALIAS} OR starts_with(base, highway || '-') OR starts_with(highway, base || '-')) THEN 'class_incompatible' WHEN is_bridge AND NOT f_bridge THEN 'bridge_layer' WHEN is_tunnel AND NOT f_tunnel THEN 'tunnel_layer'
  WHEN NOT is_bridge AND NOT is_tunnel AND f_bridge THEN 'nonbridge_to_bridge' WHEN NOT is_bridge AND NOT is_tunnel AND f_tunnel THEN 'nontunnel_to_tunnel' WHEN ha.d > 8 OR hb.d > 8 THEN 'too_far'
  WHEN seg_m >= 0.5 AND ratio < CASE WHEN way_m <= 40 THEN 0.5 ELSE 0.7 END THEN 'overlap' WHEN NOT ((is_bridge AND f_bridge) OR (is_tunnel AND f_tunnel)) AND seg_m >= 2 AND NOT ({_turn('own', 'hm.head')} <= 45 OR (chord_m >= 0.5 AND {_turn('own', 'chord')} <= 45)) THEN 'bearing' END AS reject FROM rated)"""


_KEPT = """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY way_id, feature_id, segment ORDER BY mismatch, mean_m, seg_m) AS r FROM cand WHERE reject IS NULL) WHERE r = 1),
score AS (SELECT way_id, feature_id, count(*) FILTER (seg_m >= 0.5) AS n_long, count(*) AS n, round(sum(seg_m), 6) AS m FROM best GROUP BY 1, 2), prim AS (SELECT way_id, arg_max(feature_id, (n_long, n, m, -feature_id)) AS prim FROM score GROUP BY 1),
kept AS (SELECT feature_id, segment, max(way_id) AS way_id, count(*) AS claims, arg_max(round(mean_m, 4), way_id) AS mean_m, arg_max(mismatch, way_id) AS mismatch FROM best JOIN prim USING (way_id) WHERE feature_id = prim OR seg_m >= 2 GROUP BY 1, 2)"""
O_J12 = f"WITH x7 AS ({t.O_X7}), {sql_candidates('WHERE k IN (SELECT way_id FROM x7 WHERE way_class = ' + repr('numeric') + ')')}, {_KEPT} SELECT feature_id, segment::INT AS segment, way_id, claims, mean_m, mismatch, max_height_cm, max_width_cm, max_length_cm, max_weight_10kg, max_axleload_10kg, max_bogie_10kg FROM kept JOIN x7 USING (way_id)"
O_A14 = f"""WITH x7 AS ({t.O_X7}), {sql_candidates('WHERE k IN (SELECT way_id FROM x7 WHERE way_class = ' + repr('numeric') + ')')}, {_KEPT} SELECT coalesce(reject, 'accepted') AS item, count(*) AS n FROM cand GROUP BY 1
UNION ALL SELECT CASE WHEN way_id IN (SELECT way_id FROM cand WHERE reject IS NULL) THEN 'ways_matched' ELSE 'ways_unmatched' END, count(*) FROM w GROUP BY 1 UNION ALL SELECT 'rows', count(*) FROM kept"""
O_M4 = f"""WITH {sql_candidates()} SELECT way_id, feature_id, segment::INT AS segment, round(sum(ha.along), 3) AS along_a, round(sum(hb.along), 3) AS along_b, round(sum(ha.d), 3) AS d_a, round(sum(hb.d), 3) AS d_b, round(sum(ratio), 3) AS ratio FROM cand GROUP BY 1, 2, 3"""


def triangles(spark, sf) -> DataFrame:
    """A soft or hard triangle beside every third order's way."""
    k = "59 + (k % 800) * 0.004e0 + floor(k / 800.0e0) * 0.00015e0"
    return spark.sql(
        f"SELECT CAST(1 + k % 2 AS INT) AS class, {k} - 0.0001e0 AS y0, 10 + (k % 900) * 0.004e0 - 0.0001e0 AS x0, {k} + 0.0005e0 AS y1, 10 + (k % 900) * 0.004e0 + 0.0001e0 AS x1, {k} + 0.0001e0 AS y2, 10 + (k % 900) * 0.004e0 + 0.0003e0 AS x2 FROM (SELECT o_orderkey * 3 AS k FROM {{orders}}) o",
        orders=table(spark, sf, "orders"),
    )


def j8_a8_wet_segments(spark, sf):
    """Segments of the local ways by worst wetland class, boardwalks carved out, with lengths."""
    legs = local_ways(spark, sf).select("way_id", F.posexplode(annotate.legs(c("nodes"))).alias("segment", "l"))
    s = legs.select("way_id", "segment", c("l.a.lat").alias("lat1"), c("l.a.lon").alias("lon1"), c("l.b.lat").alias("lat2"), c("l.b.lon").alias("lon2"))
    wet = annotate.wet_segments(s, triangles(spark, sf))
    length = legs.select("way_id", "segment", annotate.step_m(c("l.a"), c("l.b")).alias("m"))
    planks = view(spark, sf, "v_ways").select("way_id", tags.boardwalk(c("bridge"), c("surface")).alias("planks"))
    kind = F.when(c("class").isNull(), "dry").when(c("planks"), "boardwalk").when(c("class") == 1, "soft").otherwise("hard")
    every = length.join(planks, "way_id").join(wet, ["way_id", "segment"], "left").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"))
    total = F.sum("m").over(Window.partitionBy())  # four rows
    return every.select("kind", "n", F.round("m", 2).alias("metres"), F.when(total > 0, F.round(c("m") / total, 6)).otherwise(0.0).alias("share"))


_P = _LOCAL.format(orders="orders")
_TRI = "SELECT 1 + k % 2 AS class, ({k}) - 0.0001::DOUBLE AS y0, 10 + (k % 900) * 0.004::DOUBLE - 0.0001::DOUBLE AS x0, ({k}) + 0.0005::DOUBLE AS y1, 10 + (k % 900) * 0.004::DOUBLE + 0.0001::DOUBLE AS x1, ({k}) + 0.0001::DOUBLE AS y2, 10 + (k % 900) * 0.004::DOUBLE + 0.0003::DOUBLE AS x2 FROM (SELECT o_orderkey * 3 AS k FROM orders) o".format(k="59 + (k % 800) * 0.004::DOUBLE + floor(k / 800.0::DOUBLE) * 0.00015::DOUBLE")


def _cr(a, b, p):
    return f"(({b[0]} - {a[0]}) * ({p[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({p[0]} - {a[0]}))"


def _in(p):
    v = [("x0", "y0"), ("x1", "y1"), ("x2", "y2")]
    d = [_cr(v[i], v[(i + 1) % 3], p) for i in range(3)]
    return f"NOT (least({', '.join(d)}) < 0 AND greatest({', '.join(d)}) > 0)"


def _cross(i):
    p, q, a, b = ("lon1", "lat1"), ("lon2", "lat2"), (f"x{i}", f"y{i}"), (f"x{(i + 1) % 3}", f"y{(i + 1) % 3}")
    return f"({_cr(a, b, p)} * {_cr(a, b, q)} < 0 AND {_cr(p, q, a)} * {_cr(p, q, b)} < 0)"


O_J8 = with_views("v_ways") + f""" p AS ({_P}), s AS (SELECT k, i, lat AS lat1, lon AS lon1, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM p WINDOW w AS (PARTITION BY k ORDER BY i)), l AS (SELECT *, sqrt(pow((lon2 - lon1) * cos(radians((lat1 + lat2) / 2)) * 111320, 2) + pow((lat2 - lat1) * 111320, 2)) AS m FROM s WHERE lat2 IS NOT NULL),
t AS ({_TRI}), h AS (SELECT k, i, max(class) AS class FROM l JOIN t ON x0 < greatest(lon1, lon2) + 0.001 AND x2 > least(lon1, lon2) - 0.001 AND abs(y0 - lat1) < 0.01 WHERE {_in(('lon1', 'lat1'))} OR {_in(('lon2', 'lat2'))} OR {_in(('((lon1 + lon2) / 2)', '((lat1 + lat2) / 2)'))} OR {_cross(0)} OR {_cross(1)} OR {_cross(2)} GROUP BY 1, 2),
q AS (SELECT CASE WHEN class IS NULL THEN 'dry' WHEN coalesce(lower(bridge) = 'boardwalk', false) OR coalesce(surface = 'wood', false) THEN 'boardwalk' WHEN class = 1 THEN 'soft' ELSE 'hard' END AS kind, m FROM l JOIN v_ways ON way_id = k LEFT JOIN h USING (k, i))
SELECT kind, count(*) AS n, round(sum(m), 2) AS metres, round(sum(m) / sum(sum(m)) OVER (), 6) AS share FROM q GROUP BY 1"""


def shrunk(nodes: DataFrame, by: float) -> DataFrame:
    """The map drawn smaller, so that limits in metres are met on its wide legs."""
    return nodes.withColumns({"lat": 59 + (c("lat") - 59) / by, "lon": 10 + (c("lon") - 10) / by})


MAX_STOPS, MAX_INHERIT_M = 6, 150_000.0
_FERRY_REL = f"""SELECT o_custkey AS relation_id, o_orderkey AS way_id, {pick('o_custkey * 3', ['ferry', 'ferry', None, 'ferry'])} AS route, {pick('o_custkey * 5', ['yes', None, 'no', 'designated', None])} AS motorcar, {pick('o_custkey * 7', [None, 'no', None])} AS access, {pick('o_custkey * 11', [None, 'primary', None, 'Trunk', 'no'])} AS ferry,
{pick('o_orderkey * 7', ['stop', None, 'platform', '', 'Harbour', 'outer', 'forward_stop', 'halt'])} AS node_role FROM {{orders}}"""


def j4_ferry_inheritance(spark, sf):
    """Ways that inherit car access from a relation (customer) that the whole ferry rule admits for cars: at most six stops, 150 km in all and 150 km a way; a way without coordinates counts as 0 m."""
    _, refs, nodes = g.parts(spark, sf)
    none = F.lit(None).cast("string")
    admits = tags.ferry_admits("car", c("motorcar"), none, none, c("access"), c("ferry"), none, none, F.lit(False))
    rel = spark.sql(_FERRY_REL, orders=table(spark, sf, "orders")).filter(tags.is_ferry(c("route"), none, c("ferry")) & admits)
    role = tags.clean(c("node_role"))
    stop = F.coalesce(role.contains("stop") | role.isin("platform", "terminal", "harbour", "harbor", "port", "halt"), F.lit(False))
    at = plan.resolved(refs.join(rel.select("way_id").distinct(), "way_id", "left_semi"), shrunk(nodes, 4.0)).filter(c("way_id") % 9 != 4)
    order = Window.partitionBy("way_id").orderBy("pos")
    length = at.withColumn("d", geo.haversine(c("lat"), c("lon"), F.lead("lat").over(order), F.lead("lon").over(order), geo.TOOL_RADIUS)).groupBy("way_id").agg(F.coalesce(F.sum("d"), F.lit(0.0)).alias("m"))
    members = rel.select("relation_id", "way_id", stop.alias("stop")).join(length, "way_id", "left").withColumn("own_m", F.coalesce("m", F.lit(0.0)))
    good = members.groupBy("relation_id").agg(F.count_if("stop").alias("stops"), F.sum("own_m").alias("total")).filter((c("stops") <= MAX_STOPS) & (c("total") <= MAX_INHERIT_M))
    return members.filter(c("own_m") <= MAX_INHERIT_M).join(good, "relation_id", "left_semi").select("way_id", F.round("own_m", 2).alias("m")).distinct()


O_J4 = with_views("v_way_nodes", "v_nodes") + f""" s AS (SELECT way_id, {g.hav('lat', 'lon', 'nlat', 'nlon', '6371000.0::DOUBLE')} AS d FROM (SELECT way_id, lat, lon, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon FROM (SELECT way_id, pos, 59 + (lat - 59) / 4.0::DOUBLE AS lat, 10 + (lon - 10) / 4.0::DOUBLE AS lon FROM v_way_nodes JOIN v_nodes USING (node_id) WHERE way_id % 9 <> 4) WINDOW w AS (PARTITION BY way_id ORDER BY pos))),
l AS (SELECT way_id, coalesce(sum(d), 0) AS m FROM s GROUP BY 1), b AS (SELECT relation_id, r.way_id, coalesce(m, 0) AS m, node_role FROM ({_FERRY_REL.format(orders='orders')}) r LEFT JOIN l ON l.way_id = r.way_id WHERE (coalesce(route = 'ferry', false) OR (ferry IS NOT NULL AND ferry <> 'no'))
  AND CASE WHEN motorcar IS NOT NULL THEN motorcar IN ('yes', 'designated') WHEN coalesce(access = 'no', false) THEN false ELSE coalesce(lower(ferry) IN ('primary', 'trunk'), false) END),
k AS (SELECT relation_id FROM b GROUP BY 1 HAVING count(*) FILTER (node_role IN ('stop', 'platform', 'Harbour', 'forward_stop', 'halt')) <= 6 AND sum(m) <= 150000)
SELECT DISTINCT way_id, round(m, 2) AS m FROM b WHERE m <= 150000 AND relation_id IN (SELECT relation_id FROM k)"""


def j36_j38_poi_and_buildings(spark, sf):
    """POIs from nodes, buildings from nodes in a box and from ways with a node in it (mean of all refs)."""
    ways, refs, nodes = g.parts(spark, sf)
    inside = c("lat").between(59.3, 60.2) & c("lon").between(10.4, 11.6)
    cats = places.poi_categories({k: c(k) for k in ("amenity", "tourism", "natural", "operator", "network", "shop", "leisure", "highway", "hgv")})
    poi = nodes.filter(F.size(cats) > 0).select(F.lit("poi").alias("kind"), "lat", "lon")
    house = nodes.filter(c("building").isNotNull() & inside).select(F.lit("house").alias("kind"), "lat", "lon")
    at = plan.resolved(refs.join(ways.filter("building is not null").select("way_id"), "way_id", "left_semi"), nodes)
    block = at.groupBy("way_id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.bool_or(inside).alias("in")).filter("in").select(F.lit("block").alias("kind"), "lat", "lon")
    return poi.unionByName(house).unionByName(block).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("lat"), 3).alias("lat"), F.round(F.sum("lon"), 3).alias("lon"))


_CATS = "(" + " OR ".join(f"coalesce({v}, false)" for v in records.CATEGORY_SQL.values()) + ")"
_IN = "(lat BETWEEN 59.3 AND 60.2 AND lon BETWEEN 10.4 AND 11.6)"
O_J36 = with_views("v_ways", "v_nodes", "v_way_nodes") + f""" a AS (SELECT 'poi' AS kind, lat, lon FROM v_nodes WHERE {_CATS} UNION ALL SELECT 'house', lat, lon FROM v_nodes WHERE building IS NOT NULL AND {_IN}
UNION ALL SELECT 'block', la, lo FROM (SELECT way_id, avg(lat) AS la, avg(lon) AS lo, bool_or({_IN}) AS i FROM v_way_nodes JOIN v_nodes USING (node_id) WHERE way_id IN (SELECT way_id FROM v_ways WHERE building IS NOT NULL) GROUP BY 1) WHERE i)
SELECT kind, count(*) AS n, round(sum(lat), 3) AS lat, round(sum(lon), 3) AS lon FROM a GROUP BY 1"""


_RELATIONS = f"""SELECT o_custkey AS relation_id, o_orderkey AS way_id, {pick('o_orderkey * 3', ['outer', 'inner', 'Outer', None, ''])} AS role, {pick('o_custkey', [None, 'wetland', None, 'water'])} AS "natural", {pick('o_custkey * 7', ['bog', None, 'swamp', None])} AS wetland FROM {{orders}}"""


def j37_w17_ring_assembly(spark, sf):
    """Wetland rings as closed sides: classified ways of three or more refs, and outer members of classified relations; one missing node drops a ring whole."""
    ways, refs, nodes = g.parts(spark, sf)
    kind = tags.wetland_class(c("natural"), c("wetland"))
    own = ways.filter(kind.isNotNull()).select("way_id", kind.alias("class"))
    relations = spark.sql(_RELATIONS.replace('"', "`"), orders=table(spark, sf, "orders"))
    outer = relations.filter((F.lower("role") == "outer") & kind.isNotNull()).select("way_id", kind.alias("class"))
    wet = own.unionByName(outer).distinct()
    present = nodes.filter("node_id % 23 <> 0").select("node_id", "lat", "lon")
    at = refs.join(wet, "way_id").join(present, "node_id", "left")
    order = Window.partitionBy("way_id", "class").orderBy("pos")
    whole = Window.partitionBy("way_id", "class")
    at = at.withColumns({"n": F.count(F.lit(1)).over(whole), "have": F.count("lat").over(whole), "first": F.first(F.struct("node_id", "lat", "lon")).over(order)}).filter("n >= 3 and n = have")
    sides = at.withColumn("to", F.coalesce(F.lead(F.struct("node_id", "lat", "lon")).over(order), c("first"))).filter(c("to.node_id") != c("node_id"))
    length = F.sum(geo.haversine(c("lat"), c("lon"), c("to.lat"), c("to.lon"), geo.TOOL_RADIUS))
    return sides.groupBy("way_id", "class").agg(F.count(F.lit(1)).alias("sides"), F.round(length, 2).alias("metres"))


O_J37 = with_views("v_ways", "v_way_nodes", "v_nodes") + f""" m AS ({_RELATIONS.format(orders='orders')}), a AS (SELECT way_id, "natural", wetland FROM v_ways UNION SELECT way_id, "natural", wetland FROM m WHERE lower(role) = 'outer'),
k AS (SELECT DISTINCT way_id, CASE WHEN lower(wetland) IN ('bog', 'fen') THEN 1 WHEN wetland IN ('swamp', 'reedbed') THEN 2 WHEN lower("natural") = 'wetland' THEN 1 END::INT AS class FROM a),
r AS (SELECT way_id, class, pos, node_id, lat, lon, count(*) OVER (PARTITION BY way_id, class) AS n, count(*) FILTER (node_id % 23 <> 0) OVER (PARTITION BY way_id, class) AS h FROM v_way_nodes JOIN k USING (way_id) JOIN v_nodes USING (node_id) WHERE class IS NOT NULL),
s AS (SELECT way_id, class, node_id, lat, lon, coalesce(lead(node_id) OVER w, first_value(node_id) OVER w) AS b, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS blat, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS blon FROM r WHERE n >= 3 AND n = h WINDOW w AS (PARTITION BY way_id, class ORDER BY pos))
SELECT way_id, class, count(*) AS sides, round(sum({g.hav('lat', 'lon', 'blat', 'blon', '6371000.0::DOUBLE')}), 2) AS metres FROM s WHERE b <> node_id GROUP BY 1, 2"""


def f33_key_extract(spark, sf):
    """Objects that carry a key, with the nodes they refer to."""
    ways, refs, nodes = g.parts(spark, sf)
    keyed = ways.filter("route = 'ferry'").select("way_id")
    touched = refs.join(keyed, "way_id", "left_semi").select("node_id").distinct()
    own = nodes.filter("tourism is not null").select("node_id")
    return touched.unionByName(own).distinct().agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("node_id").alias("ids")).join(keyed.agg(F.count(F.lit(1)).alias("n_ways")))


O_F33 = with_views("v_ways", "v_way_nodes", "v_nodes") + " u AS (SELECT node_id FROM v_way_nodes WHERE way_id IN (SELECT way_id FROM v_ways WHERE route = 'ferry') UNION SELECT node_id FROM v_nodes WHERE tourism IS NOT NULL) SELECT count(*) AS n_nodes, sum(node_id)::BIGINT AS ids, (SELECT count(*) FROM v_ways WHERE route = 'ferry') AS n_ways FROM u"


def route_pairs(spark, sf, e: DataFrame) -> DataFrame:
    """query, start, goal, apart of the pairs of ``v_route_pairs`` on a graph, written out.

    Customers a and b stand at the least node of their share of the node hashes. The goal of every
    fourth pair is b's node, mostly in another component (``apart``); that of the others is the node
    of a's component that b falls on, as most components are small.
    """
    comps = materialize(connected_components(e), "components")
    pairs = view(spark, sf, "v_route_pairs")
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = materialize(salted_lookup(comps, sizes, "component", "size", comps.count(), c("node")), "sized")
    h = F.xxhash64("node")
    slots = sized.groupBy("component", F.pmod(h, c("size")).alias("slot")).agg(F.min("node").alias("near"))
    at = sized.groupBy(F.pmod(h, F.lit(max(1, pairs.count()))).alias("k")).agg(F.min(F.struct("node", "component", "size")).alias("m"))
    start = at.select(c("k").alias("a"), c("m.node").alias("start"), c("m.component").alias("component"), c("m.size").alias("size"))
    goal = at.select(c("k").alias("b"), c("m.node").alias("far"), c("m.component").alias("far_component"))
    met = pairs.join(start, "a", "left").join(goal, "b", "left").withColumn("slot", F.pmod(c("b"), c("size"))).join(slots, ["component", "slot"], "left")
    away = c("query") % 4 == 0
    # a component is named by its least node: the goal where no node falls on the slot
    placed = met.select("query", "start", F.when(away, c("far")).otherwise(F.coalesce("near", "component")).alias("goal"), F.coalesce(away & (c("far_component") != c("component")), F.lit(False)).alias("apart"))
    return materialize(placed, "route-pairs")


def blocked_nodes(spark, sf) -> DataFrame:
    return view(spark, sf, "v_nodes").filter(tags.barrier_blocks(c("barrier"), "car", *[c(x) for x in plan.ACCESS])).select("node_id")


def i2_batch_paths(spark, sf):
    """Cheapest paths of one pair a customer, over all graph nodes; blocked barriers are not passed.

    Pairs in two components have no path and are answered without a search.
    """
    e = materialize(g.edges(spark, sf).select("edge_id", "src", "dst", "weight", "surface_rank"), "edges")
    placed = route_pairs(spark, sf, e)
    found = routing.shortest_paths(e, placed.filter(~c("apart")), blocked_nodes(spark, sf))
    return found.unionByName(placed.filter("apart").select("query", "start", "goal"), allowMissingColumns=True)


def option_edges(spark, sf) -> DataFrame:
    """Edges of the car graph with the options that admit them and an eco weight, the energy in kJ of every edge but one in seven, written out."""
    allowed = t.allowed_for_options(t.edge_attributes(t.ways(spark, sf)), t.option_rows(), "car", F.to_timestamp(F.lit("2024-06-12 08:30:00")))
    by_way = allowed.groupBy("way_id").agg(F.collect_set("option_id").alias("options"))
    eco = F.when(F.pmod(F.xxhash64("edge_id"), F.lit(7)) > 0, geo.flat_energy(c("length_m")) / 1000)
    e = g.edges(spark, sf).join(by_way, "way_id").select("edge_id", "src", "dst", "weight", "surface_rank", "options", eco.alias("eco_weight"))
    return materialize(e, "edges")


def i2_option_paths(spark, sf):
    """Cheapest paths under the route options of each pair, every other pair by eco weight."""
    e = option_edges(spark, sf)
    placed = route_pairs(spark, sf, e).withColumns({"option_id": (c("query") % len(t.OPTION_ROWS)).cast("int"), "use_eco": c("query") % 2 == 1})
    found = routing.shortest_paths(e, placed.filter(~c("apart")).drop("apart"), blocked_nodes(spark, sf))
    return found.unionByName(placed.filter("apart").select("query", "start", "goal", "option_id", "use_eco"), allowMissingColumns=True)


def i3_boarding(spark, sf):
    """Boarding ways promoted from ferry ends by chains of at most 500 m, on the map drawn 300 times smaller."""
    ways, refs, nodes = g.parts(spark, sf)
    nodes = shrunk(nodes, 300.0)
    ferry = tags.is_ferry(c("route"), c("highway"), c("ferry"))
    order = Window.partitionBy("way_id").orderBy("pos")
    at = plan.resolved(refs, nodes)
    step = at.withColumns({"b": F.lead("node_id").over(order), "length_m": geo.haversine(c("lat"), c("lon"), F.lead("lat").over(order), F.lead("lon").over(order), geo.TOOL_RADIUS)}).filter("b is not null and b <> node_id").select("way_id", c("node_id").alias("a"), "b", "length_m")
    road = ways.filter(~ferry & tags.road_admits(c("highway"), "car")).select("way_id")
    board = ways.filter(tags.boarding_candidate(ferry, c("man_made"), c("highway")) & ~tags.road_admits(c("highway"), "car")).select("way_id")
    car = tags.ferry_admits("car", *[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "access", "ferry", "foot", "bicycle")], F.lit(False))
    ends = refs.join(ways.filter(ferry & car).select("way_id"), "way_id").groupBy("way_id").agg(F.min_by("node_id", "pos").alias("p"), F.max_by("node_id", "pos").alias("q")).select(F.explode(F.array("p", "q")).alias("node"))
    uses = plan.junctions(refs.join(road, "way_id", "left_semi")).select("node_id", (c("uses") > 1).alias("j"))
    roads = step.join(road, "way_id", "left_semi").join(uses.select(c("node_id").alias("a"), c("j").alias("junction_a")), "a").join(uses.select(c("node_id").alias("b"), c("j").alias("junction_b")), "b")
    return routing.boarding_ways(step.join(board, "way_id", "left_semi"), ends, roads, 500.0)


def r4_stream_changed_content(spark, sf):
    """The log as a stream: the first of equal (provider, content) rows within a day's watermark."""
    schema = table(spark, sf, "events").schema
    s = feeds.read_stream(spark, sf, "events", schema).select(c("ts").cast("timestamp").alias("ts"), "user_id", "props")
    return feeds.run(feeds.changed_only(s, ["user_id", "props"], "ts", "60 days")).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


O_R4S = "SELECT user_id, count(DISTINCT props) AS n FROM events GROUP BY 1"


def r5_stream_failure_runs(spark, sf):
    """Failure runs by provider, kept from batch to batch."""
    schema = table(spark, sf, "events").schema
    s = feeds.read_stream(spark, sf, "events", schema).select("event_id", c("ts").cast("timestamp").alias("ts"), c("user_id").alias("provider"), F.when(c("event_type") == "error", "fail").otherwise("ok").alias("status"))
    return feeds.failure_runs(s).select("provider", "fails", "hold_s")


O_R5S = lifecycle.O_R5.replace("SELECT provider, last_status, fails, CASE", "SELECT provider, fails, CASE").replace("::INT ELSE 0 END AS hold_s", "::BIGINT ELSE 0 END AS hold_s")


def r1_stream_changelog(spark, sf):
    """Numbered changes as a stream onto the orders table, batch by batch."""
    n = table(spark, sf, "orders").count() + 50
    schema = table(spark, sf, "events").schema
    s = feeds.read_stream(spark, sf, "events", schema)
    kind = F.when(c("event_type") == "signup", "create").when(c("event_type") == "error", "delete").otherwise("modify")
    changes = s.select(c("event_id").alias("seq"), ((c("event_id") * 7919) % F.lit(n)).alias("id"), kind.alias("action"), c("value").alias("payload"))
    return feeds.apply_change_stream(changes, lifecycle.base_rows(spark, sf))


def r2_stream_windows(spark, sf):
    """Rows by closed day and type, late ones out: days of which the watermark has passed the end."""
    schema = table(spark, sf, "events").schema
    s = feeds.read_stream(spark, sf, "events", schema).select(c("ts").cast("timestamp").alias("ts"), "event_type")
    return feeds.run(feeds.counts_by_window(s, "ts", "1 day", "2 days", "event_type")).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


O_R2S = "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1, 2"

PAIRS = [
    (j12_w5_w7_limit_matching, O_J12), (a14_match_report, O_A14), (m4_m5_projections, O_M4), (j8_a8_wet_segments, O_J8), (j4_ferry_inheritance, O_J4), (j36_j38_poi_and_buildings, O_J36), (j37_w17_ring_assembly, O_J37), (f33_key_extract, O_F33), (i2_batch_paths, None), (i2_option_paths, None), (i3_boarding, None),
    (r4_stream_changed_content, O_R4S), (r5_stream_failure_runs, O_R5S), (r1_stream_changelog, lifecycle.O_R1), (r2_stream_windows, O_R2S),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS if sql}
