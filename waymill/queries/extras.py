"""Queries on the remaining scans, sinks, joins and reports: S10-S12, S16, K2, K10, K11, F25, F30, X27, M26, J9, J11, J14, J27-J32, A5, A16, A19, U2-U5, T5, T10, G6."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions import clock, geo, places, tags
from waymill.functions.sql import register
from waymill.operators import cells
from waymill.operators.shared import shared_path, table
from waymill.plans import graph as plan
from waymill.queries import graph as g
from waymill.queries import annotate, lifecycle, records, spatial
from waymill.queries import tag_rules as t
from waymill.queries.views import pick, view, with_views
from waymill.sources.raster import decode_grids


def c(name):
    return F.col(name)


def s10_u6_leaf_selection(spark, sf):
    """Index features with a source and no children: parents drop out by anti-join; bounds by country prefix."""
    o = table(spark, sf, "customer").select(c("c_custkey").alias("id"), F.when(c("c_custkey") % 4 != 0, (c("c_custkey") - c("c_custkey") % 4).cast("long")).alias("parent"), (c("c_custkey") % 7 != 3).alias("has_source"), "c_nationkey", "c_acctbal")
    leaves = o.filter("has_source").join(o.select(c("parent").alias("id")).filter("id is not null").distinct(), "id", "left_anti")
    return leaves.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))


O_S10 = """WITH o AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey - c_custkey % 4 END AS parent, c_nationkey, c_acctbal FROM customer)
SELECT c_nationkey, count(*) AS n, min(c_acctbal) AS low, max(c_acctbal) AS high FROM o WHERE id % 7 <> 3 AND id NOT IN (SELECT parent FROM o WHERE parent IS NOT NULL) GROUP BY 1"""


def s11_s12_export_documents(spark, sf):
    """Exports whose rows stand under one of several keys; markers by case-folded country, later rows win."""
    path = shared_path(spark, "exports")
    o = table(spark, sf, "orders").withColumn("row", F.struct(c("o_orderkey").alias("locator"), F.when(c("o_orderkey") % 2 == 0, " Norway ").otherwise("SWEDEN").alias("country")))
    rows = o.groupBy("o_custkey").agg(F.collect_list("row").alias("rows"))
    named = lambda k, i: F.when(c("o_custkey") % 3 == i, c("rows")).alias(k)
    rows.select("o_custkey", named("results", 0), named("data", 1), named("repeaters", 2)).write.json(path)
    item = "array<struct<locator bigint, country string>>"
    d = spark.read.schema(f"o_custkey long, results {item}, data {item}, repeaters {item}").json(path)
    marks = d.select("o_custkey", F.explode_outer(F.coalesce("results", "data", "repeaters")).alias("m")).select("o_custkey", "m.*").filter(F.lower(F.trim("country")).isin("norway"))
    return marks.groupBy((c("locator") % 100).alias("key")).agg(F.max_by("o_custkey", "locator").alias("owner"), F.count(F.lit(1)).alias("n"))


O_S11 = 'SELECT o_orderkey % 100 AS "key", arg_max(o_custkey, o_orderkey) AS owner, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1'


def s16_height_grids(spark, sf):
    """Six-by-six grids of big-endian heights, made from the parts table and decoded: posts, voids, sum by grid."""
    p = table(spark, sf, "part").select(F.floor(c("p_partkey") / 36).alias("cell"), (c("p_partkey") % 36).alias("post"), (c("p_size") * 10).alias("h"))
    posts = p.select("cell").distinct().select("cell", F.explode(F.sequence(F.lit(0), F.lit(35))).alias("post")).join(p, ["cell", "post"], "left")
    word = F.lpad(F.hex(F.coalesce(c("h"), F.lit(0x8000)).cast("long")), 4, "0")
    grids = posts.groupBy("cell").agg(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("post", word.alias("w")))), lambda x: x["w"]), "")).alias("content"))
    rows = decode_grids(grids.select(c("cell").cast("string").alias("path"), "content"))
    return rows.groupBy("path").agg(F.count(F.lit(1)).alias("posts"), F.count_if(c("elev_m").isNull()).alias("voids"), F.sum("elev_m").alias("sum_m"))


O_S16 = "SELECT (p_partkey // 36)::VARCHAR AS path, 36::BIGINT AS posts, 36 - count(*) AS voids, sum(p_size * 10)::BIGINT AS sum_m FROM part GROUP BY 1"


def k2_k10_layer_sinks(spark, sf):
    """POI, segment, ring, building and stub layers under one generation, read back by layer; stubs are named places, outlines and routes."""
    path = shared_path(spark, "layers")
    rings = view(spark, sf, "v_ring_points")
    after = Window.partitionBy("region_id").orderBy("vertex")
    first = F.first(F.struct("lat", "lon")).over(after)
    sides = rings.select("region_id", "vertex", "lat", "lon", F.coalesce(F.lead(F.struct("lat", "lon")).over(after), first).alias("to"))
    stub = lambda rows, kind, key: rows.select(F.lit(kind).alias("kind"), c(key).cast("string").alias("key")).distinct()
    stubs = stub(records.x15_t8_search_stubs(spark, sf), "name", "name").unionByName(stub(t10_admin_outlines(spark, sf), "outline", "way_id")).unionByName(stub(records.f20_x16_t11_named_routes(spark, sf), "route", "id"))
    layers = {"pois": view(spark, sf, "v_pois").select("poi_id"), "segments": sides, "rings": rings, "buildings": view(spark, sf, "v_nodes").filter("building is not null").select("node_id"), "stubs": stubs}
    for name, rows in layers.items():
        rows.write.parquet(f"{path}/generation=1/layer={name}")
    counts = [spark.read.parquet(f"{path}/generation=1/layer={name}").agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n")) for name in layers]
    out = counts[0]
    for x in counts[1:]:
        out = out.unionByName(x)
    return out


def o_k2() -> str:
    stubs = f"SELECT 'name' AS kind, name AS key FROM ({records.O_X15}) UNION SELECT 'outline', way_id::VARCHAR FROM ({O_T10}) UNION SELECT 'route', id::VARCHAR FROM ({records.O_F20})"
    return with_views("v_nodes", "v_pois", "v_ring_points") + f" x AS (SELECT 1) SELECT 'pois' AS layer, count(*) AS n FROM v_pois UNION ALL SELECT 'segments', count(*) FROM v_ring_points UNION ALL SELECT 'rings', count(*) FROM v_ring_points UNION ALL SELECT 'buildings', count(*) FROM v_nodes WHERE building IS NOT NULL UNION ALL SELECT 'stubs', count(*) FROM ({stubs})"


def k11_publish_projection(spark, sf):
    """Nested region rows reduced to a fixed key set."""
    l = view(spark, sf, "v_leaves").groupBy("region_id").agg(F.array_sort(F.collect_set(F.struct("leaf_id", "coverage", "overspill"))).alias("leaves"))
    slim = l.select("region_id", F.transform("leaves", lambda x: F.struct(x["leaf_id"].alias("leaf"), x["coverage"].alias("pct"))).alias("leaves"))
    return slim.select("region_id", F.size("leaves").alias("n"), F.round(F.aggregate("leaves", F.lit(0.0), lambda s, x: s + x["pct"]), 4).alias("pct"), F.element_at("leaves", 1)["leaf"].alias("first"))


O_K11 = with_views("v_leaves") + " l AS (SELECT DISTINCT region_id, leaf_id, coverage, overspill FROM v_leaves) SELECT region_id, count(*)::INT AS n, round(sum(coverage), 4) AS pct, min(leaf_id) AS first FROM l GROUP BY 1"


def f25_f30_exclusions(spark, sf):
    """Fixed ids out; a path that is the parent of another out, by its exploded ancestors."""
    kinds = ["europe", "europe/norway", "europe/norway/ost", "asia/japan", "asia", "europe/sweden"]
    p = spark.sql(f"SELECT c_custkey AS id, concat({pick('c_custkey', kinds)}, CASE WHEN c_custkey % 5 = 0 THEN concat('/x', c_custkey % 30) ELSE '' END) AS path FROM {{customer}} WHERE c_custkey % 97 <> 13", customer=table(spark, sf, "customer"))
    parts = F.split("path", "/")
    ancestors = p.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("path"), F.size(parts).alias("k")).filter("k > 1").select("path").distinct()
    return p.join(ancestors, "path", "left_anti").groupBy("path").agg(F.count(F.lit(1)).alias("n"))


O_F25 = "WITH p AS (SELECT " + pick("c_custkey", ["europe", "europe/norway", "europe/norway/ost", "asia/japan", "asia", "europe/sweden"]) + " || CASE WHEN c_custkey % 5 = 0 THEN '/x' || (c_custkey % 30) ELSE '' END AS path FROM customer WHERE c_custkey % 97 <> 13), d AS (SELECT DISTINCT path FROM p) SELECT path, count(*) AS n FROM p WHERE NOT EXISTS (SELECT 1 FROM d WHERE starts_with(d.path, p.path || '/')) GROUP BY 1"


def x27_stop_roles(spark, sf):
    """Members whose role counts as a stop, by relation."""
    roles = ["stop", "platform", "", "forward_stop", "Harbour", "outer", None, "halt"]
    m = spark.sql(f"SELECT l_orderkey AS relation_id, {pick('l_partkey', roles)} AS role FROM {{lineitem}}", lineitem=table(spark, sf, "lineitem"))
    r = tags.clean(c("role"))
    return m.groupBy("relation_id").agg(F.count_if(r.contains("stop") | r.isin("platform", "terminal", "harbour", "harbor", "port", "halt")).alias("stops"))


O_X27 = "SELECT l_orderkey AS relation_id, count(*) FILTER (l_partkey % 8 IN (0, 1, 3, 4, 7)) AS stops FROM lineitem GROUP BY 1"


MAX_TILES, WIDEST = 256, 90.0


def m26_tile_grid(spark, sf):
    """Tiles of each region (its box drawn 20 times larger): cells of a degree, grown step by step until at most 256 or over 90 degrees wide."""
    r = view(spark, sf, "v_regions").withColumns({"tall": (c("max_lat") - c("min_lat")) * 20, "wide": (c("max_lon") - c("min_lon")) * 20})
    rows = lambda cell: F.greatest(F.ceil(c("tall") / cell), F.lit(1))
    cols = lambda cell: F.greatest(F.ceil(c("wide") / cell), F.lit(1))
    tiles = lambda cell: rows(cell) * cols(cell)
    grown = lambda cell, _: F.when((tiles(cell) > MAX_TILES) & (cell <= WIDEST), cell * F.greatest(F.sqrt(tiles(cell) / MAX_TILES), F.lit(1.05))).otherwise(cell)
    r = r.withColumn("cell", F.aggregate(F.sequence(F.lit(1), F.lit(93)), F.lit(1.0), grown))  # 1.05 ** 93 > 90
    needed = (c("tall") > 1.25) | (c("wide") > 1.25) | (c("tall") * c("wide") > 2.0)
    grid = r.select("region_id", "cell", needed.alias("tiled"), rows(c("cell")).alias("rows"), cols(c("cell")).alias("cols"))
    each = grid.select("*", F.explode(F.sequence(F.lit(0), c("rows") - 1)).alias("row")).select("*", F.explode(F.sequence(F.lit(0), c("cols") - 1)).alias("col"))
    return each.groupBy("region_id", "tiled").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("last_row"), F.max("col").alias("last_col"), F.round(F.max("cell"), 6).alias("cell"))


O_M26 = with_views("v_regions").replace("WITH ", "WITH RECURSIVE ", 1) + """ g AS (SELECT region_id, 0 AS i, 1.0::DOUBLE AS cell, (max_lat - min_lat) * 20 AS tall, (max_lon - min_lon) * 20 AS wide FROM v_regions
UNION ALL SELECT region_id, i + 1, cell * greatest(sqrt(greatest(ceil(tall / cell), 1) * greatest(ceil(wide / cell), 1) / 256), 1.05), tall, wide FROM g WHERE greatest(ceil(tall / cell), 1) * greatest(ceil(wide / cell), 1) > 256 AND cell <= 90),
l AS (SELECT region_id, arg_max(cell, i) AS cell, any_value(tall) AS tall, any_value(wide) AS wide FROM g GROUP BY 1), s AS (SELECT *, greatest(ceil(tall / cell), 1)::BIGINT AS r, greatest(ceil(wide / cell), 1)::BIGINT AS k FROM l)
SELECT region_id, tall > 1.25 OR wide > 1.25 OR tall * wide > 2 AS tiled, r * k AS n, r - 1 AS last_row, k - 1 AS last_col, round(cell, 6) AS cell FROM s"""


def j9_segments_in_rings(spark, sf):
    """Ways of which a segment has its middle in a ring or meets one of its sides; the smallest ring id of the hits."""
    leg, r = spatial.way_segments(spark, sf), spatial.rings(spark, sf)
    mid = spatial.points_in_rings(leg.select("way_id", ((c("lat1") + c("lat2")) / 2).alias("lat"), ((c("lon1") + c("lon2")) / 2).alias("lon")), r).select("way_id", "region_id")
    return mid.unionByName(spatial.side_crossings(leg, r)).groupBy("way_id").agg(F.min("region_id").alias("ring"), F.count_distinct("region_id").alias("n"))


O_J9 = with_views("v_way_nodes", "v_nodes", "v_ring_points") + spatial.RING_EDGES + f""", {spatial.LEGS}, m AS (SELECT leg, (lat1 + lat2) / 2 AS lat, (lon1 + lon2) / 2 AS lon FROM legs), i AS ({spatial.sql_inside('m', 'leg')}), x AS ({spatial.sql_meets('legs', 'leg')}), u AS (SELECT leg, region_id FROM i UNION SELECT leg, region_id FROM x)
SELECT way_id, min(region_id) AS ring, count(DISTINCT region_id) AS n FROM u JOIN legs USING (leg) GROUP BY 1"""


def j11_ambiguous_lookup(spark, sf):
    """Way ids to feature ids: the feature where there is one, flagged where several, listed where none."""
    l = table(spark, sf, "lineitem").select(c("l_orderkey").alias("way_id"), (c("l_partkey") % 40).alias("feature_id")).distinct().filter("feature_id < 25")
    w = table(spark, sf, "orders").select(c("o_orderkey").alias("way_id"))
    n = w.join(l, "way_id", "left").groupBy("way_id").agg(F.count("feature_id").alias("k"), F.min("feature_id").alias("least"))
    return n.select("way_id", F.when(c("k") == 0, "none").when(c("k") == 1, "one").otherwise("ambiguous").alias("kind"), F.when(c("k") == 1, c("least")).alias("feature_id"), c("k").alias("n"))


O_J11 = "WITH l AS (SELECT DISTINCT l_orderkey, l_partkey % 40 AS f FROM lineitem WHERE l_partkey % 40 < 25) SELECT o_orderkey AS way_id, CASE count(f) WHEN 0 THEN 'none' WHEN 1 THEN 'one' ELSE 'ambiguous' END AS kind, CASE count(f) WHEN 1 THEN min(f) END AS feature_id, count(f) AS n FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1"


def j27_superroute_chain(spark, sf):
    """Super-relation (nation) to its first relation (customer), that one's first way, the way's first located node."""
    child = table(spark, sf, "customer").groupBy(c("c_nationkey").alias("super_id")).agg(F.min("c_custkey").alias("relation_id"))
    ways = table(spark, sf, "orders").select(c("o_custkey").alias("relation_id"), c("o_orderkey").alias("way_id"))
    first = child.join(ways, "relation_id", "left").groupBy("super_id", "relation_id").agg(F.min("way_id").alias("way_id"))
    node = view(spark, sf, "v_way_nodes").groupBy("way_id").agg(F.min_by("node_id", "pos").alias("node_id"))
    return first.join(node, "way_id", "left").select("super_id", "relation_id", "way_id", "node_id")


O_J27 = with_views("v_way_nodes") + """ c AS (SELECT c_nationkey AS super_id, min(c_custkey) AS relation_id FROM customer GROUP BY 1), f AS (SELECT super_id, relation_id, min(o_orderkey) AS way_id FROM c LEFT JOIN orders ON o_custkey = relation_id GROUP BY 1, 2)
SELECT super_id, relation_id, way_id, node_id FROM f LEFT JOIN (SELECT way_id, arg_min(node_id, pos) AS node_id FROM v_way_nodes GROUP BY 1) USING (way_id)"""


def j30_j32_a19_overrides(spark, sf):
    """Sparse overrides onto base heights and limits onto segments by key, with shares by part group."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (c("l_partkey") % 10).alias("grp"), "l_quantity").dropDuplicates(["l_orderkey", "l_linenumber", "grp"])
    over = table(spark, sf, "orders").filter("o_orderkey % 3 = 0").select(c("o_orderkey").alias("l_orderkey"), F.lit(3).alias("l_linenumber"), F.lit(7.5).alias("dem"))
    return l.join(over, ["l_orderkey", "l_linenumber"], "left").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.count("dem").alias("n_over"), F.round(F.count("dem") / F.count(F.lit(1)), 6).alias("share"), F.count_distinct(F.when(c("dem").isNotNull(), c("l_orderkey"))).alias("features"))


O_J30 = """WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey % 10 AS grp FROM lineitem), j AS (SELECT grp, l_orderkey, l_linenumber = 3 AND l_orderkey % 3 = 0 AND l_orderkey IN (SELECT o_orderkey FROM orders) AS o FROM l)
SELECT grp, count(*) AS n, count(*) FILTER (o) AS n_over, round(count(*) FILTER (o) / count(*), 6) AS share, count(DISTINCT l_orderkey) FILTER (o) AS features FROM j GROUP BY 1"""


def a5_exclusion_counts(spark, sf):
    """Ways restricted for cars, and shut by season at two instants."""
    w = view(spark, sf, "v_ways")
    shut = lambda at: clock.forbids(c("access_conditional"), F.to_timestamp(F.lit(at))) | clock.forbids(c("motor_vehicle_conditional"), F.to_timestamp(F.lit(at)))
    return w.agg(F.count_if(t.forbidden("car")).alias("restricted"), F.count_if(shut("2024-06-12 08:30:00")).alias("summer"), F.count_if(clock.forbids(c("access_conditional"), F.to_timestamp(F.lit("2024-01-02 03:00:00")))).alias("winter"))


O_A5 = with_views("v_ways") + f" x AS (SELECT 1) SELECT count(*) FILTER ({t.sql_forbidden('car')}) AS restricted, count(*) FILTER ({t.SQL_CLOSED}) AS summer, count(*) FILTER (access_conditional IN ('no @ Nov-Jun', 'no @ (Dec-Apr)', 'yes @ (Jun-Sep)')) AS winter FROM v_ways"


def a16_u5_road_cells(spark, sf):
    """Tenth-degree cells with a road or ferry node, less those known to be missing, plus new misses."""
    ways, refs, nodes = g.parts(spark, sf)
    road = ways.filter(c("highway").isNotNull() | tags.is_ferry(c("route"), c("highway"), c("ferry"))).select("way_id")
    at = plan.resolved(refs.join(road, "way_id", "left_semi"), nodes).select(F.floor(c("lat") / 0.1).alias("cy"), F.floor(c("lon") / 0.1).alias("cx")).distinct()
    known = table(spark, sf, "supplier").select((c("s_suppkey") % 20 + 590).alias("cy"), (c("s_suppkey") * 3 % 20 + 100).alias("cx")).distinct()
    return at.join(known, ["cy", "cx"], "left_anti").groupBy("cy").agg(F.count(F.lit(1)).alias("n"), F.min("cx").alias("west"))


O_A16 = with_views("v_ways", "v_way_nodes", "v_nodes") + f""" a AS (SELECT DISTINCT floor(lat / 0.1::DOUBLE)::BIGINT AS cy, floor(lon / 0.1::DOUBLE)::BIGINT AS cx FROM v_way_nodes JOIN v_nodes USING (node_id) WHERE way_id IN (SELECT way_id FROM v_ways WHERE highway IS NOT NULL OR {t.SQL_FERRY})),
k AS (SELECT DISTINCT s_suppkey % 20 + 590 AS cy, s_suppkey * 3 % 20 + 100 AS cx FROM supplier) SELECT cy, count(*) AS n, min(cx) AS west FROM a ANTI JOIN k USING (cy, cx) GROUP BY 1"""


def u2_u3_merged_parts(spark, sf):
    """Parts of a download united, the first part's row of a key kept."""
    o = table(spark, sf, "orders")
    part = lambda no, rule: o.filter(rule).select(F.lit(no).alias("part"), (c("o_orderkey") % 900).alias("id"), "o_orderpriority", "o_orderkey")
    both = part(1, "o_orderkey % 3 = 0").unionByName(part(2, "o_orderkey % 2 = 0"))
    return both.groupBy("id").agg(F.min(F.struct("part", "o_orderkey", "o_orderpriority")).alias("m"), F.count(F.lit(1)).alias("n")).select("id", "m.part", "m.o_orderkey", "n")


O_U2 = """WITH b AS (SELECT 1 AS part, o_orderkey % 900 AS id, o_orderkey FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 2, o_orderkey % 900, o_orderkey FROM orders WHERE o_orderkey % 2 = 0) SELECT id, arg_min(part, (part, o_orderkey))::INT AS part, arg_min(o_orderkey, (part, o_orderkey)) AS o_orderkey, count(*) AS n FROM b GROUP BY 1"""


def t5_terminal_order(spark, sf):
    """Both ends of each ferry in report order: name, position, node. One sort by ranges."""
    ways, refs, nodes = g.parts(spark, sf)
    ferry = ways.filter(tags.is_ferry(c("route"), c("highway"), c("ferry"))).select("way_id", F.coalesce("name", F.lit("")).alias("name"))
    at = plan.resolved(refs, nodes).groupBy("way_id").agg(F.min_by(F.struct("node_id", "lat", "lon"), "pos").alias("a"), F.max_by(F.struct("node_id", "lat", "lon"), "pos").alias("b"))
    ends = at.join(ferry, "way_id").select("name", F.explode(F.array("a", "b")).alias("e")).select("name", c("e.node_id").alias("node_id"), "e.lat", "e.lon").distinct()
    return ends.orderBy("name", "lat", "lon", "node_id").select("name", "node_id", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))


O_T5 = with_views("v_ways", "v_way_nodes", "v_nodes") + f""" r AS (SELECT way_id, node_id, lat, lon, row_number() OVER (PARTITION BY way_id ORDER BY pos) AS i, row_number() OVER (PARTITION BY way_id ORDER BY pos DESC) AS j FROM v_way_nodes JOIN v_nodes USING (node_id))
SELECT DISTINCT coalesce(name, '') AS name, node_id, round(lat, 4) AS lat, round(lon, 4) AS lon FROM r JOIN v_ways USING (way_id) WHERE (i = 1 OR j = 1) AND {t.SQL_FERRY} ORDER BY 1, 3, 4, 2"""
_REL = f"SELECT c_custkey AS relation_id, c_name AS name, {pick('c_custkey', ['administrative', None, 'water'])} AS boundary, {pick('c_custkey * 7', ['6', '8', '4', 'x', None])} AS level FROM {{customer}}"
_MEM = f"SELECT o_custkey AS relation_id, o_orderkey AS way_id, {pick('o_orderkey * 3', ['outer', 'inner', '', None, 'part', 'Outer', 'label'])} AS role FROM {{orders}}"
_OWN = f"SELECT way_id, name, {pick('way_id * 5', [None, 'administrative', None])} AS boundary, {pick('way_id * 11', ['6', '7', '9', None])} AS level FROM {{v_ways}}"


def t10_admin_outlines(spark, sf):
    """Outlines of level 6 to 8: members with no role, outer or part of such relations, and such ways of three nodes or more that stand alone."""
    level = places.admin_level(c("boundary"), c("name"), c("level"))
    rel = spark.sql(_REL, customer=table(spark, sf, "customer")).select("relation_id", level.alias("level")).filter("level is not null")
    members = spark.sql(_MEM, orders=table(spark, sf, "orders")).filter(F.lower(F.coalesce("role", F.lit(""))).isin("", "outer", "part"))
    outline = members.join(rel, "relation_id").select("way_id", "relation_id", "level")
    own = spark.sql(_OWN, v_ways=view(spark, sf, "v_ways")).select("way_id", level.alias("level")).filter("level is not null")
    long = view(spark, sf, "v_way_nodes").groupBy("way_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    alone = own.join(long, "way_id", "left_semi").join(outline.select("way_id"), "way_id", "left_anti").select("way_id", F.lit(None).cast("long").alias("relation_id"), "level")
    return outline.unionByName(alone)


_LEVEL = "boundary = 'administrative' AND trim(name) <> '' AND level IN ('6', '7', '8')"
O_T10 = with_views("v_ways", "v_way_nodes") + f""" r AS ({_REL.format(customer='customer')}), m AS ({_MEM.format(orders='orders')}), w AS ({_OWN.format(v_ways='v_ways')}), o AS (SELECT way_id, relation_id, level::INT AS level FROM m JOIN r USING (relation_id) WHERE lower(coalesce(role, '')) IN ('', 'outer', 'part') AND {_LEVEL})
SELECT * FROM o UNION ALL SELECT way_id, NULL, level::INT FROM w WHERE {_LEVEL} AND way_id IN (SELECT way_id FROM v_way_nodes GROUP BY 1 HAVING count(*) >= 3) AND way_id NOT IN (SELECT way_id FROM o)"""


def g6_leaf_set(spark, sf):
    """Expected leaves without a polygon, polygons without a leaf, and both."""
    want = table(spark, sf, "customer").select((c("c_custkey") % 70).alias("leaf")).distinct().withColumn("w", F.lit(True))
    have = table(spark, sf, "orders").select((c("o_orderkey") % 50 + 10).alias("leaf")).distinct().withColumn("h", F.lit(True))
    both = want.join(have, "leaf", "full_outer")
    return both.groupBy(F.when(c("w").isNull(), "leftover").when(c("h").isNull(), "missing").otherwise("ok").alias("state")).agg(F.count(F.lit(1)).alias("n"), F.sum("leaf").alias("ids"))


O_G6 = "WITH w AS (SELECT DISTINCT c_custkey % 70 AS leaf, true AS w FROM customer), h AS (SELECT DISTINCT o_orderkey % 50 + 10 AS leaf, true AS h FROM orders) SELECT CASE WHEN w IS NULL THEN 'leftover' WHEN h IS NULL THEN 'missing' ELSE 'ok' END AS state, count(*) AS n, sum(leaf)::BIGINT AS ids FROM w FULL JOIN h USING (leaf) GROUP BY 1"

def g6_adjacency_warnings(spark, sf):
    """Missing regions beside ones that are there, by touching boxes: a hole in the set rather than its edge."""
    pairs = spatial.j31_f16_adjacent_boxes(spark, sf).select("a_id", "b_id")
    both = pairs.unionByName(pairs.select(c("b_id").alias("a_id"), c("a_id").alias("b_id")))
    have = table(spark, sf, "customer").select((c("c_custkey") * 7 % 17).cast("int").alias("a_id")).distinct()
    gone = view(spark, sf, "v_regions").select(c("region_id").cast("int").alias("b_id")).join(have.select(c("a_id").alias("b_id")), "b_id", "left_anti")
    return both.join(have, "a_id", "left_semi").join(gone, "b_id", "left_semi").groupBy(c("b_id").alias("missing_id")).agg(F.count(F.lit(1)).alias("n_present"), F.min("a_id").alias("beside"))


O_G6W = f"""WITH pr AS ({spatial.O_J31}), b AS (SELECT a_id, b_id FROM pr UNION ALL SELECT b_id, a_id FROM pr), h AS (SELECT DISTINCT (c_custkey * 7 % 17)::INT AS id FROM customer)
SELECT b_id AS missing_id, count(*) AS n_present, min(a_id) AS beside FROM b WHERE a_id IN (SELECT id FROM h) AND b_id NOT IN (SELECT id FROM h) GROUP BY 1"""


def f27_class_compatibility(spark, sf):
    """Pairs of road class and feature class, by name, alias or prefix."""
    w, f = annotate.local_ways(spark, sf), annotate.local_features(spark, sf)
    pairs = w.join(f.select((c("feature_id") - 1_000_000 + 1).alias("way_id"), "base"), "way_id").select("highway", "base")
    return pairs.groupBy("highway", "base").agg(F.count(F.lit(1)).alias("n")).withColumn("ok", annotate.annotate.compatible(c("highway"), c("base")))


_BASES = annotate.KINDS[:3] + ["path", "cycleway"] + annotate.BASES
O_F27 = f"""WITH f AS (SELECT o_orderkey + 1 AS way_id, {pick('o_orderkey', _BASES)} AS base FROM orders UNION ALL SELECT o_orderkey + 1, {pick('o_orderkey', _BASES)} FROM orders WHERE o_orderkey % 3 = 0), w AS (SELECT o_orderkey AS way_id, {pick('o_orderkey', annotate.KINDS)} AS highway FROM orders)
SELECT highway, base, count(*) AS n, highway = base OR {annotate._ALIAS} OR starts_with(base, highway || '-') OR starts_with(highway, base || '-') AS ok FROM w JOIN f USING (way_id) GROUP BY 1, 2"""


def j39_flagged_midpoints(spark, sf):
    """Middles of the feature segments that are flagged as boardwalk, by a semi join on (feature, segment)."""
    f = annotate.local_features(spark, sf).select("feature_id", F.posexplode(annotate.annotate.legs(c("points"))).alias("segment", "leg"))
    flagged = table(spark, sf, "lineitem").filter("l_tax >= 0.06").select((c("l_orderkey") + 1_000_000).alias("feature_id"), (c("l_linenumber") - 1).cast("int").alias("segment")).distinct()
    mid = lambda k: F.round((c(f"leg.a.{k}") + c(f"leg.b.{k}")) / 2, 7).alias(k)
    return f.join(flagged, ["feature_id", "segment"], "left_semi").select("feature_id", "segment", mid("lat"), mid("lon"))


O_J39 = f"""WITH {annotate.sql_candidates()}, g AS (SELECT DISTINCT l_orderkey AS k, l_linenumber - 1 AS segment FROM lineitem WHERE l_tax >= 0.06)
SELECT k + 1000000 AS feature_id, segment::INT AS segment, round((ay + bmy) / 2, 7) AS lat, round((ax + bmx) / 2, 7) AS lon FROM fs SEMI JOIN g USING (k, segment)"""


def a13_gap_rows(spark, sf):
    """Ferries that the new rule gains or loses, by region; and up to eight examples of each form of duration that does not parse."""
    w = view(spark, sf, "v_ways").join(table(spark, sf, "orders").select(c("o_orderkey").alias("way_id"), "o_custkey"), "way_id").join(table(spark, sf, "customer").select(c("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    ferry = w.filter(tags.is_ferry(c("route"), c("highway"), c("ferry")))
    was = tags.old_ferry_class(*[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle")]) == "car"
    now = tags.ferry_admits("car", *[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "access", "ferry", "foot", "bicycle")], F.lit(False))
    gaps = ferry.filter(was != now).select(F.when(now, "became_car").otherwise("left_car").alias("item"), c("c_nationkey").cast("string").alias("grp"), "way_id")
    bad = ferry.filter(c("duration").isNotNull() & tags.duration_seconds(c("duration")).isNull()).select(F.lit("rejected_duration").alias("item"), c("duration").alias("grp"), "way_id")
    ranked = bad.withColumn("place", F.row_number().over(Window.partitionBy("item", "grp").orderBy("way_id"))).filter("place <= 8").drop("place")
    return gaps.unionByName(ranked)


O_A13 = with_views("v_ways") + f""" f AS (SELECT v_ways.*, c_nationkey, ({lifecycle._OLD}) = 'car' AS was, {t.SQL_CAR_FERRY} AS now, {t.SQL_SECONDS} AS secs FROM v_ways JOIN orders ON o_orderkey = way_id JOIN customer ON c_custkey = o_custkey WHERE {t.SQL_FERRY}),
b AS (SELECT duration, way_id, row_number() OVER (PARTITION BY duration ORDER BY way_id) AS p FROM f WHERE duration IS NOT NULL AND secs IS NULL)
SELECT CASE WHEN now THEN 'became_car' ELSE 'left_car' END AS item, c_nationkey::VARCHAR AS grp, way_id FROM f WHERE was <> now UNION ALL SELECT 'rejected_duration', duration, way_id FROM b WHERE p <= 8"""


def a12_tag_combinations(spark, sf):
    """The hundred most common access combinations of ferries of unknown class, and shares of durations by class."""
    w = view(spark, sf, "v_ways").filter(tags.is_ferry(c("route"), c("highway"), c("ferry")))
    kind = tags.old_ferry_class(*[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle")])
    keys = ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle", "access")
    combo = F.concat_ws(";", *[F.concat(F.lit(f"{k}="), c(k)) for k in keys])
    counts = w.filter(kind == "unknown").groupBy(combo.alias("item")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item").limit(100)
    shares = w.groupBy(kind.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.count("duration").alias("given"), F.count(tags.duration_seconds(c("duration"))).alias("parsed"))
    share = lambda a, b: F.when(c(b) > 0, F.round(c(a) / c(b), 6))
    return counts.select(F.lit("combination").alias("kind"), "item", "n", F.lit(None).cast("double").alias("given"), F.lit(None).cast("double").alias("parsed")).unionByName(shares.select(F.lit("duration").alias("kind"), c("k").alias("item"), "n", share("given", "n").alias("given"), share("parsed", "given").alias("parsed")))


_COMBO = "concat_ws(';', " + ", ".join(f"'{k}=' || {k}" for k in ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle", "access")) + ")"
O_A12C = with_views("v_ways") + f""" f AS (SELECT *, {lifecycle._OLD} AS k, {t.SQL_SECONDS} AS secs FROM v_ways WHERE {t.SQL_FERRY}), n AS (SELECT {_COMBO} AS item, count(*) AS n FROM f WHERE k = 'unknown' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100)
SELECT 'combination' AS kind, item, n, NULL::DOUBLE AS given, NULL::DOUBLE AS parsed FROM n UNION ALL SELECT 'duration', k, count(*), round(count(duration) / count(*), 6), CASE WHEN count(duration) > 0 THEN round(count(secs) / count(duration), 6) END FROM f GROUP BY k"""


def f34_x30_tag_subset(spark, sf):
    """Tags kept by prefix or by name, with a composite id and the location of its parts."""
    w = view(spark, sf, "v_ways")
    keys = ("toll", "toll_motorcar", "toll_hgv", "toll_bicycle", "name", "ref", "surface", "oneway")
    m = F.create_map(*[x for k in keys for x in (F.lit(k), c(k))])
    kept = F.map_filter(m, lambda k, v: v.isNotNull() & (k.startswith("toll") | k.isin("name", "ref")))
    text = F.array_join(F.array_sort(F.transform(F.map_entries(kept), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return w.select("way_id", text.alias("kept"), F.concat_ws(":", c("way_id") % 7, "way_id").alias("composite"), F.concat_ws(", ", F.nullif(F.trim("name"), F.lit("")), F.nullif(F.trim("ref"), F.lit(""))).alias("place"))


O_F34 = with_views("v_ways") + """ x AS (SELECT 1) SELECT way_id, array_to_string(list_sort(list_filter(['toll=' || toll, 'toll_motorcar=' || toll_motorcar, 'toll_hgv=' || toll_hgv, 'toll_bicycle=' || toll_bicycle, 'name=' || name, 'ref=' || ref], lambda x: x IS NOT NULL)), ';') AS kept,
(way_id % 7) || ':' || way_id AS composite, concat_ws(', ', nullif(trim(name), ''), nullif(trim(ref), '')) AS place FROM v_ways"""


def a27_merged_counters(spark, sf):
    """Numeric counters of several extracts summed by key."""
    l = table(spark, sf, "lineitem")
    one = l.groupBy((c("l_orderkey") % 6).alias("extract"), "l_returnflag").agg(F.count(F.lit(1)).alias("kept"), F.count_if(c("l_linenumber") > 4).alias("dropped"))
    return one.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("extracts"), F.sum("kept").alias("kept"), F.sum("dropped").alias("dropped"))


O_A27 = "SELECT l_returnflag, count(DISTINCT l_orderkey % 6) AS extracts, count(*) AS kept, count(*) FILTER (l_linenumber > 4) AS dropped FROM lineitem GROUP BY 1"


def j38_corridor_load(spark, sf):
    """Buildings inside the route band only, within 1500 m of the legs between region centres: nodes, and ways by the middle of their nodes in the map's box."""
    ways, refs, nodes = g.parts(spark, sf)
    legs = spatial.corridor(spark, sf)
    pad = 1500 / (geo.METRES_A_DEGREE * 0.45)
    low, high = lambda a, b: F.least(c(a), c(b)) - pad, lambda a, b: F.greatest(c(a), c(b)) + pad
    boxed = cells.box_in_cells(legs.withColumns({"min_lat": low("lat1", "lat2"), "min_lon": low("lon1", "lon2"), "max_lat": high("lat1", "lat2"), "max_lon": high("lon1", "lon2")}), 0.1).drop("min_lat", "min_lon", "max_lat", "max_lon")
    houses = nodes.filter("building is not null").select(F.lit("node").alias("kind"), c("node_id").alias("id"), "building", "lat", "lon")
    box = c("lat").between(59.1, 60.8) & c("lon").between(10.1, 11.8)
    blocks = plan.resolved(refs.join(ways.filter("building is not null").select("way_id", "building"), "way_id"), nodes).filter(box).groupBy("way_id", "building").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    every = houses.unionByName(blocks.select(F.lit("way").alias("kind"), c("way_id").alias("id"), "building", "lat", "lon"))
    d = geo.segment_distance(*[c(x) for x in ("lat", "lon", "lat1", "lon1", "lat2", "lon2")])
    near = cells.own_cell(every, "lat", "lon", 0.1).join(boxed, ["cy", "cx"]).withColumn("d", d).filter("d <= 1500")
    return near.groupBy("kind", "building").agg(F.count_distinct("id").alias("n"), F.round(F.min("d"), 2).alias("nearest"))


O_J38 = with_views("v_ways", "v_way_nodes", "v_nodes", "v_regions") + spatial._LEGS + f""", h AS (SELECT 'node' AS kind, node_id AS id, building, lat, lon FROM v_nodes WHERE building IS NOT NULL UNION ALL SELECT 'way', way_id, w.building, avg(lat), avg(lon) FROM v_ways w JOIN v_way_nodes USING (way_id) JOIN v_nodes USING (node_id) WHERE w.building IS NOT NULL AND lat BETWEEN 59.1 AND 60.8 AND lon BETWEEN 10.1 AND 11.8 GROUP BY ALL),
x AS (SELECT kind, id, building, lat, lon, lat1, lon1, lat2, lon2 FROM h, legs), d AS ({spatial.sql_segdist('x', 'kind, id, building')}) SELECT kind, building, count(DISTINCT id) AS n, round(min(d), 2) AS nearest FROM d WHERE d <= 1500 GROUP BY 1, 2"""


def sql_functions(spark, sf):
    """The rules called from SQL text."""
    register(spark)
    return spark.sql(
        "SELECT way_road_base(highway) AS base, count(*) AS n, count_if(way_access_no(access)) AS shut, round(sum(way_metric(maxweight)), 4) AS tonnes, round(sum(way_haversine_m(59.0D, 10.0D, 59.0D + way_id % 10, 10.5D, 6371000.0D)), 1) AS metres FROM {w} GROUP BY 1",
        w=view(spark, sf, "v_ways"),
    )


O_SQL = with_views("v_ways") + f""" x AS (SELECT *, 59.0::DOUBLE + way_id % 10 AS la FROM v_ways) SELECT regexp_replace(highway, '_link$', '') AS base, count(*) AS n, count(*) FILTER (access IN ('no', 'private')) AS shut, round(sum({t.sql_metric('maxweight')}), 4) AS tonnes,
round(sum({g.hav('59.0::DOUBLE', '10.0::DOUBLE', 'la', '10.5::DOUBLE', '6371000.0::DOUBLE')}), 1) AS metres FROM x GROUP BY 1"""

PAIRS = [
    (s10_u6_leaf_selection, O_S10), (s11_s12_export_documents, O_S11), (s16_height_grids, O_S16), (k2_k10_layer_sinks, o_k2()), (k11_publish_projection, O_K11), (f25_f30_exclusions, O_F25), (x27_stop_roles, O_X27), (m26_tile_grid, O_M26),
    (j9_segments_in_rings, O_J9), (j11_ambiguous_lookup, O_J11), (j27_superroute_chain, O_J27), (j30_j32_a19_overrides, O_J30), (a5_exclusion_counts, O_A5), (a16_u5_road_cells, O_A16), (u2_u3_merged_parts, O_U2),
    (t5_terminal_order, O_T5), (t10_admin_outlines, O_T10), (g6_leaf_set, O_G6), (g6_adjacency_warnings, O_G6W), (f27_class_compatibility, O_F27), (j39_flagged_midpoints, O_J39), (a13_gap_rows, O_A13), (a12_tag_combinations, O_A12C),
    (f34_x30_tag_subset, O_F34), (a27_merged_counters, O_A27), (j38_corridor_load, O_J38), (sql_functions, O_SQL),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS}
