"""Queries on parsing rules and sources: S2-S14, X10-X19, X24-X31, F20-F29, T8-T12, J24-J26, W8, A32."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.functions import places, radio
from waymill.operators.shared import shared_path, table
from waymill.queries.views import pick, view, with_views

C = "c_custkey"
FREQ = {"145.600": 145600000, "434,725 MHz": 434725000, "145600000": 145600000, "x; 439.1 mhz": 439100000, "600000 Hz": 600000, "": None, "abc": None, "145.7;": 145700000, "about 29.6": 29600000}
SHIFT = {"-0.6": -600000, "600": None, "7,6 MHz": 7600000, "-9400000": -9400000, "": None, "900 MHz; -1.6": -1600000}
TONE = {"88.5": (88.5, None), "D023N": (None, "D023N"), "DCS 047": (None, "047"), "none": (None, None), "123,0": (123.0, None), "-": (None, None), "tone": (None, "tone"), "023I": (None, "023I")}
MODES = {"16K0F3E": "FM", "7k60FXE; 16K0F3E": "DMR,FM", "9K36F7W;9K36F7W": "C4FM", "X1": "X1", "20K0F2D": "APRS", "": ""}
KEY = {"yes": (True, None), "no": (False, None), "LA5XR": (True, "LA5XR"), "": (True, None), "disused": (False, None)}
STATUS = {"active": True, "off_air": False, "Retired": False, "": True, "maybe": True}
LEAVES = ["Norway_Hedmark", "Latvia", "US_Texas_West", "Canada_Ontario", "Germany_Bavaria", "World_Coasts", "Brazil_North", "Sweden_Norra Sverige", "Europe_All", "Peru"]
PATHS = ["europe/norway/ostlandet", "/north-america/us/texas/", "europe/great-britain", "asia", "", " europe/french_guiana ", "Asia/Japan/Kanto!"]


def cust(spark: SparkSession, sf: str, **columns) -> DataFrame:
    """Customers with text columns picked by key."""
    made = ", ".join(f"{pick(f'{C} * {m} + {C} % 3', v)} AS {n}" for n, (m, v) in columns.items())
    return spark.sql(f"SELECT {C} AS id, {made} FROM {{customer}}", customer=table(spark, sf, "customer"))


def sql_cust(**columns) -> str:
    return f"WITH c AS (SELECT {C} AS id, " + ", ".join(f"{pick(f'{C} * {m} + {C} % 3', v)} AS {n}" for n, (m, v) in columns.items()) + " FROM customer)"


def case(column: str, table_: dict, kind: str) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else repr(v)
    return f"CAST(CASE {column} " + " ".join(f"WHEN '{k}' THEN {lit(v)}" for k, v in table_.items()) + f" END AS {kind})"


def c(name):
    return F.col(name)


_RADIO = {"freq": (1, [*FREQ, None]), "shift": (5, [*SHIFT, None]), "tone": (7, [*TONE, None]), "modes": (11, [*MODES, None]), "flag": (13, [*KEY, None]), "status": (17, [*STATUS, None])}


def x11_x13_radio_fields(spark, sf):
    """Frequency, shift, input, tone, modes, enabled and active of each record; aprs and simplex marked."""
    r = cust(spark, sf, **_RADIO)
    out, move = radio.first_hertz(c("freq")), radio.shift(c("shift"))
    return r.select(
        "id", out.alias("output_hz"), move.alias("shift_hz"), (out + move).alias("input_hz"), *[v.alias(k) for k, v in radio.tone(c("tone")).items()], F.array_join(radio.modes(c("modes")), ",").alias("modes"),
        *[v.alias(k) for k, v in radio.enabled(c("flag")).items()], radio.active(c("status")).alias("active"), radio.entry_kind(F.array_join(radio.modes(c("modes")), " "), c("status")).alias("kind"),
    )


O_X11 = sql_cust(**_RADIO) + f""" SELECT id, {case('freq', FREQ, 'BIGINT')} AS output_hz, {case('shift', SHIFT, 'BIGINT')} AS shift_hz, {case('freq', FREQ, 'BIGINT')} + {case('shift', SHIFT, 'BIGINT')} AS input_hz,
{case('tone', {k: v[0] for k, v in TONE.items()}, 'DOUBLE')} AS ctcss_hz, {case('tone', {k: v[1] for k, v in TONE.items()}, 'VARCHAR')} AS code, coalesce({case('modes', MODES, 'VARCHAR')}, '') AS modes,
coalesce({case('flag', {k: v[0] for k, v in KEY.items()}, 'BOOLEAN')}, false) AS enabled, {case('flag', {k: v[1] for k, v in KEY.items()}, 'VARCHAR')} AS callsign, coalesce({case('status', STATUS, 'BOOLEAN')}, true) AS active,
CASE WHEN modes = '20K0F2D' THEN 'aprs' ELSE 'repeater' END AS kind FROM c"""


def s3_x14_text_lines(spark, sf):
    """Element lines made from customers and parsed back, with escapes in the tags."""
    lines = table(spark, sf, "customer").select(
        F.concat(F.lit("n"), c("c_custkey"), F.lit(" v"), c("c_nationkey") + 1, F.lit(" t2024-01-01T00:00:00Z Tname="), F.replace(c("c_name"), F.lit("#"), F.lit("%23%")), F.lit(",seg="), F.replace(c("c_mktsegment"), F.lit("E"), F.lit("%20ac%")),
                 F.lit(",p=first,freq=145,6,p=%25%20% x"), c("c_custkey") % 180, F.lit(".5 y-"), c("c_custkey") % 90, F.lit(".25 Nn1,n"), c("c_custkey"), F.lit(" Mn7@stop%20%a,r9,w"), c("c_custkey"), F.lit("@")).alias("line")
    )
    o = lines.select(*[v.alias(k) for k, v in radio.opl(c("line")).items()])
    return o.select("type", "id", "version", "lat", "lon", c("tags")["name"].alias("name"), c("tags")["seg"].alias("seg"), c("tags")["freq"].alias("freq"), c("tags")["p"].alias("p"), F.array_join(c("nodes").cast("array<string>"), ",").alias("nodes"), F.array_join(F.transform("members", lambda m: F.concat(m["type"], m["ref"], F.lit("@"), m["role"])), ",").alias("members"))


O_S3 = """SELECT 'node' AS type, c_custkey AS id, (c_nationkey + 1)::INT AS version, -((c_custkey % 90) + 0.25)::DOUBLE AS lat, ((c_custkey % 180) + 0.5)::DOUBLE AS lon, c_name AS name, replace(c_mktsegment, 'E', '€') AS seg, '145,6' AS freq, '%20%' AS p,
'1,' || c_custkey AS nodes, 'n7@stop a,r9@,w' || c_custkey || '@' AS members FROM customer"""


def s2_xml_elements(spark, sf):
    """Nodes written as XML, one element a line, and scanned again by a declared schema."""
    p = view(spark, sf, "v_points")
    path = shared_path(spark, "xml")
    row = F.concat(F.lit('<node id="'), "point_id", F.lit('" lat="'), c("lat"), F.lit('" lon="'), c("lon"), F.lit('"><tag k="place" v="p'), c("point_id") % 5, F.lit('"/><tag k="name" v="P"/></node>'))
    p.select(row.alias("value")).write.text(path)
    kind = "_id long, _lat double, _lon double, tag array<struct<_k string, _v string>>"
    n = spark.read.text(path).select(F.from_xml("value", kind).alias("e")).select("e.*")
    tags = F.map_from_entries(F.transform("tag", lambda t: F.struct(t["_k"], t["_v"])))
    return n.groupBy(tags["place"].alias("place")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("_lat"), 4).alias("lat"))


O_S2 = with_views("v_points") + " x AS (SELECT 1) SELECT 'p' || (point_id % 5) AS place, count(*) AS n, round(sum(lat), 4) AS lat FROM v_points GROUP BY 1"


def s4_x10_road_features(spark, sf):
    """Road features as JSON Lines: class, bridge and tunnel from type strings; one-point features dropped."""
    o = table(spark, sf, "orders")
    path = shared_path(spark, "features")
    kinds = pick("o_orderkey", ["highway-primary-bridge", "highway-service-driveway", "building", "Highway-x", "highway-track-tunnel", "highway-residential"])
    made = spark.sql(f"SELECT o_orderkey AS feature_id, array('psurface-paved', {kinds}) AS types, transform(sequence(1, 1 + CAST(o_orderkey % 3 AS INT)), i -> named_struct('lat', 59.0 + i, 'lon', 10.0, 'alt_m', 1.5)) AS points FROM {{o}}", o=o)
    made.write.json(path)
    f = spark.read.schema("feature_id long, types array<string>, points array<struct<lat double, lon double, alt_m double>>").json(path).filter(F.size("points") >= 2)
    raw = F.lower(F.substr(F.get(F.filter("types", lambda t: t.startswith("highway-")), F.lit(0)), F.lit(9)))
    return f.select(F.regexp_replace(raw, "-(bridge|tunnel)$", "").alias("class"), raw.endswith("-bridge").alias("bridge"), raw.endswith("-tunnel").alias("tunnel")).groupBy("class", "bridge", "tunnel").agg(F.count(F.lit(1)).alias("n"))


_K = pick("o_orderkey", ["primary", "service-driveway", None, None, "track", "residential"])
O_S4 = f"""WITH k AS (SELECT {_K} AS class, o_orderkey % 6 AS m FROM orders WHERE o_orderkey % 3 >= 1) SELECT class, CASE WHEN class IS NOT NULL THEN m = 0 END AS bridge, CASE WHEN class IS NOT NULL THEN m = 4 END AS tunnel, count(*) AS n FROM k GROUP BY ALL"""


def s5_s6_json_documents(spark, sf):
    """Ferry elements nested in JSON documents: id forms, points from where they are given, ends."""
    o = table(spark, sf, "orders")
    path = shared_path(spark, "elements")
    made = spark.sql(
        """SELECT o_custkey AS doc, collect_list(named_struct('id', CASE o_orderkey % 3 WHEN 0 THEN concat('way/', o_orderkey) WHEN 1 THEN concat('w', o_orderkey) ELSE CAST(o_orderkey AS STRING) END,
        'geometry', CASE WHEN o_orderkey % 2 = 0 THEN array(named_struct('lat', 1.0D + o_orderkey, 'lon', 2.0D), named_struct('lat', 3.0D + o_orderkey, 'lon', 4.0D)) END,
        'center', named_struct('lat', 9.0D + o_orderkey, 'lon', 8.0D))) AS elements FROM {o} GROUP BY o_custkey""",
        o=o,
    )
    made.write.json(path)
    e = spark.read.schema("doc long, elements array<struct<id string, geometry array<struct<lat double, lon double>>, center struct<lat double, lon double>>>").json(path).select(F.explode("elements").alias("e"))
    points = F.coalesce(c("e.geometry"), F.array("e.center"))
    return e.select(F.regexp_extract(c("e.id"), "([0-9]+)$", 1).cast("long").alias("way_id"), F.size(points).alias("n"), F.element_at(points, 1)["lat"].alias("first_lat"), F.element_at(points, -1)["lat"].alias("last_lat"))


O_S5 = "SELECT o_orderkey AS way_id, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END::INT AS n, (o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 9 END)::DOUBLE AS first_lat, (o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 9 END)::DOUBLE AS last_lat FROM orders"


def s7_polygon_text(spark, sf):
    """Polygon files, one a region: rings numbered by their headers, holes marked, vertices counted."""
    p = view(spark, sf, "v_ring_points")
    path = shared_path(spark, "poly")
    ring = p.groupBy("region_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("vertex", "lat", "lon"))), lambda v: F.concat(F.lit("  "), v["lon"], F.lit(" "), v["lat"])), "\n").alias("body"))
    ring.select(F.concat(F.lit("r"), "region_id", F.lit("\n1\n"), "body", F.lit("\nEND\n!2\n"), "body", F.lit("\nEND\nEND\n@@")).alias("value")).write.text(path)
    text = spark.read.text(path, lineSep="@@\n").filter("value <> ''")
    lines = text.select(F.substring_index("value", "\n", 1).alias("name"), F.posexplode(F.split("value", "\n")).alias("no", "line")).filter("no > 0 and line <> ''")
    order = Window.partitionBy("name").orderBy("no")
    at = lines.withColumn("ring_no", F.sum((~c("line").startswith("  ") & (c("line") != "END")).cast("int")).over(order)).filter("line like '  %'")
    xy = F.split(F.trim("line"), " ")
    return at.groupBy("name", "ring_no").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(xy[1].cast("double")), 4).alias("lat"))


O_S7 = with_views("v_ring_points") + " x AS (SELECT 1) SELECT 'r' || region_id AS name, k AS ring_no, count(*) AS n, round(sum(lat), 4) AS lat FROM v_ring_points, (SELECT unnest([1, 2])::BIGINT AS k) GROUP BY 1, 2"


def s8_region_list(spark, sf):
    """Region list lines: comments dropped, the first line of an id wins; of a repeated option the last value, terrain classes joined."""
    k = c("c_custkey")
    more = F.when(k % 4 == 1, " graph_max_ratio=7.5 terrain_class=polar_sparse+Dense_Network,x").when(k % 4 == 2, F.concat(F.repeat(F.lit(" note=1"), F.lit(120)), F.lit(" GRAPH_MAX_RATIO=2"))).otherwise("")
    lines = table(spark, sf, "customer").select(
        k.alias("no"), F.when(k % 9 == 0, F.lit("# note")).otherwise(F.concat(F.lit("  r"), k % 60, F.lit(" geofabrik:europe/x"), k, F.lit("  graph_max_ratio="), c("c_nationkey"), F.lit(" terrain_class=dense_network"), more)).alias("line")
    )
    words = F.split(F.trim("line"), r"\s+")
    kept = lines.filter(~F.trim(c("line")).startswith("#") & (F.size(words) >= 2)).select("no", words[0].alias("region_id"), words[1].alias("source"), places.line_options(F.slice(words, 3, F.size(words))).alias("opts"))
    first = kept.withColumn("r", F.row_number().over(Window.partitionBy("region_id").orderBy("no"))).filter("r = 1")
    return first.select("region_id", "source", c("opts.values")["graph_max_ratio"].cast("double").alias("graph_max"), F.array_join("opts.terrain", ",").alias("terrain"))


O_S8 = """SELECT 'r' || (c_custkey % 60) AS region_id, 'geofabrik:europe/x' || min(c_custkey) AS source, CASE min(c_custkey) % 4 WHEN 1 THEN 7.5 WHEN 2 THEN 2 ELSE arg_min(c_nationkey, c_custkey) END::DOUBLE AS graph_max,
CASE WHEN min(c_custkey) % 4 = 1 THEN 'dense_network,polar_sparse,x' ELSE 'dense_network' END AS terrain FROM customer WHERE c_custkey % 9 <> 0 GROUP BY c_custkey % 60"""


NEWEST = 3


def s14_t7_page_links(spark, sf):
    """Distinct absolute links of each page, and the newest three: highest numeric last part first, then by text from the end."""
    p = table(spark, sf, "pages")
    links = p.select("page_id", "url", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))).alias("href"))
    base = F.regexp_extract("url", "^(https?://[^/]*)", 1)
    link = F.when(c("href").startswith("/"), F.concat(base, "href")).otherwise(c("href"))
    last = F.regexp_extract(F.regexp_replace("href", "[?#].*$", ""), "([^/]*)$", 1)
    number = F.when(last.rlike(r"^[0-9]{1,18}(\.xml)?$"), F.regexp_replace(last, r"\.xml$", "").cast("long")).otherwise(F.lit(-1))
    made = links.select("page_id", link.alias("link"), number.alias("number")).groupBy("page_id", "link").agg(F.max("number").alias("number"))
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("number"), F.desc("link")))
    ranked = made.withColumn("rank", rank)
    newest = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c("rank") <= NEWEST, F.struct("rank", "link")))), lambda x: x["link"]), " ")
    return ranked.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), newest.alias("newest"))


O_S14 = r"""WITH h AS (SELECT page_id, url, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS href FROM pages), b AS (SELECT page_id, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^(https?://[^/]*)', 1) || href ELSE href END AS link, regexp_extract(regexp_replace(href, '[?#].*$', ''), '([^/]*)$', 1) AS last FROM h),
l AS (SELECT page_id, link, max(CASE WHEN regexp_matches(last, '^[0-9]{1,18}(\.xml)?$') THEN regexp_replace(last, '\.xml$', '')::BIGINT ELSE -1 END) AS number FROM b GROUP BY 1, 2)
SELECT page_id, count(*) AS n, array_to_string(list(link ORDER BY number DESC, link DESC)[1:3], ' ') AS newest FROM l GROUP BY 1"""


def s13_document_validation(spark, sf):
    """Publications judged by their first 8 KiB: XML, and a version marker (here the page's language)."""
    p = table(spark, sf, "pages")
    head = F.substring("html", 1, 8192)
    lang = F.regexp_extract(head, '<html lang="([a-z]+)"', 1)
    status = F.when(~head.startswith("<"), "not_xml").when(lang == "", "no_version").when(lang.isin("en", "de"), "ok").otherwise("wrong_version")
    return p.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("chars"))


O_S13 = r"""WITH p AS (SELECT html, regexp_extract(substr(html, 1, 8192), '<html lang="([a-z]+)"', 1) AS l FROM pages) SELECT CASE WHEN html NOT LIKE '<%' THEN 'not_xml' WHEN l = '' THEN 'no_version' WHEN l IN ('en', 'de') THEN 'ok' ELSE 'wrong_version' END AS status, count(*) AS n, sum(length(html))::BIGINT AS chars FROM pages JOIN p USING (html) GROUP BY 1"""
O_S13 = O_S13.replace("FROM pages JOIN p USING (html) GROUP", "FROM p GROUP")


def x17_x19_poi_classes(spark, sf):
    """Categories of each node as text and mask, back from the mask, icon and weekly-rest rule."""
    n = view(spark, sf, "v_nodes")
    t = {k: c(k) for k in ("amenity", "tourism", "natural", "operator", "network", "shop", "leisure", "highway", "hgv", "name")}
    cats = places.poi_categories(t)
    icon = places.icon_key(t)
    mask = places.category_mask(cats)
    return n.select("node_id", F.array_join(cats, ",").alias("categories"), mask.alias("mask"), (F.array_join(places.from_mask(mask), ",") == F.array_join(cats, ",")).alias("same"), icon.alias("icon"), places.weekly_rest(c("highway"), icon, c("name")).alias("weekly"))


def _b(test, name):
    return f"CASE WHEN {test} THEN '{name}' END"


_HUT = "tourism IN ('wilderness_hut', 'alpine_hut')"
_NET = " OR ".join(f"coalesce(operator, network) LIKE '%{n}%'" for n in places.HUT_NETWORKS)
CATEGORY_SQL = {
    "water": "amenity = 'drinking_water' OR \"natural\" = 'spring'", "restroom": "amenity = 'toilets'", "cabin": "tourism IN ('alpine_hut', 'camp_site', 'wilderness_hut', 'hostel') OR amenity = 'shelter'",
    "overnight": "tourism IN ('alpine_hut', 'camp_site', 'wilderness_hut', 'hostel') OR amenity = 'shelter'", "tent": "tourism = 'camp_site' OR amenity = 'camping'", "general": "amenity IN ('cafe', 'restaurant', 'museum') OR tourism = 'viewpoint'",
    "network_hut": f"{_HUT} AND ({_NET})", "brewery": "shop = 'alcohol'", "fishing": "leisure = 'fishing' OR shop = 'fishing'", "rest_area": "highway IN ('rest_area', 'services') OR (amenity = 'parking' AND hgv IS NOT NULL)", "lodging": "tourism IN ('hotel', 'hostel')",
}
O_X17 = with_views("v_nodes") + " x AS (SELECT *, {ic} AS icon FROM v_nodes) SELECT node_id, concat_ws(',', {a}) AS categories, ({m})::INT AS mask, true AS same, icon, coalesce(highway = 'services', false) OR coalesce(icon LIKE '%services%', false) OR coalesce(lower(name) LIKE '%service%', false) AS weekly FROM x".format(
    ic="coalesce(" + ", ".join(f"'{k}-' || \"{k}\"" for k in ("amenity", "tourism", "shop", "leisure", "highway", "natural")) + ")", a=", ".join(_b(v, k) for k, v in CATEGORY_SQL.items()), m=" + ".join(f"CASE WHEN {v} THEN {1 << i} ELSE 0 END" for i, v in enumerate(CATEGORY_SQL.values()))
)


def x15_t8_search_stubs(spark, sf):
    """Named nodes and way centroids as sorted, distinct search rows."""
    n, refs, w = view(spark, sf, "v_nodes"), view(spark, sf, "v_way_nodes"), view(spark, sf, "v_ways")
    made = places.named({k: c(k) for k in ("name", "shop", "amenity", "highway", "natural", "leisure", "tourism")})
    own = n.select(*[v.alias(k) for k, v in made.items()], F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")).filter("name is not null")
    mid = refs.join(n.select("node_id", "lat", "lon"), "node_id").groupBy("way_id").agg(F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"))
    lines = w.filter("name <> '' and highway is null").select("way_id", "name").join(mid, "way_id").select("name", F.lit("named").alias("kind"), "lat", "lon")
    return own.unionByName(lines).distinct()


O_X15 = with_views("v_nodes", "v_way_nodes", "v_ways") + """ m AS (SELECT way_id, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM v_way_nodes JOIN v_nodes USING (node_id) GROUP BY 1)
SELECT name, coalesce('shop:' || shop, 'amenity:' || amenity, 'highway:' || highway, CASE WHEN "natural" = 'peak' THEN 'natural:peak' END, 'leisure:' || leisure, 'tourism:' || tourism, 'named') AS kind, round(lat, 6) AS lat, round(lon, 6) AS lon FROM v_nodes WHERE name IS NOT NULL
UNION SELECT w.name, 'named', m.lat, m.lon FROM v_ways w JOIN m USING (way_id) WHERE w.name <> '' AND w.highway IS NULL"""

ROUTE = {"route": (3, ["hiking", "foot", "bicycle", "mtb", "horse", "ski", "canoe", None, "road", "running"]), "network": (7, ["lwn", "NCN", None, "rcn", "iwn", None]), "title": (11, ["Pilgrim way", "R1", None, ""]), "ref": (13, [None, "9", ""])}


def relations(spark, sf) -> DataFrame:
    return cust(spark, sf, **ROUTE)


def f20_x16_t11_named_routes(spark, sf):
    """Route relations with kind, name or reference, and the first node of their first member way."""
    r = relations(spark, sf)
    name = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("ref"), F.lit("")))
    kind = places.route_kind(c("route"), c("network"), F.coalesce(F.lower("title").contains("pilgrim"), F.lit(False)))
    kept = r.select("id", kind.alias("kind"), name.alias("name")).filter("name is not null and kind <> 'other'")
    first_way = table(spark, sf, "orders").groupBy(c("o_custkey").alias("id")).agg(F.min("o_orderkey").alias("way_id"))
    first_node = view(spark, sf, "v_way_nodes").filter("pos = 1").select("way_id", "node_id")
    return kept.join(first_way, "id").join(first_node, "way_id").select("id", "kind", "name", "way_id", "node_id")


O_F20 = sql_cust(**ROUTE) + ", " + with_views("v_way_nodes").removeprefix("WITH ") + """ k AS (SELECT id, coalesce(nullif(trim(title), ''), nullif(trim(ref), '')) AS name, CASE WHEN title LIKE 'Pilgrim%' THEN 'pilgrimage' WHEN route IN ('hiking', 'foot') THEN 'hiking' WHEN route IN ('bicycle', 'mtb', 'horse', 'running', 'ski', 'canoe') THEN route ELSE 'other' END AS kind FROM c),
f AS (SELECT o_custkey AS id, min(o_orderkey) AS way_id FROM orders GROUP BY 1) SELECT id, kind, name, way_id, node_id FROM k JOIN f USING (id) JOIN v_way_nodes USING (way_id) WHERE pos = 1 AND name IS NOT NULL AND kind <> 'other'"""

LEAF = {"leaf": (3, LEAVES), "path": (7, PATHS), "boundary": (5, ["administrative", None, "water"]), "level": (11, ["6", "8", "4", "x", None])}


def x24_x26_region_names(spark, sf):
    """Keys, prefixes, slugs and names of paths; continent, elevation class and threshold of leaves; admin level."""
    r = cust(spark, sf, **LEAF)
    prefix = places.country_prefix(F.trim("path"))
    return r.select(
        "id", places.region_key(c("path")).alias("key"), prefix.alias("prefix"), places.slug(prefix).alias("slug"), places.display_name(prefix).alias("shown"), places.humanised(c("leaf")).alias("human"), places.continent(c("leaf")).alias("continent"),
        places.elevation_class(c("leaf")).alias("height_class"), places.elevation_threshold(c("leaf"), F.lit(40.0) + c("id") % 30, 2).alias("threshold"), places.admin_level(c("boundary"), F.lit("A"), c("level")).alias("level"),
    )


_PREFIX = {"europe/norway/ostlandet": "europe/norway", "/north-america/us/texas/": "north-america/us", "europe/great-britain": "europe/great-britain", " europe/french_guiana ": "europe/french_guiana", "Asia/Japan/Kanto!": "Asia/Japan"}
_KEYS = {"europe/norway/ostlandet": "europe_norway_ostlandet", "/north-america/us/texas/": "north-america_us_texas", "europe/great-britain": "europe_great-britain", "asia": "asia", "": "unknown", " europe/french_guiana ": "europe_french_guiana", "Asia/Japan/Kanto!": "asia_japan_kanto"}
_SLUG = {"europe/norway/ostlandet": "norway", "/north-america/us/texas/": "us", "europe/great-britain": "great-britain", " europe/french_guiana ": "french-guiana", "Asia/Japan/Kanto!": "japan"}
_SHOWN = {"europe/norway/ostlandet": "Norway", "/north-america/us/texas/": "Us", "europe/great-britain": "Great Britain", " europe/french_guiana ": "French_guiana", "Asia/Japan/Kanto!": "Japan"}
_CONT = dict(zip(LEAVES, ["nordic", "world", "world", "world", "europe", "world", "world", "nordic", "europe", "world"], strict=True))
_CLS = dict(zip(LEAVES, ["high_res", "high_res_20m", "high_res", "mixed", "copernicus_only", "copernicus_only", "copernicus_only", "high_res", "copernicus_only", "copernicus_only"], strict=True))
O_X24 = sql_cust(**LEAF) + f""" SELECT id, {case('path', _KEYS, 'VARCHAR')} AS "key", {case('path', _PREFIX, 'VARCHAR')} AS prefix, {case('path', _SLUG, 'VARCHAR')} AS slug, {case('path', _SHOWN, 'VARCHAR')} AS shown, replace(leaf, '_', ' ') AS human, {case('leaf', _CONT, 'VARCHAR')} AS continent,
{case('leaf', _CLS, 'VARCHAR')} AS height_class, CASE WHEN {case('leaf', _CLS, 'VARCHAR')} = 'copernicus_only' AND 40 + id % 30 < 60 THEN 5.0::DOUBLE ELSE 2 END AS threshold, CASE WHEN boundary = 'administrative' THEN {case('level', {'6': 6, '8': 8}, 'INT')} END AS level FROM c"""


def a32_x31_country_plans(spark, sf):
    """Regions grouped by two-segment prefix, with the hash of each group's sorted content."""
    r = cust(spark, sf, **LEAF).withColumn("prefix", places.country_prefix(F.trim("path"))).filter("prefix is not null")
    return r.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.expr("listagg(concat_ws('|', id, leaf), ';') within group (order by concat_ws('|', id, leaf))").cast("binary"), 256).alias("hash"))


O_A32 = sql_cust(**LEAF) + f" SELECT {case('path', _PREFIX, 'VARCHAR')} AS prefix, count(*) AS n, sha256(string_agg(id || '|' || leaf, ';' ORDER BY id || '|' || leaf)) AS hash FROM c WHERE {case('path', _PREFIX, 'VARCHAR')} IS NOT NULL GROUP BY 1"


def j24_x30_locator_join(spark, sf):
    """API rows joined to map markers by locator: matched, one side only; later markers win."""
    api = table(spark, sf, "customer").select(c("c_custkey").alias("locator"), F.concat_ws(", ", F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name").alias("place"))
    marks = table(spark, sf, "orders").groupBy((c("o_custkey") * 2).alias("locator")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("note"))
    both = api.join(marks, "locator", "full_outer")
    side = F.when(c("place").isNull(), "map_only").when(c("note").isNull(), "api_only").otherwise("matched")
    return both.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("place"), F.max("note").alias("note"))


O_J24 = """WITH a AS (SELECT c_custkey AS locator, concat_ws(', ', nullif(c_mktsegment, 'BUILDING'), c_name) AS place FROM customer), m AS (SELECT o_custkey * 2 AS locator, arg_max(o_orderpriority, o_orderkey) AS note FROM orders GROUP BY 1)
SELECT CASE WHEN place IS NULL THEN 'map_only' WHEN note IS NULL THEN 'api_only' ELSE 'matched' END AS side, count(*) AS n, max(place) AS place, max(note) AS note FROM a FULL JOIN m USING (locator) GROUP BY 1"""


def j25_f23_network_membership(spark, sf):
    """Nodes with the networks (customers) whose ways pass them, for networks with at least three ways."""
    o = table(spark, sf, "orders").select(c("o_custkey").alias("network_id"), c("o_orderkey").alias("way_id"))
    nets = o.groupBy("network_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3").select("network_id")
    members = o.join(nets, "network_id").join(view(spark, sf, "v_way_nodes").select("way_id", "node_id").distinct(), "way_id")
    return members.groupBy("node_id").agg(F.count_distinct("network_id").alias("n_networks"), F.min("network_id").alias("first_network"))


O_J25 = with_views("v_way_nodes") + """ n AS (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 3) SELECT node_id, count(DISTINCT o_custkey) AS n_networks, min(o_custkey) AS first_network FROM orders JOIN n USING (o_custkey) JOIN v_way_nodes ON way_id = o_orderkey GROUP BY 1"""


def j26_way_centroids(spark, sf):
    """Mean of a way's distinct nodes, beside the mean of all refs (building rule)."""
    at = view(spark, sf, "v_way_nodes").join(view(spark, sf, "v_nodes").select("node_id", "lat", "lon"), "node_id")
    distinct = at.select("way_id", "node_id", "lat").distinct().groupBy("way_id").agg(F.round(F.avg("lat"), 6).alias("lat"), F.count(F.lit(1)).alias("n_nodes"))
    return distinct.join(at.groupBy("way_id").agg(F.round(F.avg("lat"), 6).alias("ref_lat"), F.count(F.lit(1)).alias("n_refs")), "way_id")


O_J26 = with_views("v_way_nodes", "v_nodes") + """ a AS (SELECT way_id, node_id, lat FROM v_way_nodes JOIN v_nodes USING (node_id)), d AS (SELECT way_id, round(avg(lat), 6) AS lat, count(*) AS n_nodes FROM (SELECT DISTINCT * FROM a) GROUP BY 1)
SELECT d.*, ref_lat, n_refs FROM d JOIN (SELECT way_id, round(avg(lat), 6) AS ref_lat, count(*) AS n_refs FROM a GROUP BY 1) USING (way_id)"""

PAIRS = [
    (x11_x13_radio_fields, O_X11), (s3_x14_text_lines, O_S3), (s2_xml_elements, O_S2), (s4_x10_road_features, O_S4), (s5_s6_json_documents, O_S5), (s7_polygon_text, O_S7), (s8_region_list, O_S8), (s14_t7_page_links, O_S14), (s13_document_validation, O_S13),
    (x17_x19_poi_classes, O_X17), (x15_t8_search_stubs, O_X15), (f20_x16_t11_named_routes, O_F20), (x24_x26_region_names, O_X24), (a32_x31_country_plans, O_A32), (j24_x30_locator_join, O_J24), (j25_f23_network_membership, O_J25), (j26_way_centroids, O_J26),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS}
