"""Queries on nested and XML documents: S2, S5, S6, S9, S13, A25."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymill.operators.shared import shared_path, table
from waymill.queries.views import view, with_views
from waymill.sources import documents

c = F.col


def s9_a25_country_tree(spark, sf):
    """Trees of unlike depth, one a group of regions: leaves with sizes and checksums, summed for every node above them.

    A customer is a leaf; every third stands one level deeper, every seventh has no id, some no size, some the id of
    another; nations without customers are empty groups.
    """
    made = spark.sql(
        """WITH leaf AS (SELECT c_nationkey AS n, c_custkey AS k, concat('{{"x": 1', CASE WHEN c_custkey % 7 = 3 THEN '' ELSE concat(', "id": "L', CAST(floor(c_custkey / 2) * 2 AS INT), '"') END,
              CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat(', "s": ', c_custkey) END, ', "sha1_base64": "h', c_custkey % 4, '", "affiliations": ["a", "b"]}}') AS j FROM {customer}),
           placed AS (SELECT n, k, CASE WHEN k % 3 = 0 THEN concat('{{"id": "S', k, '", "g": [', j, ', 5]}}') ELSE j END AS j FROM leaf),
           nation AS (SELECT n_regionkey AS r, n_nationkey AS n, concat('{{"id": "', n_name, '", "g": [', coalesce(array_join(transform(array_sort(collect_list(struct(k, j))), x -> x.j), ', '), ''), ']}}') AS j
             FROM {nation} LEFT JOIN placed ON n = n_nationkey GROUP BY n_regionkey, n_nationkey, n_name)
           SELECT r AS doc, concat('{{"v": 3, "id": "root", "g": [', array_join(transform(array_sort(collect_list(struct(n, j))), x -> x.j), ', '), ']}}') AS raw FROM nation GROUP BY r""",
        customer=table(spark, sf, "customer"), nation=table(spark, sf, "nation"),
    )
    nodes = documents.tree_nodes(made)
    leaves = documents.tree_leaves(nodes)
    totals = documents.tree_totals(nodes, leaves)
    return totals.groupBy("doc", "id", F.size("path").alias("depth")).agg(F.sum("leaves").alias("leaves"), F.sum("size").alias("size"))


O_S9 = """WITH leaf AS (SELECT n_regionkey AS doc, n_nationkey AS n, n_name, c_custkey AS k, c_custkey % 3 = 0 AS deep, 'L' || (c_custkey // 2 * 2) AS id, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS s
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 7 <> 3),
last AS (SELECT * FROM leaf QUALIFY row_number() OVER (PARTITION BY doc, id ORDER BY n DESC, k DESC) = 1),
groups AS (SELECT DISTINCT n_regionkey AS doc, 'root' AS id, 0 AS depth FROM nation UNION SELECT n_regionkey, n_name, 1 FROM nation UNION SELECT n_regionkey, 'S' || c_custkey, 2 FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 3 = 0),
sums AS (SELECT doc, 'root' AS id, 0 AS depth, count(*) AS leaves, sum(s) AS size FROM last GROUP BY 1 UNION ALL SELECT doc, n_name, 1, count(*), sum(s) FROM last GROUP BY 1, 2 UNION ALL SELECT doc, 'S' || k, 2, 1, s FROM last WHERE deep)
SELECT doc, id, depth, coalesce(leaves, 0)::BIGINT AS leaves, coalesce(size, 0)::BIGINT AS size FROM groups LEFT JOIN sums USING (doc, id, depth)"""


def s6_ferry_elements(spark, sf):
    """Points of ferry elements in order: own geometry, members' geometry and places, own place, centre; with both ends."""
    made = spark.sql(
        """SELECT o_custkey AS doc, concat('{{"elements": [', array_join(collect_list(concat('{{"type": "', CASE WHEN k % 3 = 0 THEN 'relation' ELSE 'way' END, '", "id": ', k,
             CASE WHEN k % 11 = 0 THEN ', "geometry": "none"' WHEN k % 2 = 0 THEN concat(', "geometry": [{{"lat": ', k, '.25, "lon": 2}}, {{"lat": 7}}, {{"lat": ', k, '.5, "lon": 4.5}}]') ELSE '' END,
             CASE WHEN k % 3 = 0 THEN concat(', "members": [{{"ref": 1, "geometry": [{{"lat": 1, "lon": ', k, '}}], "lat": 2, "lon": ', k, '}}, 6, {{"lat": 3, "lon": ', k, '.5}}]') ELSE '' END,
             CASE WHEN k % 5 = 0 THEN concat(', "lat": 5, "lon": ', k, '.125') ELSE '' END, CASE WHEN k % 7 < 4 THEN concat(', "center": {{"lat": 9, "lon": ', k, '}}') ELSE '' END, '}}')), ', '), ']}}') AS raw
           FROM (SELECT o_custkey, o_orderkey AS k FROM {o}) GROUP BY o_custkey""",
        o=table(spark, sf, "orders"),
    )
    e = documents.elements(made).select(F.try_variant_get("element", F.lit("$.id"), "long").alias("id"), F.try_variant_get("element", F.lit("$.type"), "string").alias("type"), documents.element_points(c("element")).alias("p"))
    end = lambda at: F.try_element_at("p", F.lit(at))
    return e.select("id", "type", F.size("p").alias("n"), end(1)["lat"].alias("first_lat"), end(1)["lon"].alias("first_lon"), end(-1)["lat"].alias("last_lat"), end(-1)["lon"].alias("last_lon"))


O_S6 = """WITH e AS (SELECT o_orderkey AS k, CASE WHEN k % 2 = 0 AND k % 11 <> 0 THEN [{'lat': k + 0.25, 'lon': 2.0}, {'lat': k + 0.5, 'lon': 4.5}] ELSE [] END AS g, CASE WHEN k % 3 = 0 THEN [{'lat': 1.0, 'lon': k + 0.0}, {'lat': 2.0, 'lon': k + 0.0}, {'lat': 3.0, 'lon': k + 0.5}] ELSE [] END AS m,
  CASE WHEN k % 5 = 0 THEN [{'lat': 5.0, 'lon': k + 0.125}] ELSE [] END AS s, CASE WHEN k % 7 < 4 THEN [{'lat': 9.0, 'lon': k + 0.0}] ELSE [] END AS z FROM orders), p AS (SELECT k, list_concat(list_concat(g, m), list_concat(s, z)) AS p FROM e)
SELECT k AS id, CASE WHEN k % 3 = 0 THEN 'relation' ELSE 'way' END AS type, len(p)::INT AS n, p[1].lat::DOUBLE AS first_lat, p[1].lon::DOUBLE AS first_lon, p[-1].lat::DOUBLE AS last_lat, p[-1].lon::DOUBLE AS last_lon FROM p"""


def s5_tagged_ways(spark, sf):
    """GeoJSON features to tagged ways: only lines of two points or more, every form of id, the limit tags that are there."""
    made = spark.sql(
        """SELECT o_custkey AS doc, concat('{{"features": [', array_join(collect_list(concat('{{"properties": {{"highway": "primary", ',
             CASE k % 6 WHEN 0 THEN concat('"@type": "way", "@id": ', k) WHEN 1 THEN concat('"@id": "way/', k, '"') WHEN 2 THEN concat('"@id": "node", "id": "w', k, '"') WHEN 3 THEN concat('"osm_id": ', k) WHEN 4 THEN concat('"@type": "way", "@id": "', k, '"') ELSE '"id": "relation/5"' END,
             CASE WHEN k % 4 = 1 THEN ', "maxheight": "3.5", "maxweight": 7' WHEN k % 4 = 2 THEN ', "maxspeed": "50", "maxlength": null' ELSE '' END, CASE WHEN k % 5 = 0 THEN ', "bridge": "YES"' ELSE ', "bridge": "no"' END,
             '}}, "geometry": {{"type": "', CASE WHEN k % 8 = 7 THEN 'Polygon' ELSE 'LineString' END, '", "coordinates": [[10, ', k, '.5]', CASE WHEN k % 9 = 0 THEN '' ELSE ', [11, 60], [12.5, 61, 7]' END, ']}}}}')), ', '), ']}}') AS raw
           FROM (SELECT o_custkey, o_orderkey AS k FROM {o}) GROUP BY o_custkey""",
        o=table(spark, sf, "orders"),
    )
    w = documents.tagged_ways(made)
    return w.groupBy("doc", "way_id", "is_bridge", "highway").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("points")).alias("points"), F.sum(F.size("tags")).alias("limits"), F.sum(c("points")[0]["lat"]).alias("lat"), F.sum(F.element_at("points", -1)["lon"]).alias("lon"))


O_S5 = """SELECT o_custkey AS doc, CASE WHEN k % 6 < 5 THEN k END AS way_id, k % 5 = 0 AS is_bridge, 'primary' AS highway, count(*) AS n, (3 * count(*))::BIGINT AS points, sum(CASE WHEN k % 4 = 1 THEN 2 ELSE 0 END)::BIGINT AS limits, sum(k + 0.5)::DOUBLE AS lat, sum(12.5)::DOUBLE AS lon
FROM (SELECT o_custkey, o_orderkey AS k FROM orders) WHERE k % 8 <> 7 AND k % 9 <> 0 GROUP BY ALL"""


def s2_xml_documents(spark, sf):
    """Nodes, ways with their refs and relations with their members from XML documents, one a file and of many lines; a repeated tag key keeps the last value."""
    path = shared_path(spark, "xml")
    p, r, m = view(spark, sf, "v_points"), view(spark, sf, "v_way_nodes"), view(spark, sf, "v_members")
    spark.sql(
        """WITH e AS (SELECT point_id AS id, concat('  <node id="', point_id, '" lat="', lat, '" lon="', lon, '">\n    <tag k="place" v="old"/>\n    <tag k="place" v="p', point_id % 5, '"/>\n  </node>') AS x FROM {p}
           UNION ALL SELECT way_id, concat('  <way id="', way_id, '">\n', array_join(transform(array_sort(collect_list(struct(pos, node_id))), n -> concat('    <nd ref="', n.node_id, '"/>')), '\n'), '\n    <tag k="highway" v="a &amp; b"/>\n  </way>') FROM {r} GROUP BY way_id
           UNION ALL SELECT relation_id, concat('  <relation id="', relation_id, '">\n', array_join(transform(array_sort(collect_list(struct(pos, ref, role))), n -> concat('    <member type="way" ref="', n.ref, '"', CASE WHEN n.role IS NULL THEN '' ELSE concat(' role="', n.role, '"') END, '/>')), '\n'), '\n  </relation>') FROM {m} GROUP BY relation_id)
           SELECT floor(id / 10000) AS doc, concat('<?xml version="1.0" encoding="UTF-8"?>\n<osm version="0.6">\n', array_join(collect_list(x), '\n'), '\n</osm>') AS value FROM e GROUP BY floor(id / 10000)""",
        p=p, r=r, m=m,
    ).write.partitionBy("doc").text(path)
    e = documents.xml_elements(spark, path)
    last = F.coalesce(F.element_at("nodes", -1), F.element_at("members", -1)["ref"])
    roles = F.array_join(F.transform("members", lambda x: x["role"]), ",")
    return e.groupBy("type", F.coalesce(c("tags")["place"], c("tags")["highway"]).alias("tag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("nodes"), F.lit(0)) + F.coalesce(F.size("members"), F.lit(0))).alias("parts"), F.sum(last).alias("last"), F.sum(F.length(roles)).alias("role_chars"), F.round(F.sum("lat"), 4).alias("lat"),
    )


O_S2 = with_views("v_points", "v_way_nodes", "v_members") + """ w AS (SELECT way_id, count(*) AS n, arg_max(node_id, pos) AS last FROM v_way_nodes GROUP BY 1), r AS (SELECT relation_id, count(*) AS n, arg_max(ref, pos) AS last, sum(length(coalesce(role, ''))) + count(*) - 1 AS chars FROM v_members GROUP BY 1)
SELECT 'node' AS type, 'p' || (point_id % 5) AS tag, count(*) AS n, 0::BIGINT AS parts, NULL::BIGINT AS last, NULL::BIGINT AS role_chars, round(sum(lat), 4) AS lat FROM v_points GROUP BY 2
UNION ALL SELECT 'way', 'a & b', count(*), sum(n)::BIGINT, sum(last)::BIGINT, NULL, NULL FROM w UNION ALL SELECT 'relation', NULL, count(*), sum(n)::BIGINT, sum(last)::BIGINT, sum(chars)::BIGINT, NULL FROM r"""

_HEADS = ["'<?xml version=\"1.0\"?><p xmlns=\"http://datex2.eu/schema/3/common\">'", "'<d2LogicalModel xmlns=\"http://datex2.eu/schema/2/2_0\">'", "''", "'<messageContainer>'", "'<payloadPublication>'"]
_MADE = "SELECT page_id, CASE WHEN page_id % 7 = 6 THEN NULL ELSE concat(CASE page_id % 5 " + " ".join(f"WHEN {i} THEN {h}" for i, h in enumerate(_HEADS)) + " END, CASE WHEN page_id % 7 = 5 THEN replace(html, '<', '(') ELSE html END) END AS content, CASE page_id % 4 WHEN 0 THEN '3' WHEN 1 THEN '2.3' WHEN 2 THEN ' ' END AS expected FROM "


def s13_publication_versions(spark, sf):
    """Publications judged by namespace within the head that the rule looks at, against the version that is expected."""
    made = spark.sql(_MADE + "{p}", p=table(spark, sf, "pages"))
    return made.select("page_id", documents.publication_status(c("content"), c("expected")).alias("status"))


O_S13 = f"""WITH m AS ({_MADE} pages), h AS (SELECT *, substr(content, 1, 8192) AS h, trim(coalesce(expected, '')) AS w FROM m),
v AS (SELECT *, CASE WHEN regexp_matches(h, 'datex2\\.eu/schema/3/|messageContainer|EnergyInfrastructure') THEN '3' WHEN regexp_matches(h, 'datex2\\.eu/schema/2/|d2LogicalModel') THEN '2' ELSE 'u' END AS v FROM h)
SELECT page_id, CASE WHEN content IS NULL OR strpos(substr(content, 1, 500), '<') = 0 THEN 'not_xml' WHEN w = '' AND v = 'u' AND NOT regexp_matches(h, 'SituationPublication|payloadPublication|MeasuredDataPublication|EnergyInfrastructure') THEN 'not_a_publication'
  WHEN (w LIKE '3%' AND v <> '3') OR (w LIKE '2%' AND v <> '2') THEN 'wrong_version' ELSE 'ok' END AS status FROM v"""

PAIRS = [(s9_a25_country_tree, O_S9), (s6_ferry_elements, O_S6), (s5_tagged_ways, O_S5), (s2_xml_documents, O_S2), (s13_publication_versions, O_S13)]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS}
