"""Road-map views over the star-schema tables, as SQL that both engines read.

Only integer arithmetic and CASE: the text serves as a Spark query over the tables and, as
a WITH clause, as the oracle's input. Every view grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymill.operators.shared import table


def pick(number: str, values: list[str | None]) -> str:
    """One of the values by a number's remainder."""
    cases = " ".join(f"WHEN {i} THEN " + ("CAST(NULL AS VARCHAR(99))" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


WAY_TAGS: dict[str, tuple[str, list[str | None]]] = {
    "highway": ("k", ["motorway", "primary", "residential", "footway", "track", "trunk_link", "service", "secondary", "path", "tertiary", "unclassified", "cycleway", "motorway_link", "living_street", "steps", None, "platform", "pedestrian", "road"]),
    "oneway": ("k * 3", ["yes", "no", None, None, "-1", "true", None]),
    "junction": ("k * 5", [None, None, None, "roundabout", None, None, None, "Roundabout", None, None, None]),
    "maxspeed": ("k * 7 + 1", ["50", "80", "30 mph", None, "NO:urban", "110", "none", "70;80", "90 km/h", None, "walk", "60kmh", "0"]),
    "maxspeed_practical": ("k * 11", [None, None, None, "65", None, None, None, None, "45"]),
    "maxspeed_advisory": ("k * 13", [None, None, None, "40", None, None, None, "x"]),
    "minspeed": ("k * 17", [None, None, None, None, None, None, None, None, "60", None, None]),
    "surface": ("k * 19 + 2", ["asphalt", None, "gravel", "dirt", "paved", None, "wood", "Compacted", "cobblestone", "sand"]),
    "tracktype": ("k * 23", [None, "grade1", None, "grade2", None, "grade4", None, None, "solid"]),
    "toll": ("k * 29", [None, "yes", None, None, "no", None, None]),
    "toll_motorcar": ("k * 31", [None, None, None, None, "yes", None, None, "no", None]),
    "toll_hgv": ("k * 37", [None, None, "yes", None, None, None, None, "no", None, None, None]),
    "toll_bicycle": ("k * 41", [None, None, None, None, None, "yes", None, None]),
    "access": ("k * 43", [None, None, "no", None, None, "yes", None, "private", None, "destination", None, None, None]),
    "motor_vehicle": ("k * 47", [None, None, None, "yes", None, None, "no", None, None, None, "customers", None]),
    "motorcar": ("k * 53", [None, None, None, None, "yes", None, None, None, "no", None]),
    "vehicle": ("k * 59", [None, None, None, None, None, "permissive", None, None, "no"]),
    "foot": ("k * 61", [None, None, "no", None, None, "designated", None, None, None, None]),
    "bicycle": ("k * 67", [None, "no", None, None, None, None, "yes", None, None]),
    "route": ("k * 71", [None, None, None, None, None, None, None, None, "ferry", None, "mtb", None, None]),
    "ferry": ("k * 73", [None, None, None, None, None, None, "no", None, None, None, None, None, "primary", None, None, None, "trunk"]),
    "duration": ("k * 79", ["0:25", None, "15", "PT1H30M", "90:00", "abc", "01:05:30", None, "P1D", "20000", "PT", "1:75"]),
    "lanes": ("k * 83", ["2", None, "1", "3;2", None, "x4", "300"]),
    "motorroad": ("k * 89", [None, None, None, None, None, "yes", None, None]),
    "expressway": ("k * 97", [None, None, None, None, None, None, "yes", "no", None, None]),
    "tunnel": ("k * 101", [None, None, "yes", None, "no", None, "culvert", None, None]),
    "bridge": ("k * 103", [None, "yes", None, "Boardwalk", None, None, None]),
    "man_made": ("k * 107", [None, None, None, None, None, "pier", None, None, None, "Pier", None]),
    "ref": ("k * 109", ["E6", None, " 12 ", "Rv3", None, ""]),
    "int_ref": ("k * 113", [None, "e6", "E 16", None, " "]),
    "maxheight": ("k * 127", ["3.5", "4 m", "12'6\"", None, "default", "none", "below_default", "350 cm", None, "3,8", "13 ft", "yes", "4.0 @ (x)"]),
    "maxwidth": ("k * 131", [None, "2.5", None, "2 m", None, "6'", None, "120 in"]),
    "maxlength": ("k * 137", [None, None, "12", None, "10 m", None, None]),
    "maxweight": ("k * 139", [None, "3.5 t", "7.5", None, "10 tons", "3500 kg", None, "unsigned", "20 lbs", None]),
    "maxaxleload": ("k * 149", [None, None, "8", None, "10t", None]),
    "maxbogieweight": ("k * 151", [None, None, None, "18 t", None]),
    "mtb_scale": ("k * 157", [None, None, "1", None, "3:2", None, None, "6", "9", None]),
    "smoothness": ("k * 163", [None, "good", None, "bad", "horrible", None, "impassable", None]),
    "incline": ("k * 167", [None, "10%", None, "-20%", "35%", None, "up", None, "15 %"]),
    "access_conditional": ("k * 173", [None, None, "no @ Nov-Jun", None, None, "no @ (Dec-Apr)", None, "no@Apr 15-Jul 15", None, "yes @ (Jun-Sep)", None, "no @ snow", None]),
    "motor_vehicle_conditional": ("k * 179", [None, None, None, "private @ (Mo-Fr 07:00-16:00)", None, None, "yes @ May-Oct; no @ (Jul)", None, None]),
    "maxspeed_conditional": ("k * 181", [None, "50 @ (Mo-Fr 00:00-06:00)", None, "80 @ Nov-Mar", None, "x @ Jan; 60 @ (Jan-Feb)", None]),
    "natural": ("k * 191", [None, None, "wetland", None, None, "Wetland", None]),
    "wetland": ("k * 193", [None, "bog", "swamp", None, "marsh", "Fen", "reedbed", None]),
    "name": ("k * 197", ["North Road", None, "Sea Road", None, "", "Ring 3"]),
    "building": ("k * 199", [None, "yes", None, None, "house", None, None]),
}

NODE_TAGS: dict[str, tuple[str, list[str | None]]] = {
    "barrier": ("n", [None, None, None, "gate", None, None, None, None, "bollard", None, None]),
    "access": ("n * 3", [None, None, "no", None, "yes", None, "private"]),
    "motor_vehicle": ("n * 5", [None, None, None, "no", None, None, None, "yes", "agricultural"]),
    "foot": ("n * 7", [None, None, None, None, "yes", "no"]),
    "bicycle": ("n * 11", [None, None, "no", None, None]),
    "amenity": ("n * 12", [None, "drinking_water", None, "toilets", "cafe", None, "parking", "shelter", None, "restaurant", "camping", None, "museum"]),
    "tourism": ("n * 17", [None, None, "alpine_hut", "camp_site", None, "hotel", "viewpoint", None, "wilderness_hut", "hostel", None]),
    "natural": ("n * 19", [None, None, None, "spring", None, "peak", None]),
    "operator": ("n * 23", [None, "DNT Oslo", None, "STF", None, "Private", None]),
    "network": ("n * 29", [None, None, "DNT", None, None]),
    "shop": ("n * 31", [None, None, None, "alcohol", None, "fishing", None, None]),
    "leisure": ("n * 37", [None, None, None, None, "fishing", None]),
    "highway": ("n * 41", [None, None, None, "rest_area", None, "services", None, None, None]),
    "hgv": ("n * 43", [None, "yes", None, "designated", None]),
    "name": ("n * 47", [None, "Old Service Point", "Hut", None, "Cafe", None, None]),
    "building": ("n * 53", [None, "yes", None, None, "house", None]),
}

_WAYS = "SELECT k AS way_id, k AS id, " + ", ".join(f"{pick(e, v)} AS {t}" for t, (e, v) in WAY_TAGS.items()) + " FROM (SELECT o_orderkey AS k FROM {orders}) o"

VIEWS: dict[str, tuple[list[str], str]] = {
    "v_ways": (["orders"], _WAYS),
    "v_way_nodes": (
        ["lineitem"],
        """SELECT l_orderkey AS way_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS BIGINT) AS pos,
        ((l_partkey * 16 + l_orderkey % 16) * 7919 + CAST(floor(l_orderkey / 16.0) AS BIGINT) * 31) % (2 * (SELECT count(*) FROM {lineitem})) AS node_id FROM {lineitem}""",
    ),
    "v_node_ids": (["v_way_nodes"], "SELECT DISTINCT node_id FROM {v_way_nodes}"),
    "v_nodes": (
        ["v_node_ids"],
        "SELECT n AS node_id, 59 + (n * 7919 % 10007) / 5000.0e0 AS lat, 10 + (n * 104729 % 10009) / 5000.0e0 AS lon, "
        + ", ".join(f"{pick(e, v)} AS {t}" for t, (e, v) in NODE_TAGS.items())
        + " FROM (SELECT node_id AS n FROM {v_node_ids}) x",
    ),
    "v_relations": (["customer"], "SELECT c_custkey AS relation_id, c_name AS name, " + pick("c_custkey", ["route", None, "boundary", "multipolygon"]) + " AS type FROM {customer}"),
    "v_members": (
        ["orders"],
        "SELECT o_custkey AS relation_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS pos, 'way' AS member_type, o_orderkey AS ref, " + pick("o_orderkey * 3", ["outer", "inner", "", None, "stop"]) + " AS role FROM {orders}",
    ),
    "v_points": (["customer"], "SELECT c_custkey AS point_id, 59 + (c_custkey * 6007 % 10007) / 5000.0e0 AS lat, 10 + (c_custkey * 7001 % 10009) / 5000.0e0 AS lon FROM {customer}"),
    "v_route_pairs": (["customer"], "SELECT c_custkey AS query, c_custkey AS a, c_custkey * 31 % (SELECT count(*) FROM {customer}) AS b FROM {customer}"),
    "v_regions": (
        ["nation"],
        """SELECT n_nationkey AS region_id, n_name AS name, n_regionkey AS group_id, 59 + (n_nationkey * 7 % 25) * 0.06e0 AS min_lat, 10 + (n_nationkey * 11 % 25) * 0.06e0 AS min_lon,
        59 + (n_nationkey * 7 % 25) * 0.06e0 + 0.25e0 + (n_nationkey % 4) * 0.1e0 AS max_lat,
        10 + (n_nationkey * 11 % 25) * 0.06e0 + CASE WHEN n_nationkey = 13 THEN 130 ELSE 0.3e0 + (n_nationkey % 3) * 0.1e0 END AS max_lon FROM {nation}""",
    ),
    "v_ring_points": (
        ["v_regions"],
        """SELECT region_id, v AS vertex, min_lat + fy * (max_lat - min_lat) AS lat, min_lon + fx * (CASE WHEN max_lon - min_lon > 100 THEN 0.5e0 ELSE max_lon - min_lon END) AS lon, 1 + region_id % 2 AS class
        FROM {v_regions} CROSS JOIN (VALUES (0, 0.0e0, 0.2e0), (1, 0.0e0, 0.8e0), (2, 0.5e0, 1.0e0), (3, 1.0e0, 0.8e0), (4, 1.0e0, 0.2e0), (5, 0.5e0, 0.0e0)) AS f(v, fy, fx)""",
    ),
    "v_pois": (["v_nodes"], "SELECT node_id AS poi_id, lat, lon, amenity, tourism, name FROM {v_nodes} WHERE amenity IS NOT NULL"),
    "v_dem": (
        ["embeddings"],
        """SELECT CAST(floor(vec_id / s) AS BIGINT) AS cell_row, CAST(vec_id % CAST(s AS BIGINT) AS BIGINT) AS cell_col, y AS post_row, x AS post_col, CASE WHEN (vec_id + y * 3 + x) % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST((vec_id * 37 + y * 11 + x * 7) % 500 + label AS DOUBLE) END AS elev_m
        FROM {embeddings} CROSS JOIN (SELECT floor(sqrt(count(*))) AS s FROM {embeddings}) AS n CROSS JOIN (VALUES (0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)) AS f(y, x)""",
    ),
    "v_log": (
        ["events"],
        "SELECT event_id, ts, user_id AS provider, CASE event_type WHEN 'error' THEN 'fail' WHEN 'view' THEN 'unchanged' ELSE 'ok' END AS status, value, props FROM {events}",
    ),
    "v_packs": (
        ["orders"],
        """SELECT region_id, generation, count(*) AS n, CAST(sum(b) AS BIGINT) AS graph_b, CAST(sum(b % 1000) AS BIGINT) AS poi_b, CAST(sum(b % 100) * (generation % 3) AS BIGINT) AS wetland_b, CAST(sum(k * 7 % 90000) AS BIGINT) AS source_b,
        CAST(sum(k % 5) AS BIGINT) AS missing, CAST(sum(k % 97) AS BIGINT) AS edges, generation % 7 <> 3 AS has_manifest, (generation + region_id) % 11 = 5 AS in_progress
        FROM (SELECT o_orderkey AS k, o_custkey % 25 AS region_id, CAST(extract(YEAR FROM o_orderdate) * 100 + extract(MONTH FROM o_orderdate) AS BIGINT) AS generation, CAST(floor(o_totalprice) AS BIGINT) AS b FROM {orders}) o GROUP BY region_id, generation""",
    ),
    "v_leaves": (
        ["orders"],
        """SELECT DISTINCT o_custkey % 40 AS region_id, o_orderkey % 60 AS leaf_id, (o_orderkey % 60) * 1.5e0 + (o_custkey % 40) * 0.25e0 AS coverage, (o_orderkey % 60 + o_custkey % 40) % 100 AS overspill, CAST(o_orderkey % 3 AS INT) AS version FROM {orders}""",
    ),
    "v_changes": (
        ["events", "orders"],
        """SELECT event_id AS seq, (event_id * 7919) % (SELECT count(*) + 50 FROM {orders}) AS id,
        CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'modify' END AS action, value AS payload, ts FROM {events}""",
    ),
}


def _order(name: str, seen: list[str]) -> list[str]:
    for x in VIEWS[name][0]:
        if x in VIEWS and x not in seen:
            _order(x, seen)
    if name not in seen:
        seen.append(name)
    return seen


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    inputs, sql = VIEWS[name]
    return spark.sql(sql, **{x: view(spark, sf_dir, x) for x in inputs})


def with_views(*names: str) -> str:
    """The oracle's WITH clause for the views, ready for more parts: ends with a comma."""
    needed: list[str] = []
    for n in names:
        _order(n, needed)
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1].format(**{x: x for x in VIEWS[n][0]})})" for n in needed) + ","
