"""Queries on tag rules: filters F*, expressions X* and M16-M20 over the ways view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.functions import clock, limits, tags
from waymill.queries.views import view, with_views

W = with_views("v_ways")
N = with_views("v_nodes")
ROADS = ", ".join(f"'{h}'" for h in tags.CAR_ROADS)
PLAIN = ", ".join(f"'{h}'" for h in tags.CAR_ROADS if h not in tags.MOTORWAYS)
NO, YES = "('no', 'false', '0', 'private')", "('yes', 'true', '1', 'designated', 'permissive', 'official')"
AT = "TIMESTAMP '2024-06-12 08:30:00'"


def ways(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_ways")


def c(name: str):
    return F.col(name)


ACCESS = ("motor_vehicle", "access", "foot", "bicycle")


def forbidden(profile: str):
    return tags.access_forbids(profile, *[c(x) for x in ACCESS])


def ferry():
    return tags.is_ferry(c("route"), c("highway"), c("ferry"))


def sql_forbidden(profile: str) -> str:
    own = {"foot": "foot", "bicycle": "bicycle"}.get(profile, "motor_vehicle")
    return f"CASE WHEN {own} IS NOT NULL THEN lower(trim({own})) NOT IN {YES} ELSE coalesce(lower(trim(access)) IN {NO}, false) END"


SQL_FERRY = "(coalesce(lower(route) = 'ferry', false) OR coalesce(highway = 'ferry', false) OR coalesce(ferry <> 'no', false))"
FY = "('yes', 'true', '1', 'designated', 'permissive', 'official', 'destination', 'customers')"
SQL_CAR_FERRY = f"""CASE WHEN motorcar IS NOT NULL THEN motorcar IN {FY} WHEN motor_vehicle IS NOT NULL THEN motor_vehicle IN {FY} WHEN vehicle IS NOT NULL THEN vehicle IN {FY}
 WHEN access IN {NO} THEN false ELSE coalesce(ferry IN ('motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'unclassified', 'residential', 'service'), false) END"""


def f1_way_tag_projection(spark, sf):
    """Kept tags of each way, with and without the pier key, as sorted text."""
    w = ways(spark, sf)
    keys = [k for k in ("highway", "oneway", "surface", "man_made", "natural", "wetland", "name")]
    m = F.create_map(*[x for k in keys for x in (F.lit(k), c(k))])
    text = lambda t: F.array_join(F.array_sort(F.transform(F.map_entries(t), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return w.select("way_id", text(tags.kept_tags(m, tags.WAY_KEYS)).alias("kept"), text(tags.kept_tags(m, (*tags.WAY_KEYS, "man_made"))).alias("kept_boarding"))


_KEPT = "list_sort(list_filter([{}], lambda x: x IS NOT NULL))"


def f2_f5_barrier_nodes(spark, sf):
    """Tags kept of barrier nodes and the modes that each blocks."""
    n = view(spark, sf, "v_nodes").filter("barrier is not null")
    m = F.create_map(*[x for k in ("barrier", "access", "motor_vehicle", "foot", "bicycle", "amenity") for x in (F.lit(k), c(k))])
    kept = F.array_join(F.array_sort(F.transform(F.map_entries(tags.kept_tags(m, tags.BARRIER_KEYS)), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return n.select("node_id", kept.alias("kept"), *[tags.barrier_blocks(c("barrier"), p, *[c(x) for x in ACCESS]).alias(f"blocks_{p}") for p in ("car", "foot", "bicycle")])


O_F2 = N + f""" x AS (SELECT 1) SELECT node_id, array_to_string(list_sort(list_filter(['barrier=' || barrier, 'access=' || access, 'motor_vehicle=' || motor_vehicle, 'foot=' || foot, 'bicycle=' || bicycle], lambda x: x IS NOT NULL)), ';') AS kept,
{sql_forbidden('car')} AS blocks_car, {sql_forbidden('foot')} AS blocks_foot, {sql_forbidden('bicycle')} AS blocks_bicycle FROM v_nodes WHERE barrier IS NOT NULL"""


def f3_highway_admission(spark, sf):
    return ways(spark, sf).select("way_id", *[tags.road_admits(c("highway"), p).alias(p) for p in tags.PROFILES])


O_F3 = W + f""" x AS (SELECT 1) SELECT way_id, coalesce(highway IN ({ROADS}), false) AS car, coalesce(highway IN ({ROADS}), false) AS truck,
coalesce(highway IN ({PLAIN}, 'footway', 'path', 'steps', 'pedestrian', 'cycleway'), false) AS foot, coalesce(highway IN ({PLAIN}, 'cycleway', 'path', 'footway'), false) AS bicycle FROM v_ways"""


def f4_static_access(spark, sf):
    return ways(spark, sf).select("way_id", *[forbidden(p).alias(f"no_{p}") for p in ("car", "foot", "bicycle")])


O_F4 = W + f" x AS (SELECT 1) SELECT way_id, {sql_forbidden('car')} AS no_car, {sql_forbidden('foot')} AS no_foot, {sql_forbidden('bicycle')} AS no_bicycle FROM v_ways"


def f6_minimum_speed(spark, sf):
    """Ways that foot and bicycle lose to a parseable minimum speed."""
    return ways(spark, sf).filter(tags.speed_kmh(c("minspeed")).isNotNull()).select("way_id", tags.speed_kmh(c("minspeed")).alias("min_kmh"))


O_F6 = W + " x AS (SELECT 1) SELECT way_id, try_cast(minspeed AS DOUBLE) AS min_kmh FROM v_ways WHERE try_cast(minspeed AS DOUBLE) > 0"


def f7_f12_ferries(spark, sf):
    """Ferry test, admission by profile, road test, boarding candidates, way skip and keep tests."""
    w = ways(spark, sf).withColumn("is_ferry", ferry())
    admits = lambda p: tags.ferry_admits(p, c("motorcar"), c("motor_vehicle"), c("vehicle"), c("access"), c("ferry"), c("foot"), c("bicycle"), F.lit(False))
    skip = lambda p: F.when(c("is_ferry"), ~admits(p)).otherwise(forbidden(p))
    any_road = tags.road_admits(c("highway"), "car") | tags.road_admits(c("highway"), "foot") | tags.road_admits(c("highway"), "bicycle")
    board = tags.boarding_candidate(c("is_ferry"), c("man_made"), c("highway"))
    return w.select(
        "way_id", "is_ferry", admits("car").alias("ferry_car"), admits("foot").alias("ferry_foot"), (~c("is_ferry") & tags.road_admits(c("highway"), "car")).alias("car_road"),
        (c("is_ferry") & admits("car")).alias("car_ferry"), board.alias("boarding"), skip("car").alias("skip_car"), skip("bicycle").alias("skip_bicycle"), (any_road | c("is_ferry") | board).alias("keep"),
    )


O_F7 = W + f""" f AS (SELECT *, {SQL_FERRY} AS is_ferry, {SQL_CAR_FERRY} AS fc, coalesce(highway IN ({ROADS}), false) AS cr, coalesce(highway IN ({ROADS}, 'footway', 'path', 'steps', 'pedestrian', 'cycleway'), false) AS ar FROM v_ways),
g AS (SELECT *, NOT is_ferry AND (coalesce(lower(man_made) = 'pier', false) OR coalesce(highway IN ('footway', 'platform'), false)) AS b FROM f)
SELECT way_id, is_ferry, fc AS ferry_car, NOT ({sql_forbidden('foot')}) AS ferry_foot, NOT is_ferry AND cr AS car_road, is_ferry AND fc AS car_ferry, b AS boarding,
CASE WHEN is_ferry THEN NOT fc ELSE {sql_forbidden('car')} END AS skip_car, {sql_forbidden('bicycle')} AS skip_bicycle, ar OR is_ferry OR b AS keep FROM g"""


def f9_old_ferry_classes(spark, sf):
    """Ferries by the coverage report's older class."""
    w = ways(spark, sf).filter(ferry())
    kind = tags.old_ferry_class(*[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle")])
    return w.groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"))


_Y = "('yes', 'designated', 'permissive', 'true', '1')"
O_F9 = W + f""" x AS (SELECT 1) SELECT CASE WHEN motorcar IN {_Y} OR motor_vehicle IN {_Y} OR vehicle IN {_Y} THEN 'car' WHEN foot IN {_Y} OR bicycle IN {_Y} THEN 'passenger' ELSE 'unknown' END AS class,
count(*) AS n FROM v_ways WHERE {SQL_FERRY} GROUP BY 1"""


def edge_columns() -> dict:
    """every attribute of an edge from tags, one select."""
    toll = {"motorcar": c("toll_motorcar"), "hgv": c("toll_hgv"), "bicycle": c("toll_bicycle")}
    return {
        "kmh": tags.speed_kmh(c("maxspeed")), "practical_kmh": tags.speed_kmh(c("maxspeed_practical")), "advisory_kmh": tags.speed_kmh(c("maxspeed_advisory")), "min_kmh": tags.speed_kmh(c("minspeed")),
        "road_ref": tags.road_refs(c("ref"), c("int_ref")), "motorroad_yes": tags.truthy(c("motorroad")), "expressway_yes": tags.truthy(c("expressway")), "oneway_yes": tags.oneway_yes(c("oneway")),
        "n_lanes": tags.lanes(c("lanes")), "weight_t": tags.metric(c("maxweight")), "axle_t": tags.metric(c("maxaxleload")), "bogie_t": tags.metric(c("maxbogieweight")), "height_m": tags.metric(c("maxheight")),
        "width_m": tags.metric(c("maxwidth")), "length_limit_m": tags.metric(c("maxlength")), "is_toll": tags.toll_applies("car", c("toll"), toll), "is_ferry": ferry(), "is_tunnel": tags.is_tunnel(c("tunnel")),
        "is_boardwalk": tags.boardwalk(c("bridge"), c("surface")), "is_roundabout": tags.yes(F.lower(c("junction")) == "roundabout"), "no_car": forbidden("car"),
        "surface_rank": tags.surface_rank(c("highway"), c("surface"), c("tracktype")), "ferry_s": tags.duration_seconds(c("duration")),
    }


def edge_attributes(w: DataFrame) -> DataFrame:
    return w.withColumns(edge_columns())


def f31_edge_attributes(spark, sf):
    made = edge_attributes(ways(spark, sf))
    return made.select("way_id", *[F.round(k, 6).alias(k) if k.endswith(("kmh", "_t", "_m", "_s")) else k for k in edge_columns()])


def sql_speed(x: str) -> str:
    s = f"lower(trim({x}))"
    body = f"trim(regexp_replace({s}, '(mph|km/h|kmh|kph)$', ''))"
    n = f"try_cast(list_filter(regexp_split_to_array({body}, '[;,\\s]+'), lambda t: t <> '')[1] AS DOUBLE)"
    return f"CASE {s} WHEN 'no:urban' THEN 50 WHEN 'no:living_street' THEN 50 WHEN 'no:rural' THEN 80 WHEN 'no:motorway' THEN 100 ELSE CASE WHEN {n} > 0 THEN {n} * CASE WHEN {s} LIKE '%mph' THEN 1.609344e0 ELSE 1 END END END::DOUBLE"


def sql_metric(x: str) -> str:
    return f"try_cast(trim(replace(replace(lower(trim({x})), 't', ''), 'm', '')) AS DOUBLE)"


SQL_RANK = """coalesce(greatest(CASE WHEN lower(surface) IN ('paved', 'asphalt', 'concrete', 'concrete:plates', 'concrete:lanes') THEN 0 WHEN lower(surface) IN ('gravel', 'compacted', 'fine_gravel') THEN 1 WHEN surface IS NOT NULL THEN 2 END,
CASE tracktype WHEN 'grade1' THEN 0 WHEN 'grade2' THEN 1 ELSE CASE WHEN tracktype IS NOT NULL THEN 2 END END), CASE WHEN highway = 'track' THEN 2 ELSE 0 END)::INT"""
SQL_SECONDS = "CASE duration WHEN '0:25' THEN 1500 WHEN '15' THEN 900 WHEN 'PT1H30M' THEN 5400 WHEN '90:00' THEN 5400 WHEN '01:05:30' THEN 3930 WHEN 'P1D' THEN 86400 END::DOUBLE"
SQL_REF = "CASE WHEN nullif(trim(ref), '') IS NOT NULL AND nullif(trim(int_ref), '') IS NOT NULL AND lower(trim(ref)) <> lower(trim(int_ref)) THEN trim(ref) || ';' || trim(int_ref) ELSE coalesce(nullif(trim(ref), ''), nullif(trim(int_ref), '')) END"
SQL_LANES = "CASE WHEN try_cast(nullif(regexp_extract(lanes, '[0-9]+'), '') AS INT) <= 255 THEN try_cast(nullif(regexp_extract(lanes, '[0-9]+'), '') AS INT) END"
SQL_TOLL = "CASE WHEN toll_motorcar IS NOT NULL THEN toll_motorcar = 'yes' ELSE coalesce(toll = 'yes', false) END"
O_F31 = W + f""" x AS (SELECT 1) SELECT way_id, {", ".join(f"round({sql_speed(t)}, 6) AS {a}" for a, t in (("kmh", "maxspeed"), ("practical_kmh", "maxspeed_practical"), ("advisory_kmh", "maxspeed_advisory"), ("min_kmh", "minspeed")))},
{SQL_REF} AS road_ref, coalesce(motorroad = 'yes', false) AS motorroad_yes, coalesce(expressway = 'yes', false) AS expressway_yes, coalesce(oneway IN ('yes', 'true', '1'), false) AS oneway_yes, {SQL_LANES} AS n_lanes,
{", ".join(f"round({sql_metric(t)}, 6) AS {a}" for a, t in (("weight_t", "maxweight"), ("axle_t", "maxaxleload"), ("bogie_t", "maxbogieweight"), ("height_m", "maxheight"), ("width_m", "maxwidth"), ("length_limit_m", "maxlength")))},
{SQL_TOLL} AS is_toll, {SQL_FERRY} AS is_ferry, coalesce(tunnel <> 'no', false) AS is_tunnel, coalesce(lower(bridge) = 'boardwalk', false) OR coalesce(surface = 'wood', false) AS is_boardwalk,
coalesce(lower(junction) = 'roundabout', false) AS is_roundabout, {sql_forbidden('car')} AS no_car, {SQL_RANK} AS surface_rank, {SQL_SECONDS} AS ferry_s FROM v_ways"""

#: An option's own measures and the edge limit that each must not exceed.
MEASURES = {"weight_kg": "weight_t", "axle_kg": "axle_t", "bogie_kg": "bogie_t", "own_height_m": "height_m", "own_width_m": "width_m", "own_length_m": "length_limit_m"}
OPTIONS = "option_id int, avoid_motorways boolean, avoid_tolls boolean, avoid_ferries boolean, " + ", ".join(f"{m} double" for m in MEASURES)
_ANY = (None,) * 6
OPTION_ROWS = [
    (0, False, False, False, *_ANY), (1, True, False, False, *_ANY), (2, False, True, True, *_ANY), (3, False, False, False, 4000.0, None, None, 3.6, None, None), (4, False, False, False, None, 9000.0, None, None, None, None),
    (5, False, False, False, None, None, 18500.0, None, None, None), (6, False, False, False, None, None, None, None, 2.25, None), (7, False, False, False, None, None, None, None, None, 11.0), (8, True, True, True, 8000.0, 8000.0, 18000.0, 3.5, 2.5, 12.0),
]


def allowed_for_options(edges: DataFrame, options: Column, profile: str, at) -> DataFrame:
    """edges that each option admits; ``options`` is an array of a request's options."""
    grade = tags.motorway_grade(c("highway"), c("motorroad_yes"), c("expressway_yes"), c("oneway_yes"), c("n_lanes"), c("kmh"))
    motor = profile in tags.MOTOR
    closed = clock.forbids(c("access_conditional"), at)
    if motor:
        closed = closed | clock.forbids(c("motor_vehicle_conditional"), at)
    ok = ~(c("no_car") | (grade & (c("avoid_motorways") | F.lit(not motor))) | (c("is_toll") & c("avoid_tolls")) | (c("is_ferry") & c("avoid_ferries")) | closed)
    for own, limit in MEASURES.items():
        ok = ok & ~tags.yes(c(own) / (1000 if own.endswith("_kg") else 1) > c(limit))
    # Each edge carries the option rows as one array: as many copies of an edge as admit it, no join.
    return edges.withColumn("option", F.explode(options)).select("*", "option.*").drop("option").filter(ok)


def option_rows() -> Column:
    """The handful of option rows as an array of structs."""
    kinds = dict(x.split() for x in OPTIONS.split(", "))
    return F.array(*[F.struct(*[F.lit(v).cast(kind).alias(name) for (name, kind), v in zip(kinds.items(), row, strict=True)]) for row in OPTION_ROWS])


def f13_f14_route_options(spark, sf):
    return allowed_for_options(edge_attributes(ways(spark, sf)), option_rows(), "car", F.to_timestamp(F.lit("2024-06-12 08:30:00"))).groupBy("option_id").agg(F.count(F.lit(1)).alias("n"), F.sum("way_id").alias("ways"))


# At Wednesday 12 June 08:30: Nov-Jun holds, Dec-Apr and Jul do not, 07:00-16:00 on weekdays does, May-Oct does.
SQL_CLOSED = "(coalesce(access_conditional IN ('no @ Nov-Jun', 'no@Apr 15-Jul 15'), false) OR coalesce(motor_vehicle_conditional = 'private @ (Mo-Fr 07:00-16:00)', false))"
SQL_GRADE = f"(coalesce(highway IN ('motorway', 'motorway_link'), false) OR coalesce(motorroad = 'yes', false) OR coalesce(expressway = 'yes', false) OR (coalesce(oneway IN ('yes', 'true'), false) AND coalesce({SQL_LANES} >= 2, false) AND coalesce({sql_speed('maxspeed')} >= 90, false)))"
_SQL_OPTIONS = ", ".join("(" + ", ".join("NULL::DOUBLE" if v is None else str(v).lower() for v in row) + ")" for row in OPTION_ROWS)
_SQL_LIMITS = " ".join(f"AND NOT coalesce({own}{' / 1000' if own.endswith('_kg') else ''} > {sql_metric(tag)}, false)" for own, tag in zip(MEASURES, ("maxweight", "maxaxleload", "maxbogieweight", "maxheight", "maxwidth", "maxlength"), strict=True))
O_F13 = W + f""" o(option_id, m, t, f, {', '.join(MEASURES)}) AS (VALUES {_SQL_OPTIONS})
SELECT option_id::INT AS option_id, count(*) AS n, sum(way_id)::BIGINT AS ways FROM v_ways, o WHERE NOT ({sql_forbidden('car')}) AND NOT {SQL_CLOSED} AND NOT (m AND {SQL_GRADE}) AND NOT (t AND {SQL_TOLL}) AND NOT (f AND {SQL_FERRY}) {_SQL_LIMITS} GROUP BY 1"""


def f15_x33_conditionals(spark, sf):
    """Closed at an instant, and the conditional speed that holds then."""
    at = F.to_timestamp(F.lit("2024-06-12 08:30:00"))
    winter = F.to_timestamp(F.lit("2024-01-02 03:00:00"))
    return ways(spark, sf).select(
        "way_id", (clock.forbids(c("access_conditional"), at) | clock.forbids(c("motor_vehicle_conditional"), at)).alias("closed"),
        clock.forbids(c("access_conditional"), winter).alias("closed_winter"), clock.speed_at(c("maxspeed_conditional"), winter, tags.speed_kmh).alias("winter_kmh"),
    )


O_F15 = W + f""" x AS (SELECT 1) SELECT way_id, {SQL_CLOSED} AS closed, coalesce(access_conditional IN ('no @ Nov-Jun', 'no @ (Dec-Apr)', 'yes @ (Jun-Sep)'), false) AS closed_winter,
CASE WHEN maxspeed_conditional LIKE '50%' THEN 50.0::DOUBLE WHEN maxspeed_conditional LIKE '80%' THEN 80 WHEN maxspeed_conditional LIKE 'x%' THEN 60 END AS winter_kmh FROM v_ways"""


def f19_bike_suitability(spark, sf):
    args = [c(x) for x in ("route", "mtb_scale", "smoothness", "tracktype", "incline", "surface")]
    return ways(spark, sf).select("way_id", *[tags.bike_unsuitable(k, *args).alias(k) for k in ("road", "trekking", "mountain")])


_SM = "CASE smoothness WHEN 'good' THEN 0 WHEN 'bad' THEN 2 WHEN 'horrible' THEN 4 WHEN 'impassable' THEN 6 END"
_MT = "CASE mtb_scale WHEN '1' THEN 1 WHEN '3:2' THEN 3 WHEN '6' THEN 6 END"
_IN = "CASE incline WHEN '10%' THEN 10 WHEN '-20%' THEN 20 WHEN '35%' THEN 35 WHEN '15 %' THEN 15 END"
_GR = "CASE tracktype WHEN 'grade1' THEN 1 WHEN 'grade2' THEN 2 WHEN 'grade4' THEN 4 END"


def _bike(m, s, g, i, rough, extra="false"):
    return f"{extra} OR coalesce({_MT} >= {m}, false) OR coalesce({_SM} >= {s}, false) OR coalesce({_GR} >= {g}, false) OR coalesce({_IN} > {i}, false) OR {rough}"


O_F19 = W + f""" x AS (SELECT 1) SELECT way_id, {_bike(1, 2, 3, 12, "coalesce(lower(surface) IN ('gravel', 'dirt', 'compacted', 'sand'), false)", "coalesce(route = 'mtb', false)")} AS road,
{_bike(2, 4, 4, 18, "coalesce(surface = 'sand', false)")} AS trekking, {_bike(5, 6, 5, 30, "false")} AS mountain FROM v_ways"""


def f28_x23_boardwalk_and_wetland(spark, sf):
    return ways(spark, sf).select(
        "way_id", tags.boardwalk(c("bridge"), c("surface")).alias("boardwalk"), tags.wetland_class(c("natural"), c("wetland")).alias("loader_class"), tags.wetland_class_strict(c("natural"), c("wetland")).alias("annotator_class")
    )


O_F28 = W + """ x AS (SELECT 1) SELECT way_id, coalesce(lower(bridge) = 'boardwalk', false) OR coalesce(surface = 'wood', false) AS boardwalk,
CASE WHEN lower(wetland) IN ('bog', 'fen') THEN 1 WHEN wetland IN ('swamp', 'reedbed') THEN 2 WHEN lower("natural") = 'wetland' THEN 1 END::INT AS loader_class,
CASE WHEN lower(wetland) IN ('bog', 'fen') THEN 1 WHEN wetland IN ('swamp', 'reedbed') THEN 2 WHEN wetland IS NULL AND lower("natural") = 'wetland' THEN 1 END::INT AS annotator_class FROM v_ways"""


def f32_profile_edges(spark, sf):
    """Ways each profile keeps: access, minimum speed, class."""
    w = edge_attributes(ways(spark, sf))
    keep = lambda p: ~forbidden(p) & tags.road_admits(c("highway"), p) & (F.lit(p in tags.MOTOR) | c("min_kmh").isNull())
    return w.agg(*[F.count_if(keep(p)).alias(p) for p in tags.PROFILES])


O_F32 = W + f""" x AS (SELECT 1) SELECT count(*) FILTER (NOT ({sql_forbidden('car')}) AND highway IN ({ROADS})) AS car, count(*) FILTER (NOT ({sql_forbidden('car')}) AND highway IN ({ROADS})) AS truck,
count(*) FILTER (NOT ({sql_forbidden('foot')}) AND highway IN ({PLAIN}, 'footway', 'path', 'steps', 'pedestrian', 'cycleway') AND minspeed IS NULL) AS foot,
count(*) FILTER (NOT ({sql_forbidden('bicycle')}) AND highway IN ({PLAIN}, 'cycleway', 'path', 'footway') AND minspeed IS NULL) AS bicycle FROM v_ways"""


def x1_speeds(spark, sf):
    return ways(spark, sf).groupBy("maxspeed").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(tags.speed_kmh(c("maxspeed"))), 6).alias("kmh"))


O_X1 = W + f" x AS (SELECT 1) SELECT maxspeed, count(*) AS n, round(max({sql_speed('maxspeed')}), 6) AS kmh FROM v_ways GROUP BY 1"


def x2_x3_durations(spark, sf):
    return ways(spark, sf).groupBy("duration").agg(F.count(F.lit(1)).alias("n"), F.max(tags.duration_seconds(c("duration"))).alias("seconds"), F.max(tags.duration_format(c("duration"))).alias("format"))


O_X2 = W + f""" x AS (SELECT 1) SELECT duration, count(*) AS n, max({SQL_SECONDS}) AS seconds, max(CASE WHEN duration IS NULL THEN 'missing' WHEN duration LIKE 'P%' THEN 'iso8601' WHEN duration IN ('0:25', '90:00', '1:75') THEN 'h:mm'
WHEN duration = '01:05:30' THEN 'h:mm:ss' WHEN duration IN ('15', '20000') THEN 'minutes' ELSE 'other' END) AS format FROM v_ways GROUP BY 1"""


def x4_x6_numbers_and_refs(spark, sf):
    return ways(spark, sf).groupBy(tags.road_refs(c("ref"), c("int_ref")).alias("road_ref"), tags.lanes(c("lanes")).alias("n_lanes"), tags.metric(c("maxweight")).alias("weight_t")).agg(F.count(F.lit(1)).alias("n"))


O_X4 = W + f" x AS (SELECT 1) SELECT {SQL_REF} AS road_ref, {SQL_LANES} AS n_lanes, {sql_metric('maxweight')} AS weight_t, count(*) AS n FROM v_ways GROUP BY ALL"


def x7_x9_limits(spark, sf):
    raw = {k: c(k) for k in ("maxheight", "maxwidth", "maxlength", "maxweight", "maxaxleload", "maxbogieweight")}
    made = limits.limit_columns(raw)
    return ways(spark, sf).select("way_id", limits.value_class(c("maxheight")).alias("height_class"), limits.way_class(list(raw.values())).alias("way_class"), *[v.alias(k) for k, v in made.items()])


_VALUES = {
    "maxheight": {"3.5": 350, "4 m": 400, "12''6\"": 381, "350 cm": 350, "3,8": 380, "13 ft": 396}, "maxwidth": {"2.5": 250, "2 m": 200, "6''": 183, "120 in": 305}, "maxlength": {"12": 1200, "10 m": 1000},
    "maxweight": {"3.5 t": 350, "7.5": 750, "10 tons": 1000, "3500 kg": 350, "20 lbs": 1}, "maxaxleload": {"8": 800, "10t": 1000}, "maxbogieweight": {"18 t": 1800},
}


def _cases(k):
    return "CASE " + k + " " + " ".join(f"WHEN '{v}' THEN {n}" for v, n in _VALUES[k].items()) + " ELSE 0 END"


_ANY = " OR ".join(f"{_cases(k)} > 0" for k in _VALUES)
_SET = " OR ".join(f"{k} IS NOT NULL" for k in _VALUES)
O_X7 = W + f""" x AS (SELECT 1) SELECT way_id, CASE WHEN maxheight IS NULL THEN 'empty' WHEN maxheight IN ('default', 'none') THEN 'non_numeric_no_limit' WHEN maxheight = 'below_default' THEN 'unknown_value' WHEN {_cases('maxheight')} > 0 THEN 'numeric' ELSE 'unparseable' END AS height_class,
CASE WHEN NOT ({_SET}) THEN 'unparseable' WHEN {_ANY} THEN 'numeric' WHEN maxheight = 'below_default' THEN 'unknown_value' WHEN maxheight IN ('yes', '4.0 @ (x)') THEN 'unparseable' ELSE 'non_numeric_no_limit' END AS way_class,
{_cases('maxheight')}::INT AS max_height_cm, {_cases('maxwidth')}::INT AS max_width_cm, {_cases('maxlength')}::INT AS max_length_cm, {_cases('maxweight')}::INT AS max_weight_10kg, {_cases('maxaxleload')}::INT AS max_axleload_10kg, {_cases('maxbogieweight')}::INT AS max_bogie_10kg FROM v_ways"""


def x20_x22_surface_toll_class(spark, sf):
    toll = {"motorcar": c("toll_motorcar"), "hgv": c("toll_hgv"), "bicycle": c("toll_bicycle")}
    return ways(spark, sf).select(
        "way_id", tags.surface_rank(c("highway"), c("surface"), c("tracktype")).alias("surface_rank"), *[tags.toll_applies(p, c("toll"), toll).alias(f"toll_{p}") for p in tags.PROFILES],
        tags.road_base(c("highway")).alias("base"), tags.class_speed(c("highway")).alias("class_kmh"), tags.class_label(c("highway")).alias("label"),
    )


_BASE = "regexp_replace(highway, '_link$', '')"
_SPEED = "CASE " + " ".join(f"WHEN {_BASE} = '{k}' THEN {v}" for k, v in tags.CLASS_SPEEDS.items()) + " ELSE 50.0 END::DOUBLE"
O_X20 = W + f""" x AS (SELECT 1) SELECT way_id, {SQL_RANK} AS surface_rank, {SQL_TOLL} AS toll_car,
CASE WHEN toll_motorcar IS NULL AND toll_hgv IS NULL THEN coalesce(toll = 'yes', false) ELSE coalesce(toll_motorcar = 'yes', false) OR coalesce(toll_hgv = 'yes', false) END AS toll_truck,
coalesce(toll = 'yes', false) AS toll_foot, CASE WHEN toll_bicycle IS NOT NULL THEN toll_bicycle = 'yes' ELSE coalesce(toll = 'yes', false) END AS toll_bicycle,
{_BASE} AS base, {_SPEED} AS class_kmh, CASE {" ".join(f"WHEN {_BASE} = '{k}' THEN '{v}'" for k, v in tags.CLASS_LABELS.items())} ELSE 'Road' END AS label FROM v_ways"""


def m16_m19_costs(spark, sf):
    """Speed, hours for a nominal length, ferry weight and soft cost of each way."""
    w = edge_attributes(ways(spark, sf)).withColumn("len", (c("way_id") % 97 + 1) * 25.0)
    kmh = tags.travel_speed(c("practical_kmh"), c("kmh"), c("advisory_kmh"), c("min_kmh"), c("highway"))
    has = F.coalesce("kmh", "practical_kmh", "advisory_kmh").isNotNull()
    return w.select(
        "way_id", F.round(kmh, 4).alias("kmh"), F.round(tags.travel_hours(c("len"), kmh), 8).alias("hours"), F.round(tags.ferry_weight(c("len"), c("ferry_s"), "car"), 4).alias("ferry_m"),
        F.round(tags.ferry_weight(c("len"), c("ferry_s"), "foot"), 4).alias("ferry_foot_m"), *[F.round(tags.soft_cost(c("surface_rank"), has, c("is_ferry"), c("highway"), v), 6).alias(f"cost_{v}") for v in tags.SURFACE_COST],
        tags.transition_cost(F.lit(0), c("surface_rank")).alias("from_good"),
    )


_TS = f"greatest(coalesce({sql_speed('maxspeed_practical')}, {sql_speed('maxspeed')}, {sql_speed('maxspeed_advisory')}, {_SPEED}), coalesce(try_cast(minspeed AS DOUBLE), 0))"
_LEN = "((way_id % 97 + 1) * 25.0::DOUBLE)"
_HAS = f"coalesce({sql_speed('maxspeed_practical')}, {sql_speed('maxspeed')}, {sql_speed('maxspeed_advisory')}) IS NOT NULL"
_EX = f"({SQL_FERRY} OR highway IS NULL OR highway IN ('path', 'footway', 'cycleway', 'steps', 'pedestrian', 'platform') OR {_HAS})"
O_M16 = W + f""" x AS (SELECT 1) SELECT way_id, round({_TS}, 4) AS kmh, round({_LEN} / 1000 / greatest({_TS}, 1), 8) AS hours, round(coalesce({SQL_SECONDS} * 80000 / 3600, {_LEN} * 8) + 600 * 80000 / 3600.0::DOUBLE, 4) AS ferry_m,
round(coalesce({SQL_SECONDS} * 80000 / 3600, {_LEN} * 8), 4) AS ferry_foot_m, {", ".join(f"round(CASE {SQL_RANK} WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN {a} ELSE {b} END * CASE WHEN {_EX} THEN 1.0::DOUBLE ELSE {tags.NO_SPEED_COST[v]} END, 6) AS cost_{v}" for v, (a, b) in tags.SURFACE_COST.items())},
CASE WHEN {SQL_RANK} > 1 THEN 500.0::DOUBLE ELSE 0 END AS from_good FROM v_ways"""

O_F1 = W + " x AS (SELECT 1) SELECT way_id, array_to_string({a}, ';') AS kept, array_to_string({b}, ';') AS kept_boarding FROM v_ways".format(
    a=_KEPT.format(", ".join(f"'{k}=' || {k}" for k in ("highway", "oneway", "surface", "name"))), b=_KEPT.format(", ".join(f"'{k}=' || {k}" for k in ("highway", "oneway", "surface", "name", "man_made")))
)

PAIRS = [
    (f1_way_tag_projection, O_F1), (f2_f5_barrier_nodes, O_F2), (f3_highway_admission, O_F3), (f4_static_access, O_F4), (f6_minimum_speed, O_F6), (f7_f12_ferries, O_F7), (f9_old_ferry_classes, O_F9),
    (f13_f14_route_options, O_F13), (f15_x33_conditionals, O_F15), (f19_bike_suitability, O_F19), (f28_x23_boardwalk_and_wetland, O_F28), (f31_edge_attributes, O_F31), (f32_profile_edges, O_F32), (x1_speeds, O_X1),
    (x2_x3_durations, O_X2), (x4_x6_numbers_and_refs, O_X4), (x7_x9_limits, O_X7), (x20_x22_surface_toll_class, O_X20), (m16_m19_costs, O_M16),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS}
