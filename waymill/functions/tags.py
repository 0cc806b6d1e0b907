"""Column rules over tags: access, ferries, speeds, tolls, surfaces, limits.

Each rule is an expression on tag columns; nothing here touches a row in Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tag scheme.
WAY_KEYS = (
    "highway", "oneway", "junction", "maxspeed", "maxspeed:practical", "maxspeed:advisory", "maxspeed:type", "maxspeed:variable", "maxspeed:conditional", "minspeed", "name",
    "ref", "int_ref", "motorroad", "expressway", "lanes", "maxweight", "maxaxleload", "maxbogieweight", "maxheight", "maxwidth", "maxlength", "toll", "toll:motor_vehicle",
    "toll:motorcar", "toll:motorcycle", "toll:hgv", "toll:bicycle", "toll:foot", "route", "ferry", "duration", "motorcar", "vehicle", "tunnel", "bridge", "surface", "tracktype",
    "motor_vehicle", "access", "foot", "bicycle", "motor_vehicle:conditional", "access:conditional",
)
BARRIER_KEYS = ("barrier", "access", "motor_vehicle", "foot", "bicycle")
MOTORWAYS = ("motorway", "motorway_link", "motorway_junction")
CAR_ROADS = (*MOTORWAYS, "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street", "road", "service", "track")
FOOT_WAYS = ("footway", "path", "steps", "pedestrian", "cycleway")
CYCLE_WAYS = ("cycleway", "path", "footway")
ACCESS_NO = ("no", "false", "0", "private")
ACCESS_YES = ("yes", "true", "1", "designated", "permissive", "official")
FERRY_ROADS = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "service")
FERRY_YES = (*ACCESS_YES, "destination", "customers")
TOLL_YES = ("yes", "true", "1", "toll")
SPEED_WORDS = {"no:urban": 50.0, "no:living_street": 50.0, "no:rural": 80.0, "no:motorway": 100.0}
CLASS_SPEEDS = {
    "motorway": 100.0, "trunk": 80.0, "primary": 70.0, "secondary": 60.0, "tertiary": 50.0, "unclassified": 50.0, "residential": 40.0, "living_street": 40.0, "service": 20.0,
    "track": 20.0, "road": 20.0, "path": 10.0, "footway": 10.0, "cycleway": 10.0, "bridleway": 10.0, "steps": 10.0,
}
CLASS_LABELS = {
    "motorway": "Motorway", "trunk": "Trunk road", "primary": "Primary road", "secondary": "Secondary road", "tertiary": "Tertiary road", "unclassified": "Unclassified road",
    "residential": "Residential road", "living_street": "Living street", "service": "Service road", "track": "Track", "road": "Road", "path": "Path", "footway": "Footway",
    "cycleway": "Cycleway", "bridleway": "Bridleway", "steps": "Steps", "pedestrian": "Pedestrian street",
}
DEFAULT_SPEED = 50.0
SURFACES = {"paved": 0, "asphalt": 0, "concrete": 0, "concrete:plates": 0, "concrete:lanes": 0, "gravel": 1, "compacted": 1, "fine_gravel": 1}
TRACKTYPES = {"grade1": 0, "grade2": 1}
POOR = 2
SURFACE_COST = {"car": (1.5, 3.0), "motorcycle": (2.2, 4.5), "truck": (2.0, 4.0), "mobile_home": (2.4, 5.0)}
NO_SPEED_COST = {"car": 1.10, "motorcycle": 1.10, "truck": 1.15, "mobile_home": 1.15}
NO_SPEED_EXEMPT = ("ferry", "path", "footway", "cycleway", "steps", "pedestrian", "platform")
FERRY_EQUIVALENT_KMH, FERRY_SLOW_KMH, FERRY_BOARDING_MIN = 80.0, 10.0, 10.0

MOTOR = ("car", "truck")
PROFILES = ("car", "truck", "foot", "bicycle")


def clean(c: Column) -> Column:
    return F.lower(F.trim(c))


def yes(test: Column) -> Column:
    """A test that is false where a tag is missing."""
    return F.coalesce(test, F.lit(False))


def lookup(c: Column, table: dict, default=None) -> Column:
    out = reduce(lambda w, kv: w.when(c == kv[0], F.lit(kv[1])), table.items(), F.when(F.lit(False), F.lit(next(iter(table.values())))))
    return out.otherwise(F.lit(default))


def kept_tags(tags: Column, keys: tuple[str, ...]) -> Column:
    return F.map_filter(tags, lambda k, v: k.isin(*keys) & v.isNotNull())


def road_admits(highway: Column, profile: str) -> Column:
    plain = highway.isin(*[h for h in CAR_ROADS if h not in MOTORWAYS])
    return yes({"foot": plain | highway.isin(*FOOT_WAYS), "bicycle": plain | highway.isin(*CYCLE_WAYS)}.get(profile, highway.isin(*CAR_ROADS)))


def access_forbids(profile: str, motor_vehicle: Column, access: Column, foot: Column, bicycle: Column) -> Column:
    """The mode's own key decides: only a yes-value admits. Without it, access=no forbids."""
    own = {"foot": foot, "bicycle": bicycle}.get(profile, motor_vehicle)
    return F.when(own.isNotNull(), ~clean(own).isin(*ACCESS_YES)).otherwise(yes(clean(access).isin(*ACCESS_NO)))


def barrier_blocks(barrier: Column, profile: str, *tags: Column) -> Column:
    return barrier.isNotNull() & access_forbids(profile, *tags)


def is_ferry(route: Column, highway: Column, ferry: Column) -> Column:
    return yes(F.lower(route) == "ferry") | yes(highway == "ferry") | yes(ferry != "no")


def ferry_admits(profile: str, motorcar: Column, motor_vehicle: Column, vehicle: Column, access: Column, ferry: Column, foot: Column, bicycle: Column, inherited: Column) -> Column:
    if profile not in MOTOR:
        return ~access_forbids(profile, motor_vehicle, access, foot, bicycle)
    first = F.coalesce(motorcar, motor_vehicle, vehicle)
    return F.when(first.isNotNull(), clean(first).isin(*FERRY_YES)).when(clean(access).isin(*ACCESS_NO), False).otherwise(yes(clean(ferry).isin(*FERRY_ROADS)) | inherited)


def old_ferry_class(motorcar: Column, motor_vehicle: Column, vehicle: Column, foot: Column, bicycle: Column) -> Column:
    """The coverage report's classes."""
    car = reduce(lambda a, b: a | b, (yes(clean(c).isin("yes", "designated", "permissive", "true", "1")) for c in (motorcar, motor_vehicle, vehicle)))
    light = reduce(lambda a, b: a | b, (yes(clean(c).isin("yes", "designated", "permissive", "true", "1")) for c in (foot, bicycle)))
    return F.when(car, "car").when(light, "passenger").otherwise("unknown")


def speed_kmh(raw: Column) -> Column:
    """First numeric token; mph scaled; words and non-positive values give null."""
    s = clean(raw)
    body = F.trim(F.regexp_replace(s, r"(mph|km/h|kmh|kph)$", ""))
    token = F.regexp_extract(body, r"^[;,\s]*([^;,\s]+)", 1)
    number = F.when(token.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), token.try_cast("double"))
    number = F.when(number > 0, F.when(s.endswith("mph"), number * 1.609344).otherwise(number))
    return F.coalesce(lookup(s, SPEED_WORDS), number)


def duration_seconds(raw: Column) -> Column:
    """ISO 8601 without years, months and weeks; minutes up to a week; MM:SS, H:MM, H:MM:SS."""
    s = F.trim(raw)
    number = r"[0-9]+(?:\.[0-9]*)?|\.[0-9]+"
    iso = rf"^[Pp](?:({number})[Dd])?(?:[Tt](?:({number})[Hh])?(?:({number})[Mm])?(?:({number})[Ss])?)?$"
    part = lambda i: F.coalesce(F.regexp_extract(s, iso, i).try_cast("double"), F.lit(0.0))
    total = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    has_clock = s.rlike("^[Pp][^Tt]*[Tt].")
    from_iso = F.when(s.rlike(iso) & (has_clock | ((part(1) > 0) & F.lower(s).contains("d")) | s.rlike(r"^[Pp]0+[Dd]$")), total)
    pieces = F.split(s, ":")
    n = lambda i: F.trim(F.get(pieces, F.lit(i))).try_cast("double")
    good = lambda i: n(i).isNotNull() & (n(i) >= 0)
    two = F.when(good(0) & good(1) & (n(1) < 60), F.when(n(0) >= 60, n(0) * 60 + n(1)).otherwise((n(0) * 60 + n(1)) * 60))
    three = F.when(good(0) & good(1) & good(2) & (n(1) < 60) & (n(2) < 60), n(0) * 3600 + n(1) * 60 + n(2))
    minutes = F.when(good(0) & (n(0) <= 7 * 24 * 60), n(0) * 60)
    return F.coalesce(from_iso, F.when(F.size(pieces) == 1, minutes).when(F.size(pieces) == 2, two).when(F.size(pieces) == 3, three))


def duration_format(raw: Column) -> Column:
    s = F.trim(raw)
    return (
        F.when(s.isNull() | (s == ""), "missing").when(s.rlike("^[Pp]"), "iso8601").when(s.rlike(r"^[0-9]{1,2}:[0-9]{2}$"), "h:mm").when(s.rlike(r"^[0-9]+:[0-9]{2}:[0-9]{2}$"), "h:mm:ss")
        .when(s.rlike(r"^[0-9]+:[0-9]+$"), "mm:ss").when(s.rlike(r"^[0-9]+(\.[0-9]+)?$"), "minutes").otherwise("other")
    )


def duration_bucket(raw: Column) -> Column:
    """The form of a duration, as the coverage report names it."""
    s = F.trim(F.coalesce(raw, F.lit("")))
    first = F.regexp_extract(s, "^([0-9]+):", 1).try_cast("long")
    return (
        F.when(s == "", "empty").when(s.rlike("^[Pp].+$") & F.contains(F.upper(s), F.lit("T")), "iso8601").when(s.rlike(r"^[0-9]+(\.[0-9]+)?$"), "bare_minutes").when(s.rlike("^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"), "h_mm_or_hh_mm_ss")
        .when(s.rlike("^[0-9]{3,}:[0-9]{2}(:[0-9]{2})?$"), F.when(first < 60, "h_mm_three_digit_hours").otherwise("mm_ss_first_ge_60")).when(F.contains(s, F.lit(":")), "other_colon").otherwise("other")
    )


def metric(raw: Column) -> Column:
    """Every t and m letter goes; what is left must be a number."""
    left = F.trim(F.translate(F.lower(F.trim(raw)), "tm", ""))
    return F.when(left.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"), left.try_cast("double"))


def lanes(raw: Column) -> Column:
    n = F.regexp_extract(raw, "[0-9]+", 0).try_cast("int")
    return F.when(n <= 255, n)


def oneway_yes(raw: Column) -> Column:
    return yes(clean(raw).isin("yes", "true", "1"))


def truthy(raw: Column) -> Column:
    return yes(clean(raw).isin(*TOLL_YES))


def is_tunnel(raw: Column) -> Column:
    return yes(raw != "no")


def road_refs(ref: Column, int_ref: Column) -> Column:
    a, b = F.nullif(F.trim(ref), F.lit("")), F.nullif(F.trim(int_ref), F.lit(""))
    return F.when(a.isNotNull() & b.isNotNull() & (F.lower(a) != F.lower(b)), F.concat_ws(";", a, b)).otherwise(F.coalesce(a, b))


def surface_rank(highway: Column, surface: Column, tracktype: Column) -> Column:
    """0 good, 1 marginal, 2 poor; the worse of the two tags, else poor for tracks."""
    a = F.when(surface.isNotNull(), lookup(clean(surface), SURFACES, POOR))
    b = F.when(tracktype.isNotNull(), lookup(clean(tracktype), TRACKTYPES, POOR))
    return F.coalesce(F.greatest(a, b), F.when(highway == "track", POOR).otherwise(0))


def toll_applies(profile: str, toll: Column, specific: dict[str, Column]) -> Column:
    keys = {"car": ("motor_vehicle", "motorcar", "motorcycle"), "truck": ("motor_vehicle", "motorcar", "motorcycle", "hgv"), "bicycle": ("bicycle",), "foot": ("foot",)}[profile]
    own = [specific[k] for k in keys if k in specific]
    if not own:
        return truthy(toll)
    return F.when(F.coalesce(*own).isNotNull(), reduce(lambda a, b: a | b, map(truthy, own))).otherwise(truthy(toll))


def road_base(highway: Column) -> Column:
    return F.nullif(F.regexp_replace(clean(highway), "_link$", ""), F.lit(""))


def class_speed(highway: Column) -> Column:
    return lookup(road_base(highway), CLASS_SPEEDS, DEFAULT_SPEED)


def class_label(highway: Column) -> Column:
    return lookup(road_base(highway), CLASS_LABELS, "Road")


def travel_speed(practical: Column, posted: Column, advisory: Column, floor: Column, highway: Column) -> Column:
    some = lambda c: F.when(c > 0, c)
    return F.greatest(F.coalesce(some(practical), some(posted), some(advisory), class_speed(highway)), F.coalesce(some(floor), F.lit(0.0)))


def travel_hours(length_m: Column, kmh: Column) -> Column:
    return length_m / 1000 / F.greatest(kmh, F.lit(1.0))


def motorway_grade(highway: Column, motorroad: Column, expressway: Column, oneway: Column, n_lanes: Column, kmh: Column) -> Column:
    return yes(highway.isin("motorway", "motorway_link")) | motorroad | expressway | (oneway & yes(n_lanes >= 2) & yes(kmh >= 90))


def ferry_weight(length_m: Column, seconds: Column, profile: str) -> Column:
    rate = FERRY_EQUIVALENT_KMH * 1000 / 3600
    return F.coalesce(seconds * rate, length_m * (FERRY_EQUIVALENT_KMH / FERRY_SLOW_KMH)) + (FERRY_BOARDING_MIN * 60 * rate if profile in MOTOR else 0.0)


def soft_cost(rank: Column, has_speed: Column, ferry: Column, highway: Column, vehicle: str) -> Column:
    marginal, poor = SURFACE_COST[vehicle]
    surface = F.when(rank == 0, 1.0).when(rank == 1, marginal).otherwise(poor)
    exempt = ferry | highway.isNull() | yes(highway.isin(*NO_SPEED_EXEMPT)) | has_speed
    return surface * F.when(exempt, 1.0).otherwise(NO_SPEED_COST[vehicle])


def transition_cost(before: Column, after: Column) -> Column:
    return F.when(after - before > 1, 500.0).otherwise(0.0)


def boardwalk(bridge: Column, surface: Column) -> Column:
    return yes(clean(bridge) == "boardwalk") | yes(clean(surface) == "wood")


def boarding_candidate(ferry: Column, man_made: Column, highway: Column) -> Column:
    return ~ferry & (yes(F.lower(man_made) == "pier") | yes(highway.isin("footway", "platform")))


def wetland_class(natural: Column, wetland: Column) -> Column:
    """1 soft, 2 hard; an unknown subtype falls through to natural=wetland, which is soft."""
    w = clean(wetland)
    return F.when(w.isin("bog", "string_bog", "fen"), 1).when(w.isin("swamp", "reedbed"), 2).when(F.lower(natural) == "wetland", 1)


def wetland_class_strict(natural: Column, wetland: Column) -> Column:
    """The annotator's variant: an unknown subtype gives none, no subtype is soft."""
    w = F.coalesce(clean(wetland), F.lit(""))
    return F.when(w.isin("bog", "string_bog", "fen"), 1).when(w.isin("swamp", "reedbed"), 2).when((w == "") & (F.lower(natural) == "wetland"), 1)


def bike_unsuitable(capability: str, route: Column, mtb: Column, smoothness: Column, tracktype: Column, incline: Column, surface: Column) -> Column:
    scale, smooth, grade, slope = {"road": (1, 2, 3, 12.0), "trekking": (2, 4, 4, 18.0), "mountain": (5, 6, 5, 30.0)}[capability]
    ranks = {"excellent": 0, "good": 0, "intermediate": 1, "bad": 2, "very_bad": 3, "horrible": 4, "very_horrible": 5, "impassable": 6}
    level = F.trim(F.substring_index(mtb, ":", 1)).try_cast("int")
    percent = F.regexp_replace(F.trim(incline), "%+$", "").try_cast("double")
    graded = F.regexp_extract(clean(tracktype), "^grade([0-9]+)$", 1).try_cast("int")
    s = clean(surface)
    rough = {
        "road": s.isin("ground", "dirt", "earth", "grass", "sand", "mud", "snow", "ice", "compacted", "fine_gravel", "pebblestone", "gravel"),
        "trekking": s.isin("sand", "mud", "snow", "ice"),
        "mountain": F.lit(False),
    }[capability]
    mtb_route = yes(F.lower(route) == "mtb") if capability == "road" else F.lit(False)
    return mtb_route | yes(level.between(scale, 6)) | yes(lookup(clean(smoothness), ranks) >= smooth) | yes(graded.between(grade, 5)) | yes(F.abs(percent) > slope) | yes(rough)
