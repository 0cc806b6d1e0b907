"""Column geometry: distances, rings, grids, tiles, energy. Angles in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAPH_RADIUS, TOOL_RADIUS = 6_378_100.0, 6_371_000.0
METRES_A_DEGREE = 111_320.0
EPSILON = 2.220446049250313e-16
MERCATOR_LIMIT = 85.0511
QUANTUM = 1e-5


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = GRAPH_RADIUS) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.when(a > 1, 1.0).otherwise(F.sqrt(a)))


def path_length(points: Column, radius: float = GRAPH_RADIUS) -> Column:
    """Of array<struct<lat, lon>>; nulls in it are passed over."""
    p = F.filter(points, lambda x: x["lat"].isNotNull() & x["lon"].isNotNull())
    steps = F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: haversine(a["lat"], a["lon"], b["lat"], b["lon"], radius))
    return F.aggregate(steps, F.lit(0.0), lambda s, d: s + d)


def segment_distance(lat: Column, lon: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column, lat0: Column | None = None) -> Column:
    """Metres from a point to a segment on a local plane; ``lat0`` sets its scale (the point's own if none)."""
    k = F.cos(F.radians(lat if lat0 is None else lat0)) * METRES_A_DEGREE
    ax, ay, bx, by = (lon1 - lon) * k, (lat1 - lat) * METRES_A_DEGREE, (lon2 - lon) * k, (lat2 - lat) * METRES_A_DEGREE
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / square))).otherwise(0.0)
    return F.sqrt(F.pow(ax + t * dx, 2) + F.pow(ay + t * dy, 2))


def cross(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segments_meet(a: tuple, b: tuple, c: tuple, d: tuple, touching: bool = True) -> Column:
    """Do segments ab and cd, points as (x, y), meet; ``touching`` counts shared points."""
    d1, d2, d3, d4 = cross(*c, *d, *a), cross(*c, *d, *b), cross(*a, *b, *c), cross(*a, *b, *d)
    proper = (d1 * d2 < 0) & (d3 * d4 < 0)
    if not touching:
        return proper

    def on(o: Column, p: tuple, q: tuple, r: tuple) -> Column:
        return (o == 0) & r[0].between(F.least(p[0], q[0]), F.greatest(p[0], q[0])) & r[1].between(F.least(p[1], q[1]), F.greatest(p[1], q[1]))

    return proper | on(d1, c, d, a) | on(d2, c, d, b) | on(d3, a, b, c) | on(d4, a, b, d)


def in_ring(lat: Column, lon: Column, ring: Column, guard: bool = True) -> Column:
    """Ray casting over array<struct<lat, lon>>, closed or not; ``guard`` adds an epsilon to the slope."""
    n = F.size(ring)
    after = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    eps = F.lit(EPSILON if guard else 0.0)
    flips = F.zip_with(
        ring, after,
        lambda p, q: F.when(((p["lat"] > lat) != (q["lat"] > lat)) & (lon < (q["lon"] - p["lon"]) * (lat - p["lat"]) / (q["lat"] - p["lat"] + eps) + p["lon"]), 1).otherwise(0),
    )
    return F.aggregate(flips, F.lit(0), lambda s, f: s + f) % 2 == 1


def in_polygon(lat: Column, lon: Column, outer: Column, holes: Column) -> Column:
    return in_ring(lat, lon, outer, False) & ~F.exists(holes, lambda h: in_ring(lat, lon, h, False))


def in_triangle(px: Column, py: Column, a: tuple, b: tuple, c: tuple) -> Column:
    p = (px, py)
    d1, d2, d3 = cross(*a, *b, *p), cross(*b, *c, *p), cross(*c, *a, *p)
    return ~(((d1 < 0) | (d2 < 0) | (d3 < 0)) & ((d1 > 0) | (d2 > 0) | (d3 > 0)))


def ring_bounds(ring: Column) -> dict[str, Column]:
    lats, lons = F.transform(ring, lambda p: p["lat"]), F.transform(ring, lambda p: p["lon"])
    return {"min_lat": F.array_min(lats), "min_lon": F.array_min(lons), "max_lat": F.array_max(lats), "max_lon": F.array_max(lons)}


def ring_mean(ring: Column) -> dict[str, Column]:
    """Mean of the vertices, the closing one included."""

    def mean(k: str) -> Column:
        return F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[k]) / F.size(ring)

    return {"lat": mean("lat"), "lon": mean("lon")}


def ring_distance(lat: Column, lon: Column, ring: Column) -> Column:
    """Metres to a ring's edges, 0 inside."""
    n = F.size(ring)
    after = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    edges = F.array_min(F.zip_with(ring, after, lambda p, q: segment_distance(lat, lon, p["lat"], p["lon"], q["lat"], q["lon"])))
    return F.when(in_ring(lat, lon, ring), 0.0).otherwise(edges)


def ring_area(ring: Column) -> Column:
    """Planar square degrees times the cosine of the mean latitude."""
    n = F.size(ring)
    after = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    twice = F.aggregate(F.zip_with(ring, after, lambda p, q: p["lon"] * q["lat"] - q["lon"] * p["lat"]), F.lit(0.0), lambda s, x: s + x)
    return F.abs(twice) / 2 * F.cos(F.radians(ring_mean(ring)["lat"]))


def grid_stem(lat: Column, lon: Column) -> Column:
    """One-degree cell by its south-west corner, N60E010."""
    part = lambda v, width, plus, minus: F.concat(F.when(v >= 0, plus).otherwise(minus), F.lpad(F.abs(v).cast("string"), width, "0"))
    return F.concat(part(F.floor(lat), 2, "N", "S"), part(F.floor(lon), 3, "E", "W"))


def parse_stem(stem: Column) -> dict[str, Column]:
    n = lambda i: F.regexp_extract(stem, r"^([NS])([0-9]{2})([EW])([0-9]{3})$", i)
    return {"cell_lat": F.when(n(1) == "S", -n(2).try_cast("int")).otherwise(n(2).try_cast("int")), "cell_lon": F.when(n(3) == "W", -n(4).try_cast("int")).otherwise(n(4).try_cast("int"))}


def box_cells(min_lat: Column, min_lon: Column, max_lat: Column, max_lon: Column, size: float = 1.0) -> Column:
    """array<struct<cy, cx>> of the cells that a box touches, edges included."""
    ys = F.sequence(F.floor(min_lat / size), F.floor(max_lat / size))
    xs = F.sequence(F.floor(min_lon / size), F.floor(max_lon / size))
    return F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: F.struct(y.alias("cy"), x.alias("cx")))))


def _mercator(lat: Column) -> Column:
    rad = F.radians(F.greatest(F.least(lat, F.lit(MERCATOR_LIMIT)), F.lit(-MERCATOR_LIMIT)))
    return (1 - F.asinh(F.tan(rad)) / math.pi) / 2


def web_tile(lat: Column, lon: Column, zoom: int) -> dict[str, Column]:
    n = 1 << zoom
    inside = lambda v: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(v * n))).cast("int")
    return {"tx": inside((lon + 180) / 360), "ty": inside(_mercator(lat))}


def web_pixel(lat: Column, lon: Column, zoom: int, side: int = 512) -> dict[str, Column]:
    n = (1 << zoom) * side
    return {"px": (lon + 180) / 360 * n, "py": _mercator(lat) * n}


def web_tile_bounds(tx: Column, ty: Column, zoom: int) -> dict[str, Column]:
    n = float(1 << zoom)
    lat = lambda y: F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / n))))
    return {"north": lat(ty), "south": lat(ty + 1), "west": tx / n * 360 - 180, "east": (tx + 1) / n * 360 - 180}


def quantise(v: Column) -> Column:
    """Half-even in quanta of 1e-5 degrees."""
    return F.bround(v / QUANTUM, 0).cast("long")


def to_e7(v: Column) -> Column:
    return F.round(v * 1e7, 0).cast("long")


def geometry_hash(points: Column) -> Column:
    """Identity of a quantised path with altitudes in decimetres."""
    return F.sha2(F.array_join(F.transform(points, lambda p: F.concat_ws(",", quantise(p["lat"]), quantise(p["lon"]), F.bround(p["alt_m"] * 10, 0).cast("long"))), ";"), 256)


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar, 0 north, 0..360."""
    return F.pmod(F.degrees(F.atan2((lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2)), lat2 - lat1)), F.lit(360.0))


def undirected_angle(a: Column, b: Column) -> Column:
    """0..90 between two bearings, a reverse counting as the same."""
    d = F.pmod(F.abs(a - b), F.lit(180.0))
    return F.least(d, 180 - d)


def densified(lat1: Column, lon1: Column, lat2: Column, lon2: Column, step: float = 200.0) -> Column:
    """Samples on a leg at most ``step`` metres apart, its end included; none below a metre."""
    length = haversine(lat1, lon1, lat2, lon2, TOOL_RADIUS)
    n = F.greatest(F.ceil(length / step), F.lit(1)).cast("int")
    return F.when(length < 1, F.array().cast("array<struct<lat:double,lon:double>>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((lat1 + (lat2 - lat1) * i / n).alias("lat"), (lon1 + (lon2 - lon1) * i / n).alias("lon")))
    )


# Fixed physics: air density, gravity; rolling, drag, area, mass, speed, recovered share by drive.
AIR, GRAVITY = 1.225, 9.80665
DRIVES = {"car": (0.015, 0.32, 2.2, 1500.0, 25.0, 0.0), "car_electric": (0.015, 0.32, 2.2, 1500.0, 25.0, 0.4), "motorcycle": (0.015, 0.65, 0.60, 220.0, 25.0, 0.0), "motorcycle_electric": (0.015, 0.65, 0.60, 220.0, 25.0, 0.4)}


def flat_energy(metres: Column, drive: str = "car") -> Column:
    rolling, drag, area, mass, speed, _ = DRIVES[drive]
    return metres * (rolling * mass * GRAVITY + 0.5 * AIR * drag * area * speed * speed)


def segment_energy(metres: Column, climb: Column, drive: str = "car") -> Column:
    """Joules; a missing height difference costs the flat energy, never height zero's climb."""
    mass, back = DRIVES[drive][3], DRIVES[drive][5]
    flat = flat_energy(metres, drive)
    work = climb * (mass * GRAVITY)
    return F.when(climb.isNull(), flat).otherwise(F.greatest(flat + F.when(climb >= 0, work).otherwise(work * back), flat * 0.01))


def terrarium(r: Column, g: Column, b: Column) -> Column:
    """Metres of a red-green-blue height pixel."""
    return r * 256 + g + b / 256 - 32768
