"""Points within a fixed distance: how many there are, and the first of them, without a row for each pair.

Points stand in cells twice as wide as the distance, queries in those cells that their circle meets. A
cell is one group of Arrow columns, and a crowded one is cut into parts of a fixed size. Within a group
the points lie in bands of latitude, sorted by longitude: the part of a band that is surely inside the
circle is counted by its two ends, and only what lies near the circle's line is computed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.functions import geo
from waymill.operators import cells

PART = 100_000  # rows of one side in a group
BANDS = 32  # bands a radius
AT_ONCE = 1 << 20  # pairs computed at a time
SAFE = 1e-9  # degrees of doubt, left to the exact formula


def _metres(lat1, lon1, lat2, lon2, radius):
    a = np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * radius * np.arcsin(np.where(a > 1, 1.0, np.sqrt(a)))


class _Bands:
    """Points of a group, by band and longitude."""

    def __init__(self, lat, lon, name, high: float):
        self.high, self.south = high, lat.min() if len(lat) else 0.0
        band = np.floor((lat - self.south) / high).astype(np.int64)
        order = np.lexsort((lon, band))
        self.lat, self.lon, self.name, band = lat[order], lon[order], name[order], band[order]
        self.last = int(band[-1]) if len(band) else -1
        self.key = band * 1024.0 + self.lon  # longitudes are within 360 of each other
        self.start = np.searchsorted(band, np.arange(self.last + 2))

    def reach(self, lat, up):
        """First and last band that a height of ``up`` degrees round each latitude meets."""
        low = np.floor((lat - up - SAFE - self.south) / self.high)
        return np.clip(low, 0, self.last + 1).astype(np.int64), np.clip(np.floor((lat + up + SAFE - self.south) / self.high), -1, self.last).astype(np.int64)

    def place(self, band, lon):
        """How many points up to the end of the lower bands and, in this one, below a longitude."""
        at = np.searchsorted(self.key, band * 1024.0 + np.clip(lon, -500.0, 500.0))
        return np.clip(at, self.start[band], self.start[band + 1])


def _half(square, lat, other):
    """Degrees of longitude up to which the haversine is at most ``square`` (of it what the latitudes leave), 180 beyond all."""
    part = square / (np.cos(np.radians(lat)) * np.cos(np.radians(other)))
    return np.where(part < 0, -1.0, np.degrees(2 * np.arcsin(np.sqrt(np.clip(part, 0.0, 1.0)))))


def _widths(points, lat, band, metres, radius):
    """Half widths of a band: surely inside the circle, and perhaps."""
    south = points.south + band * points.high
    north = south + points.high
    edge = np.sin(metres / radius / 2) ** 2
    far = np.maximum(np.abs(lat - south), np.abs(lat - north))
    near = np.where((lat >= south) & (lat <= north), 0.0, np.minimum(np.abs(lat - south), np.abs(lat - north)))
    inner = np.minimum(np.abs(south), np.abs(north))  # the cosine is largest, so the haversine
    inner = np.where((south <= 0) & (north >= 0), 0.0, inner)
    outer = np.minimum(np.maximum(np.abs(south), np.abs(north)), 90.0)
    sure = _half(edge - np.sin(np.radians(far + SAFE) / 2) ** 2, lat, inner) - SAFE
    maybe = _half(edge - np.sin(np.radians(np.maximum(near - SAFE, 0.0)) / 2) ** 2, lat, outer) + SAFE
    return np.maximum(sure, 0.0), maybe


def _runs(first, last):
    """Owner and index of each place in the runs first..last - 1."""
    count = np.maximum(last - first, 0)
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]


def _chunks(count):
    """Slices of about AT_ONCE in sum."""
    upto, lower = np.cumsum(count), 0
    while lower < len(count):
        upper = max(lower + 1, int(np.searchsorted(upto, (upto[lower - 1] if lower else 0) + AT_ONCE, "right")))
        yield slice(lower, upper)
        lower = upper


def counted(points: _Bands, lat, lon, metres: float, radius: float) -> np.ndarray:
    n = np.zeros(len(lat), np.int64)
    first, last = points.reach(lat, math.degrees(metres / radius))
    for part in _chunks(np.maximum(last - first + 1, 0)):
        q, band = _runs(first[part], last[part] + 1)
        q += part.start
        sure, maybe = _widths(points, lat[q], band, metres, radius)
        a, b, c, d = (points.place(band, lon[q] + w) for w in (-maybe, -sure, sure, maybe))
        b, c = np.maximum(a, b), np.minimum(np.maximum(b, c), d)
        n += np.bincount(q, c - b, len(n)).astype(np.int64)
        for f, l in ((a, b), (c, d)):
            for some in _chunks(np.maximum(l - f, 0)):
                owner, at = _runs(f[some], l[some])
                own = q[some][owner]
                hit = _metres(lat[own], lon[own], points.lat[at], points.lon[at], radius) <= metres
                n += np.bincount(own[hit], minlength=len(n))
    return n


def first(points: _Bands, lat, lon, metres: float, radius: float, degrees: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least metres of a point within the limit, and the least (rank, name): by metres, or by the square of plane degrees."""
    least, rank, name = np.full(len(lat), np.inf), np.full(len(lat), np.inf), np.full(len(lat), -1, np.int64)
    if points.last < 0:
        return least, rank, name
    widest = math.degrees(metres / radius)
    shrink = np.maximum(np.cos(np.radians(np.minimum(np.abs(lat) + widest, 90.0))), 1e-3)
    out = lambda v, w: np.maximum(0.0, np.maximum(w.min() - v, v - w.max()))
    gap = np.maximum(out(lat, points.lat), out(lon, points.lon) * shrink)  # nothing is nearer to a query outside the points' box
    box = max((points.last + 1) * points.high * float(np.ptp(points.lon)), 1e-12)
    more, rest = max(math.sqrt(box / len(points.lat)), 1e-7), np.flatnonzero(gap <= widest)
    while len(rest):
        reach = np.minimum(gap[rest] + more, widest)
        low, high = points.reach(lat[rest], reach)
        for part in _chunks(np.maximum(high - low + 1, 0)):
            q, band = _runs(low[part], high[part] + 1)
            wide = (reach[part] / shrink[rest[part]])[q]
            q = rest[part][q]
            f, l = points.place(band, lon[q] - wide - SAFE), points.place(band, lon[q] + wide + SAFE)
            for some in _chunks(np.maximum(l - f, 0)):
                owner, at = _runs(f[some], l[some])
                own = q[some][owner]
                m = _metres(lat[own], lon[own], points.lat[at], points.lon[at], radius)
                ok = m <= metres
                own, at, m = own[ok], at[ok], m[ok]
                r = (lat[own] - points.lat[at]) ** 2 + (lon[own] - points.lon[at]) ** 2 if degrees else m
                np.minimum.at(least, own, m)
                order = np.lexsort((points.name[at], r, own))
                own, at, r = own[order], at[order], r[order]
                one = np.flatnonzero(np.diff(own, prepend=-1) != 0)
                own, at, r = own[one], at[one], r[one]
                better = (r < rank[own]) | ((r == rank[own]) & (points.name[at] < name[own]))
                rank[own[better]], name[own[better]] = r[better], points.name[at[better]]
        # What is left out is farther than ``reach`` in degrees, and in metres of latitude.
        done = (least[rest] <= np.radians(reach) * radius * 0.99) & ((rank[rest] <= reach * reach) if degrees else True)
        rest = rest[~(done | (reach >= widest))]
        more *= 2
    return least, rank, name


def _parts(df: DataFrame, count: DataFrame, own: str, other: str) -> DataFrame:
    """Rows of a crowded cell dealt over its parts, and repeated for each part of the other side."""
    there = df.join(F.broadcast(count), ["cy", "cx"], "left")
    n = lambda k: F.coalesce(F.col(k), F.lit(1))
    dealt = there.withColumn(own[2:], F.pmod(F.xxhash64("name", *[x for x in ("lat", "lon", "to_lat", "to_lon") if x in df.columns]), n(own)).cast("int"))
    return dealt.withColumn(other[2:], F.explode(F.sequence(F.lit(0), n(other).cast("int") - 1))).drop(own, other)


def around(queries: DataFrame, points: DataFrame, metres: float, degrees: bool = False, count: bool = True, radius: float = geo.TOOL_RADIUS) -> DataFrame:
    """name, n, metres, first of each query with a point at most ``metres`` away: how many (if ``count``), the least distance, and
    the point of the least (distance, name), or with ``degrees`` (square of plane degrees, name).

    queries: name, lat, lon; points: name, to_lat, to_lon, both read twice. Names are longs, positions within 180 degrees of each other.
    """
    high = 2 * math.degrees(metres / radius)
    q = cells._reached(queries.filter("lat is not null and lon is not null"), "lat", "lon", metres, high, radius, "").filter(F.col("least") <= metres * (1 + 1e-9)).drop("least")
    n = cells._columns(F.col("cy"), high)
    p = points.filter("to_lat is not null and to_lon is not null").withColumn("cy", F.floor(F.col("to_lat") / high)).withColumn("cx", F.pmod(F.floor(F.col("to_lon") * n / 360), n))
    crowd = lambda df, k: df.groupBy("cy", "cx").agg(F.ceil(F.count(F.lit(1)) / PART).alias(k)).filter(F.col(k) > 1)
    # Crowded cells are at most rows / PART, so the list is short.
    hot = crowd(p, "n_p_part").join(crowd(q, "n_q_part"), ["cy", "cx"], "full_outer")
    key = ["cy", "cx", "p_part", "q_part"]
    p, q = _parts(p, hot, "n_p_part", "n_q_part"), _parts(q, hot, "n_q_part", "n_p_part")

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        get = lambda t, k: t.column(k).to_numpy()
        if not left.num_rows or not right.num_rows:
            return pa.table({"name": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "metres": pa.array([], pa.float64()), "rank": pa.array([], pa.float64()), "first": pa.array([], pa.int64())})
        lat, lon = get(left, "lat"), get(left, "lon")
        bands = _Bands(get(right, "to_lat"), get(right, "to_lon"), get(right, "name"), math.degrees(metres / radius) / BANDS)
        m, rank, found = first(bands, lat, lon, metres, radius, degrees)
        some = np.isfinite(m)
        number = counted(bands, lat[some], lon[some], metres, radius) if count else np.ones(int(some.sum()), np.int64)
        return pa.table({"name": get(left, "name")[some], "n": number, "metres": m[some], "rank": rank[some], "first": found[some]})

    found = q.groupBy(*key).cogroup(p.groupBy(*key)).applyInArrow(group, "name long, n long, metres double, rank double, first long")
    best = found.groupBy("name").agg(F.sum("n").alias("n"), F.min("metres").alias("metres"), F.min(F.struct("rank", "first")).alias("m"))
    return best.select("name", *(["n"] if count else []), "metres", F.col("m.first").alias("first"))
