"""Feature segments measured against the path of a way: Arrow batches, whole columns at once.

The same rules as ``annotate.projected``, without an expression that is walked for every leg.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from waymill.functions import geo

AT_ONCE = 1 << 20  # (segment, leg) pairs held at a time; one segment's path at least
MEASURES = ("seg_m", "way_m", "chord_m", "along_a", "along_b", "d_a", "d_b", "own", "way_heading", "chord")


def paths(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of array<struct<lat, lon>>: where each path starts in the flat points, with the end, and their places."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    fields = dict(zip([f.name for f in column.type.value_type], column.flatten().flatten(), strict=True))
    at = lambda k: fields[k].cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(size)]), at("lat"), at("lon")


def _vector(lat1, lon1, lat2, lon2) -> tuple[np.ndarray, np.ndarray]:
    """Metres north and east."""
    return (lat2 - lat1) * geo.METRES_A_DEGREE, (lon2 - lon1) * (np.cos(np.radians((lat1 + lat2) / 2)) * geo.METRES_A_DEGREE)


def _metres(*ends) -> np.ndarray:
    north, east = _vector(*ends)
    return np.sqrt(east**2 + north**2)


def _heading(*ends) -> np.ndarray:
    north, east = _vector(*ends)
    return np.mod(np.degrees(np.arctan2(east, north)), 360.0)


def spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the things that are ``count`` each: its owner and its place there."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def _before(step: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the steps of a path before each of them, and over all, in the order of the path."""
    start = np.cumsum(count) - count
    before, done = np.zeros(len(step)), np.zeros(len(count))
    for i in range(int(count.max(initial=0))):
        at = np.flatnonzero(count > i)
        before[start[at] + i] = done[at]
        done[at] += step[start[at] + i]
    return before, done


def _projected(lat, lon, first, count, legs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distance, arc position and leg heading of the closest place to each point on its path, the first of equal ones."""
    d, along, head = np.full(len(lat), 1e18), np.zeros(len(lat)), np.zeros(len(lat))
    some = np.flatnonzero(count > 0)
    upto = np.cumsum(count[some])
    lower = 0
    while lower < len(some):
        upper = max(lower + 1, int(np.searchsorted(upto, (upto[lower - 1] if lower else 0) + AT_ONCE, "right")))
        own = some[lower:upper]
        owner, place = spread(count[own])
        leg = first[own][owner] + place
        ay, ax, by, bx, before, long, heading = (x[leg] for x in legs)
        py, px = lat[own][owner], lon[own][owner]
        k = np.cos(np.radians((py + ay + by) / 3)) * geo.METRES_A_DEGREE
        ey, ex, py, px = (by - ay) * geo.METRES_A_DEGREE, (bx - ax) * k, (py - ay) * geo.METRES_A_DEGREE, (px - ax) * k
        square = ex * ex + ey * ey
        t = np.where(square > 0, np.clip((px * ex + py * ey) / np.where(square > 0, square, 1.0), 0.0, 1.0), 0.0)
        far = np.sqrt((px - t * ex) ** 2 + (py - t * ey) ** 2)
        near = np.fmin.reduceat(far, np.cumsum(count[own]) - count[own])
        hit = np.flatnonzero(far == near[owner])[::-1]
        best = np.full(len(own), -1)
        best[owner[hit]] = hit
        ok = best >= 0
        at, best = own[ok], best[ok]
        d[at], along[at], head[at] = far[best], before[best] + t[best] * long[best], heading[best]
        lower = upper
    return d, along, head


def measured(nodes: pa.Array, points: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """For each segment of ``points``: its row, its number, and MEASURES against the path ``nodes`` of that row."""
    w, wy, wx = paths(nodes)
    f, fy, fx = paths(points)
    n = np.maximum(np.diff(w) - 1, 0)
    path, place = spread(n)
    a = w[path] + place
    ends = (wy[a], wx[a], wy[a + 1], wx[a + 1])
    long = _metres(*ends)
    before, way_m = _before(long, n)
    legs = (*ends, before, long, _heading(*ends))
    first = np.cumsum(n) - n
    row, segment = spread(np.maximum(np.diff(f) - 1, 0))
    a = f[row] + segment
    ends = (fy[a], fx[a], fy[a + 1], fx[a + 1])
    on = lambda lat, lon: _projected(lat, lon, first[row], n[row], legs)
    d_a, along_a, _ = on(ends[0], ends[1])
    d_b, along_b, _ = on(ends[2], ends[3])
    way_heading = on((ends[0] + ends[2]) / 2, (ends[1] + ends[3]) / 2)[2]
    whole = np.full((4, len(n)), np.nan)
    some = np.flatnonzero(np.diff(w) > 0)
    whole[:, some] = wy[w[some]], wx[w[some]], wy[w[some + 1] - 1], wx[w[some + 1] - 1]
    out = (_metres(*ends), way_m[row], _metres(*whole)[row], along_a, along_b, d_a, d_b, _heading(*ends), way_heading, _heading(*whole)[row])
    return row, segment, dict(zip(MEASURES, out, strict=True))


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``nodes`` and ``points`` to one row a segment: the other columns, ``segment`` and MEASURES."""
    for batch in batches:
        row, segment, out = measured(batch.column("nodes"), batch.column("points"))
        rest = [x for x in batch.schema.names if x not in ("nodes", "points")]
        kept = batch.select(rest).take(pa.array(row))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(segment, pa.int32()), *[pa.array(out[k], pa.float64()) for k in MEASURES]], [*rest, "segment", *MEASURES])
