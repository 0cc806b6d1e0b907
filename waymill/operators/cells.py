"""Grid-cell blocking for spatial joins: both sides to cells, an equi-join, then the exact test.

Catalyst would plan a range join as a nested loop; here the shuffle is on the cell, so AQE
can split a crowded cell and nothing is compared outside its neighbourhood.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.functions import geo


def own_cell(df: DataFrame, lat: str, lon: str, size: float) -> DataFrame:
    return df.withColumns({"cy": F.floor(F.col(lat) / size), "cx": F.floor(F.col(lon) / size)})


def neighbour_cells(df: DataFrame, lat: str, lon: str, size: float, ring: int = 1) -> DataFrame:
    """A row for each cell within ``ring`` cells of the point's own."""
    around = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in range(-ring, ring + 1) for x in range(-ring, ring + 1)])
    return df.withColumn("__d", F.explode(around)).withColumns({"cy": F.floor(F.col(lat) / size) + F.col("__d.y"), "cx": F.floor(F.col(lon) / size) + F.col("__d.x")}).drop("__d")


def box_in_cells(df: DataFrame, size: float, names: tuple[str, str, str, str] = ("min_lat", "min_lon", "max_lat", "max_lon")) -> DataFrame:
    return df.withColumn("__c", F.explode(geo.box_cells(*[F.col(n) for n in names], size))).withColumns({"cy": F.col("__c.cy"), "cx": F.col("__c.cx")}).drop("__c")


def within(left: DataFrame, right: DataFrame, metres: float, left_at=("lat", "lon"), right_at=("to_lat", "to_lon"), radius: float = geo.TOOL_RADIUS, max_lat: float = 62.0, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs at most ``metres`` apart and equal in ``on``, with their distance; other column names must not clash.

    The cell is as wide as ``metres`` at ``max_lat``, so one ring of neighbours is enough.
    """
    size = max(metres / (geo.METRES_A_DEGREE * math.cos(math.radians(max_lat))), 1e-4)
    joined = neighbour_cells(left, *left_at, size).join(own_cell(right, *right_at, size), ["cy", "cx", *on]).drop("cy", "cx")
    d = geo.haversine(*[F.col(x) for x in (*left_at, *right_at)], radius)
    return joined.withColumn("distance_m", d).filter(F.col("distance_m") <= metres)


def _columns(row: Column, high: float) -> Column:
    """Cells round the globe in a row of ``high`` degrees: as wide as high in its middle, one at a pole."""
    return F.greatest(F.lit(1), F.floor(360 / high * F.cos(F.radians(F.least(F.abs((row + 0.5) * high), F.lit(90.0))))))


def _reached(df: DataFrame, lat: str, lon: str, metres: float, high: float, radius: float, end: str) -> DataFrame:
    """A row for each cell that the circle round the point may meet, with ``least{end}``, metres to it at least."""
    y, x, arc = F.col(lat), F.col(lon), metres / radius
    up = math.degrees(arc) * (1 + 1e-9)
    far = math.sin(min(arc, math.pi / 2)) / F.cos(F.radians(y))  # the widest place of the circle
    side = F.when(far < 1, F.degrees(F.asin(far)) * (1 + 1e-9)).otherwise(180.0)
    row, n = F.col(f"cy{end}"), F.col("__n")
    rows = df.withColumn(f"cy{end}", F.explode(F.sequence(F.floor((y - up) / high), F.floor((y + up) / high)))).withColumn("__n", _columns(row, high))
    first = F.floor((x - side) * n / 360)
    both = rows.withColumn("__x", F.explode(F.sequence(first, F.least(F.floor((x + side) * n / 360), first + n - 1))))
    gap = lambda v, cell, size: F.greatest(F.lit(0.0), cell * size - v, v - (cell + 1) * size)
    down = F.radians(gap(y, row, high)) * radius
    off = F.radians(F.least(gap(x, F.col("__x"), 360 / n), F.lit(90.0)))
    least = F.greatest(down, F.when(n > 3, F.asin(F.least(F.lit(1.0), F.cos(F.radians(y)) * F.sin(off))) * radius).otherwise(0.0))
    return both.withColumns({f"cx{end}": F.pmod(F.col("__x"), n), f"least{end}": least}).drop("__x", "__n")


def within_ends(left: DataFrame, right: DataFrame, metres: float, radius: float = geo.TOOL_RADIUS, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of lines whose ends lie at most ``metres`` apart in sum, either way round, equal in ``on``; ``metres`` is that sum.

    left: lat1, lon1, lat2, lon2 and other columns; right: the same with ``to_`` before; other names must not clash.
    Both ends together are a place on a grid of four dimensions, so a line meets only those that are near at both
    ends; the right side stands there once for each way round, the left in every cell whose distance, summed over
    the ends, is within the limit. A pair may come once for each way round.
    """
    high = 2 * math.degrees(metres / radius)
    ends = ("lat1", "lon1", "lat2", "lon2")
    turned = F.array(*[F.struct(*[F.col(f"to_{x}").alias(f"to_{y}") for x, y in zip(order, ends, strict=True)]) for order in (ends, (*ends[2:], *ends[:2]))])
    rest = [x for x in right.columns if x not in {f"to_{e}" for e in ends}]
    places = ("cy1", "cx1", "cy2", "cx2")
    key = F.xxhash64(*[F.col(x) for x in (*places, *on)])
    own = right.withColumn("__e", F.explode(turned)).select(*rest, "__e.*").withColumns({f"cy{i}": F.floor(F.col(f"to_lat{i}") / high) for i in "12"})
    for i in "12":
        n = _columns(F.col(f"cy{i}"), high)
        own = own.withColumn(f"cx{i}", F.pmod(F.floor(F.col(f"to_lon{i}") * n / 360), n))
    own = own.withColumn("__k", key).drop(*places)
    met = _reached(left, "lat1", "lon1", metres, high, radius, "1").filter(F.col("least1") <= metres)
    met = _reached(met, "lat2", "lon2", metres, high, radius, "2").filter(F.col("least1") + F.col("least2") <= metres * (1 + 1e-9))
    # Two cells that share a key by hash would only give a pair again.
    met = met.withColumn("__k", key).drop(*places, "least1", "least2")
    apart = F.abs(F.col("lat1") - F.col("to_lat1")) + F.abs(F.col("lat2") - F.col("to_lat2")) <= math.degrees(metres / radius) * (1 + 1e-9)
    pairs = met.join(own, ["__k", *on]).drop("__k").filter(apart)
    d = lambda i: geo.haversine(*[F.col(x) for x in (f"lat{i}", f"lon{i}", f"to_lat{i}", f"to_lon{i}")], radius)
    return pairs.withColumn("metres", d(1) + d(2)).filter(F.col("metres") <= metres)


def contains(lat: Column, lon: Column, box: tuple[str, str, str, str] = ("min_lat", "min_lon", "max_lat", "max_lon")) -> Column:
    """Inclusive on every edge."""
    return lat.between(F.col(box[0]), F.col(box[2])) & lon.between(F.col(box[1]), F.col(box[3]))
