"""Overlap of polygons with polygons by adaptive cells.

Both sides are cut into the cells of one grid; a pair meets in the cells that both boxes touch. A
cell that no side of a polygon comes near is wholly inside or outside; only cells that are mixed for
either polygon are split in four, down to ``depth``. So work follows the length of the borders and
not the area. What is still mixed at the end is judged by its middle; the areas of those cells are
the error bound of the pair. Areas are square degrees times the cosine of a cell's middle latitude.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.functions import geo
from waymill.operators.shared import materialize
from waymill.plans import measures

SIZE, DEPTH = 0.5, 6
#: Fixed values of the mapping rule, in per cent.
INCLUDE_PCT, MICRO_PCT, OUTSIDE_OVERSPILL_PCT, OUTSIDE_COVERAGE_PCT = 0.5, 0.05, 50.0, 25.0

_KEY = ["region_id", "leaf_id"]


AT_ONCE = 4096  # sides of the pairs that are split together; one pair at least


class _Rings:
    """Rings of a batch: of each row its sides as both ends, in flat arrays, closed or not."""

    def __init__(self, column: pa.Array):
        start, lat, lon = measures.paths(column)
        self.count, self.start = np.diff(start), start[:-1]
        after = np.arange(len(lat)) + 1
        some = np.flatnonzero(self.count)
        after[start[some + 1] - 1] = start[some]
        self.sides = np.stack([lat, lon, lat[after], lon[after]]) if len(lat) else np.zeros((4, 0))

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each side of each row: its place in ``rows`` and the side."""
        owner, place = measures.spread(self.count[rows])
        return owner, self.start[rows][owner] + place

    def hold(self, rows: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        """Ray casting, as ``geo.in_ring``."""
        owner, side = self.of(rows)
        (py, px, qy, qx), y, x = self.sides[:, side], lat[owner], lon[owner]
        flips = ((py > y) != (qy > y)) & (x < (qx - px) * (y - py) / (qy - py + geo.EPSILON) + px)
        return np.bincount(owner[flips], minlength=len(rows)) % 2 == 1


def _near(sides: np.ndarray, y: np.ndarray, x: np.ndarray, half: float) -> np.ndarray:
    """Sides that meet the cell: their boxes overlap, and the cell is not all on one side of their line."""
    ay, ax, by, bx = sides
    boxes = (np.minimum(ay, by) <= y + half) & (np.maximum(ay, by) >= y - half) & (np.minimum(ax, bx) <= x + half) & (np.maximum(ax, bx) >= x - half)
    dx, dy = bx - ax, by - ay
    return boxes & (np.abs(dx * (y - ay) - dy * (x - ax)) <= half * (np.abs(dx) + np.abs(dy)) * (1 + 1e-9))


def _split(rings: tuple[_Rings, _Rings], row: np.ndarray, y: np.ndarray, x: np.ndarray, size: float, depth: int) -> Iterator[tuple]:
    """row, level, y, x, inside, mixed of cells, from the first cells of each row."""
    held = [np.zeros(len(row), bool) for _ in rings]
    sides = [r.of(row) for r in rings]
    for level in range(depth + 1):
        width, last = size / (1 << level), level == depth
        lat, lon = (y + 0.5) * width, (x + 0.5) * width
        keep, unsure = np.ones(len(row), bool), np.zeros(len(row), bool)
        for k, r in enumerate(rings):
            cell, side = sides[k]
            near = _near(r.sides[:, side], lat[cell], lon[cell], width / 2)
            cell, side = sides[k] = cell[near], side[near]
            whole = np.bincount(cell, minlength=len(row)) == 0
            mixed = ~whole & ~held[k]
            ask = np.flatnonzero(~held[k] & (whole | last))
            held[k] = held[k].copy()
            held[k][ask] = r.hold(row[ask], lat[ask], lon[ask])
            keep &= held[k] | mixed
            unsure |= mixed
        inside = held[0] & held[1]
        done = keep & (inside | last)
        yield row[done], level, y[done], x[done], inside[done], unsure[done]
        if last:
            return
        go = np.flatnonzero(keep & ~inside)
        at = np.full(len(row), -1)
        at[go] = np.arange(len(go))
        row, held = np.repeat(row[go], 4), [np.repeat(h[go], 4) for h in held]
        y, x = (y[go][:, None] * 2 + np.array([0, 0, 1, 1])).ravel(), (x[go][:, None] * 2 + np.array([0, 1, 0, 1])).ravel()
        for k, (cell, side) in enumerate(sides):
            cell, side = at[cell[at[cell] >= 0]], side[at[cell] >= 0]
            sides[k] = (cell[:, None] * 4 + np.arange(4)).ravel(), np.repeat(side, 4)


def cells(regions: DataFrame, leaves: DataFrame, size: float = SIZE, depth: int = DEPTH) -> DataFrame:
    """region_id, leaf_id, level, y, x, inside, mixed: the disjoint cells inside both polygons of a pair, and all cells
    that are still mixed at the end, whose middle says if they are inside.

    regions and leaves: an id and ``ring``. A pair meets in the first cell that both boxes touch, and is split there by Arrow batches.
    """

    def boxed(df: DataFrame, key: str, side: str) -> DataFrame:
        b = geo.ring_bounds(F.col("ring"))
        made = df.select(key, F.col("ring").alias(f"{side}_ring"), *[F.floor(b[k] / size).alias(f"{side}_{k}") for k in b])
        rows = made.withColumn("y", F.explode(F.sequence(f"{side}_min_lat", f"{side}_max_lat")))
        return rows.withColumn("x", F.explode(F.sequence(f"{side}_min_lon", f"{side}_max_lon")))

    first = (F.col("y") == F.greatest("a_min_lat", "b_min_lat")) & (F.col("x") == F.greatest("a_min_lon", "b_min_lon"))
    met = boxed(regions, "region_id", "a").join(boxed(leaves, "leaf_id", "b"), ["y", "x"]).filter(first)
    pairs = met.select(*_KEY, "a_ring", "b_ring", "y", "x", F.least("a_max_lat", "b_max_lat").alias("y_end"), F.least("a_max_lon", "b_max_lon").alias("x_end"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = _Rings(batch.column("a_ring")), _Rings(batch.column("b_ring"))
            y, x, y_end, x_end = (batch.column(k).to_numpy() for k in ("y", "x", "y_end", "x_end"))
            wide = x_end - x + 1
            count = (y_end - y + 1) * wide
            upto, lower = np.cumsum(count * (rings[0].count + rings[1].count)), 0
            while lower < batch.num_rows:
                upper = max(lower + 1, int(np.searchsorted(upto, (upto[lower - 1] if lower else 0) + AT_ONCE, "right")))
                owner, place = measures.spread(count[lower:upper])
                row = owner + lower
                for at, level, cy, cx, inside, mixed in _split(rings, row, y[row] + place // wide[row], x[row] + place % wide[row], size, depth):
                    ids = batch.select(_KEY).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(np.full(len(at), level), pa.int32()), pa.array(cy), pa.array(cx), pa.array(inside), pa.array(mixed)], [*_KEY, "level", "y", "x", "inside", "mixed"])
                lower = upper

    kinds = dict(pairs.dtypes)
    return pairs.mapInArrow(split, ", ".join(f"{k} {kinds[k]}" for k in _KEY) + ", level int, y long, x long, inside boolean, mixed boolean")


def _area(size: float) -> Column:
    width = F.lit(size) / F.pow(F.lit(2.0), F.col("level"))
    return width * width * F.cos(F.radians((F.col("y") + 0.5) * width))


def overlaps(regions: DataFrame, leaves: DataFrame, size: float = SIZE, depth: int = DEPTH) -> DataFrame:
    """Leaves kept for each region: coverage_pct, overspill_pct, mostly_outside, reason, error_pct, and union_pct of the region by all kept leaves.

    Coverage below the micro threshold goes, and so does a leaf that is mostly outside with little
    coverage. ``error_pct`` bounds the error of the coverage by the cells judged by their middle.
    """
    held = materialize(cells(regions, leaves, size, depth), "overlap-cells")
    area = _area(size)
    sums = held.groupBy(*_KEY).agg(F.sum(F.when(F.col("inside"), area).otherwise(0.0)).alias("inner"), F.sum(F.when(F.col("mixed"), area).otherwise(0.0)).alias("unsure"))
    own = regions.select("region_id", geo.ring_area(F.col("ring")).alias("region_area"))
    other = leaves.select("leaf_id", geo.ring_area(F.col("ring")).alias("leaf_area"))
    cover, spill = 100 * F.col("inner") / F.col("region_area"), 100 * F.greatest(F.lit(0.0), 1 - F.col("inner") / F.col("leaf_area"))
    made = sums.join(own, "region_id").join(other, "leaf_id").filter("region_area > 0").select(*_KEY, cover.alias("coverage_pct"), spill.alias("overspill_pct"), (100 * F.col("unsure") / F.col("region_area")).alias("error_pct"), "region_area")
    outside = F.col("overspill_pct") >= OUTSIDE_OVERSPILL_PCT
    kept = materialize(made.filter(F.col("coverage_pct") >= MICRO_PCT).filter(~(outside & (F.col("coverage_pct") < OUTSIDE_COVERAGE_PCT))), "kept-leaves")
    # The union: cells of kept leaves, each once, without those that a larger one holds.
    each = held.filter("inside").join(kept.select(*_KEY), _KEY, "left_semi").select("region_id", "level", "y", "x").distinct()
    above = each.withColumn("up", F.explode(F.when(F.col("level") > 0, F.sequence(F.lit(1), F.col("level"))).otherwise(F.array().cast("array<int>"))))
    parents = above.select("region_id", (F.col("level") - F.col("up")).alias("p_level"), F.expr("shiftright(y, up)").alias("p_y"), F.expr("shiftright(x, up)").alias("p_x"), "level", "y", "x")
    covered = parents.join(each.select("region_id", F.col("level").alias("p_level"), F.col("y").alias("p_y"), F.col("x").alias("p_x")), ["region_id", "p_level", "p_y", "p_x"], "left_semi").select("region_id", "level", "y", "x").distinct()
    union = each.join(covered, ["region_id", "level", "y", "x"], "left_anti").groupBy("region_id").agg(F.sum(area).alias("union_area"))
    reason = F.when(F.col("coverage_pct") >= INCLUDE_PCT, "threshold").otherwise("micro_land_overlap")
    return kept.join(union, "region_id").select(*_KEY, "coverage_pct", "overspill_pct", outside.alias("mostly_outside"), reason.alias("reason"), "error_pct", F.least(F.lit(100.0), 100 * F.col("union_area") / F.col("region_area")).alias("union_pct"))
