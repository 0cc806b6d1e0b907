"""Adaptive cells against exact clipping of convex polygons, and odd rings."""

from __future__ import annotations

import math
import random

import pytest

from waymill.plans import overlap


def clipped(subject, clip):
    """Convex ``subject`` within convex ``clip``, both counter-clockwise as (x, y)."""
    out = subject
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1], strict=True):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        kept = []
        for p, q in zip(out, out[1:] + out[:1], strict=True):
            s, t = side(p), side(q)
            if s >= 0:
                kept.append(p)
            if (s > 0 > t) or (s < 0 < t):
                kept.append((p[0] + (q[0] - p[0]) * s / (s - t), p[1] + (q[1] - p[1]) * s / (s - t)))
        out = kept
        if not out:
            return []
    return out


def area(points):
    twice = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1], strict=True))
    return abs(twice) / 2 * (math.cos(math.radians(sum(y for _, y in points) / len(points))) if points else 0)


def ring(x, y, r, corners, turn=0.1):
    return [(x + r * math.cos(turn + 2 * math.pi * i / corners), y + r * math.sin(turn + 2 * math.pi * i / corners)) for i in range(corners)]


def frame(spark, key, rings):
    return spark.createDataFrame([(i, [(y, x) for x, y in points]) for i, points in rings.items()], f"{key} long, ring array<struct<lat:double,lon:double>>")


def test_coverage_is_within_its_bound(spark):
    random.seed(4)
    regions = {i: ring(10 + random.random(), 59 + random.random(), 0.4, 7) for i in range(3)}
    leaves = {i: ring(10 + random.random() * 1.5, 59 + random.random() * 1.2, random.choice([0.05, 0.3, 0.9]), 5, 0.7) for i in range(12)}
    got = {(r["region_id"], r["leaf_id"]): r for r in overlap.overlaps(frame(spark, "region_id", regions), frame(spark, "leaf_id", leaves)).collect()}
    seen = 0
    for i, a in regions.items():
        for j, b in leaves.items():
            inner = area(clipped(b, a))
            cover, spill = 100 * inner / area(a), 100 * (1 - inner / area(b))
            r = got.get((i, j))
            if r is None:
                assert cover < 0.2 or (spill > 45 and cover < 26)
                continue
            seen += 1
            assert abs(r["coverage_pct"] - cover) <= r["error_pct"] + 0.3 and r["error_pct"] < 25
            assert r["mostly_outside"] == (r["overspill_pct"] >= 50) and r["reason"] == ("threshold" if r["coverage_pct"] >= 0.5 else "micro_land_overlap")
    assert seen >= 6


def test_union_counts_shared_ground_once(spark):
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    regions = {1: square(10.0, 60.0, 1.0)}
    leaves = {1: square(10.0, 60.0, 0.5), 2: square(10.25, 60.0, 0.5), 3: square(10.0, 60.0, 2.0), 4: square(30.0, 60.0, 1.0)}
    got = {r["leaf_id"]: r for r in overlap.overlaps(frame(spark, "region_id", regions), frame(spark, "leaf_id", {k: leaves[k] for k in (1, 2, 4)})).collect()}
    assert got.keys() == {1, 2} and got[1]["coverage_pct"] == pytest.approx(25, abs=1.5) and got[1]["union_pct"] == pytest.approx(37.5, abs=2.5)
    whole = overlap.overlaps(frame(spark, "region_id", regions), frame(spark, "leaf_id", {3: leaves[3], 1: leaves[1]})).filter("leaf_id = 3").first()
    assert whole["coverage_pct"] == pytest.approx(100, abs=4) and whole["mostly_outside"] and whole["union_pct"] == pytest.approx(100, abs=4)


def test_no_overlap_and_empty_tables(spark):
    none = spark.createDataFrame([], "region_id long, ring array<struct<lat:double,lon:double>>")
    assert overlap.overlaps(none, none.withColumnRenamed("region_id", "leaf_id")).collect() == []
