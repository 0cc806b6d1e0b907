"""Work that must follow the answers and not the square of what is crowded."""

from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymill.functions import geo, limits
from waymill.operators import around, shared
from waymill.plans import annotate, measures, overlap
from waymill.queries import spatial


def metres(a, b, radius=geo.TOOL_RADIUS):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * radius * math.asin(min(1.0, math.sqrt(h)))


def joined(frame):
    """Rows of a frame, and the rows that its joins gave."""
    rows, out = frame.collect(), 0

    def walk(node):
        nonlocal out
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if "Join" in name:
            out += node.metrics().get("numOutputRows").get().value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return rows, out


FERRY = "ferry_id long, name string, is_car boolean, lat1 double, lon1 double, lat2 double, lon2 double"


def ferries_of(rows):
    """The pack's form of plain ferries, moved a little."""
    return [(i + 1000, name, *((y2, x2 + 0.001, y1, x1) if i % 2 else (y1 + 0.001, x1, y2, x2))) for i, name, _, y1, x1, y2, x2 in rows]


def some_ferries():
    random.seed(5)
    spot = lambda: (60 + random.random() / 4, 10 + random.random() / 4)
    hub = [(i, "hub", i % 3 == 0, 60.0, 10.0, 61 + 0.11 * (i % 20), 11 + 0.11 * (i // 20)) for i in range(400)]
    loose = [(500 + i, ["a", "b", "", None][i % 4], i % 2 == 0, *spot(), *spot()) for i in range(120)]
    return hub + loose + [(900, "a", True, 89.99, 0.0, 89.99, 20.0), (901, "a", False, 89.99, 1.0, 89.99, 201.0 - 180.0), (902, "a", False, 60.0, 179.999, 61.0, 179.999), (903, "a", False, 60.0, -179.999, 61.0, -179.999)]


@pytest.mark.parametrize("limit", [1600.0, 9000.0])
def test_lines_near_at_both_ends_equal_all_pairs(spark, limit):
    rows = some_ferries()
    packs = ferries_of(rows)
    f = spark.createDataFrame(rows, FERRY)
    p = spark.createDataFrame(packs, "pack_id long, pack_name string, u1 double, v1 double, u2 double, v2 double")
    for same in (False, True):
        found, pairs = joined(spatial.ferry_pairs(f.drop("is_car"), p, limit, same_name=same).select("ferry_id", "pack_id", "metres"))
        want = {}
        for i, name, _, *a in rows:
            for j, other, *b in packs:
                d = min(metres(a[:2], b[:2]) + metres(a[2:], b[2:]), metres(a[:2], b[2:]) + metres(a[2:], b[:2]))
                if d <= limit and (not same or (name and name == other)):
                    want[i, j] = d
        got = {}
        for r in found:
            got[r[0], r[1]] = min(r[2], got.get((r[0], r[1]), math.inf))
        assert got == pytest.approx(want, abs=1e-4) and len(want) > 100
        assert pairs < 20_000  # one harbour alone has 160,000


def test_steps_leave_no_shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    there = lambda: sum("shuffle_" in x for x in files.getAllFiles().mkString(" ").split(" "))
    before = there()
    step = shared.materialize(spark.range(1000).repartition(7).groupBy("id").count(), "shuffled")
    assert step.count() == 1000 and there() <= before + 2  # those of the count itself
    shared.release(step)


POINTS = "array<struct<lat:double,lon:double>>"


def test_segments_measured_in_batches_equal_the_expression(spark, monkeypatch):
    random.seed(3)
    path = lambda n: [(59 + random.random() * 1e-3, 10 + random.random() * 1e-3) for _ in range(n)]
    rows = [(i, path(i % 6), path(i % 5)) for i in range(200)] + [(200, [(59.0, 10.0)] * 3, path(3)), (201, path(400), path(60))]
    frame = spark.createDataFrame(rows, f"id long, nodes {POINTS}, points {POINTS}")
    batch = pa.RecordBatch.from_pylist([{"nodes": [{"lat": y, "lon": x} for y, x in a], "points": [{"lat": y, "lon": x} for y, x in b]} for _, a, b in rows], schema=pa.schema([(k, pa.list_(pa.struct([("lat", pa.float64()), ("lon", pa.float64())]))) for k in ("nodes", "points")]))
    monkeypatch.setattr(measures, "AT_ONCE", 1000)
    row, segment, out = measures.measured(batch.column("nodes"), batch.column("points"))
    got = {(int(i), int(j)): {k: v[n] for k, v in out.items()} for n, (i, j) in enumerate(zip(row, segment, strict=True))}
    legs = frame.select("id", "nodes", F.posexplode(annotate.legs(F.col("points"))).alias("segment", "leg"))
    want = legs.select("id", "segment", *[annotate.projected(F.col(f"leg.{e}"), F.col("nodes")).alias(e) for e in "ab"], annotate.path_m(F.col("nodes")).alias("way_m"), annotate.heading(F.col("leg.a"), F.col("leg.b")).alias("own")).collect()
    assert len(want) == len(got) > 300
    for r in want:
        g = got[r["id"], r["segment"]]
        assert [g["d_a"], g["along_a"], g["d_b"], g["along_b"], g["way_m"], g["own"]] == pytest.approx([r["a"]["d"], r["a"]["along"], r["b"]["d"], r["b"]["along"], r["way_m"], r["own"]], abs=1e-6)


def test_limits_are_taken_apart_once(spark):
    values = [None, "", " ", "3.5", "12'6\"", "4 m", "350cm", "13 ft", "3,8", "default", "Below_Default", "-1", "2 @ x", "-3'2", "5 ft,", "6'3in", "1,2,3", "3500 kg", "20 lbs", "yes", "5x", "'", "5.", "5 ft 3 xx", "0", "7;8"]
    frame = spark.createDataFrame([(v,) for v in values], "raw string")
    raw = F.col("raw")
    made = limits.parsed(frame, "raw")
    assert sorted(map(str, made.collect())) == sorted(map(str, frame.select("raw", limits.value_class(raw).alias("class"), limits.length_metres(raw).alias("length_m"), limits.weight_tonnes(raw).alias("weight_t")).collect()))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") <= 8  # the expressions that copy their parts have hundreds


def test_candidates_meet_in_blocks(spark):
    random.seed(6)
    line = lambda: (y := 59 + random.random() * 4e-3, x := 10 + random.random() * 4e-3) and [(y + i * 3e-4, x + i * 1e-4) for i in range(3)]
    w, f = [(i, line()) for i in range(60)], [(i, line()) for i in range(60)]
    ways = spark.createDataFrame([(i, "primary", "", False, False, p) for i, p in w], f"way_id long, highway string, name string, is_bridge boolean, is_tunnel boolean, nodes {POINTS}")
    features = spark.createDataFrame([(i, "primary", "", False, False, p) for i, p in f], f"feature_id long, base string, name string, is_bridge boolean, is_tunnel boolean, points {POINTS}")
    cell = lambda v: math.floor(v / annotate.CELL)
    want = {(i, j) for i, p in w for j, q in f if any(abs(cell(a[0]) - cell(b[0])) <= 2 and abs(cell(a[1]) - cell(b[1])) <= 2 for a in p for b in q)}
    found, pairs = joined(annotate.candidates(ways, features).select("way_id", "feature_id"))
    assert {tuple(r) for r in found} == want and 100 < len(want) < 3600
    plan = annotate.candidates(ways, features)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "array(struct" not in plan  # no row for each of 25 cells


def test_wet_segments_small_and_wide(spark):
    random.seed(8)
    at = lambda w: (59 + random.random() / 50, 10 + random.random() / 50, w)
    legs = [(i, y, x, y + w, x + w / 2) for i, (y, x, w) in enumerate([at(2e-4) for _ in range(900)] + [at(0.3) for _ in range(20)])]
    tri = [(1 + i % 2, y, x, y + w, x + w / 3, y, x + w) for i, (y, x, w) in enumerate([at(4e-4) for _ in range(900)] + [at(0.2) for _ in range(6)])]
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])

    def hits(p, q, v):
        for m in (p, q, ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)):
            d = [side(v[i], v[(i + 1) % 3], m) for i in range(3)]
            if not (min(d) < 0 < max(d)):
                return True
        return any(side(v[i], v[i - 1], p) * side(v[i], v[i - 1], q) < 0 and side(p, q, v[i]) * side(p, q, v[i - 1]) < 0 for i in range(3))

    want = {}
    for i, y1, x1, y2, x2 in legs:
        for k, *v in tri:
            if hits((x1, y1), (x2, y2), [(v[1], v[0]), (v[3], v[2]), (v[5], v[4])]):
                want[i] = max(k, want.get(i, 0))
    s = spark.createDataFrame(legs, "way_id long, lat1 double, lon1 double, lat2 double, lon2 double")
    t = spark.createDataFrame(tri, "class int, y0 double, x0 double, y1 double, x1 double, y2 double, x2 double")
    found, pairs = joined(annotate.wet_segments(s, t))
    assert {r[0]: r[1] for r in found} == want and len(want) > 50
    assert pairs < 50_000


@pytest.mark.parametrize("degrees", [False, True])
def test_points_around_equal_all_pairs(spark, monkeypatch, degrees):
    random.seed(9)
    monkeypatch.setattr(around, "PART", 150)
    spot = lambda w: (60 + random.random() * w, 10 + random.random() * w)
    points = [(i, *spot(0.05 if i % 2 else 0.001)) for i in range(1500)] + [(2000, 60.0, 10.0), (1999, 60.0, 10.0)]
    asked = [(i, *spot(0.08 if i % 3 else 0.002)) for i in range(150)] + [(900, 60.0, 10.0), (901, 70.0, 10.0)]
    q, p = spark.createDataFrame(asked, "name long, lat double, lon double"), spark.createDataFrame(points, "name long, to_lat double, to_lon double")
    want = {}
    for i, *a in asked:
        near = [(metres(a, b), (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2, j) for j, *b in points]
        near = [x for x in near if x[0] <= 900]
        if near:
            want[i] = (len(near), min(near)[0], min((d if degrees else m, j) for m, d, j in near)[1])
    found, pairs = joined(around.around(q, p, 900.0, degrees=degrees))
    assert {r["name"]: (r["n"], pytest.approx(r["metres"], abs=1e-6), r["first"]) for r in found} == want and len(want) > 80
    assert pairs < 20_000 < sum(n for n, *_ in want.values())  # a join on cells gives a row a pair


def test_polygon_cells_are_disjoint_and_split_once(spark):
    """Leaves over several first cells: disjoint cells, areas that add up, and no step a level."""
    ring = lambda y, x, r: [(y + r, x), (y, x + r), (y - r, x), (y, x - r)]
    regions = spark.createDataFrame([(1, [(59.1, 10.1), (59.1, 12.3), (60.9, 12.3), (60.9, 10.1)])], f"region_id long, ring {POINTS}")
    leaves = spark.createDataFrame([(i, ring(59.5 + i / 7, 10.5 + i / 5, 0.1 + i / 10)) for i in range(6)], f"leaf_id long, ring {POINTS}")
    before = len(shared._WRITTEN)
    found = overlap.cells(regions, leaves)
    assert len(shared._WRITTEN) == before  # seven steps before, with the sides of each cell in them
    rows = found.collect()
    assert len({r["leaf_id"] for r in rows}) == 6
    for leaf in range(6):
        own = {(r["level"], r["y"], r["x"]) for r in rows if r["leaf_id"] == leaf}
        assert len(own) == sum(r["leaf_id"] == leaf for r in rows) and not any((lv - k, y >> k, x >> k) in own for lv, y, x in own for k in range(1, lv + 1))
    area = sum(4.0 ** -r["level"] / 4 for r in rows if r["leaf_id"] == 2 and r["inside"])
    assert area == pytest.approx(2 * 0.3**2, rel=0.05)  # wholly inside the region
