"""Queries on small inputs that a shortened job would answer differently."""

from __future__ import annotations

import hashlib
import heapq
import math

from waymill.functions import radio, tags
from waymill.plans import graph as plan
from waymill.queries import annotate, extras, lifecycle, spatial
from waymill.queries import graph as g
from waymill.queries.views import view


def test_unchanged_content_compares_the_whole_content(spark, tmp_path):
    rows = [(1, "2024-01-01", 7, "view", 0.0, '{"k": 87}'), (2, "2024-01-02", 7, "view", 0.0, '{"k": 81}'), (3, "2024-01-03", 7, "view", 0.0, '{"k": 81}'), (4, "2024-01-04", 7, "view", 0.0, None)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert [tuple(r) for r in lifecycle.r4_unchanged_content(spark, str(tmp_path)).collect()] == [(7, 1, 3)]


def cheapest(adj, start, goal, blocked):
    queue, done = [(0, start, 0)], set()
    while queue:
        cost, at, rank = heapq.heappop(queue)
        if at == goal:
            return cost
        if (at, rank) in done:
            continue
        done.add((at, rank))
        if at in blocked and at != start:
            continue
        for dst, w, s in adj.get(at, ()):
            heapq.heappush(queue, (cost + math.floor((w + (500 if s - rank > 1 else 0)) * 1000 + 0.5), dst, s))
    return None


def test_batch_paths_answer_every_customer(spark, sf):
    got = annotate.i2_batch_paths(spark, sf).collect()
    assert sorted(r["query"] for r in got) == sorted(r["c_custkey"] for r in spark.read.parquet(f"{sf}/customer.parquet").collect())
    closed = view(spark, sf, "v_nodes").filter(tags.barrier_blocks(annotate.c("barrier"), "car", *[annotate.c(x) for x in plan.ACCESS]))
    blocked, adj = {r["node_id"] for r in closed.collect()}, {}
    for r in g.edges(spark, sf).collect():
        adj.setdefault(r["src"], []).append((r["dst"], r["weight"], r["surface_rank"]))
    assert {r["query"]: r["cost"] for r in got} == {r["query"]: cheapest(adj, r["start"], r["goal"], blocked) for r in got}
    kinds = {"none": sum(r["cost"] is None for r in got), "some": sum((r["cost"] or 0) > 0 for r in got), "unplaced": sum(r["start"] is None or r["goal"] is None for r in got)}
    assert kinds["none"] and kinds["some"] and not kinds["unplaced"], kinds


def test_segments_in_rings_meet_sides_and_use_every_leg(spark, monkeypatch):
    """Ring: the box 1..2. Way 1 clips it, middle outside; 2 has only its second leg inside; 3 stays off; 4 is a point inside."""
    legs = [(1, 1.5, 1.9, 1.5, 4.0), (2, 0.0, 0.0, 0.0, 0.2), (2, 1.2, 1.2, 1.4, 1.4), (3, 0.0, 0.0, 0.5, 0.5), (4, 1.5, 1.5, 1.5, 1.5)]
    corners = [(9, 1, 0, 1.0, 1.0), (9, 1, 1, 1.0, 2.0), (9, 1, 2, 2.0, 2.0), (9, 1, 3, 2.0, 1.0)]
    points = spark.createDataFrame(corners, "region_id long, class int, vertex int, lat double, lon double")
    monkeypatch.setattr(spatial, "way_segments", lambda *_: spark.createDataFrame(legs, "way_id long, lat1 double, lon1 double, lat2 double, lon2 double"))
    monkeypatch.setattr(spatial, "view", lambda *_: points)
    assert sorted(tuple(r) for r in extras.j9_segments_in_rings(spark, "").collect()) == [(1, 9, 1), (2, 9, 1), (4, 9, 1)]


def test_way_segments_are_every_leg(spark, sf):
    nodes = {r["node_id"]: (r["lat"], r["lon"]) for r in view(spark, sf, "v_nodes").collect()}
    ways = {}
    for r in view(spark, sf, "v_way_nodes").collect():
        ways.setdefault(r["way_id"], []).append((r["pos"], nodes[r["node_id"]]))
    want = []
    for way, points in ways.items():
        p = [x for _, x in sorted(points)]
        want += [(way, *a, *b) for a, b in (zip(p, p[1:], strict=False) if len(p) > 1 else [(p[0], p[0])])]
    assert sorted(tuple(r) for r in spatial.way_segments(spark, sf).collect()) == sorted(want)


def test_hash_sample_takes_one_in_64_by_position_alone(spark, sf):
    nodes = view(spark, sf, "v_nodes").select("node_id", "lat", "lon").collect()
    place = lambda r: f"{math.floor(r['lat'] * 1e7)},{math.floor(r['lon'] * 1e7)}"
    want = sorted(r["node_id"] for r in nodes if int(hashlib.md5(place(r).encode()).hexdigest()[:8], 16) % 64 == 0)
    assert sorted(r["node_id"] for r in spatial.f18_hash_sample(spark, sf).collect()) == want
    assert abs(len(want) - len(nodes) / 64) < 5 * (len(nodes) / 64) ** 0.5


def test_element_lines_keep_long_tokens_and_bare_members(spark):
    line = "w7 v1 Nn1," + ",".join(f"n{i}" for i in range(300_000)) + " Tname=" + "a" * 1_200_000 + ",k=v Mn1@a%20%b,w2,r3@"
    got = spark.createDataFrame([(line,)], "line string").select(*[v.alias(k) for k, v in radio.opl(annotate.c("line")).items()]).first()
    assert len(got["nodes"]) == 300_001 and got["tags"]["k"] == "v" and len(got["tags"]["name"]) == 1_200_000
    assert [tuple(m) for m in got["members"]] == [("n", 1, "a b"), ("w", 2, ""), ("r", 3, "")]


def test_glacier_ends_block_without_a_crossing(spark, monkeypatch):
    """Boxes 1..2 and 3..4: way 1 lies inside the glacier, way 2 inside the soft ring, way 3 crosses both, way 4 is clear."""
    chords = [(1, 1.2, 1.2, 1.4, 1.4), (2, 3.2, 3.2, 3.4, 3.4), (3, 1.5, 1.5, 3.5, 3.5), (4, 0.0, 0.0, 0.1, 0.1)]
    box = lambda region, kind, low: [(region, kind, i, low + y, low + x) for i, (y, x) in enumerate(((0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)))]
    points = spark.createDataFrame(box(8, 2, 1.0) + box(9, 1, 3.0), "region_id long, class int, vertex int, lat double, lon double")
    monkeypatch.setattr(spatial, "way_chords", lambda *_: spark.createDataFrame(chords, "way_id long, lat1 double, lon1 double, lat2 double, lon2 double"))
    monkeypatch.setattr(spatial, "view", lambda *_: points)
    assert sorted(tuple(r) for r in spatial.j22_m7_barrier_crossings(spark, "").collect()) == [(1, 1), (3, 2)]
