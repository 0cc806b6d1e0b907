"""Iterative, streaming and array-shaped plans against plain versions on small inputs."""

from __future__ import annotations

import heapq
import math
import random

import pytest
from pyspark.sql import functions as F

from waymill.functions import clock, geo, limits, radio, tags
from waymill.operators import cells, shared
from waymill.operators.components import connected_components
from waymill.operators.ranks import at_rank
from waymill.operators.skew import salted_lookup
from waymill.plans import annotate, changes, gates, graph, routing
from waymill.queries import graph as graph_queries


def test_components(spark):
    random.seed(1)
    pairs = [(i, i + 1) for i in range(200)] + [(1000 + random.randrange(300), 1000 + random.randrange(300)) for _ in range(200)] + [(5000, 5000), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None:
            find(a), find(b)
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_run_few_tasks(spark):
    """The driver holds a record a task: with many partitions the rounds must not run a subplan twice."""
    context = spark.sparkContext._jsc.sc()

    def tasks():
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorList(True).apply(0).totalTasks()

    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    edges = shared.materialize(spark.range(1, 500).select(F.col("id").alias("src"), F.when(F.col("id") < 20, F.col("id") - 1).otherwise(0).alias("dst")))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        before = tasks()
        assert connected_components(edges).filter("component = 0").count() == 500
        ran = tasks() - before
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert ran < 1500, ran


def test_components_take_few_steps(spark):
    """The edges shrink with their trees: a chain, stars and a star around a large node in few tasks, with as many partitions."""
    context = spark.sparkContext._jsc.sc()

    def tasks():
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorList(True).apply(0).totalTasks()

    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    pairs = [(i, i - 1 if i < 20 else 0) for i in range(1, 500)] + [(2000, 1000 + i) for i in range(100)] + [(3000, 3000)]
    edges = shared.materialize(spark.createDataFrame(pairs, "src long, dst long"))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        before = tasks()
        got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
        ran = tasks() - before
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {**dict.fromkeys(range(500), 0), **dict.fromkeys([*range(1000, 1100), 2000], 1000), 3000: 3000}
    assert ran < 700, ran


def test_salted_lookup_keeps_every_row(spark):
    rows = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = salted_lookup(rows, sizes, "k", "n", 30000, F.col("id"))
    assert got.count() == 30000 and got.select("id").distinct().count() == 30000
    assert got.join(sizes.withColumnRenamed("n", "m"), "k").filter("n <> m").isEmpty()


def dijkstra(edges, start, goal, blocked):
    queue, best = [(0, start, 0)], {}
    while queue:
        cost, node, rank = heapq.heappop(queue)
        if node == goal:
            return cost
        if (node, rank) in best or (node in blocked and node != start):
            continue
        best[node, rank] = cost
        for dst, w, s in edges.get(node, ()):
            heapq.heappush(queue, (cost + math.floor((w + (500 if s - rank > 1 else 0)) * 1000 + 0.5), dst, s))
    return None


def test_batch_paths_equal_dijkstra(spark):
    random.seed(4)
    rows = [(random.randrange(60), random.randrange(60), random.randint(1, 900) / 4, random.randrange(3)) for _ in range(240)]
    adj = {}
    for a, b, w, s in rows:
        adj.setdefault(a, []).append((b, w, s))
    pairs = [(i, random.randrange(60), random.randrange(60)) for i in range(25)]
    blocked = {3, 7, 11}
    got = {r["query"]: r["cost"] for r in routing.shortest_paths(spark.createDataFrame(rows, "src long, dst long, weight double, surface_rank int"), spark.createDataFrame(pairs, "query long, start long, goal long"), spark.createDataFrame([(b,) for b in blocked], "node_id long")).collect()}
    assert got == {q: dijkstra(adj, a, b, blocked) for q, a, b in pairs}


def test_steps_are_released(spark):
    shared.release_all(spark)
    step = shared.materialize(spark.range(5), "kept")
    first, sums = shared.observed(spark.range(4), "seen", n=F.count(F.lit(1)), s=F.sum("id"))
    assert sums == {"n": 4, "s": 6} and step.count() == 5 and first.count() == 4
    shared.release(first)
    assert shared.release_all(spark) == 1 and shared.release_all(spark) == 0


def test_option_paths_equal_dijkstra(spark):
    random.seed(7)
    rows = [(random.randrange(40), random.randrange(40), random.randint(1, 900) / 4, random.randrange(3), random.sample(range(3), random.randint(0, 3)), random.choice([None, random.randint(1, 400) / 4])) for _ in range(260)]
    pairs = [(i, random.randrange(40), random.randrange(40), i % 3, i % 2 == 0) for i in range(30)]
    edges = spark.createDataFrame(rows, "src long, dst long, weight double, surface_rank int, options array<int>, eco_weight double")
    got = {r["query"]: r["cost"] for r in routing.shortest_paths(edges, spark.createDataFrame(pairs, "query long, start long, goal long, option_id int, use_eco boolean"), spark.createDataFrame([(3,)], "node_id long")).collect()}
    for q, a, b, option, eco in pairs:
        adj = {}
        for src, dst, w, s, options, e in rows:
            if option in options:
                adj.setdefault(src, []).append((dst, e if eco and e is not None else w, s))
        assert got[q] == dijkstra(adj, a, b, {3})
    assert any(v is not None for v in got.values()) and None in got.values()


def test_all_profiles_at_once_equal_single_builds(spark, sf):
    parts = graph_queries.parts(spark, sf)
    names = ["edge_id", "src", "dst", "length_m", "weight", "surface_rank", "is_ferry"]
    row = lambda r: (*r[:3], *[round(x, 6) for x in r[3:5]], *r[5:])
    got = {}
    for r in graph.profile_edges(*parts).select("profile", *names).collect():
        got.setdefault(r[0], []).append(row(tuple(r)[1:]))
    for p in graph.PROFILES:
        want = sorted(row(tuple(r)) for r in graph.edges(*parts, p).select(*names).collect())
        assert sorted(got[p]) == want and want


def test_boarding_promotes_the_pier_chain(spark):
    steps = spark.createDataFrame([(10, 1, 2, 200.0), (11, 2, 3, 250.0), (12, 2, 9, 100.0), (13, 5, 6, 800.0)], "way_id long, a long, b long, length_m double")
    roads = spark.createDataFrame([(3, 4, True, True), (6, 7, True, True), (8, 9, True, True), (4, 20, True, True)], "a long, b long, junction_a boolean, junction_b boolean")
    ends = spark.createDataFrame([(1,), (5,), (7,)], "node long")
    assert {r["way_id"] for r in routing.boarding_ways(steps, ends, roads).collect()} == {10, 11}


K = geo.METRES_A_DEGREE


def step_m(a, b):
    return math.hypot((b[1] - a[1]) * K * math.cos(math.radians((a[0] + b[0]) / 2)), (b[0] - a[0]) * K)


def place(p, path):
    best, done = (1e18, 0.0), 0.0
    for a, b in zip(path, path[1:], strict=False):
        x = K * math.cos(math.radians((p[0] + a[0] + b[0]) / 3))
        bx, by, px, py = (b[1] - a[1]) * x, (b[0] - a[0]) * K, (p[1] - a[1]) * x, (p[0] - a[0]) * K
        t = max(0, min(1, (px * bx + py * by) / (bx * bx + by * by))) if bx or by else 0
        d = math.hypot(px - t * bx, py - t * by)
        if d < best[0]:
            best = (d, done + t * step_m(a, b))
        done += step_m(a, b)
    return best


def test_projection_on_a_path(spark):
    random.seed(2)
    rows = []
    for i in range(60):
        path = [(59 + random.random() * 1e-3, 10 + random.random() * 1e-3) for _ in range(random.randint(2, 6))]
        rows.append((i, (59 + random.random() * 1e-3, 10 + random.random() * 1e-3), path))
    frame = spark.createDataFrame(rows, "id long, p struct<lat:double,lon:double>, path array<struct<lat:double,lon:double>>").select("id", annotate.projected(F.col("p"), F.col("path")).alias("x"), annotate.path_m(F.col("path")).alias("m"))
    for r in frame.collect():
        _, p, path = rows[r["id"]]
        d, along = place(p, path)
        assert r["x"]["d"] == pytest.approx(d, abs=1e-6) and r["x"]["along"] == pytest.approx(along, abs=1e-6)
        assert r["m"] == pytest.approx(sum(step_m(a, b) for a, b in zip(path, path[1:], strict=False)), abs=1e-6)


def test_limit_matching_guards(spark):
    line = lambda lat, lon, n=3, dy=2e-4, dx=0.0: [(lat + i * dy, lon + i * dx) for i in range(n)]
    ways = [(1, "primary", "a", False, False, line(59, 10)), (2, "primary", "", True, False, line(59.1, 10)), (3, "service", "", False, False, line(59.2, 10)), (4, "primary", "", False, False, line(59.3, 10))]
    features = [
        (11, "primary", "a", False, False, line(59, 10.00003)), (12, "track", "", False, False, line(59, 10.00001)), (13, "primary", "", False, False, line(59, 10.0003)), (14, "primary", "", False, False, line(59, 10, 2, 0.0, 1e-4)),
        (21, "primary", "", True, False, line(59.1, 10.00002)[::-1]), (22, "primary", "", False, False, line(59.1, 10.00002)), (31, "service-driveway", "", False, False, line(59.2, 10.0)),
    ]
    pts = "array<struct<lat:double,lon:double>>"
    w = spark.createDataFrame(ways, f"way_id long, highway string, name string, is_bridge boolean, is_tunnel boolean, nodes {pts}")
    f = spark.createDataFrame(features, f"feature_id long, base string, name string, is_bridge boolean, is_tunnel boolean, points {pts}")
    found = annotate.candidates(w, f)
    why = {(r["way_id"], r["feature_id"]): r["reject"] for r in found.filter("segment = 0").collect()}
    assert why[1, 11] is None and why[1, 12] == "class_incompatible" and why[1, 13] == "too_far" and why[1, 14] == "overlap" and why[2, 22] == "bridge_layer" and why[2, 21] is None
    kept = annotate.matched(found)
    assert {(r["feature_id"], r["segment"], r["way_id"]) for r in kept.collect()} == {(11, 0, 1), (11, 1, 1), (21, 0, 2), (21, 1, 2), (31, 0, 3), (31, 1, 3)}
    report = {r["item"]: r["n"] for r in annotate.match_report(w, found, kept).collect()}
    assert report["ways_matched"] == 3 and report["ways_unmatched"] == 1 and report["rows"] == 6


def test_limit_strings(spark):
    table = {"3.5": 3.5, "12'6\"": 3.81, "4 m": 4.0, "350cm": 3.5, "13 ft": 3.9624, "3,8": 3.8, "default": None, "below_default": None, "": None, "-1": None, "2 @ x": None}
    got = {r["s"]: r["v"] for r in spark.createDataFrame([(s,) for s in table], "s string").select("s", limits.length_metres(F.col("s")).alias("v")).collect()}
    assert all(got[s] == (pytest.approx(v) if v is not None else None) for s, v in table.items())


def test_conditions(spark):
    at = "2024-06-12 08:30:00"
    table = {"Nov-Jun": True, "Jul-Oct": False, "Jun": True, "Apr 15-Jul 15": True, "Jul 16-Apr 14": False, "Mo-Fr 07:00-16:00": True, "Sa-Su": False, "22:00-09:00": True, "snow": None, "": None, "We": True}
    got = {r["s"]: r["v"] for r in spark.createDataFrame([(s,) for s in table], "s string").select("s", clock.matches(F.col("s"), F.to_timestamp(F.lit(at))).alias("v")).collect()}
    assert got == table


def test_escapes_go_once(spark):
    table = {"a%20%b": "a b", "%25%20%": "%20%", "%1f600%": "😀", "plain": "plain", "%zz%": "%zz%"}
    got = {r["s"]: r["v"] for r in spark.createDataFrame([(s,) for s in table], "s string").select("s", radio.unescaped(F.col("s")).alias("v")).collect()}
    assert got == table


def test_durations(spark):
    table = {"0:25": 1500.0, "90:00": 5400.0, "01:05:30": 3930.0, "15": 900.0, "PT1H30M": 5400.0, "P1D": 86400.0, "P1DT2H": 93600.0, "1:75": None, "20000": None, "P1Y": None, "x": None, "-5": None, "": None}
    got = {r["s"]: r["v"] for r in spark.createDataFrame([(s,) for s in table], "s string").select("s", tags.duration_seconds(F.col("s")).alias("v")).collect()}
    assert got == table


def test_within_finds_all_pairs(spark):
    random.seed(8)
    a = [(i, 59 + random.random() * 0.1, 10 + random.random() * 0.1) for i in range(120)]
    b = [(i, 59 + random.random() * 0.1, 10 + random.random() * 0.1) for i in range(120)]

    def hav(p, q):
        s = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * geo.TOOL_RADIUS * math.asin(math.sqrt(s))

    got = {(r["i"], r["j"]) for r in cells.within(spark.createDataFrame(a, "i long, lat double, lon double"), spark.createDataFrame(b, "j long, to_lat double, to_lon double"), 900.0).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if hav(p, q) <= 900}


def test_retention_equals_the_loop(spark):
    random.seed(6)
    files = [(f"p{i:03d}", random.randrange(1, 5000)) for i in range(300)]
    keep = sorted([f for f in files if f[1] <= 4000], key=lambda f: (f[1], f[0]), reverse=True)
    while sum(s for _, s in keep) > 200_000:
        keep.pop(0)
    got = changes.retained(spark.createDataFrame(files, "path string, size long"), 200_000, 4000, bucket=100)
    assert {r["path"] for r in got.collect()} == {p for p, _ in keep}


def test_order_statistics(spark):
    random.seed(9)
    values = [round(random.gauss(0, 1), 3) for _ in range(500)] + [0.125] * 50
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert [at_rank(frame, "v", r, 0.5) for r in (0, 17, 300, 549, 550)] == [*[sorted(values)[r] for r in (0, 17, 300, 549)], None]


def test_identity_gate_counts_repeats(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert gates.identical(a, b).first().asDict() == {"only_a": 1, "only_b": 1}


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    """Two runs over a growing folder give what one run over all of it gives, for change lists and for failure runs."""
    from waymill.streaming import feeds

    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    log = [(1, 1, "fail"), (2, 1, "fail"), (3, 2, "ok"), (4, 2, "fail"), (5, 3, "fail"), (6, 1, "fail"), (7, 2, "fail"), (8, 3, "ok"), (9, 3, "fail"), (10, 4, "ok")]
    schema = "event_id long, provider long, status string, id long, action string, payload double"
    rows = [(i, p, s, i % 4, "delete" if i in (4, 7) else "modify", float(i)) for i, p, s in log]
    base = spark.createDataFrame([(0, 0.5), (3, 0.5), (9, 0.5)], "id long, payload double")
    found = []
    for part in (rows[:5], rows[5:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("event_id"))
        runs = feeds.failure_runs(stream.select("event_id", "ts", "provider", "status"), f"{state}/runs").collect()
        kept = feeds.apply_change_stream(stream.select(F.col("event_id").alias("seq"), "id", "action", "payload"), base, path=f"{state}/rows").collect()
        found = [{r["provider"]: (r["fails"], r["n"]) for r in runs}, {r["id"]: r["payload"] for r in kept}]
    assert found == [{1: (3, 3), 2: (2, 3), 3: (1, 3), 4: (0, 1)}, {1: 9.0, 2: 10.0, 0: 8.0, 9: 0.5}]
