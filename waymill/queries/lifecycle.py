"""Queries on increments, gates, catalogues and reports: R*, G*, K6-K9, U*, W8-W15, A12-A30, T4-T6, J29-J34."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.functions import tags
from waymill.operators.shared import shared_path, table
from waymill.plans import changes, gates
from waymill.queries import tag_rules as t
from waymill.queries.views import pick, view, with_views

P = with_views("v_packs")


def c(name):
    return F.col(name)


def packs(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_packs")


def base_rows(spark, sf):
    return table(spark, sf, "orders").select(c("o_orderkey").alias("id"), c("o_totalprice").alias("payload"))


def r1_changelog_apply(spark, sf):
    return changes.apply_changes(base_rows(spark, sf), view(spark, sf, "v_changes"))


O_R1 = with_views("v_changes") + """ a AS (SELECT o_orderkey AS id, -1::BIGINT AS seq, 'create' AS action, o_totalprice AS payload FROM orders UNION ALL SELECT id, seq, action, payload FROM v_changes)
SELECT id, payload, seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM a) WHERE r = 1 AND action <> 'delete'"""


def r2_r3_sequence_gaps(spark, sf):
    """Missing ranges in the numbers of the changes that are not views; and whether the tip is reached."""
    s = table(spark, sf, "events").filter("event_type <> 'view'").select(c("event_id").alias("seq"))
    tip = s.agg(F.max("seq").alias("tip"))
    return changes.gaps(s, bucket=1000).join(F.broadcast(tip)).select("start", "end", (c("end") < c("tip")).alias("before_tip"))


O_R2 = """WITH s AS (SELECT event_id AS s, lead(event_id) OVER (ORDER BY event_id) AS n FROM events WHERE event_type <> 'view') SELECT s + 1 AS start, n - 1 AS "end", true AS before_tip FROM s WHERE n > s + 1"""


MAX_AGE_DAYS = 20


def r2_refresh_decision(spark, sf):
    """Held extracts by provider: full refresh when too old or when the next diff is missing, else the diffs to apply, or nothing to do."""
    e = table(spark, sf, "events")
    diffs = e.filter("event_type <> 'view'").select(c("event_id").cast("long").alias("seq"))
    tip = e.agg(F.max("event_id").alias("tip"), F.max("ts").alias("now"))  # one row
    held = e.filter("event_type = 'signup'").groupBy(c("user_id").alias("provider")).agg(F.max(F.struct("event_id", "ts")).alias("h")).select("provider", c("h.event_id").alias("seq"), c("h.ts").alias("ts"))
    after = diffs.select((c("seq") - 1).alias("seq"), F.lit(True).alias("has_next"))
    known = held.join(after, "seq", "left").join(F.broadcast(tip))
    old = F.unix_timestamp("now") - F.unix_timestamp("ts") > MAX_AGE_DAYS * 86400
    fate = F.when(c("seq") == c("tip"), "current").when(old, "full_age").when(c("has_next").isNull(), "full_gap").otherwise("apply")
    return known.select("provider", "seq", fate.alias("decision"))


O_R2D = f"""WITH t AS (SELECT max(event_id) AS tip, max(ts) AS now FROM events), h AS (SELECT user_id AS provider, max(event_id) AS seq, arg_max(ts, event_id) AS ts FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT provider, seq, CASE WHEN seq = tip THEN 'current' WHEN floor(epoch(now)) - floor(epoch(ts)) > {MAX_AGE_DAYS * 86400} THEN 'full_age' WHEN seq + 1 NOT IN (SELECT event_id FROM events WHERE event_type <> 'view') THEN 'full_gap' ELSE 'apply' END AS decision FROM h, t"""


def r4_unchanged_content(spark, sf):
    """Fetches whose content is that of the provider's fetch before: skipped; the rest kept."""
    log = view(spark, sf, "v_log").withColumn("hash", F.sha2(c("props").cast("binary"), 256))
    order = Window.partitionBy("provider").orderBy("ts", "event_id")
    seen = log.withColumn("same", F.coalesce(c("hash") == F.lag("hash").over(order), F.lit(False)))
    return seen.groupBy("provider").agg(F.count_if("same").alias("skipped"), F.count_if(~c("same")).alias("kept"))


O_R4 = with_views("v_log") + """ h AS (SELECT provider, props = lag(props) OVER (PARTITION BY provider ORDER BY ts, event_id) AS same FROM v_log)
SELECT provider, count(*) FILTER (coalesce(same, false)) AS skipped, count(*) FILTER (NOT coalesce(same, false)) AS kept FROM h GROUP BY 1"""


def r5_feed_health(spark, sf):
    return changes.failure_runs(view(spark, sf, "v_log"))


O_R5 = with_views("v_log") + """ g AS (SELECT *, sum((status <> 'fail')::INT) OVER (PARTITION BY provider ORDER BY ts DESC, event_id DESC) AS later FROM v_log),
f AS (SELECT provider, arg_max(status, (ts, event_id)) AS last_status, count(*) FILTER (later = 0) AS fails FROM g GROUP BY 1)
SELECT provider, last_status, fails, CASE WHEN fails > 0 THEN least(3600, 5 * (1 << least(fails, 8)))::INT ELSE 0 END AS hold_s FROM f"""


def r6_pending_work(spark, sf):
    """Leaves (customers) without a finished order."""
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(c("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(done, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


O_R6 = "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"


def r7_hash_reuse(spark, sf):
    """Paths whose geometry hash is cached for the epoch, and those to compute."""
    w = table(spark, sf, "orders").select("o_orderkey", F.md5((c("o_orderkey") % 700).cast("string").cast("binary")).alias("hash"))
    cache = table(spark, sf, "customer").select(F.md5((c("c_custkey") % 400).cast("string").cast("binary")).alias("hash"), F.when(c("c_custkey") % 2 == 0, "e1").otherwise("e2").alias("epoch")).distinct()
    hits, misses = changes.reuse(w, cache, "e1")
    return hits.agg(F.lit("hit").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ids")).unionByName(misses.agg(F.lit("miss").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ids")))


O_R7 = """WITH k AS (SELECT DISTINCT c_custkey % 400 AS h FROM customer WHERE c_custkey % 2 = 0) SELECT CASE WHEN o_orderkey % 700 IN (SELECT h FROM k) THEN 'hit' ELSE 'miss' END AS kind, count(*) AS n, sum(o_orderkey)::BIGINT AS ids FROM orders GROUP BY 1"""


def r8_promotion(spark, sf):
    """Pointers after a run in which some regions failed their gate: those keep the generation before."""
    p = packs(spark, sf)
    prev = p.groupBy(c("region_id").alias("key")).agg(F.min("generation").alias("generation"))
    new = p.groupBy(c("region_id").alias("key")).agg(F.max("generation").alias("generation")).withColumn("passed", c("key") % 4 != 0)
    return changes.promote(prev, new)


O_R8 = P + """ g AS (SELECT region_id AS "key", min(generation) AS a, max(generation) AS b FROM v_packs GROUP BY 1) SELECT "key", CASE WHEN "key" % 4 <> 0 THEN b ELSE a END AS generation, "key" % 4 <> 0 AS promoted FROM g"""


def w8_u8_version_dedup(spark, sf):
    """Highest version, then latest time, of each object over several extracts; how many went."""
    l = table(spark, sf, "lineitem").select(c("l_partkey").alias("id"), c("l_linenumber").alias("version"), c("l_shipdate").alias("ts"), c("l_orderkey").alias("src"))
    kept = changes.latest(l, ["id"], [F.desc("version"), F.desc("ts"), F.asc("src")])
    n = l.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return kept.join(n, "id").select("id", "version", "src", (c("n") - 1).alias("dropped"))


O_W8 = "SELECT id, version, src, n - 1 AS dropped FROM (SELECT l_partkey AS id, l_linenumber AS version, l_orderkey AS src, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_orderkey) AS r, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem) WHERE r = 1"


def w7_last_wins(spark, sf):
    """One row a (feature, segment): that of the largest way."""
    l = table(spark, sf, "lineitem").select((c("l_partkey") % 500).alias("feature_id"), c("l_linenumber").alias("segment"), c("l_orderkey").alias("way_id"))
    return l.groupBy("feature_id", "segment").agg(F.max("way_id").alias("way_id"), F.count(F.lit(1)).alias("n"))


O_W7 = "SELECT l_partkey % 500 AS feature_id, l_linenumber AS segment, max(l_orderkey) AS way_id, count(*) AS n FROM lineitem GROUP BY 1, 2"


def w11_w12_sparse_overrides(spark, sf):
    """Altitude overrides where a sample is over 2 m off, in decimetres, sorted and unique by point; and their share."""
    l = table(spark, sf, "lineitem").select(c("l_orderkey").alias("feature_id"), c("l_linenumber").alias("point"), c("l_quantity").alias("base"), (c("l_quantity") + (c("l_partkey") % 9) - 4 + c("l_tax")).alias("dem"))
    one = l.groupBy("feature_id", "point").agg(F.min("base").alias("base"), F.min("dem").alias("dem"))
    off = one.withColumn("over", F.abs(c("dem") - c("base")) > 2)
    return off.groupBy("feature_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("over").alias("n_over"), F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c("over"), F.struct("point", F.bround(c("dem") * 10, 0).cast("long").alias("dm"))))), lambda x: F.concat_ws(":", x["point"], x["dm"])), ","), F.lit("")).alias("overrides")
    )


O_W11 = """WITH o AS (SELECT l_orderkey AS feature_id, l_linenumber AS point, min(l_quantity) AS base, min(l_quantity + (l_partkey % 9) - 4 + l_tax) AS dem FROM lineitem GROUP BY 1, 2)
SELECT feature_id, count(*) AS n, count(*) FILTER (abs(dem - base) > 2) AS n_over, coalesce(string_agg(point || ':' || round_even(dem * 10, 0)::BIGINT, ',' ORDER BY point) FILTER (abs(dem - base) > 2), '') AS overrides FROM o GROUP BY 1"""


def w14_t4_budgeted_selection(spark, sf):
    """Ranked candidates of each group taken while hours last; a skipped one uses none."""
    cand = table(spark, sf, "customer").select(c("c_nationkey").alias("grp"), c("c_custkey").alias("id"), F.floor(F.abs(c("c_acctbal"))).alias("rank"), ((c("c_custkey") % 13 + 1) / 4).alias("cost_h"))
    return changes.within_budget(cand, "grp", 6.0).select("grp", "n", "used_h", F.array_join(c("taken").cast("array<string>"), ",").alias("taken"))


O_W14 = """WITH RECURSIVE k AS (SELECT c_nationkey AS grp, c_custkey AS id, (c_custkey % 13 + 1) / 4.0::DOUBLE AS h, row_number() OVER (PARTITION BY c_nationkey ORDER BY floor(abs(c_acctbal)), c_custkey) AS r FROM customer),
s AS (SELECT grp, 0::BIGINT AS r, 0.0::DOUBLE AS used, '' AS taken FROM k GROUP BY grp UNION ALL SELECT s.grp, k.r, CASE WHEN used + h <= 6 THEN used + h ELSE used END, CASE WHEN used + h <= 6 THEN taken || CASE WHEN taken = '' THEN '' ELSE ',' END || id ELSE taken END FROM s JOIN k ON k.grp = s.grp AND k.r = s.r + 1)
SELECT grp, max(r)::INT AS n, arg_max(used, r) AS used_h, arg_max(taken, r) AS taken FROM s GROUP BY grp"""


def w15_size_retention(spark, sf):
    """Files under a size limit, the largest dropped until the rest fits the budget."""
    f = table(spark, sf, "orders").select(c("o_orderkey").cast("string").alias("path"), F.floor("o_totalprice").alias("size"))
    total = f.agg(F.sum("size")).first()[0] or 0
    return changes.retained(f, int(total * 0.4), 400_000, bucket=5000).select("path", "size")


O_W15 = """WITH f AS (SELECT o_orderkey::VARCHAR AS path, floor(o_totalprice)::BIGINT AS size FROM orders), r AS (SELECT *, sum(size) OVER (ORDER BY size, path) AS run FROM f WHERE size <= 400000) SELECT path, size FROM r WHERE run <= (SELECT floor(sum(size) * 0.4::DOUBLE) FROM f)"""


def terrain(spark, sf):
    kinds = ["polar_sparse", None, "dense_network", "wetland_heavy", None]
    return spark.sql(f"SELECT DISTINCT CAST(n_nationkey AS BIGINT) AS region_id, {pick('n_nationkey', kinds)} AS terrain FROM {{n}}", n=table(spark, sf, "nation"))


_LONG = "l AS (SELECT region_id, generation, source_b, unnest(['graph', 'poi', 'wetland', 'total']) AS kind, unnest([graph_b, poi_b, wetland_b, graph_b + poi_b + wetland_b]) AS size FROM v_packs)"


def g1_size_bands(spark, sf):
    return gates.size_bands(packs(spark, sf), terrain(spark, sf)).groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("ratio"), 4).alias("ratios"))


O_G1 = P + _LONG + """, r AS (SELECT kind, size / source_b AS ratio, region_id % 5 AS t FROM l WHERE size > 0 AND source_b > 0),
b AS (SELECT kind, ratio, CASE kind WHEN 'graph' THEN CASE WHEN t = 0 THEN 0.001 ELSE 0.05 END WHEN 'poi' THEN 0.005 WHEN 'wetland' THEN 0 ELSE 0.03 END::DOUBLE AS lo, CASE kind WHEN 'graph' THEN CASE WHEN t = 2 THEN 35 ELSE 28 END WHEN 'poi' THEN 2 WHEN 'wetland' THEN CASE WHEN t = 3 THEN 1.5 ELSE 0.75 END ELSE 35 END::DOUBLE AS hi FROM r)
SELECT kind, CASE WHEN ratio < lo OR ratio > hi THEN 'out_of_band' ELSE 'ok' END AS status, count(*) AS n, round(sum(ratio), 4) AS ratios FROM b GROUP BY 1, 2"""


def g1_j33_size_changes(spark, sf):
    return gates.size_changes(packs(spark, sf)).groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("factor"), 4).alias("worst"))


O_J33 = P + _LONG + """, b AS (SELECT *, lag(size) OVER (PARTITION BY region_id, kind ORDER BY generation) AS o FROM l WHERE kind <> 'total'), f AS (SELECT kind, greatest(size / o, o / size) AS f FROM b WHERE size > 0 AND o > 0)
SELECT kind, CASE WHEN f > 3 THEN 'changed' ELSE 'ok' END AS status, count(*) AS n, round(max(f), 4) AS worst FROM f GROUP BY 1, 2"""


def g2_g3_regressions(spark, sf):
    """Missing heights and record counts against the generation before."""
    a = gates.missing_heights(packs(spark, sf)).select("region_id", "generation", c("status").alias("heights"))
    return a.join(gates.record_counts(packs(spark, sf)).select("region_id", "generation", c("status").alias("records")), ["region_id", "generation"])


O_G2 = P + """ b AS (SELECT *, lag(missing) OVER w AS bm, lag(n) OVER w AS bn FROM v_packs WINDOW w AS (PARTITION BY region_id ORDER BY generation))
SELECT region_id, generation, CASE WHEN (CASE WHEN bm IS NULL THEN CASE WHEN edges > 0 THEN missing / edges > 0.05 ELSE missing >= 50000 END ELSE missing > greatest(floor(bm * 1.5::DOUBLE), bm + 100) END) THEN 'fail' ELSE 'ok' END AS heights,
CASE WHEN n <= 0 OR coalesce(bn > 0 AND (n < bn * 0.5 OR n > bn * 2), false) THEN 'refused' ELSE 'ok' END AS records FROM b"""


def g4_g5_domain_checks(spark, sf):
    """Rows outside their domain, and whether ambiguous ones stay under the limit."""
    l = table(spark, sf, "lineitem")
    amb = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey", "l_linenumber")) > 1
    made = l.select(amb.alias("ambiguous"), c("l_linenumber").between(1, 6).alias("class_ok"), (c("l_orderkey") > 0).alias("id_ok"))
    return made.agg(F.count_if("ambiguous").alias("n_ambiguous"), (F.count_if("ambiguous") > 100).alias("too_many"), F.count_if(~c("class_ok")).alias("bad_class"), F.count_if(~c("id_ok")).alias("bad_id"))


O_G4 = "WITH a AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS amb FROM lineitem) SELECT count(*) FILTER (amb) AS n_ambiguous, count(*) FILTER (amb) > 100 AS too_many, count(*) FILTER (NOT l_linenumber BETWEEN 1 AND 6) AS bad_class, count(*) FILTER (l_orderkey <= 0) AS bad_id FROM a"


def g7_checksums(spark, sf):
    """Digests of a listing against a manifest: equal, differing, absent."""
    listed = table(spark, sf, "orders").select("o_orderkey", F.md5(c("o_orderpriority").cast("binary")).alias("have"))
    manifest = table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").alias("k")).select("o_orderkey", F.md5(F.when(c("k") > 2, "1-URGENT").otherwise("5-LOW").cast("binary")).alias("want"))
    both = manifest.join(listed, "o_orderkey", "left")
    return both.groupBy(F.when(c("have").isNull(), "absent").when(c("have") == c("want"), "equal").otherwise("differs").alias("state")).agg(F.count(F.lit(1)).alias("n"))


O_G7 = "WITH m AS (SELECT l_orderkey, CASE WHEN max(l_linenumber) > 2 THEN '1-URGENT' ELSE '5-LOW' END AS want FROM lineitem GROUP BY 1) SELECT CASE WHEN o_orderkey IS NULL THEN 'absent' WHEN o_orderpriority = want THEN 'equal' ELSE 'differs' END AS state, count(*) AS n FROM m LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"


def g8_identity(spark, sf):
    """Recomputed annotations against cached ones: rows on one side only."""
    l = table(spark, sf, "lineitem")
    a = l.select("l_orderkey", "l_linenumber", "l_returnflag")
    b = l.select("l_orderkey", "l_linenumber", F.when(c("l_partkey") % 50 == 0, "X").otherwise(c("l_returnflag")).alias("l_returnflag"))
    return gates.identical(a, b)


O_G8 = """WITH a AS (SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 = 0 THEN 'X' ELSE l_returnflag END FROM lineitem)
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b"""


def k6_k8_w9_catalogue(spark, sf):
    """Published generations kept (newest three), and the newest complete one of each region."""
    kept = gates.kept_generations(packs(spark, sf), 3)
    path = shared_path(spark, "generations")
    kept.write.partitionBy("generation").parquet(path)
    back = spark.read.parquet(path)
    return gates.catalogue(packs(spark, sf)).join(back.groupBy("region_id").agg(F.count(F.lit(1)).alias("n_kept"), F.min("generation").cast("long").alias("oldest")), "region_id")


O_K6 = P + """ k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY generation DESC) AS r FROM v_packs) WHERE r <= 3),
g AS (SELECT region_id, max(generation) AS generation FROM v_packs WHERE has_manifest AND NOT in_progress GROUP BY 1) SELECT g.region_id, g.generation, count(*) AS n_kept, min(k.generation) AS oldest FROM g JOIN k USING (region_id) GROUP BY 1, 2"""


def k7_catalogue_upsert(spark, sf):
    old = table(spark, sf, "customer").select(c("c_mktsegment").alias("source"), c("c_custkey").alias("slug"), F.lit("old").alias("state"))
    new = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING' and c_custkey % 2 = 0").select(c("c_mktsegment").alias("source"), c("c_custkey").alias("slug"), F.lit("new").alias("state"))
    return gates.upsert(old, new, "source").groupBy("source", "state").agg(F.count(F.lit(1)).alias("n"))


O_K7 = "SELECT c_mktsegment AS source, CASE WHEN c_mktsegment = 'BUILDING' THEN 'new' ELSE 'old' END AS state, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey % 2 = 0 GROUP BY 1, 2"


def k9_manifest_status(spark, sf):
    p = packs(spark, sf)
    last = p.groupBy("region_id").agg(F.max_by("source_b", "generation").alias("source_b"))
    manifests = p.groupBy("region_id").agg(F.max_by("source_b", F.when(c("has_manifest"), c("generation"))).alias("recorded_b")).filter("region_id % 6 <> 2").withColumn("format", F.when(c("region_id") % 5 == 0, 8).otherwise(9))
    return gates.manifest_status(manifests, last, 9)


O_K9 = P + """ l AS (SELECT region_id, arg_max(source_b, generation) AS s, arg_max(source_b, generation) FILTER (has_manifest) AS r FROM v_packs GROUP BY 1)
SELECT region_id, CASE WHEN region_id % 6 = 2 THEN 'missing' WHEN r <> s THEN 'stale' WHEN region_id % 5 = 0 THEN 'version_mismatch' ELSE 'ready' END AS status FROM l"""


def a12_t6_tag_inventory(spark, sf):
    """Counts of tag keys over all ways, and the twelve most common values of some."""
    w = view(spark, sf, "v_ways")
    keys = ("highway", "maxspeed", "surface", "duration", "maxheight", "route", "ferry")
    entries = w.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), c(k).alias("value")) for k in keys])).alias("e")).select("e.*").filter("value is not null")
    counts = entries.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("key").orderBy(F.desc("n"), "value")
    return counts.withColumns({"place": F.row_number().over(order), "key_n": F.sum("n").over(Window.partitionBy("key"))}).filter("place <= 12")


O_A12 = with_views("v_ways") + " e AS (" + " UNION ALL ".join(f"SELECT '{k}' AS \"key\", {k} AS value FROM v_ways WHERE {k} IS NOT NULL" for k in ("highway", "maxspeed", "surface", "duration", "maxheight", "route", "ferry")) + """),
n AS (SELECT "key", value, count(*) AS n FROM e GROUP BY 1, 2) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY n DESC, value)::INT AS place, sum(n) OVER (PARTITION BY "key")::BIGINT AS key_n FROM n) WHERE place <= 12"""


def a11_a13_ferry_rollup(spark, sf):
    """Ferries by region (customer's nation) and old class; those that the new rule gains or loses."""
    w = view(spark, sf, "v_ways").join(table(spark, sf, "orders").select(c("o_orderkey").alias("way_id"), "o_custkey"), "way_id").join(table(spark, sf, "customer").select(c("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    ferry = w.filter(tags.is_ferry(c("route"), c("highway"), c("ferry")))
    old = tags.old_ferry_class(*[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "foot", "bicycle")])
    new = tags.ferry_admits("car", *[c(x) for x in ("motorcar", "motor_vehicle", "vehicle", "access", "ferry", "foot", "bicycle")], F.lit(False))
    kinds = ferry.select("c_nationkey", old.alias("old"), new.alias("new"))
    return kinds.groupBy("c_nationkey").agg(*[F.count_if(c("old") == k).alias(k) for k in ("car", "passenger", "unknown")], F.count_if((c("old") != "car") & c("new")).alias("became_car"), F.count_if((c("old") == "car") & ~c("new")).alias("left_car"))


_Y = "('yes', 'designated', 'permissive', 'true', '1')"
_OLD = f"CASE WHEN motorcar IN {_Y} OR motor_vehicle IN {_Y} OR vehicle IN {_Y} THEN 'car' WHEN foot IN {_Y} OR bicycle IN {_Y} THEN 'passenger' ELSE 'unknown' END"
O_A11 = with_views("v_ways") + f""" f AS (SELECT c_nationkey, {_OLD} AS o, {t.SQL_CAR_FERRY} AS nw FROM v_ways JOIN orders ON o_orderkey = way_id JOIN customer ON c_custkey = o_custkey WHERE {t.SQL_FERRY})
SELECT c_nationkey, count(*) FILTER (o = 'car') AS car, count(*) FILTER (o = 'passenger') AS passenger, count(*) FILTER (o = 'unknown') AS "unknown", count(*) FILTER (o <> 'car' AND nw) AS became_car, count(*) FILTER (o = 'car' AND NOT nw) AS left_car FROM f GROUP BY 1"""


def a17_coverage(spark, sf):
    """Cells of each region present, known missing or unresolved, and whether the region is ready."""
    cells = view(spark, sf, "v_leaves").select("region_id", c("leaf_id").alias("cell")).distinct()
    present = table(spark, sf, "supplier").select((c("s_suppkey") * 3 % 60).alias("cell")).distinct().withColumn("has", F.lit(True))
    known = table(spark, sf, "nation").select((c("n_nationkey") * 2).cast("long").alias("cell")).distinct().withColumn("gone", F.lit(True))
    kind = F.when(c("has"), "present").when(c("gone"), "known").otherwise("unresolved")
    made = cells.join(present, "cell", "left").join(known, "cell", "left").withColumn("kind", kind)
    return made.groupBy("region_id").agg(*[F.count_if(c("kind") == k).alias(k) for k in ("present", "known", "unresolved")], F.bool_and(c("kind") != "unresolved").alias("ready"))


O_A17 = with_views("v_leaves") + """ k AS (SELECT DISTINCT region_id, leaf_id AS cell FROM v_leaves), j AS (SELECT region_id, CASE WHEN cell IN (SELECT s_suppkey * 3 % 60 FROM supplier) THEN 'present' WHEN cell IN (SELECT n_nationkey * 2 FROM nation) THEN 'known' ELSE 'unresolved' END AS kind FROM k)
SELECT region_id, count(*) FILTER (kind = 'present') AS present, count(*) FILTER (kind = 'known') AS known, count(*) FILTER (kind = 'unresolved') AS unresolved, bool_and(kind <> 'unresolved') AS ready FROM j GROUP BY 1"""


def a22_a24_f24_leaf_mapping(spark, sf):
    """Noise leaves dropped, coverage summed and capped, leaves shared with other regions, review flags."""
    l = view(spark, sf, "v_leaves").groupBy("region_id", "leaf_id").agg(F.max("coverage").alias("coverage"), F.max("overspill").alias("overspill"))
    kept = l.filter(~((c("overspill") >= 50) & (c("coverage") < 25)))
    shared = kept.groupBy("leaf_id").agg(F.count_distinct("region_id").alias("k"))
    made = kept.join(shared, "leaf_id").groupBy("region_id").agg(F.count(F.lit(1)).alias("n_leaves"), F.count_if(c("k") > 1).alias("n_shared"), F.least(F.lit(100.0), F.sum("coverage")).alias("covered"))
    return made.select("*", F.round(F.greatest(F.lit(0.0), 100 - c("covered")), 4).alias("gap"), (100 - c("covered") > 0.5).alias("flag_gap"), (c("n_leaves") > 8).alias("flag_many"))


O_A22 = with_views("v_leaves") + """ l AS (SELECT region_id, leaf_id, max(coverage) AS coverage, max(overspill) AS overspill FROM v_leaves GROUP BY 1, 2), k AS (SELECT * FROM l WHERE NOT (overspill >= 50 AND coverage < 25)), s AS (SELECT leaf_id, count(DISTINCT region_id) AS n FROM k GROUP BY 1),
m AS (SELECT region_id, count(*) AS n_leaves, count(*) FILTER (n > 1) AS n_shared, least(100.0::DOUBLE, sum(coverage)) AS covered FROM k JOIN s USING (leaf_id) GROUP BY 1) SELECT *, round(greatest(0.0::DOUBLE, 100 - covered), 4) AS gap, 100 - covered > 0.5 AS flag_gap, n_leaves > 8 AS flag_many FROM m"""


def u4_u6_mapping_diff(spark, sf):
    """Two versions of the region-to-leaf map: leaves added and removed by region."""
    l = view(spark, sf, "v_leaves")
    side = lambda v: l.filter(c("version") != v).select("region_id", "leaf_id").distinct()
    old, new = side(0), side(1)
    added, removed = new.exceptAll(old).withColumn("d", F.lit("added")), old.exceptAll(new).withColumn("d", F.lit("removed"))
    return added.unionByName(removed).groupBy("region_id").agg(F.count_if(c("d") == "added").alias("n_added"), F.count_if(c("d") == "removed").alias("n_removed"), F.array_join(F.array_sort(F.collect_set(F.when(c("d") == "added", F.lpad(c("leaf_id").cast("string"), 2, "0")))), ",").alias("added"))


O_U4 = with_views("v_leaves") + """ o AS (SELECT DISTINCT region_id, leaf_id FROM v_leaves WHERE version <> 0), n AS (SELECT DISTINCT region_id, leaf_id FROM v_leaves WHERE version <> 1), a AS (SELECT *, 'added' AS d FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'removed' FROM (SELECT * FROM o EXCEPT SELECT * FROM n))
SELECT region_id, count(*) FILTER (d = 'added') AS n_added, count(*) FILTER (d = 'removed') AS n_removed, coalesce(string_agg(lpad(leaf_id::VARCHAR, 2, '0'), ',' ORDER BY leaf_id) FILTER (d = 'added'), '') AS added FROM a GROUP BY 1"""


def a25_s9_tree_totals(spark, sf):
    """A tree of groups from region to nation to customer: leaves and sizes under every node, by exploded ancestor paths."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), c("n_regionkey") == c("r_regionkey"))
    leaf = table(spark, sf, "customer").join(n, c("c_nationkey") == c("n_nationkey")).select(F.array(F.lit("world"), F.concat_ws("/", F.lit("world"), "r_name"), F.concat_ws("/", F.lit("world"), "r_name", "n_name")).alias("up"), F.floor(F.abs("c_acctbal")).alias("size"))
    return leaf.select(F.explode("up").alias("node"), "size").groupBy("node").agg(F.count(F.lit(1)).alias("n_leaves"), F.sum("size").alias("size"))


O_A25 = """WITH l AS (SELECT r_name, n_name, floor(abs(c_acctbal))::BIGINT AS s FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT 'world' || coalesce('/' || r_name, '') || coalesce('/' || n_name, '') AS node, count(*) AS n_leaves, sum(s)::BIGINT AS size FROM l GROUP BY GROUPING SETS ((), (r_name), (r_name, n_name))"""


def a26_leaf_checks(spark, sf):
    """Leaves listed under more than one region, and expected ones that are listed nowhere."""
    l = view(spark, sf, "v_leaves").select("region_id", "leaf_id").distinct()
    twice = l.groupBy("leaf_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("leaf_id", F.lit("repeated").alias("state"))
    want = table(spark, sf, "supplier").select((c("s_suppkey") % 80).alias("leaf_id")).distinct()
    return twice.unionByName(want.join(l, "leaf_id", "left_anti").select("leaf_id", F.lit("missing").alias("state")))


O_A26 = with_views("v_leaves") + """ l AS (SELECT DISTINCT region_id, leaf_id FROM v_leaves) SELECT leaf_id, 'repeated' AS state FROM l GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT DISTINCT s_suppkey % 80, 'missing' FROM supplier WHERE s_suppkey % 80 NOT IN (SELECT leaf_id FROM l)"""


def a28_cache_merge(spark, sf):
    """First non-empty samples and newest non-empty annotation of each hash."""
    l = table(spark, sf, "lineitem").select((c("l_partkey") % 300).alias("hash"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("at"), F.when(c("l_quantity") > 10, c("l_quantity")).alias("samples"), F.when(c("l_returnflag") != "N", c("l_returnflag")).alias("note"))
    return l.groupBy("hash").agg(F.min_by("samples", F.when(c("samples").isNotNull(), c("at"))).alias("samples"), F.max(F.when(c("note").isNotNull(), F.struct("at", "note")))["note"].alias("note"), F.count(F.lit(1)).alias("n"))


O_A28 = """WITH l AS (SELECT l_partkey % 300 AS hash, (l_shipdate, l_orderkey, l_linenumber) AS a, l_quantity AS q, l_returnflag AS f FROM lineitem)
SELECT hash, arg_min(q, a) FILTER (q > 10) AS samples, arg_max(f, (a, f)) FILTER (f <> 'N') AS note, count(*) AS n FROM l GROUP BY 1"""


def a29_a30_s18_pack_figures(spark, sf):
    """Sizes by kind against sources, sums, peaks, per region."""
    p = packs(spark, sf)
    return p.groupBy("region_id").agg(*[F.round(F.sum(f"{k}_b") / F.sum("source_b"), 4).alias(f"{k}_ratio") for k in ("graph", "poi", "wetland")], F.sum("source_b").alias("source_b"), F.max("graph_b").alias("peak_b"))


O_A29 = P + """ x AS (SELECT 1) SELECT region_id, round(sum(graph_b) / sum(source_b), 4) AS graph_ratio, round(sum(poi_b) / sum(source_b), 4) AS poi_ratio, round(sum(wetland_b) / sum(source_b), 4) AS wetland_ratio, sum(source_b)::BIGINT AS source_b, max(graph_b) AS peak_b FROM v_packs GROUP BY 1"""


def a18_m25_corridor_stats(spark, sf):
    """Climb and descent along each order's lines, the largest, median and 95th percentile step."""
    l = table(spark, sf, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    d = l.withColumn("d", c("l_quantity") - F.lag("l_quantity").over(order)).filter("d is not null")
    return d.groupBy("l_orderkey").agg(
        F.sum(F.greatest("d", F.lit(0.0))).alias("climb"), F.sum(F.greatest(-c("d"), F.lit(0.0))).alias("descent"), F.max(F.abs("d")).alias("largest"),
        F.expr("percentile_disc(0.5) within group (order by abs(d))").alias("median"), F.expr("percentile_disc(0.95) within group (order by abs(d))").alias("p95"),
    )


O_A18 = """WITH d AS (SELECT l_orderkey, l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS d FROM lineitem)
SELECT l_orderkey, sum(greatest(d, 0)) AS climb, sum(greatest(-d, 0)) AS descent, max(abs(d)) AS largest, quantile_disc(abs(d), 0.5) AS median, quantile_disc(abs(d), 0.95) AS p95 FROM d WHERE d IS NOT NULL GROUP BY 1"""


def a20_j39_recall(spark, sf):
    """Flagged segments against true ones: caught, missed, false, recall and precision."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount").distinct()
    truth = l.filter("l_tax >= 0.06").select("l_orderkey", "l_linenumber").distinct()
    found = l.filter("l_discount >= 0.07").select("l_orderkey", "l_linenumber").distinct()
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    out = n(truth.join(found, ["l_orderkey", "l_linenumber"], "left_semi"), "caught").join(n(truth, "n_true")).join(n(found, "n_found"))
    return out.select("caught", (c("n_true") - c("caught")).alias("missed"), (c("n_found") - c("caught")).alias("wrong"), F.round(c("caught") / c("n_true"), 6).alias("recall"), F.round(c("caught") / c("n_found"), 6).alias("precision"))


O_A20 = """WITH t AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_tax >= 0.06), f AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_discount >= 0.07), k AS (SELECT count(*) AS caught FROM t SEMI JOIN f USING (l_orderkey, l_linenumber))
SELECT caught, (SELECT count(*) FROM t) - caught AS missed, (SELECT count(*) FROM f) - caught AS wrong, round(caught / (SELECT count(*) FROM t), 6) AS recall, round(caught / (SELECT count(*) FROM f), 6) AS "precision" FROM k"""


def a21_x25_run_summary(spark, sf):
    """Runs by group: number, hours, hit rate and bytes."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), c("o_custkey") == c("c_custkey")).join(table(spark, sf, "nation"), c("c_nationkey") == c("n_nationkey"))
    return o.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).alias("size"), F.round(F.count_if(c("o_orderstatus") == "F") / F.count(F.lit(1)), 6).alias("hit_rate"))


O_A21 = "SELECT n_regionkey, count(*) AS n, sum(floor(o_totalprice)::BIGINT)::BIGINT AS size, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS hit_rate FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"


def j28_terrain_refresh(spark, sf):
    """Surface of edges recomputed from way tags by the way id in the edge id; how many changed."""
    w = view(spark, sf, "v_ways")
    rank = tags.surface_rank(c("highway"), c("surface"), c("tracktype"))
    edges = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("edge_id"), (c("l_partkey") % 3).cast("int").alias("old"))
    joined = edges.withColumn("way_id", F.split("edge_id", "-")[0].cast("long")).join(w.select("way_id", rank.alias("new")), "way_id")
    return joined.groupBy("new").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("old") != c("new")).alias("changed"))


O_J28 = with_views("v_ways") + f" x AS (SELECT way_id, {t.SQL_RANK} AS new FROM v_ways) SELECT new, count(*) AS n, count(*) FILTER (l_partkey % 3 <> new) AS changed FROM lineitem JOIN x ON way_id = l_orderkey GROUP BY 1"


def j29_j34_fallback_sizes(spark, sf):
    """Leaf sizes with override, measured and default values in that order; region totals."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    override = table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").groupBy(c("s_nationkey").alias("n_nationkey")).agg(F.max(F.floor(F.abs("s_acctbal"))).alias("o"))
    measured = table(spark, sf, "customer").filter("c_custkey % 5 <> 0").groupBy(c("c_nationkey").alias("n_nationkey")).agg(F.max(F.floor(F.abs("c_acctbal"))).alias("m"))
    made = n.join(override, "n_nationkey", "left").join(measured, "n_nationkey", "left")
    return made.groupBy("n_regionkey").agg(F.sum(F.coalesce("o", "m", F.lit(100))).alias("size"), F.count_if(c("o").isNull() & c("m").isNull()).alias("defaults"))


O_J29 = """WITH o AS (SELECT s_nationkey AS k, max(floor(abs(s_acctbal))::BIGINT) AS o FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY 1), m AS (SELECT c_nationkey AS k, max(floor(abs(c_acctbal))::BIGINT) AS m FROM customer WHERE c_custkey % 5 <> 0 GROUP BY 1)
SELECT n_regionkey, sum(coalesce(o, m, 100))::BIGINT AS size, count(*) FILTER (o IS NULL AND m IS NULL) AS defaults FROM nation LEFT JOIN o ON o.k = n_nationkey LEFT JOIN m ON m.k = n_nationkey GROUP BY 1"""


def k4_k5_report_sinks(spark, sf):
    """Annotation rows to range-sorted JSON Lines and a CSV report, read back and counted."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    path = shared_path(spark, "sinks")
    l.repartitionByRange(4, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber").write.json(f"{path}/json")
    l.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).write.option("header", True).csv(f"{path}/csv")
    js = spark.read.schema("l_orderkey long, l_linenumber int, l_returnflag string").json(f"{path}/json").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_json"), F.sum("l_orderkey").alias("keys"))
    return js.join(spark.read.option("header", True).schema("l_returnflag string, n long").csv(f"{path}/csv"), "l_returnflag")


O_K4 = "SELECT l_returnflag, count(*) AS n_json, sum(l_orderkey)::BIGINT AS keys, count(*) AS n FROM lineitem GROUP BY 1"

PAIRS = [
    (r1_changelog_apply, O_R1), (r2_r3_sequence_gaps, O_R2), (r2_refresh_decision, O_R2D), (r4_unchanged_content, O_R4), (r5_feed_health, O_R5), (r6_pending_work, O_R6), (r7_hash_reuse, O_R7), (r8_promotion, O_R8), (w8_u8_version_dedup, O_W8), (w7_last_wins, O_W7),
    (w11_w12_sparse_overrides, O_W11), (w14_t4_budgeted_selection, O_W14), (w15_size_retention, O_W15), (g1_size_bands, O_G1), (g1_j33_size_changes, O_J33), (g2_g3_regressions, O_G2), (g4_g5_domain_checks, O_G4), (g7_checksums, O_G7), (g8_identity, O_G8),
    (k6_k8_w9_catalogue, O_K6), (k7_catalogue_upsert, O_K7), (k9_manifest_status, O_K9), (a12_t6_tag_inventory, O_A12), (a11_a13_ferry_rollup, O_A11), (a17_coverage, O_A17), (a22_a24_f24_leaf_mapping, O_A22), (u4_u6_mapping_diff, O_U4),
    (a25_s9_tree_totals, O_A25), (a26_leaf_checks, O_A26), (a28_cache_merge, O_A28), (a29_a30_s18_pack_figures, O_A29), (a18_m25_corridor_stats, O_A18), (a20_j39_recall, O_A20), (a21_x25_run_summary, O_A21), (j28_terrain_refresh, O_J28),
    (j29_j34_fallback_sizes, O_J29), (k4_k5_report_sinks, O_K4),
]
QUERIES = {f.__name__: f for f, _ in PAIRS}
ORACLES = {f.__name__: sql for f, sql in PAIRS}
