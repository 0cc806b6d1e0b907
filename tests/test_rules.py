"""Rules on single values: limits, repeated keys, odd documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymill.functions import limits, places, radio
from waymill.sources import documents


def rows(spark, given, **columns):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in given], "v string").select(*[x.alias(k) for k, x in columns.items()]).collect()]


def test_feet_have_no_sign_test(spark):
    got = rows(spark, ["0 ft", "-3'", "5 ft", "12'6\"", "-2 m", "0", "5 ft -3", "-3,5 ft", "3,5 ft", None], k=limits.value_class(F.col("v")), m=F.round(limits.length_metres(F.col("v")), 4))
    assert got == [("numeric", 0.0), ("numeric", -0.9144), ("numeric", 1.524), ("numeric", 3.81), *[("unparseable", None)] * 4, ("numeric", 1.0668), ("empty", None)]


def test_element_line_with_repeated_tag_keeps_the_last(spark):
    o = radio.opl(F.col("v"))
    got = rows(spark, ["n1 v2 Ta=1,b=2,a=3 x1 y2", "n" + "1" * 18 + " v1 T", ""], id=o["id"], tags=o["tags"])
    assert got == [(1, {"a": "3", "b": "2"}), (int("1" * 18), {}), (None, {})]


def test_line_options(spark):
    o = places.line_options(F.split("v", " "))
    got = rows(spark, ["a=1 A=2 terrain_class=x+y x terrain_class=Y,z", "", "a==b"], values=o["values"], terrain=o["terrain"])
    assert got == [({"a": "2"}, ["x", "y", "z"]), ({}, []), ({"a": "=b"}, [])]


def test_trees_of_odd_documents(spark):
    docs = [(1, '{"g": [{"id": "a", "s": 2, "g": null}, {"g": []}, {"id": "b", "g": [{"id": "a", "s": 5}, {"id": ""}, 7, null]}]}'), (2, "{"), (3, None), (4, '{"id": "alone", "s": 1}'), (5, '{"g": {"id": "x"}}')]
    nodes = documents.tree_nodes(spark.createDataFrame(docs, "doc int, raw string"))
    leaves = documents.tree_leaves(nodes)
    assert sorted((r["doc"], r["id"], r["size"], list(r["path"])) for r in leaves.collect()) == [(1, "a", 5, [2, 0]), (4, "alone", 1, [])]
    assert sorted((r["doc"], list(r["path"]), r["leaves"], r["size"]) for r in documents.tree_totals(nodes, leaves).collect()) == [(1, [], 1, 5), (1, [1], 0, 0), (1, [2], 1, 5), (5, [], 0, 0)]


def test_points_of_odd_elements(spark):
    raw = '{"elements": [{"geometry": [{"lat": 1}, null, {"lat": 1, "lon": 2}], "center": 4}, {"members": 5, "lat": null, "lon": 1}, 3, {"lat": 8, "lon": 9, "center": {"lat": 7, "lon": 6}}]}'
    made = documents.elements(spark.createDataFrame([(1, raw), (2, "x"), (3, None), (4, '{"elements": 5}')], "doc int, raw string"))
    got = [[tuple(p) for p in r[0]] for r in made.select(documents.element_points(F.col("element"))).collect()]
    assert sorted(got) == [[], [], [(1.0, 2.0)], [(8.0, 9.0), (7.0, 6.0)]]


def test_names_fall_back_to_the_address(spark):
    data = [("N", "S", "1", None), (None, "S", "1", None), (None, "S", None, None), (None, "S", "2", "cafe"), (None, None, "3", None)]
    df = spark.createDataFrame(data, "name string, s string, n string, amenity string")
    keys = {"name": F.col("name"), "amenity": F.col("amenity"), "natural": F.lit(None).cast("string"), "addr:street": F.col("s"), "addr:housenumber": F.col("n")}
    got = [tuple(r) for r in df.select(*[v.alias(f"x_{k}") for k, v in places.named(keys).items()]).collect()]
    assert got == [("N", "named"), ("S 1", "addr:housenumber"), ("S", "addr:street"), ("S 2", "amenity:cafe"), (None, None)]


def test_route_records_refuse_ids_that_are_not_positive(spark):
    lines = ['{"osm_relation_id": 5, "kind": "hiking", "name": "", "ref": "E1", "lat": 59.5, "lon": -10.25}', '{"osm_relation_id": 0, "name": "x"}', "", "{", '{"osm_relation_id": 7, "name": ""}']
    o = places.route_records(F.col("v"))
    got = rows(spark, lines, id=o["id"], name=o["name"], lat=o["lat_e7"], lon=o["lon_e7"], refused=o["refused"])
    assert got == [(5, "E1", 595000000, -102500000, False), (0, "x", None, None, True), (None, None, None, None, False), (None, None, None, None, True), (7, None, None, None, False)]
