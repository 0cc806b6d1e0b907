"""Nested JSON documents as VARIANT values, and XML documents by row tag.

Rows of unlike shape keep their own fields: a value is looked up where it is and null elsewhere,
so no schema has to cover every shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.functions.maps import last_wins

#: Tag keys that state a limit; fixed values.
LIMIT_KEYS = ("maxheight", "maxwidth", "maxlength", "maxweight", "maxaxleload", "maxbogieweight")
XML_ROWS = {
    "node": "_id long, _lat double, _lon double, tag array<struct<_k string, _v string>>",
    "way": "_id long, nd array<struct<_ref long>>, tag array<struct<_k string, _v string>>",
    "relation": "_id long, member array<struct<_type string, _ref long, _role string>>, tag array<struct<_k string, _v string>>",
}


def tree_nodes(docs: DataFrame, doc: str = "doc", raw: str = "raw", children: str = "g") -> DataFrame:
    """Every node of JSON trees of any depth: doc, path (places from the root down), node (VARIANT), is_leaf.

    A node's children are the list under ``children``; children that are no objects are none. One
    round of the recursion a level, over all documents at once.
    """
    return docs.sparkSession.sql(
        f"""WITH RECURSIVE tree AS (
              SELECT {doc} AS doc, CAST(array() AS ARRAY<BIGINT>) AS path, try_parse_json({raw}) AS node FROM {{docs}}
              UNION ALL
              SELECT doc, array_append(path, CAST(e.pos AS BIGINT)), e.value FROM tree, LATERAL variant_explode(try_variant_get(node, '$.{children}', 'array<variant>')::variant) AS e
              WHERE schema_of_variant(e.value) LIKE 'OBJECT%')
            SELECT doc, path, node, try_variant_get(node, '$.{children}', 'variant') IS NULL OR is_variant_null(try_variant_get(node, '$.{children}', 'variant')) AS is_leaf FROM tree LIMIT ALL""",
        docs=docs,
    )


def tree_leaves(nodes: DataFrame) -> DataFrame:
    """Leaves with an id: doc, id, path, size, checksum, affiliations; of one id in a document the last in reading order."""
    own = lambda key, kind: F.try_variant_get("node", F.lit(f"$.{key}"), kind)
    found = nodes.filter("is_leaf").select(
        "doc", own("id", "string").alias("id"), "path", F.coalesce(own("s", "long"), F.lit(0)).alias("size"), F.coalesce(own("sha1_base64", "string"), F.lit("")).alias("checksum"),
        F.coalesce(own("affiliations", "array<string>"), F.array().cast("array<string>")).alias("affiliations"),
    ).filter("id <> ''")
    kept = F.max_by(F.struct("size", "checksum", "affiliations", "path"), "path").alias("leaf")
    return found.groupBy("doc", "id").agg(kept).select("doc", "id", "leaf.*")


def tree_totals(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """Each node above a leaf: doc, path, id, leaves, size; a leaf is counted once for each node above it, summed by path."""
    above = leaves.filter(F.size("path") > 0).select("doc", "size", F.explode(F.transform(F.sequence(F.lit(0), F.size("path") - 1), lambda n: F.slice("path", 1, n))).alias("path"))
    sums = above.groupBy("doc", "path").agg(F.count(F.lit(1)).alias("leaves"), F.sum("size").alias("size"))
    groups = nodes.filter("not is_leaf").select("doc", "path", F.try_variant_get("node", F.lit("$.id"), "string").alias("id"))
    return groups.join(sums, ["doc", "path"], "left").select("doc", "path", "id", F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("size", F.lit(0)).alias("size"))


_POINT = "struct<lat:double,lon:double>"


def _points(values: Column) -> Column:
    """Of array<variant>: objects that have both coordinates."""
    made = F.transform(F.coalesce(values, F.array().cast("array<variant>")), _point)
    return F.filter(made, lambda p: p.isNotNull())


def _point(value: Column) -> Column:
    lat, lon = F.try_variant_get(value, F.lit("$.lat"), "double"), F.try_variant_get(value, F.lit("$.lon"), "double")
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def element_points(element: Column) -> Column:
    """All points of a map element, in order: its geometry, each member's geometry and then the member itself, the element itself, its centre."""
    get = lambda v, path, kind: F.try_variant_get(v, F.lit(path), kind)
    alone = lambda p: F.filter(F.array(p), lambda x: x.isNotNull())
    members = F.coalesce(get(element, "$.members", "array<variant>"), F.array().cast("array<variant>"))
    inner = F.flatten(F.transform(members, lambda m: F.concat(_points(get(m, "$.geometry", "array<variant>")), alone(_point(m)))))
    return F.concat(_points(get(element, "$.geometry", "array<variant>")), inner, alone(_point(element)), alone(_point(get(element, "$.center", "variant"))))


def elements(docs: DataFrame, path: str = "$.elements", raw: str = "raw") -> DataFrame:
    """One row for each value of the list at ``path``: the other columns, element (VARIANT)."""
    values = F.try_variant_get(F.try_parse_json(raw), F.lit(path), "array<variant>")
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != raw], F.explode(values).alias("element"))


def way_id(properties: Column) -> Column:
    """The id of a tagged way: '@id' as a number where '@type' is way; else the first of '@id', 'id', 'osm_id' that reads way/N, wN or N."""
    own = lambda key: F.try_variant_get(properties, F.lit(f'$["{key}"]'), "string")
    number = lambda key: F.coalesce(F.nullif(F.regexp_extract(own(key), "^(?:way/|w)?([0-9]+)$", 1), F.lit("")))
    plain = F.when((own("@type") == "way") & own("@id").rlike("^[0-9]+$"), own("@id"))
    return F.coalesce(plain, number("@id"), number("id"), number("osm_id")).try_cast("long")


def tagged_ways(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """LineString features of at least two points: way_id, points, tags (the limit keys that are there), highway, name, is_bridge, is_tunnel."""
    f = elements(docs, "$.features", raw)
    own = lambda key: F.try_variant_get("element", F.lit(f'$.properties["{key}"]'), "string")
    pair = lambda p: F.struct(F.try_variant_get(p, F.lit("$[1]"), "double").alias("lat"), F.try_variant_get(p, F.lit("$[0]"), "double").alias("lon"))
    points = F.transform(F.try_variant_get("element", F.lit("$.geometry.coordinates"), "array<variant>"), pair)
    limits = F.map_filter(F.create_map(*[x for k in LIMIT_KEYS for x in (F.lit(k), own(k))]), lambda _, v: v.isNotNull())
    truthy = lambda key: F.coalesce(F.lower(own(key)).isin("yes", "true", "1"), F.lit(False))
    line = F.try_variant_get("element", F.lit("$.geometry.type"), "string") == "LineString"
    names = [F.col(c) for c in f.columns if c != "element"]
    return f.filter(line & (F.size(points) >= 2)).select(
        *names, way_id(F.try_variant_get("element", F.lit("$.properties"), "variant")).alias("way_id"), points.alias("points"), limits.alias("tags"),
        own("highway").alias("highway"), F.coalesce(own("name"), own("bridge:name")).alias("name"), truthy("bridge").alias("is_bridge"), truthy("tunnel").alias("is_tunnel"),
    )


def xml_elements(spark: SparkSession, path: str) -> DataFrame:
    """Nodes, ways and relations of XML documents: type, id, lat, lon, nodes, members, tags (the last value of a key)."""
    parts = []
    for tag, schema in XML_ROWS.items():
        rows = spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").schema(schema).load(path)
        pairs = F.transform("tag", lambda t: F.struct(t["_k"].alias("key"), t["_v"].alias("value")))
        lat, lon = (F.col("_lat"), F.col("_lon")) if tag == "node" else (F.lit(None).cast("double"),) * 2
        nodes = F.transform("nd", lambda n: n["_ref"]) if tag == "way" else F.lit(None).cast("array<bigint>")
        members = F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), F.coalesce(m["_role"], F.lit("")).alias("role")))
        members = members if tag == "relation" else F.lit(None).cast("array<struct<type:string,ref:bigint,role:string>>")
        parts.append(rows.select(F.lit(tag).alias("type"), F.col("_id").alias("id"), lat.alias("lat"), lon.alias("lon"), nodes.alias("nodes"), members.alias("members"), last_wins(pairs).alias("tags")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def publication_status(content: Column, expected: Column) -> Column:
    """Judged by the head of a document, 8 KiB as the rule has it: ok, not_xml, not_a_publication or wrong_version."""
    head = F.substring(content, 1, 8192)
    has = lambda *words: F.greatest(*[F.contains(head, F.lit(w)) for w in words]) if len(words) > 1 else F.contains(head, F.lit(words[0]))
    version = F.when(has("datex2.eu/schema/3/", "messageContainer", "EnergyInfrastructure"), "3.x").when(has("datex2.eu/schema/2/", "d2LogicalModel"), "2.x").otherwise("unknown")
    other = has("SituationPublication", "payloadPublication", "MeasuredDataPublication", "EnergyInfrastructure")
    want = F.trim(F.coalesce(expected, F.lit("")))
    wrong = (want.startswith("3") & ~version.startswith("3")) | (want.startswith("2") & ~version.startswith("2"))
    return (
        F.when(content.isNull() | ~F.contains(F.substring(content, 1, 500), F.lit("<")), "not_xml")
        .when((want == "") & (version == "unknown") & ~other, "not_a_publication").when(wrong, "wrong_version").otherwise("ok")
    )
