"""Column rules for named things: search stubs, named routes, POIs, region and leaf names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymill.functions.maps import last_wins

# POI words, route networks.
WATER = ("drinking_water", "fountain", "water_point")
CABIN = ("wilderness_hut", "alpine_hut", "hostel", "camp_site", "camp_pitch")
GENERAL = ("cafe", "restaurant", "fast_food", "museum", "gallery", "zoo", "aquarium", "viewpoint", "picnic_site")
LODGING = ("hotel", "motel", "guest_house", "apartment", "chalet", "hostel")
HUT_NETWORKS = ("DNT", "STF")
WALKING_NETWORKS = ("iwn", "nwn", "rwn", "lwn", "nhn", "rhn", "lhn")
CYCLE_NETWORKS = ("icn", "ncn", "rcn", "lcn")
CATEGORIES = ("water", "restroom", "cabin", "overnight", "tent", "general", "network_hut", "brewery", "fishing", "rest_area", "lodging")


def yes(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def poi_categories(t: dict[str, Column]) -> Column:
    """Sorted categories of a place, several at once."""
    amenity, tourism = t["amenity"], t["tourism"]
    hut = yes(tourism.isin("wilderness_hut", "alpine_hut"))
    named = lambda c: reduce(lambda a, b: a | b, (yes(c.contains(n)) for n in HUT_NETWORKS))
    lorry = yes(t["hgv"].isin("yes", "designated"))
    cabin = yes(tourism.isin(*CABIN)) | yes(amenity == "shelter")
    tests = {
        "water": yes(amenity.isin(*WATER)) | yes(t["natural"] == "spring"), "restroom": yes(amenity == "toilets"), "cabin": cabin, "overnight": cabin,
        "tent": yes(tourism.isin("camp_site", "camp_pitch")) | yes(amenity == "camping"), "general": yes(amenity.isin(*GENERAL)) | yes(tourism.isin("viewpoint", "attraction", "museum")),
        "network_hut": hut & (named(F.coalesce(t["operator"], t["network"])) | named(t["operator"])), "brewery": yes(t["shop"] == "alcohol"), "fishing": yes(t["leisure"].isin("fishing", "fishing_pier")) | yes(t["shop"] == "fishing"),
        "rest_area": yes(t["highway"].isin("rest_area", "services")) | (yes(amenity == "parking") & lorry), "lodging": yes(tourism.isin(*LODGING)),
    }
    return F.array_compact(F.array(*[F.when(tests[k], k) for k in CATEGORIES]))


def category_mask(categories: Column) -> Column:
    bits = F.create_map(*[x for i, k in enumerate(CATEGORIES) for x in (F.lit(k), F.lit(1 << i))])
    return F.aggregate(categories, F.lit(0), lambda m, k: m.bitwiseOR(F.coalesce(F.try_element_at(bits, k), F.lit(0))))


def from_mask(mask: Column) -> Column:
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, k) for i, k in enumerate(CATEGORIES)]))


def weekly_rest(highway: Column, icon: Column, name: Column) -> Column:
    return yes(highway == "services") | yes(icon.contains("services")) | yes(F.lower(name).contains("service"))


def icon_key(t: dict[str, Column]) -> Column:
    """The first tag that names a symbol."""
    return F.coalesce(*[F.concat(F.lit(f"{k}-"), t[k]) for k in ("amenity", "tourism", "shop", "leisure", "highway", "natural") if k in t])


def named(t: dict[str, Column]) -> dict[str, Column]:
    """Name and kind. Maps have no order: shop beats amenity, highway, peak, leisure, tourism, place. Without a name a street address stands for it."""
    kind = F.coalesce(
        *[F.concat(F.lit(f"{k}:"), t[k]) for k in ("shop", "amenity", "highway") if k in t], F.when(t["natural"] == "peak", "natural:peak"), *[F.concat(F.lit(f"{k}:"), t[k]) for k in ("leisure", "tourism", "place") if k in t]
    )
    street, number = t.get("addr:street", F.lit(None).cast("string")), t.get("addr:housenumber", F.lit(None).cast("string"))
    name = F.coalesce(t["name"], F.concat(street, F.lit(" "), number), street)
    address = F.when(t["name"].isNull(), F.when(number.isNotNull(), "addr:housenumber").otherwise("addr:street"))
    return {"name": name, "kind": F.when(name.isNotNull(), F.coalesce(kind, address, F.lit("named")))}


def route_records(text: Column) -> dict[str, Column]:
    """A named route from a JSON line: id, kind, name (else the reference), place in 1e-7 degrees; ``refused`` where the id is not above 0, null name where the line has none."""
    row = F.from_json(text, "osm_relation_id long, kind string, name string, ref string, lat double, lon double")
    name = F.coalesce(F.nullif(row["name"], F.lit("")), F.nullif(row["ref"], F.lit("")))
    e7 = lambda v: F.round(v * 1e7).cast("int")
    return {"id": row["osm_relation_id"], "kind": row["kind"], "name": name, "lat_e7": e7(row["lat"]), "lon_e7": e7(row["lon"]), "refused": F.coalesce(row["osm_relation_id"] <= 0, F.lit(True)) & (F.trim(text) != "")}


def route_kind(route: Column, network: Column, pilgrim: Column) -> Column:
    r, n = F.lower(route), F.lower(network)
    return (
        F.when(pilgrim, "pilgrimage").when(r.isin("hiking", "foot") & n.isin(*WALKING_NETWORKS), "hiking").when(r.isin("bicycle", "mtb") & n.isin(*CYCLE_NETWORKS), F.when(r == "mtb", "mtb").otherwise("bicycle"))
        .when(r == "horse", "horse").when(r.isin("running", "fitness_trail"), "running").when(r.isin("ski", "piste"), "ski").when(r.isin("canoe", "kayak"), "canoe").when(r == "inline_skates", "inline_skates")
        .when(r.isin("hiking", "foot"), "hiking").when(r == "mtb", "mtb").when(r == "bicycle", "bicycle").otherwise("other")
    )


def admin_level(boundary: Column, name: Column, level: Column) -> Column:
    n = level.try_cast("int")
    return F.when((boundary == "administrative") & (F.trim(name) != "") & n.between(6, 8), n)


def region_key(path: Column) -> Column:
    """Letters, digits, - and _ only, lower case; 'unknown' for none."""
    bare = F.regexp_replace(F.trim(path), "^/+|/+$", "")
    clean = F.lower(F.regexp_replace(F.regexp_replace(bare, "[^A-Za-z0-9_-]", "_"), "^_+|_+$", ""))
    return F.when(bare == "", "unknown").otherwise(clean)


def country_prefix(path: Column) -> Column:
    """The first two segments, if there are two."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.when(F.size(segments) >= 2, F.concat_ws("/", F.get(segments, F.lit(0)), F.get(segments, F.lit(1))))


def slug(prefix: Column) -> Column:
    return F.replace(F.lower(F.substring_index(prefix, "/", -1)), F.lit("_"), F.lit("-"))


def display_name(prefix: Column) -> Column:
    return F.initcap(F.replace(F.substring_index(prefix, "/", -1), F.lit("-"), F.lit(" ")))


def humanised(region_id: Column) -> Column:
    """Underscores to spaces, the first letter up, the rest as it is."""
    s = F.replace(region_id, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.left(s, F.lit(1))), F.substr(s, F.lit(2)))


def line_options(words: Column) -> Column:
    """key=value words of a line: ``values``, the last of a key, and ``terrain``, the distinct classes of all terrain_class words (parted by comma or plus)."""
    own = F.filter(words, lambda w: w.contains("="))
    pairs = F.transform(own, lambda w: F.struct(F.lower(F.substring_index(w, "=", 1)).alias("key"), F.regexp_replace(w, "^[^=]*=", "").alias("value")))
    classes = F.flatten(F.transform(F.filter(pairs, lambda p: p["key"] == "terrain_class"), lambda p: F.split(F.lower(p["value"]), "[,+]")))
    return F.struct(last_wins(F.filter(pairs, lambda p: p["key"] != "terrain_class")).alias("values"), F.array_distinct(F.filter(classes, lambda x: x != "")).alias("terrain"))


def continent(leaf: Column) -> Column:
    nordic = leaf.rlike("^(Norway|Sweden|Denmark|Finland|Iceland)")
    europe = leaf.rlike("^(Germany|France|UK|Spain|Italy|Europe)|_Europe") & ~leaf.rlike("^World(_|$)")
    return F.when(nordic, "nordic").when(europe, "europe").otherwise("world")


def elevation_class(leaf: Column) -> Column:
    return F.when(leaf.startswith("Latvia"), "high_res_20m").when(leaf.rlike("^(Australia|Canada)"), "mixed").when(leaf.rlike("^(Norway|Sweden|France|UK|US)(_|$)"), "high_res").otherwise("copernicus_only")


def elevation_threshold(leaf: Column, lat_max: Column, policy: int) -> Column:
    """5 m for coarse-only leaves wholly south of 60 N under policy 2, else 2 m."""
    return F.when(F.lit(policy >= 2) & (elevation_class(leaf) == "copernicus_only") & (lat_max < 60), 5.0).otherwise(2.0)
