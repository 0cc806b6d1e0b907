"""Column rules for repeater records: frequencies, shifts, tones, designators, text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymill.functions.maps import last_wins

# Emission designators and words.
DESIGNATORS = {"16K0F3E": "FM", "11K2F3E": "FM", "7K60FXE": "DMR", "6K00F7W": "DSTAR", "9K36F7W": "C4FM", "20K0F2D": "APRS", "12K5F1D": "DATA"}
DISABLED = ("no", "false", "0", "disused")
ENABLED = ("", "yes", "true", "1")
OFF_AIR = ("inactive", "off-air", "offair", "off air", "retired", "disabled")
NO_TONE = ("CSQ", "NONE", "OFF", "N/A", "NA", "-")
MAX_SHIFT_HZ = 100_000_000


def decimal(raw: Column) -> Column:
    """A number that may have spaces and a decimal comma."""
    return F.replace(F.replace(F.trim(raw), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def _scaled(v: Column) -> Column:
    return F.bround(F.when(F.abs(v) < 10000, v * 1_000_000).otherwise(v), 0).cast("long")


def hertz(raw: Column) -> Column:
    """Hz; a bare number below 10000 is in MHz; units in either case; other signs are dropped."""
    s = F.replace(F.trim(raw), F.lit(","), F.lit("."))
    unit = F.lower(F.regexp_extract(s, r"(?i)^(-?[0-9]*\.?[0-9]+)\s*(mhz|hz)$", 2))
    value = F.regexp_extract(s, r"(?i)^(-?[0-9]*\.?[0-9]+)\s*(mhz|hz)$", 1).try_cast("double")
    loose = F.regexp_replace(s, r"[^0-9.\-]", "").try_cast("double")
    return F.when(unit == "hz", F.bround(value, 0).cast("long")).when(unit == "mhz", F.bround(value * 1_000_000, 0).cast("long")).otherwise(_scaled(F.coalesce(decimal(raw), loose)))


def parts(raw: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ";"), lambda p: F.trim(p)), lambda p: p != "")


def first_hertz(raw: Column) -> Column:
    return F.get(F.filter(F.transform(parts(raw), hertz), lambda h: h.isNotNull()), F.lit(0))


def shift(raw: Column) -> Column:
    """The first parseable part of at most 100 MHz."""
    return F.get(F.filter(F.transform(parts(raw), hertz), lambda h: h.isNotNull() & (F.abs(h) <= MAX_SHIFT_HZ)), F.lit(0))


def tone(raw: Column) -> dict[str, Column]:
    """ctcss_hz for a tone, code for a digital one."""
    s, up = F.trim(raw), F.upper(F.trim(raw))
    none = up.isNull() | (up == "") | up.isin(*NO_TONE)
    coded = up.startswith("D") | up.contains("DCS") | up.endswith("N") | up.endswith("I")
    code = F.trim(F.replace(up, F.lit("DCS"), F.lit("")))
    return {
        "ctcss_hz": F.when(~none & ~coded, decimal(s)),
        "code": F.when(~none & coded, F.coalesce(F.nullif(code, F.lit("")), up)).when(~none & decimal(s).isNull(), s),
    }


def modes(raw: Column) -> Column:
    """Ordered distinct modes of designators; an unknown one stands for itself."""
    table = F.create_map(*[F.lit(x) for kv in DESIGNATORS.items() for x in kv])
    return F.array_distinct(F.transform(parts(raw), lambda d: F.coalesce(F.try_element_at(table, F.replace(F.upper(d), F.lit(" "), F.lit(""))), d)))


def enabled(raw: Column) -> dict[str, Column]:
    """Is it one, and the callsign if the value itself is."""
    low = F.lower(F.trim(raw))
    keep = F.coalesce(~low.isin(*DISABLED), F.lit(False))
    return {"enabled": keep, "callsign": F.when(keep & ~low.isin(*ENABLED), F.trim(raw))}


def active(status: Column) -> Column:
    s = F.replace(F.lower(F.trim(status)), F.lit("_"), F.lit("-"))
    return F.coalesce(~s.isin(*OFF_AIR), F.lit(True))


def entry_kind(*texts: Column) -> Column:
    blob = F.lower(F.concat_ws(" ", *texts))
    return F.when(blob.contains("aprs"), "aprs").when(blob.contains("simplex"), "simplex").otherwise("repeater")


def unescaped(value: Column) -> Column:
    """%hex% to the code point, each once and from left to right."""
    gaps = F.split(value, "%[0-9a-fA-F]+%", -1)
    hits = F.regexp_extract_all(value, F.lit("%([0-9a-fA-F]+)%"), F.lit(1))
    signs = F.transform(hits, lambda h: F.decode(F.unhex(F.lpad(h, 8, "0")), "UTF-32"))
    return F.array_join(F.transform(F.arrays_zip(gaps.alias("g"), signs.alias("s")), lambda x: F.concat(x["g"], F.coalesce(x["s"], F.lit("")))), "")


def opl(line: Column) -> dict[str, Column]:
    """An element line: type, id, version, time, place, tags map, node ids, members."""
    tokens = F.split(F.trim(line), r"\s+")
    own = lambda p: F.get(F.filter(tokens, lambda t: t.rlike(p)), F.lit(0))
    body = lambda p: F.regexp_replace(own(p), "^.", "")
    pairs = F.filter(F.split(body("^T.*="), ",(?=[^=,]+=)"), lambda p: p.contains("="))
    entries = F.transform(pairs, lambda p: F.struct(unescaped(F.regexp_extract(p, "^([^=]*)=", 1)).alias("key"), unescaped(F.regexp_replace(p, "^[^=]*=", "")).alias("value")))
    head = F.get(tokens, F.lit(0))
    return {
        "type": F.when(head.startswith("n"), "node").when(head.startswith("w"), "way").when(head.startswith("r"), "relation"), "id": F.substr(head, F.lit(2)).try_cast("long"),
        "version": body("^v[0-9]+$").try_cast("int"), "ts": body("^t[0-9]"), "lat": body("^y-?[0-9]").try_cast("double"), "lon": body("^x-?[0-9]").try_cast("double"),
        "tags": last_wins(entries),
        "nodes": F.transform(F.filter(F.split(body("^N"), ","), lambda n: n.rlike("^n?[0-9]+$")), lambda n: F.regexp_replace(n, "^n", "").cast("long")),
        "members": F.transform(
            F.filter(F.split(body("^M"), ","), lambda m: m.rlike("^[nwr][0-9]+(?:@|$)")),
            lambda m: F.struct(F.substring(m, 1, 1).alias("type"), F.regexp_extract(m, "^.([0-9]+)", 1).cast("long").alias("ref"), unescaped(F.when(m.contains("@"), F.regexp_replace(m, "^[^@]*@", "")).otherwise("")).alias("role")),
        ),
    }
