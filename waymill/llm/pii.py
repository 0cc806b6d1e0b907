"""Personal data: weak supervision over candidate spans, by column functions only.

Candidates are the fixed patterns' spans (email, ip, card, phone; these always stay) and
looser groups of digits ("number": local telephone and identity numbers without a plus).
Three labelers vote +1, -1 or 0 on each candidate: a regex labeler (strict shape), a
gazetteer labeler (a word for such data just before it) and a context labeler (what touches
it). Expectation-maximisation over the counts of vote patterns, at most 27 rows, estimates
how each labeler votes on true and on false spans; its posteriors are soft labels from which
a final span classifier, naive Bayes over kind, length, separators and neighbours, is
trained by one aggregation. Numbers that it accepts are added.

Positions: a text split by a pattern, beside the pattern's matches, gives the lengths between
and of the matches; each match becomes a row, and running sums in windows over a text's
matches give the starts in code points. The patterns are written with possessive repeats and
run-start guards, so that each is linear and free of recursion on any text, and match what
the plain ones match. The text is read once and never shuffled: only its matches are.

Defined cases: a null text is the empty text, without spans; a very long text, or one with
very many matches, takes time in proportion to its length (and to n log n of its matches,
sorted in windows that spill); rows repeated give their rows again; extra columns are
ignored; an empty table gives an empty result, and no candidate at all leaves an empty model
that accepts nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,5}){1,3}(?![0-9A-Za-z-])",
}
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "number")
#: A cheap test that a pattern may match at all.
HINTS = {"email": "@", "phone": r"\+", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "number": r"[0-9][)]?[\x20.-][0-9]{2}"}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|$)){4}$"
NEAR = 24  # code points of context on each side
GAZETTEER = r"(?i)(?:phone|telephone|tel|mobile|cell|call|fax|contact|ssn|social security|passport|licen[cs]e no|account|iban|card|id|e-?mail|mail|ip|address|telefon|handy|t[eé]l[eé]phone|tel[eé]fono|m[oó]vil|correo|konto)[\x20.:#=-]*$"
NOT_PERSONAL = r"(?i)(?:version|isbn|issn|doi|page|pages|chapter|section|figure|table|year|vol|no\.|\$|€|£|%)[\x20.:#=-]*$"
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}+$",
    "ip": r"^(?!0)[0-9]{1,3}(?:\.[0-9]{1,3}){3}$",
    "card": r"^[3-6][0-9]{3}(?:[\x20-]?[0-9]){9,15}$",
    "phone": r"^\+[1-9][0-9]{0,2}[\x20(.-]",
    "number": r"^(?:\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$",
}
ROUNDS = 50
ACCEPT = math.log(9)  # posterior odds of 9 to 1


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digits padded to 19 from the left: zeros add nothing."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(19):
        d = F.substring(padded, i + 1, 1).cast("int")
        total = total + (d if i % 2 == 0 else F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return total % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(OCTETS)
    if kind == "card":
        return F.length(_digits(hit)).between(13, 19) & _luhn(_digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "number":
        return F.length(_digits(hit)).between(7, 12)
    return F.lit(True)


def _matches(docs: DataFrame) -> DataFrame:
    """row, doc_id and hits: every match of every kind, valid or not, with what lies before and beside it.

    A text split by a pattern gives the pieces between its matches, so all contexts are cut from
    single pieces and no step looks at the text once a match. A context goes back, or on, to the
    neighbouring match of the kind at most.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select(
        "row", "doc_id",
        *[F.when(F.col("text").rlike(HINTS[k]), F.split("text", PATTERNS[k], -1)).otherwise(F.array().cast("array<string>")).alias(f"pieces_{k}") for k in KINDS],
        *[F.when(F.col("text").rlike(HINTS[k]), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"found_{k}") for k in KINDS],
    )

    def described(i: int, kind: str) -> Column:
        pieces, found = F.col(f"pieces_{kind}"), F.col(f"found_{kind}")
        beside = lambda at: F.coalesce(F.get(found, at), F.lit(""))
        return F.transform(
            found,
            lambda hit, no: F.struct(
                F.lit(i).alias("kind"), no.alias("no"), F.length(F.get(pieces, no)).alias("gap"), hit.alias("hit"),
                F.right(F.concat(beside(no - 1), F.get(pieces, no)), F.lit(NEAR)).alias("left"), F.substring(F.concat(F.get(pieces, no + 1), beside(no + 1)), 1, NEAR).alias("right"),
            ),
        )

    return materialize(rows.select("row", "doc_id", F.concat(*[described(i, k) for i, k in enumerate(KINDS)]).alias("hits")), "matches")


def _placed(matches: DataFrame) -> DataFrame:
    """row, kind, start, end, hit, left, right of the valid matches; numbers that touch a base span are left out.

    Positions are running sums within a row and kind; whether a number touches a base span follows
    from the furthest end before it and the first start after it, in two passes over sorted rows.
    """
    c = F.col
    each = matches.select("row", F.inline("hits")).repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(c("gap") + F.length("hit")).over(upto).cast("int")).withColumn("start", c("end") - F.length("hit"))
    valid = F.lit(False)
    for i, kind in enumerate(KINDS):
        valid = F.when(c("kind") == i, _valid(kind, c("hit"))).otherwise(valid)
    number = c("kind") == KINDS.index("number")
    before = Window.partitionBy("row").orderBy("start", number, "end", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("row").orderBy(c("start").desc(), number.desc(), c("end").desc(), c("kind").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.filter(valid).withColumns({"upto": F.max(F.when(~number, c("end"))).over(before), "from": F.min(F.when(~number, c("start"))).over(after)})
    touched = (F.coalesce("upto", F.lit(0)) > c("start")) | (F.coalesce("from", c("end")) < c("end"))
    return each.filter(~(number & touched)).select("row", "kind", "start", "end", "hit", "left", "right")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def candidates(matches: DataFrame) -> DataFrame:
    """row, kind, start, end, the three votes in one code and the classifier's features; written out."""
    kind, hit, left, right = (F.col(x) for x in ("kind", "hit", "left", "right"))
    strict = F.lit(False)
    for i, name in enumerate(KINDS):
        strict = F.when(kind == i, hit.rlike(STRICT[name])).otherwise(strict)
    votes = (_vote(strict, ~strict), _vote(left.rlike(GAZETTEER), left.rlike(NOT_PERSONAL)), _vote(left.rlike(r"(?:^|[\x20\n\"'(:=])$") & right.rlike(r"^(?:$|[\x20\n\"'),;.!?])"), left.rlike(r"[A-Za-z0-9_/.,-]$") | right.rlike("^[A-Za-z0-9_/]")))
    code = (votes[0] + 1) * 9 + (votes[1] + 1) * 3 + votes[2] + 1
    features = F.array(
        F.concat(F.lit("size:"), kind, F.lit(":"), F.least(F.floor((F.col("end") - F.col("start")) / 4), F.lit(8))),
        F.concat(F.lit("marks:"), kind, F.lit(":"), F.array_join(F.array_distinct(F.regexp_extract_all(hit, F.lit(r"[\x20().@-]"), F.lit(0))), "")),
        F.concat(F.lit("left:"), kind, F.lit(":"), F.when(left.rlike(GAZETTEER), "word").when(left == "", "start").when(left.rlike(r"[\x20\n]$"), "space").otherwise("other")),
        F.concat(F.lit("shape:"), kind, F.lit(":"), strict.cast("string")),
    )
    return materialize(_placed(matches).select("row", "kind", "start", "end", code.cast("int").alias("votes"), features.alias("features")), "candidates")


def reliabilities(patterns: dict[int, int]) -> dict[int, float]:
    """Vote pattern -> posterior that the span is personal, by EM on pattern counts.

    Each labeler votes -1, 0 or 1 with its own probabilities on true and on false spans, the
    labelers independent given the truth. The start is the majority of the votes.
    """
    if not patterns:
        return {}
    votes = {p: (p // 9, p // 3 % 3, p % 3) for p in patterns}
    posterior = {p: min(max(0.5 + 0.15 * (sum(v) - 3), 0.05), 0.95) for p, v in votes.items()}
    for _ in range(ROUNDS):
        mass = [sum(n * (1 - posterior[p]) for p, n in patterns.items()), sum(n * posterior[p] for p, n in patterns.items())]
        rate = [[[0.1 + sum(n * (posterior[p] if y else 1 - posterior[p]) for p, n in patterns.items() if votes[p][i] == v) for v in range(3)] for i in range(3)] for y in (0, 1)]
        rate = [[[x / sum(row) for x in row] for row in side] for side in rate]
        for p, v in votes.items():
            side = [math.log(max(mass[y], 0.5)) + sum(math.log(rate[y][i][v[i]]) for i in range(3)) for y in (0, 1)]
            posterior[p] = 1 / (1 + math.exp(min(max(side[0] - side[1], -50), 50)))
    return posterior


def classifier(found: DataFrame) -> tuple[dict[str, float], float]:
    """Log odds of each feature and of the prior, from EM posteriors as soft labels."""
    counts = {r["votes"]: r["n"] for r in found.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 27 rows
    posterior = reliabilities(counts)
    if not posterior:
        return {}, 0.0
    soft = F.create_map(*[F.lit(x) for p, q in sorted(posterior.items()) for x in (p, q)])
    sums = (
        found.withColumn("p", F.element_at(soft, F.col("votes"))).select("p", F.explode("features").alias("f"))
        .groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    )  # kinds times classes: a few hundred at most
    yes = sum(posterior[p] * n for p, n in counts.items()) + 1
    no = sum((1 - posterior[p]) * n for p, n in counts.items()) + 1
    return {r["f"]: math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["no"] + 0.5) / (no + 1)) for r in sums}, math.log(yes / no)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of each kind, base_sha256 and spans for every row."""
    matches = _matches(docs)
    found = candidates(matches)
    weights, prior = classifier(found)
    table = F.create_map(*[F.lit(x) for f, w in sorted(weights.items()) for x in (f, float(w))]) if weights else F.create_map(F.lit(""), F.lit(0.0))
    odds = F.aggregate("features", F.lit(float(prior)), lambda a, f: a + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))
    names, number = F.array(*[F.lit(k) for k in KINDS]), KINDS.index("number")
    spans = F.sort_array(F.collect_list(F.struct("kind", "start", "end")))
    own = found.filter((F.col("kind") != number) | (odds >= ACCEPT)).groupBy("row").agg(spans.alias("s"), *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS)])
    written = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    own = own.select("row", written(F.filter("s", lambda s: s["kind"] != number)).alias("base"), written(F.col("s")).alias("spans"), *[f"n_{k}" for k in KINDS])
    return matches.select("row", "doc_id").join(own, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
