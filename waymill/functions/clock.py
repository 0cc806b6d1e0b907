"""Conditional restrictions at an instant: a documented subset of opening hours.

Month ranges that may wrap the year (Nov-Jun), single months, day-month ranges
(Apr 15-Jul 15), weekday ranges and clock ranges (Mo-Fr 07:00-16:00), or a clock range
alone. Any other condition gives null and its clause is passed over.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DAYS = "Mo|Tu|We|Th|Fr|Sa|Su"
NO_WORDS = ("no", "private", "destination", "permit", "agricultural", "forestry", "delivery")
YES_WORDS = ("yes", "permissive", "designated", "official")

MONTH_RANGE = rf"^({MONTHS})(?:\s*-\s*({MONTHS}))?$"
DAY_RANGE = rf"^({MONTHS})\s+([0-9]{{1,2}})\s*-\s*({MONTHS})\s+([0-9]{{1,2}})$"
WEEK_CLOCK = rf"^(?:({DAYS})(?:\s*-\s*({DAYS}))?\s*)?(?:([0-9]{{2}}):([0-9]{{2}})\s*-\s*([0-9]{{2}}):([0-9]{{2}}))?$"


def _place(word: Column, names: str) -> Column:
    """1 for the first name."""
    return F.array_position(F.array(*[F.lit(n) for n in names.split("|")]), word).cast("int")


def _within(at: Column, low: Column, high: Column) -> Column:
    """Inclusive, around the end when low is above high."""
    return F.when(low <= high, (at >= low) & (at <= high)).otherwise((at >= low) | (at <= high))


def matches(condition: Column, at: Column) -> Column:
    """True, false, or null for a condition outside the subset."""
    c = F.trim(condition)
    group = lambda p, i: F.regexp_extract(c, p, i)
    month, day, weekday = F.month(at), F.dayofmonth(at), F.weekday(at) + 1
    minute = F.hour(at) * 60 + F.minute(at)
    months = _within(month, _place(group(MONTH_RANGE, 1), MONTHS), F.coalesce(F.nullif(_place(group(MONTH_RANGE, 2), MONTHS), F.lit(0)), _place(group(MONTH_RANGE, 1), MONTHS)))
    number = lambda p, i: F.coalesce(group(p, i).try_cast("int"), F.lit(0))
    days = _within(month * 100 + day, _place(group(DAY_RANGE, 1), MONTHS) * 100 + number(DAY_RANGE, 2), _place(group(DAY_RANGE, 3), MONTHS) * 100 + number(DAY_RANGE, 4))
    first = F.nullif(_place(group(WEEK_CLOCK, 1), DAYS), F.lit(0))
    last = F.coalesce(F.nullif(_place(group(WEEK_CLOCK, 2), DAYS), F.lit(0)), first)
    in_week = F.when(first.isNull(), True).otherwise(_within(weekday, first, last))
    start, end = number(WEEK_CLOCK, 3) * 60 + number(WEEK_CLOCK, 4), number(WEEK_CLOCK, 5) * 60 + number(WEEK_CLOCK, 6)
    in_clock = F.when(group(WEEK_CLOCK, 3) == "", True).when(start < end, (minute >= start) & (minute < end)).otherwise((minute >= start) | (minute < end))
    return F.when(c.rlike(MONTH_RANGE), months).when(c.rlike(DAY_RANGE), days).when((c != "") & c.rlike(WEEK_CLOCK), in_week & in_clock)


def _clauses(raw: Column) -> Column:
    """Clauses with a token before and a condition after the first @."""
    parts = F.transform(F.split(raw, ";"), lambda p: F.trim(p))
    return F.transform(
        F.filter(parts, lambda p: p.rlike(r"^[^@]*[^@\s][^@]*@.*\S")),
        lambda p: F.struct(
            F.lower(F.trim(F.substring_index(p, "@", 1))).alias("token"),
            F.coalesce(F.nullif(F.trim(F.regexp_extract(p, r"@[^(]*\((.*)\)", 1)), F.lit("")), F.trim(F.regexp_replace(p, r"^[^@]*@", ""))).alias("when"),
        ),
    )


def forbids(raw: Column, at: Column) -> Column:
    """A no-clause that matches forbids; so do yes-windows none of which is open."""
    seen = F.filter(F.transform(_clauses(raw), lambda c: F.struct(c["token"].alias("token"), matches(c["when"], at).alias("on"))), lambda c: c["on"].isNotNull())
    no = F.exists(seen, lambda c: c["token"].isin(*NO_WORDS) & c["on"])
    window = F.exists(seen, lambda c: c["token"].isin(*YES_WORDS))
    opened = F.exists(seen, lambda c: c["token"].isin(*YES_WORDS) & c["on"])
    return F.coalesce(no | (window & ~opened), F.lit(False))


def speed_at(raw: Column, at: Column, parse) -> Column:
    """The first matching clause whose token is a speed."""
    fits = F.filter(_clauses(raw), lambda c: matches(c["when"], at) & parse(c["token"]).isNotNull())
    return parse(F.get(fits, F.lit(0))["token"])
