"""Maps from lists of pairs in which a key may repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_wins(entries: Column) -> Column:
    """Map of array<struct<key, value>>; of equal keys the last stays, null entries are none."""
    some = F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))
    keys = F.array_distinct(F.transform(some, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(some, lambda e: e["key"] == k), -1)["value"]))
