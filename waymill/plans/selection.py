"""Selection under several budgets: an ordered fold over sorted partitions.

A candidate is taken or deferred by what those before it have used of every budget, so the rule
is sequential within a group. Groups are spread over tasks and sorted there (the sort spills); the
rows of a group then stream through a fold whose state is a few sums, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the weekly budget.
MAX_HOURS, MAX_DISK_GIB, MAX_PEAK_MB = 6.0, 80.0, 14 * 1024.0
PACK_SHARE = 0.25  # of a pack's size that its publication adds
RANK = ("scan_pending", "severity", "missing", "cars", "id")


def ranked(candidates: DataFrame) -> DataFrame:
    """Candidates with severity; those without any gap and with a known scan are left out."""
    gap = F.coalesce("no_road", F.lit(0)) + F.coalesce("tiny", F.lit(0))
    known = candidates.withColumn("severity", F.when(F.col("scan_pending"), 0).otherwise(gap))
    return known.filter(F.col("scan_pending") | (gap > 0))


def _order(group: str) -> list[Column]:
    return [F.col(group), F.col("scan_pending"), F.desc("severity"), F.desc(F.coalesce("missing", F.lit(0))), F.desc(F.coalesce("cars", F.lit(0))), F.col("id")]


def selected(candidates: DataFrame, group: str, max_hours: float = MAX_HOURS, max_disk_gib: float = MAX_DISK_GIB, max_peak_mb: float = MAX_PEAK_MB) -> DataFrame:
    """group, id, place (from 1, in rank order), taken, reason (null if taken) for every ranked candidate.

    candidates: id, scan_pending, no_road, tiny, missing, cars, in_weekly, peak_mb, convert_s,
    dem_mib, pack_gib. A pending scan and a peak over the memory limit defer first; what is
    already weekly is taken and uses nothing; others are taken while their hours and then their
    disk fit, and a deferred one uses nothing.
    """
    numbers = ["peak_mb", "convert_s", "dem_mib", "pack_gib"]
    rows = ranked(candidates).repartition(group).sortWithinPartitions(*_order(group)).select(group, "id", "scan_pending", "in_weekly", *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in numbers])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, seconds, dem, pack = object(), 0, 0.0, 0.0, 0.0
        for batch in batches:
            places, reasons = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, _, pending, weekly, peak, add_s, add_dem, add_pack = row
                if own != now:
                    now, place, seconds, dem, pack = own, 0, 0.0, 0.0, 0.0
                place += 1
                hours = (seconds + add_s) / 3600
                disk = (dem + add_dem) / 1024 + (pack + add_pack) * PACK_SHARE
                reason = "pack_scan_pending" if pending else "peak_memory" if peak > max_peak_mb else None
                if reason is None and not weekly:
                    reason = "convert_hours" if hours > max_hours else "disk" if disk > max_disk_gib else None
                    if reason is None:
                        seconds, dem, pack = seconds + add_s, dem + add_dem, pack + add_pack
                places.append(place)
                reasons.append(reason)
            taken = pa.array([r is None for r in reasons])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.int64()), taken, pa.array(reasons, pa.string())], [group, "id", "place", "taken", "reason"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(fold, f"`{group}` {kinds[group]}, id {kinds['id']}, place long, taken boolean, reason string")
