"""A hash history that follows its daily snapshots, whatever the order in which days arrive or are loaded again.

After every load the table is what ``scd2_hash_history`` gives for all snapshots stored by then. A load compares the mark
of each day (row count and hash sum) with the one it recorded before. Days that are new, late, corrected or gone are
changed days; only the keys on them are affected, and only from the first changed day on. One job replays these keys: their last
version before that day, then their snapshots since, scanned once. The versions that come out, and marks for
versions that are no more, go to a keyed target (``streaming.cdc_flow``), which stores them without touching
the versions of other keys. No loop over days, and one plan for a first load, a gap and a correction alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.operators.scd import SCD2_AUDIT, scd2_hash_history
from lakelayer.session import missing_path
from lakelayer.streaming.cdc_flow import CdcTarget, apply_batch, last_batch, read_target

START, LOAD, GONE = "effective_start_date", "_ll_load", "_ll_gone"
MARK = "load long, day date, mark string"


@dataclass(frozen=True)
class ReplayedHistory:
    root: str
    key: str
    day_col: str = "ingest_date"
    hash_col: str = "record_hash"
    buckets: int | None = None

    @property
    def target(self) -> CdcTarget:
        return CdcTarget(f"{self.root.rstrip('/')}/versions", keys=(self.key, START), sequence_by=LOAD, scd_type=1,
                         delete_when=GONE, buckets=self.buckets)

    @property
    def marks(self) -> str:
        return f"{self.root.rstrip('/')}/marks"


def read_history(spark: SparkSession, h: ReplayedHistory) -> DataFrame | None:
    """The whole history (None before the first load)."""
    held = read_target(spark, h.target)
    return None if held is None else held.drop(LOAD, GONE)


def _marks(spark: SparkSession, h: ReplayedHistory) -> tuple[dict, int]:
    """Newest mark of each day, and the number of the last load."""
    try:
        rows = spark.read.schema(MARK).json(h.marks)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return {}, 0
    got = rows.groupBy("day").agg(F.max_by("mark", "load").alias("mark"), F.max("load").alias("load")).collect()   # one row a day
    return {r["day"]: r["mark"] for r in got if r["mark"] is not None}, max((r["load"] for r in got), default=0)


def replay(spark: SparkSession, h: ReplayedHistory, snapshots: DataFrame,
           clock: Callable[[Column], Column] | None = None) -> list:
    """Bring the history up to ``snapshots`` (all of them: one row per key and day; rows without a key are left out).
    Returns the changed days."""
    clock = clock or (lambda day: F.current_timestamp())
    snaps = snapshots.where(F.col(f"`{h.key}`").isNotNull())
    mark = F.concat_ws(":", F.count(F.lit(1)), F.sum(F.xxhash64(h.key, h.hash_col).cast("decimal(38,0)")))
    now = {r[0]: r[1] for r in snaps.groupBy(h.day_col).agg(mark).collect()}                # one row a day
    before, load = _marks(spark, h)
    changed = sorted(d for d in now | before if now.get(d) != before.get(d))
    if not changed:
        return []
    first = F.lit(changed[0])
    held = read_history(spark, h)
    since = snaps.where(F.col(h.day_col) >= first)
    if held is not None:
        on_changed = F.col("_ll_day").isin(changed)
        affected = (since.select(h.key, F.col(h.day_col).alias("_ll_day"))
                    .union(held.select(h.key, F.col(START).alias("_ll_day"))).where(on_changed).select(h.key).distinct())
        mine = held.join(affected, h.key, "left_semi")
        since = since.join(affected, h.key, "left_semi")
        own = [c for c in held.columns if c not in SCD2_AUDIT]
        last = (mine.where(F.col(START) < first).groupBy(h.key)
                .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in own if c != h.key], "record_version"), START).alias("_ll_v")))
        prior = last.select(h.key, "_ll_v.*")
        since = since.withColumn("record_version", F.lit(None).cast("int")).unionByName(prior, allowMissingColumns=True)
        offset = prior.select(F.col(h.key).alias("_ll_key"), (F.col("record_version") - 1).alias("_ll_offset"))
        fresh = scd2_hash_history(since.drop("record_version"), h.key, h.day_col, h.hash_col, clock)
        fresh = (fresh.join(offset, fresh[h.key] == offset["_ll_key"], "left")
                 .withColumn("record_version", (F.col("record_version") + F.coalesce("_ll_offset", F.lit(0))).cast("int"))
                 .drop("_ll_key", "_ll_offset"))
        gone = (mine.where(F.col(START) >= first).join(fresh.select(h.key, START), [h.key, START], "left_anti")
                .withColumn(GONE, F.lit(True)))
        batch = fresh.withColumn(GONE, F.lit(False)).unionByName(gone, allowMissingColumns=True)
    else:
        batch = scd2_hash_history(since, h.key, h.day_col, h.hash_col, clock).withColumn(GONE, F.lit(False))
    load = max(load, last_batch(spark, h.target, "replay")) + 1         # a load lost before its marks is made anew
    apply_batch(spark, h.target, batch.withColumn(LOAD, F.lit(load).cast("long")), load, source="replay")
    (spark.createDataFrame([(load, d, now.get(d)) for d in changed], MARK).coalesce(1).write.mode("append").json(h.marks))
    return changed
