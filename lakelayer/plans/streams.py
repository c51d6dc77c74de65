"""Listening-events domain: silver stream transforms and gold change flows.

Silver (each a function of a batch or streaming DataFrame):
users (upper-case name, rescued column dropped, first row per user), tracks
(duration bucket, hyphens to spaces, first row per track), dates, artists and
facts (rescued column dropped). Gold: users, tracks and dates as SCD type 2 by
``updated_at`` / ``date`` (users behind the not-null expectation), facts as SCD
type 1 by ``stream_timestamp``; plus the fact x user x track star join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakelayer.functions import duration_flag, hyphen_to_space, upper_name
from lakelayer.operators.columns import drop_columns
from lakelayer.operators.dedup import first_seen
from lakelayer.operators.quality import expect_all_or_drop
from lakelayer.operators.scd import scd1_apply, scd2_apply
from lakelayer.operators.star import JoinSpec, star_join
from lakelayer.sources.files import RESCUED
from lakelayer.streaming.cdc_flow import CdcTarget, run_cdc_stream

USER_RULES = {"rule_1": "user_id IS NOT NULL"}


def silver_users(df: DataFrame) -> DataFrame:
    return first_seen(drop_columns(df.withColumn("user_name", upper_name("user_name")), [RESCUED]), ["user_id"])


def silver_tracks(df: DataFrame) -> DataFrame:
    out = (df.withColumn("durationFlag", duration_flag("duration_sec"))
           .withColumn("track_name", hyphen_to_space("track_name")))
    return first_seen(drop_columns(out, [RESCUED]), ["track_id"])


def silver_passthrough(df: DataFrame) -> DataFrame:
    """Dates, artists and facts: only the rescued column is dropped."""
    return drop_columns(df, [RESCUED])


@dataclass(frozen=True)
class Flow:
    name: str
    keys: tuple[str, ...]
    sequence_by: str
    scd_type: int
    rules: dict | None = None


# The four gold flows (target, keys, sequence, SCD type).
FLOWS = (
    Flow("dimuser", ("user_id",), "updated_at", 2, USER_RULES),
    Flow("dimtrack", ("track_id",), "updated_at", 2),
    Flow("dimdate", ("date_key",), "date", 2),
    Flow("factstream", ("stream_id",), "stream_timestamp", 1),
)


def gold_batch(flow: Flow, changes: DataFrame) -> DataFrame:
    """One flow over all changes at once (the ``once`` form)."""
    if flow.rules:
        changes = expect_all_or_drop(changes, flow.rules)
    if flow.scd_type == 1:
        return scd1_apply(changes, list(flow.keys), [flow.sequence_by])
    return scd2_apply(changes, list(flow.keys), flow.sequence_by)


def gold_target(flow: Flow, root: str) -> CdcTarget:
    """The flow's table under ``root``, named after the flow."""
    return CdcTarget(root=f"{root.rstrip('/')}/{flow.name}", keys=flow.keys, sequence_by=flow.sequence_by, scd_type=flow.scd_type)


def gold_stream(flow: Flow, stream: DataFrame, root: str, checkpoint: str | None = None) -> int:
    """The same flow as a streaming query (foreachBatch); returns the number of batches. The flow's name names its table
    and, by default, its checkpoint."""
    if flow.rules:
        stream = expect_all_or_drop(stream, flow.rules)
    return run_cdc_stream(stream, gold_target(flow, root), checkpoint or f"{root.rstrip('/')}/_checkpoints/{flow.name}")


STAR = [
    JoinSpec("factstream", "factstream", "factstream.stream_id, factstream.listen_duration"),
    JoinSpec("dimuser", "dimuser", "dimuser.user_id, dimuser.user_name", "factstream.user_id = dimuser.user_id"),
    JoinSpec("dimtrack", "dimtrack", "dimtrack.track_id, dimtrack.track_name",
             "factstream.track_id = dimtrack.track_id"),
]


def star_report(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    return star_join(spark, STAR, frames)
