"""Change-data application: SCD type 1 and type 2, by sequence and by record hash.

All functions are pure: (input DataFrames, parameters) -> new DataFrame. Storage
(generations, partition replace) is the caller's business (``lakelayer.sinks``),
so a merge is classified once, from fixed inputs, in one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.operators.dedup import latest_per_key
from lakelayer.operators.ordered import ISLAND, NEXT_START, SEGMENT, scan, segmented

START_AT = "__START_AT"
END_AT = "__END_AT"
# fixed values: the audit fields of a hash history
AUDIT_SCHEMA = T.StructType([T.StructField("effective_start_date", T.DateType()),
                             T.StructField("effective_end_date", T.DateType()),
                             T.StructField("is_current", T.BooleanType()),
                             T.StructField("record_version", T.IntegerType()),
                             T.StructField("silver_load_timestamp", T.TimestampType())])
SCD2_AUDIT = tuple(AUDIT_SCHEMA.names)


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _valid(df: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def quarantine(changes: DataFrame, keys, sequence_by) -> DataFrame:
    """Change rows that cannot be applied: a NULL key or a NULL sequence value."""
    return changes.filter(~_valid(changes, _as_list(keys) + _as_list(sequence_by)))


# ── SCD type 1 ────────────────────────────────────────────────────────────────

def scd1_apply(changes: DataFrame, keys, sequence_by, delete_when: str | None = None,
               except_columns: Sequence[str] = ()) -> DataFrame:
    """Latest row per key by sequence; ties broken by the greatest remaining columns.

    A key whose latest change matches ``delete_when`` is removed. Arrival order of
    the changes does not matter.
    """
    keys, seq = _as_list(keys), _as_list(sequence_by)
    valid = changes.filter(_valid(changes, keys + seq))
    latest = latest_per_key(valid, keys, seq)
    if delete_when:
        latest = latest.filter(~F.coalesce(F.expr(delete_when), F.lit(False)))
    return latest.drop(*except_columns)


# ── SCD type 2 by sequence ───────────────────────────────────────────────────

def change_points(changes: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """One row per (key, sequence), the greatest of its rows, with the segment of its key's scan."""
    cut = segmented(changes, keys, [sequence_by])
    cut = cut.repartition(*[F.col(f"`{k}`") for k in keys], SEGMENT)
    return latest_per_key(cut, [*keys, SEGMENT, sequence_by], [])


def scd2_apply(changes: DataFrame, keys, sequence_by: str, track_except: Sequence[str] | None = None,
               delete_when: str | None = None) -> DataFrame:
    """Version history with ``__START_AT`` / ``__END_AT`` (NULL = current).

    * one version per (key, sequence) after collapsing ties (greatest row wins);
    * ``track_except``: consecutive changes whose tracked columns are equal merge
      into one version that keeps the latest values of the untracked columns;
    * ``delete_when``: a matching change closes the open version and opens none.
    Out-of-order input gives the same result as ordered input. The scan runs in segments (``operators.ordered``), so
    the sequence may have any orderable type and a key any size; rows are shuffled once, by (key, segment), which serves
    both the tie collapse and the scan.
    """
    keys = _as_list(keys)
    cols = changes.columns
    valid = changes.filter(_valid(changes, keys + [sequence_by]))
    one = change_points(valid, keys, sequence_by)
    one = one.withColumn("_ll_del", F.coalesce(F.expr(delete_when), F.lit(False))
                         if delete_when else F.lit(False))

    if track_except is None:
        n = scan(one, keys, [sequence_by], next_cols=[sequence_by])
        return (n.filter(~F.col("_ll_del"))
                .select(*[F.col(f"`{c}`") for c in cols],
                        F.col(sequence_by).alias(START_AT),
                        F.col("_next_" + sequence_by).alias(END_AT)))

    ex = set(track_except)
    tracked = [c for c in cols if c not in keys and c not in ex]
    one = one.withColumn("_ll_trk", F.struct(*[F.col(f"`{c}`") for c in tracked], F.col("_ll_del")))
    n = scan(one, keys, [sequence_by], next_cols=[sequence_by], island_of="_ll_trk")
    row = F.struct(*[F.col(f"`{c}`") for c in cols], F.col("_ll_del"))
    v = (n.groupBy(*keys, ISLAND)
         .agg(F.min(sequence_by).alias(START_AT), F.max_by("_next_" + sequence_by, sequence_by).alias(END_AT),
              F.max_by(row, sequence_by).alias("_ll_last")))
    return (v.filter(~F.col("_ll_last._ll_del"))
            .select(*[F.col(f"_ll_last.`{c}`").alias(c) for c in cols], F.col(START_AT), F.col(END_AT)))


# ── SCD type 2 by record hash (daily snapshots) ──────────────────────────────

def scd2_bootstrap(sample: DataFrame) -> DataFrame:
    """Empty history for snapshots like ``sample``: its fields, then the audit fields. Reads nothing."""
    own = [f for f in sample.schema.fields if f.name not in AUDIT_SCHEMA.names]
    return sample.sparkSession.createDataFrame([], T.StructType(own + AUDIT_SCHEMA.fields))


def _is_current(df: DataFrame) -> Column:
    return F.coalesce(F.col("is_current"), F.lit(False))


def current_rows(silver: DataFrame) -> DataFrame:
    return silver.filter(_is_current(silver))


def key_states(silver: DataFrame, batch: DataFrame, key: str, hash_col: str = "record_hash") -> DataFrame:
    """(key, state) of every batch row: ``new`` (stored in no version), ``changed`` (the stored current hash
    differs; a NULL hash on either side is no difference) or ``same``. One aggregate, one join."""
    held = silver.groupBy(key).agg(F.max(F.when(_is_current(silver), F.col(hash_col))).alias("_ll_held"),
                                   F.lit(True).alias("_ll_known"))
    state = (F.when(F.col("_ll_known").isNull(), "new")
             .when(F.col("_ll_held") != F.col(hash_col), "changed").otherwise("same"))
    return batch.select(key, hash_col).join(held, key, "left").select(key, state.alias("state"))


def changed_ids(silver: DataFrame, batch: DataFrame, key: str, hash_col: str = "record_hash") -> DataFrame:
    return key_states(silver, batch, key, hash_col).where("state = 'changed'").select(key)


def new_ids(silver: DataFrame, batch: DataFrame, key: str, hash_col: str = "record_hash") -> DataFrame:
    return key_states(silver, batch, key, hash_col).where("state = 'new'").select(key).distinct()


def ids_to_insert(silver: DataFrame, batch: DataFrame, key: str, hash_col: str = "record_hash") -> DataFrame:
    return key_states(silver, batch, key, hash_col).where("state != 'same'").select(key).distinct()


def key_states_by_day(snapshots: DataFrame, key: str, day_col: str = "ingest_date",
                      hash_col: str = "record_hash") -> DataFrame:
    """(day, key, state) of every snapshot row against the state its day's batch would meet, as ``key_states`` gives it
    day after day: ``new`` on the key's first day, ``changed`` where the hash differs from the key's previous present
    day, else ``same``. Rows without a key are left out, as the merge does. One scan over the snapshots."""
    held = snapshots.where(F.col(key).isNotNull()).select(day_col, key, hash_col)
    n = scan(segmented(held, [key], [day_col]), [key], [day_col], prev_cols=[day_col, hash_col])
    state = (F.when(F.col("_prev_" + day_col).isNull(), "new")
             .when(F.col("_prev_" + hash_col) != F.col(hash_col), "changed").otherwise("same"))
    return n.select(day_col, key, state.alias("state"))


def scd2_hash_merge_parts(current: DataFrame, batch: DataFrame, key: str, day, load_ts: Column | None = None,
                          hash_col: str = "record_hash", same_day: str = "keep",
                          known_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One day's snapshot against the current rows only: (rows closed today, new current rows).

    Stored and incoming rows meet in one full outer join on the key; each meeting has one outcome. Equal hash, or
    no incoming row: the stored row stays. Different hash: the stored row is closed (end = day - 1) and the
    incoming one opens the next version. No stored row: version 1. Incoming rows without a key are left out.
    ``known_ids``: every key ever stored (default: the current keys, which is the same set for any history built
    by these functions, since a row is only closed together with a new version). Both sides hold one row per key.
    Cost grows with current rows + batch, not with history.

    ``same_day="keep"`` (default) treats a second, different load of the day the
    current version started as a change (the old row ends the day before it
    started). ``"replace"`` overwrites that same-day version instead: the row is
    dropped and the new one keeps its version number.
    """
    if same_day not in ("keep", "replace"):
        raise ValueError("same_day must be 'keep' or 'replace'")
    day_c = F.to_date(F.lit(day)) if not isinstance(day, Column) else F.to_date(day)
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    stored = current_rows(current)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(f"`{key}`").alias("_ll_key"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))

    incoming = packed(batch.where(F.col(f"`{key}`").isNotNull()), "_ll_new").withColumn("_ll_known", F.lit(False))
    if known_ids is not None:
        ever = known_ids.select(F.col(f"`{key}`").alias("_ll_key"), F.lit(True).alias("_ll_ever")).distinct()
        incoming = (incoming.join(ever, "_ll_key", "left")
                    .withColumn("_ll_known", F.coalesce("_ll_ever", "_ll_known")).drop("_ll_ever"))
    met = packed(stored, "_ll_old").join(incoming, "_ll_key", "full_outer")

    def old(c: str) -> Column:
        return F.col(f"_ll_old.`{c}`") if c in stored.columns else F.lit(None)

    def new(c: str) -> Column:
        return F.col(f"_ll_new.`{c}`") if c in batch.columns else F.lit(None)

    has_old, has_new = F.col("_ll_old").isNotNull(), F.col("_ll_new").isNotNull()
    differs = F.coalesce(has_old & has_new & (old(hash_col) != new(hash_col)), F.lit(False))
    overwritten = differs & (old("effective_start_date") == day_c) if same_day == "replace" else F.lit(False)
    overwritten = F.coalesce(overwritten, F.lit(False))
    version = F.coalesce(old("record_version"), F.lit(0))
    outcome = (F.when(overwritten, "overwrite").when(differs, "change").when(has_old, "keep")
               .when(has_new & ~F.col("_ll_known"), "add"))
    met = met.withColumn("_ll_do", outcome)
    opens = F.col("_ll_do") != "keep"

    ends = {"effective_end_date": F.date_sub(day_c, 1), "is_current": F.lit(False), "silver_load_timestamp": load_ts}
    closed = (met.where("_ll_do = 'change'")
              .select(*[ends.get(c, old(c)).alias(c) for c in stored.columns]))
    starts = {"effective_start_date": day_c, "effective_end_date": F.lit(None).cast("date"), "is_current": F.lit(True),
              "record_version": F.when(F.col("_ll_do") == "overwrite", version).otherwise(version + 1).cast("int"),
              "silver_load_timestamp": load_ts}
    names = list(dict.fromkeys([*stored.columns, *batch.columns, *SCD2_AUDIT]))
    fresh = (met.where(F.col("_ll_do").isNotNull())
             .select(*[F.when(opens, starts.get(c, new(c))).otherwise(old(c)).alias(c) for c in names]))
    return closed, fresh


def scd2_hash_merge(silver: DataFrame, batch: DataFrame, key: str, day, load_ts: Column | None = None,
                    hash_col: str = "record_hash", same_day: str = "keep") -> DataFrame:
    """New full history after loading one day's snapshot ``batch`` (one row per key).

    Closed rows pass through without a join; only current rows meet the batch
    (see ``scd2_hash_merge_parts`` for the rules and ``same_day``). Keys stored
    in any version count as known.
    """
    hist = silver.filter(~_is_current(silver))
    closed, current = scd2_hash_merge_parts(current_rows(silver), batch, key, day, load_ts, hash_col, same_day,
                                            known_ids=silver.select(key))
    return (hist.unionByName(closed, allowMissingColumns=True)
            .unionByName(current, allowMissingColumns=True))


def scd2_hash_history(snapshots: DataFrame, key: str, day_col: str = "ingest_date",
                      hash_col: str = "record_hash", clock: Callable[[Column], Column] | None = None) -> DataFrame:
    """Closed form of applying ``scd2_hash_merge`` day by day, in order, from empty.

    A version starts on a day whose hash differs from the key's previous present
    day; it ends the day before the next version starts. ``clock(day)`` gives
    the load timestamp of a day (default: now).
    """
    clock = clock or (lambda d: F.current_timestamp())
    cols = snapshots.columns
    v = scan(segmented(snapshots, [key], [day_col]), [key], [day_col], island_of=hash_col, starts_only=True,
             differs=lambda before, now: before.isNull() | (before != now))
    nxt = F.col(f"{NEXT_START}.o0")
    return v.select(
        *[F.col(f"`{c}`") for c in cols],
        F.to_date(F.col(day_col)).alias("effective_start_date"),
        F.date_sub(nxt, 1).alias("effective_end_date"),
        nxt.isNull().alias("is_current"),
        F.col(ISLAND).cast("int").alias("record_version"),
        F.when(nxt.isNull(), clock(F.col(day_col))).otherwise(clock(nxt)).alias("silver_load_timestamp"),
    )
