"""Streaming change application (SCD type 1 / type 2) with ``foreachBatch``, by key.

A target is a set of runs. A batch is merged with what is stored for its keys only, and what that changes is written as one
new run; no stored file is rewritten for it. Type 1 stores the latest change per key. Type 2 stores change points,
one row per (key, sequence) with the sequence of the key's next point (``_ll_next``): a late change splits the version
it falls into, so its own point and the point before it are written anew. Of equal points the newest run counts. Changes
that delete are stored like others and left out when the table is read, so older changes that come later still
find their place.

Per micro-batch:
1. the batch's rows are dealt out, its points (equal ones collapsed) are kept, and its keys looked up in the stored runs:
   only the bucket folders of its keys are read, and only files and pages that can hold them when they are few (pushed
   filters);
2. stored and new points of these keys are moved and sorted once, equal ones of several runs collapsed on the way, and
   scanned in order, in segments, so one key may hold any share of the rows;
3. new points and the points before them are written as a run, and one record makes the run visible;
4. runs are merged geometrically: when the newest few (``FAN``) each have, with those behind them, at least half the rows
   of the one before, they become one. So there are about log2(rows) runs and a row is rewritten at most about as often.

A batch is recorded under its source (the stream's checkpoint) and number: a batch that is applied again after
its record is left out, one that failed before its record is computed again from the same runs. Stored runs are never
changed, so readers see whole batches only; folders of merged runs stay until ``drop_merged``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.operators.dedup import latest_per_key
from lakelayer.operators.ordered import SEGMENT, scan, segmented
from lakelayer.operators.scd import END_AT, START_AT, scd2_apply
from lakelayer.session import missing_path
from lakelayer.sinks.schemas import conform, grow_schema, stored_schema

BUCKET, NEXT, BATCH, TOUCHED, SPREAD = "_ll_bucket", "_ll_next", "_ll_batch", "_ll_touched", "_ll_spread"
RUN = "number long, first long, last long, rows long, source string, batch long, read long, path string"
RUN_FIELDS = [f.split()[0] for f in RUN.split(", ")]
FAN = 4                    # so many runs are merged at once, or more
FEW_KEYS = 1000            # up to so many keys of a batch are pushed into the scan as values


@dataclass(frozen=True)
class CdcTarget:
    root: str                     # target folder: runs/, log/, schema/, meta/
    keys: tuple[str, ...]
    sequence_by: str | tuple[str, ...]
    scd_type: int = 1
    track_except: tuple[str, ...] | None = None
    delete_when: str | None = None
    buckets: int | None = None    # default: spark.sql.shuffle.partitions at creation; fixed afterwards

    def path(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    @property
    def sequence(self) -> list[str]:
        return [self.sequence_by] if isinstance(self.sequence_by, str) else list(self.sequence_by)

    @property
    def identity(self) -> list[str]:
        """What one stored row stands for: a key (type 1) or a point of a key (type 2)."""
        return [*self.keys, *(self.sequence if self.scd_type == 2 else [])]


def suggest_buckets(expected_rows: int, rows_per_bucket: int = 2_000_000) -> int:
    """Bucket count for a target expected to hold ``expected_rows`` rows."""
    return max(1, -(-int(expected_rows) // rows_per_bucket))


def _json(spark: SparkSession, schema: str, path: str) -> list:
    try:
        return spark.read.schema(schema).json(path).collect()
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return []


def bucket_count(spark: SparkSession, t: CdcTarget) -> int:
    """The target's bucket count: stored with the target when it is created and
    read back afterwards, because changing it would move keys between buckets.
    Size it so one bucket holds roughly 0.5-1 GB of the target."""
    rows = _json(spark, "buckets int", t.path("meta"))
    if rows:
        return int(rows[0]["buckets"])
    if runs(spark, t):
        raise ValueError(f"{t.root} holds data but no bucket count; a new count would move keys between buckets")
    n = int(t.buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([(n,)], "buckets int").coalesce(1).write.mode("append").json(t.path("meta"))
    return n


def _log(spark: SparkSession, t: CdcTarget) -> list:
    """Every run ever recorded, in order."""
    return sorted(_json(spark, RUN, t.path("log")), key=lambda r: r["number"])


def runs(spark: SparkSession, t: CdcTarget, log: list | None = None) -> list:
    """The runs that make up the table: those not merged into a wider one."""
    log = _log(spark, t) if log is None else log
    live = [r for r in log if not any(o["first"] <= r["first"] and r["last"] <= o["last"] and o["number"] > r["number"]
                                      for o in log)]
    return sorted(live, key=lambda r: r["first"])


def _record(spark: SparkSession, t: CdcTarget, log: list, **run) -> list:
    """Append a record; returns the log with it."""
    row = Row(*RUN_FIELDS)(*[run.get(n) for n in RUN_FIELDS])
    values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, T.StructType.fromDDL(RUN))]
    spark.range(1).coalesce(1).select(*values).write.mode("append").json(t.path("log"))
    return [*log, row]


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly over the tasks: a micro-batch may be one file that one task reads, and its rows are still to
    be sorted."""
    return df.withColumn(SPREAD, F.monotonically_increasing_id()).repartition(SPREAD).drop(SPREAD)


def _bucket(t: CdcTarget, n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in t.keys]), F.lit(n)).cast("int")


def _stored(spark: SparkSession, t: CdcTarget, live: list, columns: T.StructType) -> DataFrame | None:
    """Rows of these runs, each with the number of the run that wrote it."""
    if not live:
        return None
    fields = list(columns.fields) + [T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
    if t.scd_type == 2:
        fields.insert(-2, T.StructField(NEXT, columns[t.sequence[0]].dataType))
    parts = [spark.read.schema(T.StructType(fields)).parquet(r["path"]) for r in live]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _newest(t: CdcTarget, stored: DataFrame, per: list[str] | None = None) -> DataFrame:
    """One row per identity: the one that the newest run wrote. Rows are moved before they are sorted, once, as few are
    dropped; ``per``: names to group by instead, of rows that lie together already."""
    names = per or t.identity
    ids = [F.col(f"`{c}`") for c in names]
    rest = [c for c in stored.columns if c not in names]
    best = (stored if per else stored.repartition(*ids)).groupBy(*ids).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), BATCH).alias("_ll_row"))
    return best.select(*ids, *[F.col(f"_ll_row.`{c}`").alias(c) for c in rest])


def _write(df: DataFrame, path: str, t: CdcTarget) -> int:
    """Rows of a bucket go to one writer, sorted by key so that files and pages hold key ranges; AQE's rebalance cuts a
    bucket that a hot key fills into several tasks."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", BUCKET)
     .sortWithinPartitions(BUCKET, *[F.col(f"`{k}`") for k in t.keys])
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path))
    return int(seen.get.get("rows") or 0)


def apply_batch(spark: SparkSession, t: CdcTarget, batch: DataFrame, batch_id: int, source: str = "") -> dict | None:
    """Apply one micro-batch (also usable directly for batch loads). Returns the number of its ``keys`` (if few), of
    stored rows ``read`` and of rows ``written``; None for a batch already applied or without a row."""
    log = _log(spark, t)
    if last_batch(spark, t, source, log) >= batch_id:
        return None
    n = bucket_count(spark, t)
    valid = F.lit(True)
    for c in [*t.keys, *t.sequence]:
        valid = valid & F.col(f"`{c}`").isNotNull()
    changes = spread(batch.where(valid))
    points = latest_per_key(changes, t.identity, [] if t.scd_type == 2 else t.sequence).withColumn(BUCKET, _bucket(t, n)).persist()
    held = None
    try:
        keys = points.select(*[F.col(f"`{k}`") for k in t.keys], BUCKET).distinct()
        few = keys.limit(FEW_KEYS + 1).collect()
        if not few:
            return None
        known = len(few) <= FEW_KEYS
        touched = {r[BUCKET] for r in (few if known else keys.select(BUCKET).distinct().collect())}   # at most all buckets
        columns = grow_schema(spark, t.path("schema"), batch.schema)
        number = max((r["number"] for r in log), default=0) + 1
        new = conform(points, columns)
        live, seen = runs(spark, t, log), Observation()
        stored, read = _stored(spark, t, live, columns), 0
        if stored is not None:
            mine = stored.where(F.col(BUCKET).isin(sorted(touched)))
            if known:
                for k in t.keys:
                    mine = mine.where(F.col(f"`{k}`").isin(list({r[k] for r in few})))
            mine = mine.observe(seen, F.count(F.lit(1)).alias("read"))
            held = mine.join(keys.drop(BUCKET), list(t.keys), "left_semi").drop(BUCKET, NEXT).persist()
            held.count()
            read = int(seen.get.get("read") or 0)
        path = t.path(f"runs/{number:012d}")
        rows = _write(_merged(t, new, held, number, columns).withColumns({BATCH: F.lit(number).cast("long"), BUCKET: _bucket(t, n)}), path, t)
        log = _record(spark, t, log, number=number, first=number, last=number, rows=rows, source=source, batch=batch_id,
                      read=read, path=path)
        merge_runs(spark, t, log, columns)
        return {"keys": len(few) if known else None, "read": read, "written": rows}
    finally:
        points.unpersist()
        if held is not None:
            held.unpersist()


def last_batch(spark: SparkSession, t: CdcTarget, source: str = "", log: list | None = None) -> int:
    """The newest recorded batch of a source; -1 before the first."""
    log = _log(spark, t) if log is None else log
    return max((r["batch"] for r in log if r["source"] == source and r["batch"] is not None), default=-1)


def _merged(t: CdcTarget, new: DataFrame, held: DataFrame | None, number: int, columns: T.StructType) -> DataFrame:
    """Rows to store: of type 1 the latest change per key; of type 2 the touched points and the points before them.
    ``held``: stored rows of the batch's keys, as the runs hold them."""
    if t.scd_type == 1:
        both = new if held is None else new.unionByName(_newest(t, held).select(*new.columns))
        return latest_per_key(both, list(t.keys), t.sequence)
    seq = t.sequence[0]
    both = new.withColumns({BATCH: F.lit(number).cast("long"), TOUCHED: F.lit(True)})
    if held is not None:
        both = both.unionByName(held.withColumn(TOUCHED, F.lit(False)).select(*both.columns))
    cut = segmented(both, t.keys, [seq]).repartition(*[F.col(f"`{k}`") for k in t.keys], SEGMENT)
    # the rows of a segment lie together now: one sort serves the three steps that follow
    at = [*t.keys, SEGMENT, seq]
    cut = _newest(t, cut, [*at, TOUCHED]).drop(BATCH)
    # of equal points the greatest row wins, whichever batch brought it; a touched one stays touched
    one = latest_per_key(cut, at, [], also={TOUCHED: F.max(TOUCHED)})
    after = scan(one, t.keys, [seq], next_cols=[seq, TOUCHED])
    return (after.where(F.col(TOUCHED) | F.coalesce(F.col(f"_next_{TOUCHED}"), F.lit(False)))
            .select(*[F.col(f"`{c}`") for c in columns.names], F.col(f"`_next_{seq}`").alias(NEXT)))


def merge_runs(spark: SparkSession, t: CdcTarget, log: list | None = None, columns: T.StructType | None = None) -> int:
    """Merge the newest runs, each with at least half the rows of the run before it, once there are ``FAN`` of them;
    returns the live runs left."""
    log = _log(spark, t) if log is None else log
    columns = stored_schema(spark, t.path("schema")) if columns is None else columns
    live = runs(spark, t, log)
    n = len(live)
    while n > 1 and 2 * sum(r["rows"] for r in live[n - 1:]) >= live[n - 2]["rows"]:
        n -= 1
    tail = live[n - 1:]
    if len(tail) < FAN:
        return len(live)
    number = max(r["number"] for r in log) + 1
    path = t.path(f"runs/{number:012d}")
    rows = _write(_newest(t, _stored(spark, t, tail, columns)), path, t)
    _record(spark, t, log, number=number, first=tail[0]["first"], last=tail[-1]["last"], rows=rows, path=path)
    return n


def drop_merged(spark: SparkSession, t: CdcTarget) -> int:
    """Delete the folders of runs that were merged into others (readers that started before may need them)."""
    live = {r["path"] for r in runs(spark, t)}
    gone = 0
    for r in _log(spark, t):
        if r["path"] not in live:
            path = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
            gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def run_cdc_stream(stream: DataFrame, t: CdcTarget, checkpoint: str) -> int:
    """Run the flow until the available input is consumed; returns the batch count."""
    spark = stream.sparkSession
    seen = []

    def each(batch: DataFrame, batch_id: int) -> None:
        apply_batch(spark, t, batch, batch_id, source=checkpoint)
        seen.append(batch_id)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(seen)


def read_target(spark: SparkSession, t: CdcTarget) -> DataFrame | None:
    """The current target table (None before the first batch). A single run is read as it is; several are merged by key."""
    live = runs(spark, t)
    columns = stored_schema(spark, t.path("schema"))
    stored = _stored(spark, t, live, columns) if live else None
    if stored is None:
        return None
    rows = (stored if len(live) == 1 else _newest(t, stored)).drop(BATCH, BUCKET)
    if t.scd_type == 2 and t.track_except is not None:
        return scd2_apply(rows.drop(NEXT), list(t.keys), t.sequence[0], track_except=t.track_except, delete_when=t.delete_when)
    if t.delete_when:
        rows = rows.where(~F.coalesce(F.expr(t.delete_when), F.lit(False)))
    rows = rows.select(*[F.col(f"`{c}`") for c in columns.names], *([NEXT] if t.scd_type == 2 else []))
    if t.scd_type == 2:
        rows = rows.withColumn(START_AT, F.col(f"`{t.sequence[0]}`")).withColumnRenamed(NEXT, END_AT)
        rows = rows.select(*columns.names, START_AT, END_AT)
    return rows
