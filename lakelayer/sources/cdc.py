"""Incremental extraction with a stored high-water mark (watermark) per table.

One run per table: read the stored watermark (or the backfill override), read
rows with ``cdc_col > watermark`` (the filter reaches the Parquet/JDBC scan),
write them as one run-stamped Parquet folder, and take the row count and the
new watermark from that same write through ``observe`` — no second pass. The
watermark advances only when rows were read. Every run returns an audit row.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakelayer.session import missing_path
from lakelayer.sinks.schemas import conform, grow_schema, stored_schema

AUDIT_SCHEMA = ("run_id string, table_name string, rows long, old_watermark string, "
                "new_watermark string, status string, error string, output_path string, run_ts string")


@dataclass(frozen=True)
class CdcSource:
    """One source table: how to read it and which column orders its changes."""
    table: str
    cdc_col: str
    read: Callable[[SparkSession], DataFrame]
    schema: str = "dbo"
    from_date: str = ""          # non-empty: replaces the stored watermark for this run
    inclusive_key: tuple[str, ...] = ()   # non-empty: read >= watermark, skip keys already loaded


def parquet_table(path: str) -> Callable[[SparkSession], DataFrame]:
    return lambda spark: spark.read.parquet(path)


def jdbc_table(url: str, table: str | None = None, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, query_timeout_s: int = 7200,
               query: str | None = None) -> Callable[[SparkSession], DataFrame]:
    """JDBC reader; with a partition column the read is split into parallel range queries.

    ``query`` runs a statement in the database instead of reading a table (e.g. the
    global ``MAX(cdc_col)``, which the JDBC source does not push down itself).
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")

    def read(spark: SparkSession) -> DataFrame:
        r = (spark.read.format("jdbc").option("url", url)
             .option("dbtable" if table is not None else "query", table if table is not None else query)
             .option("queryTimeout", str(query_timeout_s)))
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        if partition_column:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
                 .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
        return r.load()
    return read


# ── watermark store ──────────────────────────────────────────────────────────

def watermark_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}_cdc"


def read_watermark(spark: SparkSession, root: str, table: str) -> str | None:
    """Stored watermark text, or None when none was ever written (= full load)."""
    try:
        log = spark.read.schema("cdc string, n long").json(watermark_path(root, table))
        row = log.orderBy(F.col("n").desc_nulls_last()).first()
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return None
    return None if row is None else row["cdc"]


def write_watermark(spark: SparkSession, root: str, table: str, value: str) -> None:
    """Append the next numbered record; the newest counts, so a crash while writing loses nothing."""
    path = watermark_path(root, table)
    try:
        last = spark.read.schema("cdc string, n long").json(path).agg(F.max("n")).first()[0] or 0
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        last = 0
    spark.createDataFrame([(value, last + 1)], "cdc string, n long").coalesce(1).write.mode("append").json(path)


def effective_watermark(stored: str | None, from_date: str | None) -> str | None:
    """A non-empty backfill date replaces the stored watermark."""
    return from_date if from_date else stored


# ── extract ──────────────────────────────────────────────────────────────────

def extract(df: DataFrame, cdc_col: str, watermark: str | None, inclusive: bool = False,
            key: list[str] | None = None, loaded: DataFrame | None = None) -> DataFrame:
    """Rows after the watermark (all rows when there is none).

    Default is strict ``>``: rows that arrive later with the boundary value are
    never read. ``inclusive=True`` reads ``>=`` and drops the boundary rows whose
    ``key`` is already in ``loaded`` (the rows copied before), so late rows with
    the boundary value are picked up without duplicates. The literal is cast to
    the column's type so the comparison is typed and pushed into the scan.
    """
    if watermark is None:
        return df
    t = df.schema[cdc_col].dataType
    wm = F.lit(watermark).cast(t)
    if not inclusive:
        return df.filter(F.col(cdc_col) > wm)
    if not key or loaded is None:
        raise ValueError("inclusive extraction needs the key columns and the loaded rows")
    seen = loaded.filter(F.col(cdc_col) == wm).select(*key)
    return df.filter(F.col(cdc_col) >= wm).join(seen, key, "left_anti")


def max_watermark(df: DataFrame, cdc_col: str) -> DataFrame:
    """Global high-water mark and row count: (rows, new_watermark) as text."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(cdc_col).cast("string").alias("new_watermark"))


def run_stamp(now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y-%m-%dT%H%M%S%fZ")


def output_path(root: str, table: str, stamp: str) -> str:
    return f"{root.rstrip('/')}/bronze/{table}/{table}_{stamp}"


def run_table(spark: SparkSession, src: CdcSource, root: str, stamp: str, run_id: str) -> dict:
    stored = read_watermark(spark, root, src.table)
    wm = effective_watermark(stored, src.from_date)
    out = output_path(root, src.table, stamp)
    try:
        if src.inclusive_key and wm is not None:
            batch = extract(src.read(spark), src.cdc_col, wm, inclusive=True, key=list(src.inclusive_key),
                            loaded=read_bronze(spark, root, src.table))
        else:
            batch = extract(src.read(spark), src.cdc_col, wm)
        if batch.isEmpty():                     # nothing is written, so no empty folder stays behind
            return dict(run_id=run_id, table_name=src.table, rows=0, old_watermark=wm, new_watermark=wm,
                        status="empty", error=None, output_path=None, run_ts=stamp)
        batch = conform(batch, grow_schema(spark, schema_location(root, src.table), batch.schema))
        obs = Observation(f"cdc_{src.table}_{uuid.uuid4().hex[:8]}")
        observed = batch.observe(obs, F.count(F.lit(1)).alias("rows"),
                                 F.max(src.cdc_col).cast("string").alias("wm"))
        observed.write.mode("overwrite").option("compression", "snappy").parquet(out)
        m = obs.get
        rows, new_wm = int(m.get("rows", 0) or 0), m.get("wm")
        if rows > 0 and new_wm is not None:
            write_watermark(spark, root, src.table, new_wm)
            status = "succeeded"
        else:
            new_wm, status = wm, "empty"
        return dict(run_id=run_id, table_name=src.table, rows=rows, old_watermark=wm, new_watermark=new_wm,
                    status=status, error=None, output_path=out if rows else None, run_ts=stamp)
    except Exception as exc:  # one table failing does not stop the others
        return dict(run_id=run_id, table_name=src.table, rows=0, old_watermark=wm, new_watermark=wm,
                    status="failed", error=str(exc), output_path=None, run_ts=stamp)


def run_incremental(spark: SparkSession, sources: Sequence[CdcSource], root: str,
                    stamp: str | None = None, run_id: str | None = None,
                    audit_path: str | None = None, parallel: int = 1) -> DataFrame:
    """Run every source; returns (and optionally appends) the audit rows.

    Tables are independent: with ``parallel > 1`` their jobs are submitted from
    that many driver threads and run side by side; a failing table still only
    marks its own audit row.
    """
    from lakelayer.session import run_concurrently
    stamp = stamp or run_stamp()
    run_id = run_id or str(uuid.uuid4())
    rows = run_concurrently([lambda s=s: run_table(spark, s, root, stamp, run_id) for s in sources],
                            max_workers=max(1, parallel)) if parallel > 1 else \
        [run_table(spark, s, root, stamp, run_id) for s in sources]
    audit = spark.createDataFrame([tuple(r[k] for k in (
        "run_id", "table_name", "rows", "old_watermark", "new_watermark", "status", "error",
        "output_path", "run_ts")) for r in rows], AUDIT_SCHEMA)
    if audit_path:
        audit.write.mode("append").parquet(audit_path)
    return audit


def schema_location(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/schema/{table}"


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All run folders of one table (one Parquet scan over the table folder), with every column that any run brought:
    the schema is the one kept beside the table, footers are read only for a table older than its schema record."""
    schema = stored_schema(spark, schema_location(root, table))
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/bronze/{table}")
