"""Incremental file ingestion with Structured Streaming.

New files in a folder are new rows: ``readStream`` (file source, schema given or
discovered and evolved at start-up) -> optional transforms -> append to a
Parquet folder through the file sink, with a durable checkpoint (exactly-once:
a restart never re-reads committed files). ``availableNow`` processes what is
there, in as many micro-batches as ``max_files_per_trigger`` asks, then stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.sinks.tables import replace_partitions
from lakelayer.sources.files import RESCUED, discover_schema, evolve_schema, read_rescued, with_rescued_data

BATCH = "_ll_batch"


@dataclass(frozen=True)
class StreamRun:
    target: str
    checkpoint: str
    batches: int
    rows: int


def file_stream(spark: SparkSession, source: str, schema: T.StructType | None = None,
                schema_location: str | None = None, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, rescue_as: T.StructType | None = None) -> DataFrame:
    """Streaming DataFrame over a folder.

    ``schema_location``: the schema is the stored one grown by new columns
    (addNewColumns); ``rescue_as``: the files are read as text columns and cast
    to this schema, with what does not fit kept in ``_rescued_data``.
    """
    if schema is None:
        schema = evolve_schema(spark, source, schema_location) if schema_location else \
            discover_schema(spark, source)
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(source)
    if rescue_as is not None:
        df = with_rescued_data(df, rescue_as, RESCUED)
    return df


def run_rescued(spark: SparkSession, source: str, declared: T.StructType, target: str, checkpoint: str,
                max_files_per_trigger: int = 1000, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamRun:
    """Append new files of a folder to ``target``, whatever the physical types of their columns.

    A file stream reads all files by one schema and ends at a file whose column has another type. This one streams the
    file names; each micro-batch reads its files by their own footers (``read_rescued``) and replaces its own
    partition of the target, so a batch that runs again adds nothing. Read the target with ``read_rescued_table``.
    """
    names = (spark.readStream.schema("path string, modificationTime timestamp, length long, content binary")
             .format("binaryFile").option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", str(max_files_per_trigger)))
    rows: dict[int, int] = {}

    def each(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").collect())          # bounded by max_files_per_trigger
        out = read_rescued(spark, paths, declared)
        out = (transform(out) if transform is not None else out).withColumn(BATCH, F.lit(batch_id))
        seen = Observation()
        replace_partitions(out.observe(seen, F.count(F.lit(1)).alias("rows")), target, [BATCH])
        rows[batch_id] = int(seen.get.get("rows") or 0)

    q = (names.load(source).select("path").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return StreamRun(target, checkpoint, len(rows), sum(rows.values()))


def read_rescued_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(BATCH)


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """Streaming read of a catalog table (new files of the table are new rows)."""
    return spark.readStream.table(name)


def run_to_parquet(df: DataFrame, target: str, checkpoint: str, full_reload: bool = False,
                   partition_cols=()) -> StreamRun:
    """Append a streaming DataFrame to ``target`` until the available input is done.

    ``full_reload`` starts from scratch: a new checkpoint and a new output
    folder (never deletes the old ones), so readers of the old output are safe.
    """
    if full_reload:
        tag = uuid.uuid4().hex[:12]
        target, checkpoint = f"{target.rstrip('/')}/reload-{tag}", f"{checkpoint.rstrip('/')}/reload-{tag}"
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    q = w.start(target)
    rows: dict[int, int] = {}              # by batch: the query itself remembers only its last reports
    ended = False
    while not ended:
        ended = q.awaitTermination(0.2)
        rows |= {p["batchId"]: int(p["numInputRows"]) for p in q.recentProgress if p["numInputRows"]}
    return StreamRun(target, checkpoint, len(rows), sum(rows.values()))


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str,
           transform: Callable[[DataFrame], DataFrame] | None = None, **stream_opts) -> StreamRun:
    """Bronze folder -> (transform) -> silver append table, run once."""
    df = file_stream(spark, source, **stream_opts)
    if transform is not None:
        df = transform(df)
    return run_to_parquet(df, target, checkpoint)


def preview(df: DataFrame, n: int = 20, name: str | None = None) -> DataFrame:
    """First rows of a batch or streaming DataFrame (the stream through a memory sink)."""
    if not df.isStreaming:
        return df.limit(n)
    name = name or f"preview_{uuid.uuid4().hex[:8]}"
    q = df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).limit(n)
