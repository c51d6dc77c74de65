"""Parquet table writes: partition replace, append, DDL, generations, raw pages.

No table is ever overwritten while it is being read: stateful targets (SCD
history, streaming CDC targets) are written as a new generation folder and
become visible through a small commit log written after the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakelayer.session import missing_path


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], gather: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite).

    An empty ``df`` leaves every existing partition in place. Rows are gathered by partition first, so a partition
    gets a few files and not one per task; AQE cuts a large partition into several tasks. ``gather=False`` is for rows
    that a shuffle has just dealt out into few tasks: a file per task and partition, and no row is moved again.
    """
    df = df.hint("rebalance", *partition_cols) if gather else df
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def read_slice(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """One partition of a partitioned table; the filter prunes folders at planning time."""
    return spark.read.option("mergeSchema", "true").parquet(path).filter(F.col(column) == F.lit(value))


def ensure_table(spark: SparkSession, name: str, ddl: str, location: str,
                 partition_cols: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` (schema first when needed)."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part} LOCATION '{location}'")


def shared(df: DataFrame, key: str, n: int) -> list[DataFrame]:
    """``df`` in ``n`` parts of about as many keys each; a key's rows, also those of the NULL key, are in one part."""
    if n <= 1:
        return [df]
    part = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(n))
    return [df.where(part == i) for i in range(n)]


# ── generations ──────────────────────────────────────────────────────────────

def generation_path(root: str, gen: int) -> str:
    return f"{root.rstrip('/')}/data/gen={gen:020d}"


def commit_path(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def latest_generation(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """Newest committed generation number (optionally older than ``before``)."""
    try:
        log = spark.read.schema("gen long, rows long").json(commit_path(root))
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return None
    if before is not None:
        log = log.filter(F.col("gen") < before)
    row = log.agg(F.max("gen").alias("g")).first()
    return None if row is None or row["g"] is None else int(row["g"])


def write_generation(spark: SparkSession, df: DataFrame | Sequence[DataFrame], root: str, gen: int,
                     partition_cols: Sequence[str] = (), tag: str | None = None,
                     days: dict[str, str] | None = None, before_commit: Callable[[], None] | None = None) -> str:
    """Write ``df`` as generation ``gen`` then commit it (with an optional ``tag``, e.g.
    the day it loaded, and marks of the input days it holds). Re-running the same ``gen`` is idempotent.
    Several frames are written one after another, as parts of one generation.
    ``before_commit`` is called when the rows are written and not yet committed."""
    path, rows = generation_path(root, gen), 0
    for i, part in enumerate([df] if isinstance(df, DataFrame) else df):
        obs = Observation(f"gen_{gen}_{uuid.uuid4().hex[:8]}")
        w = part.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append" if i else "overwrite")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        w.parquet(path)
        rows += int(obs.get.get("rows", 0) or 0)
    if before_commit is not None:
        before_commit()
    (spark.createDataFrame([(gen, rows, tag, days or {})], "gen long, rows long, tag string, days map<string,string>")
     .coalesce(1)
     .write.mode("overwrite").json(f"{commit_path(root)}/gen={gen:020d}"))
    return path


def generation_tag(spark: SparkSession, root: str) -> str | None:
    """Tag of the newest committed generation (None if none or untagged)."""
    try:
        log = spark.read.schema("gen long, rows long, tag string").json(commit_path(root))
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return None
    row = log.orderBy(F.col("gen").desc()).select("tag").first()
    return None if row is None else row["tag"]


def generation_days(spark: SparkSession, root: str) -> dict[str, str]:
    """Newest committed mark of every input day (one small entry per day)."""
    try:
        log = spark.read.schema("gen long, days map<string,string>").json(commit_path(root))
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return {}
    marks = log.select("gen", F.explode("days").alias("day", "mark")).groupBy("day").agg(F.max_by("mark", "gen").alias("mark"))
    return {r["day"]: r["mark"] for r in marks.collect()}


def read_generation(spark: SparkSession, root: str, gen: int | None = None, schema=None) -> DataFrame | None:
    """A committed generation (the newest by default); None when nothing is committed."""
    g = latest_generation(spark, root) if gen is None else gen
    if g is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(generation_path(root, g))


# ── SCD2 history store: append-only closed rows + generations of current rows ─

@dataclass(frozen=True)
class HistoryStore:
    """A type-2 history kept as two parts so a day's load never rewrites history.

    ``history/closed_on=<day>``: rows closed by that day's load (replaced as a
    whole partition, so re-running a day is idempotent); ``current/``: one
    generation per load holding the open version of every key.
    """
    root: str

    @property
    def current(self) -> str:
        return f"{self.root.rstrip('/')}/current"

    @property
    def history(self) -> str:
        return f"{self.root.rstrip('/')}/history"


def store_generation(spark: SparkSession, store: HistoryStore) -> int | None:
    return latest_generation(spark, store.current)


def store_current(spark: SparkSession, store: HistoryStore, gen: int | None = None) -> DataFrame | None:
    """Current rows: the newest committed generation, or generation ``gen`` when the
    caller just committed it (saves the commit-log lookup)."""
    return read_generation(spark, store.current, gen)


def store_table(spark: SparkSession, store: HistoryStore) -> DataFrame | None:
    """The whole history: closed rows and the current rows."""
    cur = store_current(spark, store)
    if cur is None:
        return None
    try:
        hist = spark.read.option("mergeSchema", "true").parquet(store.history)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return cur
    # rows of a load that never committed its current part do not count
    hist = hist.where(F.col("load_gen") <= store_generation(spark, store)).drop("closed_on", "load_gen")
    return hist.unionByName(cur, allowMissingColumns=True)


def store_write(spark: SparkSession, store: HistoryStore, closed: DataFrame, current: DataFrame, gen: int,
                loaded_through: str | None = None, days: dict[str, str] | None = None) -> None:
    """Append the closed rows (by the day that closed them and this load, so a second load of a day adds to
    the first and a retry replaces only its own rows), then commit the new current
    generation, recording the last day it includes (``loaded_through``) and the marks of its days."""
    _write_closed(store, closed, gen)
    write_generation(spark, current, store.current, gen, tag=loaded_through, days=days)


def _write_closed(store: HistoryStore, closed: DataFrame, gen: int) -> None:
    replace_partitions(closed.withColumns({"closed_on": F.date_add("effective_end_date", 1), "load_gen": F.lit(gen)}),
                       store.history, ["closed_on", "load_gen"])


def store_first(spark: SparkSession, store: HistoryStore, hists: Sequence[DataFrame], loaded_through: str | None = None,
                days: dict[str, str] | None = None) -> None:
    """Generation 0 of a store from a whole history, as ``store_write`` gives it; ``hists`` are the histories of shares of
    its keys. They are not held for their two parts: a plan runs for the current rows, and once more for the closed
    ones if that run met any."""
    told = [Observation(f"first_{uuid.uuid4().hex[:8]}") for _ in hists]
    current = [h.observe(o, F.count_if(~F.col("is_current")).alias("closed")).filter(F.col("is_current"))
               for h, o in zip(hists, told)]

    def closed() -> None:
        some = [h.filter(~F.col("is_current")) for h, o in zip(hists, told) if o.get.get("closed")]
        if some:
            _write_closed(store, reduce(DataFrame.unionByName, some), 0)

    write_generation(spark, current, store.current, 0, tag=loaded_through, days=days, before_commit=closed)


def store_loaded_through(spark: SparkSession, store: HistoryStore) -> str | None:
    """Last day committed to the store."""
    return generation_tag(spark, store.current)


def store_days(spark: SparkSession, store: HistoryStore) -> dict[str, str]:
    """Marks of the days the store holds."""
    return generation_days(spark, store.current)


# ── raw pages ────────────────────────────────────────────────────────────────

def write_raw_pages(pages: DataFrame, root: str, compression: str = "none", gather: bool = True, add: bool = False) -> None:
    """Bundle JSON text, one document per line, under ``resource_name=<R>/date=<D>``.

    ``pages`` has columns (resource, date, body); folders are
    ``resource_name=<R>/date=<D>``; ``compression="gzip"`` shrinks the landing zone
    about 3x for some CPU (the JSON reader decompresses transparently). Only the
    folders present are replaced, so reloading a day is idempotent. Pages are gathered by folder first, so a folder
    gets a few files and not one per task; AQE cuts a large folder into several tasks. ``gather=False`` is for pages
    whose tasks each hold a good part of one folder: a file per task, and no page is moved. ``add=True`` leaves what
    the folders hold and adds to it.
    """
    # JSON strings hold no raw line breaks, so a page of any layout fits one line unchanged in meaning
    replace = pages.select(F.regexp_replace("body", "[\\r\\n]+", " ").alias("value"), F.col("resource").alias("resource_name"),
                           F.col("date").cast("string").alias("date"))
    replace = replace.hint("rebalance", "resource_name", "date") if gather else replace
    (replace.write.mode("append" if add else "overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy("resource_name", "date").text(root))
