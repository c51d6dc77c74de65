"""Session settings and shared scratch space.

Everything here uses only public SparkSession / SparkConf APIs. Scratch data goes
under the folder named by ``spark.checkpoint.dir`` (a shared file system on a
cluster); a local folder is created only when the session names none (tests).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on. All are session-scoped and safe to
# set on an existing session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # state of streams on disk, not on the heap: it may outgrow an executor's memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# For jobs that write several layers one after another: a query's shuffle files go when it ends, not when the driver next
# collects its garbage, and tables are stored smaller.
LEAN_DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str = "local[*]", app: str = "lakelayer", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark: UI off, UTC, AQE on."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SQL_SETTINGS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-scoped settings to a session built elsewhere."""
    for k, v in SQL_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """The settings of ``LEAN_DISK`` for the queries that run inside; the session's own ones are put back."""
    before = {k: spark.conf.get(k, None) for k in LEAN_DISK}
    for k, v in LEAN_DISK.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the context).
    A session on a local master may name none (tests): a local folder is created
    and set. On a cluster that would be each machine's own disk, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakelayer-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def missing_path(error: AnalysisException) -> bool:
    """Whether a read failed only because nothing is stored there yet; other failures must not pass for "empty"."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/lakelayer/{label}-{uuid.uuid4().hex}"


def run_concurrently(tasks: Iterable[Callable[[], object]], max_workers: int = 4) -> list:
    """Submit independent Spark actions from a few driver threads.

    Spark runs jobs from different threads at the same time on the same
    executors, so small independent jobs (one per resource, per table) overlap
    instead of queueing. Results come back in task order; the first error is
    raised.
    """
    tasks = list(tasks)
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]
