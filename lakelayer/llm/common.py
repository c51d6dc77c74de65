"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakelayer.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back: a lineage cut that outlives executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def col(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col(f"`{name}`")


def small_batches(spark: SparkSession, rows: int = 2500, size: str = "32m") -> None:
    """Hand Arrow batches of at most ``rows`` rows, and of about ``size`` bytes unless one text is longer, to Python: that
    bounds what a worker and its executor hold at once, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
