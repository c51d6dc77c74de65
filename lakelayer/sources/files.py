"""File sources: fixtures, evolving Parquet schemas and rescued data."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.session import run_concurrently
from lakelayer.sinks.schemas import grow_schema

RESCUED = "_rescued_data"


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """``.json``: one array of flat objects; ``.csv``: header row, every column a string."""
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported fixture format: {path}")


# ── schema discovery and evolution (addNewColumns) ───────────────────────────

def discover_schema(spark: SparkSession, path: str) -> T.StructType:
    """Union of the schemas of all Parquet files under ``path`` (footers only)."""
    return spark.read.option("mergeSchema", True).parquet(path).schema


def evolve_schema(spark: SparkSession, path: str, location: str) -> T.StructType:
    """Schema for the next stream run: the schema kept at ``location``, grown by newly seen columns."""
    return grow_schema(spark, location, discover_schema(spark, path))


# ── rescued data ─────────────────────────────────────────────────────────────

def with_rescued_data(raw: DataFrame, declared: T.StructType, column: str = RESCUED) -> DataFrame:
    """Cast raw columns to the declared types; keep what does not fit in ``column``.

    ``column`` is a JSON object of {name: original text} for every value that was
    present but could not be cast, plus every column that is not declared; NULL
    when nothing was rescued.
    """
    declared_names = {f.name.lower() for f in declared.fields}
    have = {c.lower(): c for c in raw.columns}
    out, rescued = [], []
    for f in declared.fields:
        if f.name.lower() in have:
            src = F.col(f"`{have[f.name.lower()]}`")
            # another type goes by its text, so 1.5 does not silently become 1
            same = raw.schema[have[f.name.lower()]].dataType == f.dataType
            cast = src if same else src.cast("string").try_cast(f.dataType)
            rescued.append(F.when(src.isNotNull() & cast.isNull(), src.cast("string")).alias(f.name))
            out.append(cast.alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    for c in raw.columns:
        if c.lower() not in declared_names:
            rescued.append(F.col(f"`{c}`").cast("string").alias(c))
    js = F.to_json(F.struct(*rescued)) if rescued else F.lit(None).cast("string")
    return raw.select(*out, F.nullif(js, F.lit("{}")).alias(column))


def file_groups(spark: SparkSession, paths: Sequence[str], max_workers: int = 16) -> list[tuple[T.StructType, list[str]]]:
    """Parquet files by the schema in their footers. Footers are read one by one from a few driver threads; the
    caller bounds the number of files (a micro-batch)."""
    groups: dict[str, list[str]] = {}
    seen = run_concurrently([lambda p=p: spark.read.parquet(p).schema for p in paths], max_workers)
    for path, schema in zip(paths, seen):
        groups.setdefault(schema.json(), []).append(path)
    return [(T.StructType.fromJson(json.loads(k)), v) for k, v in sorted(groups.items())]


def read_rescued(spark: SparkSession, paths: Sequence[str], declared: T.StructType, column: str = RESCUED) -> DataFrame:
    """Files whose columns may differ in name and physical type: one scan for each footer schema, cast to ``declared``
    with what does not fit kept in ``column``, united."""
    parts = [with_rescued_data(spark.read.schema(schema).parquet(*mine), declared, column)
             for schema, mine in file_groups(spark, paths)]
    if not parts:
        return spark.createDataFrame([], T.StructType([*declared.fields, T.StructField(column, T.StringType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
