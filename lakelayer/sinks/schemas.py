"""The schema of a stored table, kept beside it: numbered records that are only ever appended.

A table's files may differ in columns, because columns come up over time. Reading one footer would miss columns, reading
all of them grows with the table; the record is small and tells every reader the same. Columns keep their place and type;
new ones go to the end. A crash while a record is written loses no earlier one.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.session import missing_path

RECORD = "n long, schema string"


def union_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Old columns keep their position and type; columns seen for the first time are appended. All become nullable."""
    fields = list(old.fields) if old is not None else []
    names = {f.name.lower() for f in fields}
    fields += [f for f in new.fields if f.name.lower() not in names]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def _records(spark: SparkSession, location: str) -> list:
    try:
        return spark.read.schema(RECORD).json(location).orderBy("n", "schema").collect()   # one for each change of columns
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return []


def stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The newest schema; records that two writers gave one number are united."""
    out = None
    for r in _records(spark, location):
        out = union_schema(out, T.StructType.fromJson(json.loads(r["schema"])))
    return out


def grow_schema(spark: SparkSession, location: str, seen: T.StructType) -> T.StructType:
    """The stored schema with the columns of ``seen``; a new record is appended if that adds any."""
    records = _records(spark, location)
    old = None
    for r in records:
        old = union_schema(old, T.StructType.fromJson(json.loads(r["schema"])))
    merged = union_schema(old, seen)
    if merged != old:
        n = max((r["n"] for r in records), default=0) + 1
        spark.createDataFrame([(n, merged.json())], RECORD).coalesce(1).write.mode("append").json(location)
    return merged


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: missing columns become NULL. A column whose type is not the stored one must fit it without
    loss (a narrower number); another type raises, so that no value is lost in writing."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        mine = have.get(f.name.lower())
        if mine is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif mine.dataType == f.dataType or _widens(mine.dataType, f.dataType):
            out.append(F.col(f"`{mine.name}`").cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name} is {mine.dataType.simpleString()}, stored as {f.dataType.simpleString()}")
    return df.select(*out)


_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def _widens(one: T.DataType, other: T.DataType) -> bool:
    if type(one) in _WIDTH and type(other) in _WIDTH:
        return _WIDTH[type(one)] < _WIDTH[type(other)]
    if isinstance(other, T.DoubleType):
        return isinstance(one, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    return isinstance(one, T.NullType) or one.simpleString() == other.simpleString()
