"""Column-shape operators: tolerant drop, metadata columns, typed copy."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop by name; names are matched case-insensitively and unknown names are ignored."""
    return df.drop(*columns)


def dropping(columns: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """``df.transform(dropping([...]))`` form of ``drop_columns``."""
    return lambda df: drop_columns(df, columns)


def with_ingest_metadata(df: DataFrame, ingest_date, api_url=None, extraction_ts=None,
                         load_ts=None) -> DataFrame:
    """Bronze provenance columns: literal day (as DATE), source URL, timestamps."""
    def lit(v):
        return v if not isinstance(v, (str, type(None))) or v is None else F.lit(v)

    out = df.withColumn("ingest_date", F.to_date(F.lit(ingest_date)) if isinstance(ingest_date, str)
                        else F.to_date(ingest_date))
    if api_url is not None:
        out = out.withColumn("api_url", lit(api_url))
    out = out.withColumn("extraction_timestamp",
                         F.current_timestamp() if extraction_ts is None else F.to_timestamp(lit(extraction_ts)))
    return out.withColumn("bronze_load_timestamp",
                          F.current_timestamp() if load_ts is None else F.to_timestamp(lit(load_ts)))


def convert_types(df: DataFrame, target: Mapping[str, str], truncate: Mapping[str, int] | None = None,
                  strict: bool = False) -> DataFrame:
    """Copy with type conversion: cast to ``target`` types, cut strings to a length.

    ``strict=False`` uses ``try_cast`` (a value that does not fit becomes NULL);
    booleans are never converted from or to numbers (that raises at analysis).
    Columns not named keep their type.
    """
    truncate = truncate or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in target:
            t = target[f.name]
            if (t.lower() == "boolean") != (f.dataType.simpleString() == "boolean") and \
                    f.dataType.simpleString() != "string":
                raise TypeError(f"no boolean/number conversion for {f.name}")
            c = c.cast(t) if strict else c.try_cast(t)
        if f.name in truncate:
            c = F.left(c, F.lit(truncate[f.name]))
        out.append(c.alias(f.name))
    return df.select(*out)
