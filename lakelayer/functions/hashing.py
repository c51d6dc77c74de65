"""Record hash over business columns, as a native expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metadata / audit columns that never take part in the record hash.
HASH_EXCLUDE = frozenset({
    "extraction_timestamp", "api_url", "ingest_date",
    "bronze_load_timestamp", "effective_start_date",
    "effective_end_date", "is_current", "record_hash",
    "silver_load_timestamp", "record_version",
})


def hash_columns(columns: Iterable[str], exclude: Iterable[str] = HASH_EXCLUDE) -> list[str]:
    ex = {c.lower() for c in exclude}
    return sorted(c for c in columns if c.lower() not in ex)


def record_hash(df: DataFrame, exclude: Iterable[str] = HASH_EXCLUDE) -> Column:
    """SHA-256 hex of the JSON of the sorted business columns.

    ``to_json`` leaves NULL fields out, so a column that is NULL everywhere does
    not change any hash (adding such a column keeps old hashes valid).
    """
    cols = hash_columns(df.columns, exclude)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)
