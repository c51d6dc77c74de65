"""Keep one row per key.

``latest_per_key`` is an aggregate (the greatest order value carries its row along), so Spark combines
rows map-side before the shuffle: a hot key costs one partial row per input partition, not one task holding all of
its rows. Rows may hold columns of any type, maps and variants too: only the order has to be orderable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def tie_break(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """Deterministic tie value over the remaining columns in name order.

    Struct comparison when every column is orderable, else the JSON text.
    """
    ex = set(exclude)
    fields = [f for f in sorted(df.schema.fields, key=lambda f: f.name) if f.name not in ex]
    s = F.struct(*[F.col(f"`{f.name}`") for f in fields])
    if all(_orderable(f.dataType) for f in fields):
        return s
    return F.to_json(s)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   also: dict[str, Column] | None = None) -> DataFrame:
    """The row with the greatest ``order`` for each key; of equal ones, the one with the greatest remaining columns.

    ``order`` items are column names or expressions whose larger value wins (NULL loses to any value;
    ``F.col("x").desc()`` is not allowed). Remaining columns are compared one by one
    in name order; where a column cannot be ordered (map, variant), by the JSON text of the columns.
    ``also``: further aggregates over the rows of a key, by name; columns of these names take no part otherwise.
    """
    keys, also = list(keys), also or {}
    columns = [c for c in df.columns if c not in also]
    fields = [(o if isinstance(o, Column) else F.col(f"`{o}`")).alias(f"_ll_o{i}") for i, o in enumerate(order)]
    named = {o: f"_ll_o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    rest = sorted(c for c in columns if c not in keys and c not in named)
    if all(_orderable(df.schema[c].dataType) for c in rest):
        # order and remaining columns are the whole row: its greatest value is the row itself
        best = F.max(F.struct(*fields, *[F.col(f"`{c}`").alias(f"_ll_r{i}") for i, c in enumerate(rest)]))
        inside = named | {c: f"_ll_r{i}" for i, c in enumerate(rest)}
    else:
        fields.append(tie_break(df, exclude=[*keys, *named, *also]).alias("_ll_tie"))
        others = [c for c in columns if c not in keys]
        best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.struct(*fields)) if others else None
        inside = {c: f"`{c}`" for c in others}
    if not inside:                       # every column is a key
        best = F.lit(None)
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best.alias("_ll_best"), *[a.alias(n) for n, a in also.items()])
    # grouping columns pass through as they are, so the output keeps the
    # aggregate's hash partitioning (a later window / join on them needs no shuffle)
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_ll_best.{inside[c]}").alias(c) for c in columns], *also)


def first_seen(df: DataFrame, keys: Sequence[str], event_time: str | None = None,
               delay: str | None = None) -> DataFrame:
    """Any one row per key (``dropDuplicates``); on a stream the first one seen wins.

    On a stream the key state is kept forever unless ``event_time`` and ``delay``
    are given: then duplicates are dropped within the watermark delay and the
    state of older keys is released (``dropDuplicatesWithinWatermark``).
    """
    if event_time and delay:
        return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))
