"""Per-key ordered scans (previous / next row, running sum) in segments, so that a key of any size is shared out.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a key holding a third of the table then runs
in one task. Here ``segmented`` cuts the (key, order) sequence of the whole table at sampled points into segments of about
equal count: the points of the smallest hashes are a uniform sample, whatever the types of key and order. A row's segment is
the number of its key's cuts at or before it. Rows of a key without a cut share segment -1, so small keys are scanned
whole, as in a plain window; a large key gets cuts, and is dealt out, in proportion to its size.

The row-level window runs per (key, segment). Only keys that hold a cut need more: one summary row per (key, segment) is
scanned per key, and its edges (last row before, first row after, total before) are joined back. Both broadcasts are
bounded by the number of cuts: one row per key that holds one, and at most twice as many summary rows as cuts.

It is one plan at every size and no job runs while it is built. The cuts depend on the rows' values alone, so every part
of a plan, and a task that runs again, cuts alike. Copies of one (key, order) point are one point of the
sample but may fill it: that costs balance, never a result.

The order columns must be unique within a key where rows are numbered (callers collapse ties first). Nulls are values of
their own and come first, in keys and in orders.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = "_ll_segment"
WHOLE = -1                 # segment of the keys that hold no cut
NEW, ISLAND, NEXT_START = "_ll_new", "_ll_island", "_ll_next_start"


def cut_count(df: DataFrame) -> int:
    """Cuts per table: ``lakelayer.segmentCuts``, by default four for each shuffle partition."""
    conf = df.sparkSession.conf
    return int(conf.get("lakelayer.segmentCuts", None) or 4 * int(conf.get("spark.sql.shuffle.partitions")))


def _point(cols: Sequence[str], names: str) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"{names}{i}") for i, c in enumerate(cols)])


def segmented(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: int | None = None) -> DataFrame:
    """``df`` with a column ``SEGMENT``; rows of one key are in the order of their segments."""
    n = cut_count(df) if cuts is None else cuts
    stride = math.isqrt(max(1, n))
    names = {k: f"_ll_k{i}" for i, k in enumerate(keys)}
    points = df.select(*[F.col(f"`{k}`").alias(c) for k, c in names.items()], _point(order, "o").alias("_ll_at"))
    held = (points.orderBy(F.xxhash64(*names.values(), "_ll_at"), *names.values(), "_ll_at").limit(n)
            .groupBy(*names.values()).agg(F.array_sort(F.collect_list("_ll_at")).alias("_ll_cuts"))
            .withColumn("_ll_every", F.filter("_ll_cuts", lambda c, i: (i + 1) % stride == 0)))
    out = df.join(F.broadcast(held), _same([(df[f"`{k}`"], held[c]) for k, c in names.items()]), "left")
    # in two steps, of about the square root of the number of cuts each
    out = out.withColumn("_ll_at", _point(order, "o"))
    out = out.withColumn("_ll_skip", F.size(F.filter("_ll_every", lambda c: c <= F.col("_ll_at"))) * stride)
    near = F.filter(F.slice("_ll_cuts", F.col("_ll_skip") + 1, F.lit(stride)), lambda c: c <= F.col("_ll_at"))
    segment = F.when(F.col("_ll_cuts").isNull(), WHOLE).otherwise(F.col("_ll_skip") + F.size(near))
    return out.withColumn(SEGMENT, segment).select(*[F.col(f"`{c}`") for c in df.columns if c != SEGMENT], SEGMENT)


def _same(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Equal keys; a null key equals a null key."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & a.eqNullSafe(b)
    return cond


def _differs(before: Column, now: Column) -> Column:
    return ~before.eqNullSafe(now)


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], prev_cols: Sequence[str] = (),
         next_cols: Sequence[str] = (), island_of: str | None = None, differs: Callable[[Column, Column], Column] = _differs,
         starts_only: bool = False) -> DataFrame:
    """One pass over a ``segmented`` table in the order of its keys. Adds ``_prev_<c>`` and ``_next_<c>`` (values on the
    previous and next row of the key).

    ``island_of`` adds ``NEW`` (first row of its key, or ``differs(value on the previous row, value)``) and ``ISLAND``
    (how many of the key's rows up to this one are new). With ``starts_only`` the new rows alone come back, each
    with ``NEXT_START``: the order, as a struct of o0, o1, ..., of the key's next new row.
    """
    keys, order = list(keys), list(order)
    key_cols = [F.col(f"`{k}`") for k in keys]
    w = Window.partitionBy(*key_cols, SEGMENT).orderBy(*[F.col(f"`{o}`") for o in order])
    per_key = Window.partitionBy(*key_cols).orderBy(SEGMENT)
    at = _point(order, "o")

    def values(cols):
        return F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])

    seen = [*prev_cols, *([island_of] if island_of else [])]
    local, parts, edges = df, [], []
    if seen:
        local = local.withColumn("_ll_before", F.lag(values(seen)).over(w))
        parts.append(F.max_by(values(seen), at).alias("_ll_last"))
        edges.append(F.lag("_ll_last").over(per_key).alias("_ll_before_edge"))
    if next_cols:
        local = local.withColumn("_ll_after", F.lead(values(next_cols)).over(w))
        parts.append(F.min_by(values(next_cols), at).alias("_ll_first"))
        edges.append(F.lead("_ll_first").over(per_key).alias("_ll_after_edge"))
    last = f"v{len(seen) - 1}"
    if island_of:
        # the first row of a segment counts as new until the segment before it is known
        opens = F.col("_ll_before").isNull()
        changed = F.coalesce(differs(F.col("_ll_before")[last], F.col(f"`{island_of}`")), F.lit(False))
        local = local.withColumn(NEW, opens | changed)
        parts += [F.sum(F.col(NEW).cast("long")).alias("_ll_news"), F.min_by(F.col(f"`{island_of}`"), at).alias("_ll_value"),
                  F.min(at).alias("_ll_from"), F.min(F.when(~opens & F.col(NEW), at)).alias("_ll_inner")]
    summary = local.where(F.col(SEGMENT) != WHOLE).groupBy(*key_cols, SEGMENT).agg(*parts)
    if island_of:
        summary = summary.withColumn("_ll_held", F.lag("_ll_last").over(per_key))
        opens_new = F.col("_ll_held").isNull() | F.coalesce(differs(F.col("_ll_held")[last], F.col("_ll_value")), F.lit(False))
        summary = summary.withColumn("_ll_opens", opens_new)
        upto = per_key.rowsBetween(Window.unboundedPreceding, -1)
        beyond = per_key.rowsBetween(1, Window.unboundedFollowing)
        edges += [F.col("_ll_opens"),
                  F.sum(F.col("_ll_news") - (~F.col("_ll_opens")).cast("long")).over(upto).alias("_ll_earlier"),
                  F.min(F.when(F.col("_ll_opens"), F.col("_ll_from")).otherwise(F.col("_ll_inner"))).over(beyond).alias("_ll_later")]
    names = {c: f"_ll_e{i}" for i, c in enumerate([*keys, SEGMENT])}
    edge = summary.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *edges)

    if island_of:
        local = local.withColumn(ISLAND, F.sum(F.col(NEW).cast("long")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if starts_only:
        # a segment's first row may turn out not to be new; then it is no start for the rows before it, which lie in
        # other segments, so the next start within the segment is the next row kept here
        local = local.where(NEW).withColumn(NEXT_START, F.lead(at).over(w))
    out = local.join(F.broadcast(edge), _same([(local[f"`{c}`"], edge[n]) for c, n in names.items()]), "left")
    for i, c in enumerate(prev_cols):
        out = out.withColumn(f"_prev_{c}", F.coalesce("_ll_before", "_ll_before_edge")[f"v{i}"])
    for i, c in enumerate(next_cols):
        out = out.withColumn(f"_next_{c}", F.coalesce("_ll_after", "_ll_after_edge")[f"v{i}"])
    if island_of:
        opens = F.coalesce("_ll_opens", F.lit(True))
        out = (out.withColumn(NEW, F.when(F.col("_ll_before").isNull(), opens).otherwise(F.col(NEW)))
               .withColumn(ISLAND, F.col(ISLAND) + F.coalesce("_ll_earlier", F.lit(0)) - (~opens).cast("long")))
    if starts_only:
        out = out.where(NEW).withColumn(NEXT_START, F.coalesce(NEXT_START, "_ll_later"))
    return out.drop(*names.values(), "_ll_before", "_ll_after", "_ll_before_edge", "_ll_after_edge", "_ll_opens",
                    "_ll_earlier", "_ll_later")
