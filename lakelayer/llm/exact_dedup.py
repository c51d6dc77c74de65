"""Exact duplicates by sorting the content itself.

Rows are range-partitioned on (32 characters of text, 64-bit hash of the text, piece): Spark samples the splitters, so
only bounded keys travel to the driver. Within a partition an external sort by the whole text puts equals side by side,
and each row is compared in full with its neighbour. A text that holds more rows than a quarter of a mean partition is
dealt out in pieces; at most 4 x partitions texts can be that frequent, which bounds the broadcast list. The few heads
of such pieces are merged by their full text afterwards. All of it is DataFrame code.

Defined results: null text counts as the empty text; a null id sorts last, so it stays only if every id of its group is
null; of rows that repeat both id and text exactly one stays; an empty table gives an empty result. Columns beside id
and text may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakelayer.llm.common import col, shuffle_partitions, stored, text_or_empty


def _runs(df: DataFrame, id_col: str, text_col: str, keep: str, carry: list[str], prefix_chars: int) -> DataFrame:
    """Sorted rows with run marks: _new (first row of a run), _keep (id of the run's first row), _k (pieces or null)."""
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    src = df.select(F.struct(col(id_col).alias("id")).alias("_id"), text_or_empty(text_col).alias("_text"),
                    F.struct(*[col(c) for c in carry], F.lit(0).alias("_pad")).alias("_row"))
    keyed = (src.withColumn("_p", F.substring("_text", 1, prefix_chars))
             .withColumn("_h", F.xxhash64("_text")))
    share = max(1, -(-df.count() // (4 * n)))
    hot = (keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share)
           .select("_h", F.ceil(F.col("_n") / share).alias("_k")))
    dealt = (keyed.join(F.broadcast(hot), "_h", "left")
             .withColumn("_s", F.when(F.col("_k").isNull(), F.lit(0)).otherwise(
                 F.pmod(F.xxhash64("_id"), F.coalesce("_k", F.lit(1)).cast("long"))))
             .repartitionByRange(n, "_p", "_h", "_s"))
    w = Window.partitionBy("_p", "_h", "_s").orderBy("_text", *_order(keep))
    before = F.lag("_text").over(w)
    marked = dealt.withColumn("_new", before.isNull() | (before != F.col("_text")))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (marked.withColumn("_run", F.sum(F.col("_new").cast("long")).over(upto))
            .withColumn("_keep", F.last(F.when(F.col("_new"), F.col("_id")), ignorenulls=True).over(upto)))


def _order(keep: str, name: str = "_id") -> list[Column]:
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    one = F.col(f"{name}.id")
    return [one.asc_nulls_last() if keep == "min" else one.desc_nulls_last()]


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                     prefix_chars: int = 32) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (see the module docstring)."""
    runs = _runs(df, id_col, text_col, keep, [], prefix_chars)
    slim = runs.select("_id", "_p", "_h", "_s", "_run", "_new", "_keep", "_k", F.sha2("_text", 256).alias("_sha"),
                       F.when(F.col("_new") & F.col("_k").isNotNull(), F.col("_text")).alias("_head"))
    whole = Window.partitionBy("_p", "_h", "_s", "_run")
    rows = stored(slim.withColumn("_n", F.count(F.lit(1)).over(whole)), "exact-rows")
    heads = rows.where(F.col("_head").isNotNull())
    per_text = Window.partitionBy("_head")
    ranked = per_text.orderBy(*_order(keep, "_keep"), "_s")
    merged = heads.select("_p", "_h", "_s", "_run", F.first("_keep.id").over(ranked).alias("_bid"),
                          F.sum("_n").over(per_text).alias("_bn"), (F.row_number().over(ranked) == 1).alias("_wins"))
    # at most one row per piece of a frequent text: bounded by 8 x partitions
    out = rows.join(F.broadcast(merged), ["_p", "_h", "_s", "_run"], "left")
    is_hot = F.col("_bn").isNotNull()
    return out.select(
        F.col("_id.id").alias(id_col),
        F.when(is_hot, F.col("_bid")).otherwise(F.col("_keep.id")).alias("keep_id"),
        F.when(is_hot, F.col("_bn")).otherwise(F.col("_n")).cast("long").alias("group_size"),
        (F.col("_new") & F.coalesce("_wins", F.lit(True))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def distinct_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                  prefix_chars: int = 32) -> DataFrame:
    """The rows that stay, with the input's columns and types."""
    others = [c for c in df.columns if c not in (id_col, text_col)]
    runs = _runs(df.withColumn("_no_text", col(text_col).isNull()), id_col, text_col, keep,
                 [*others, "_no_text"], prefix_chars)
    heads = stored(runs.where("_new").select("_id", "_text", "_row", "_h", "_s", "_k"), "exact-heads")
    split = heads.where(F.col("_k").isNotNull())
    first = F.row_number().over(Window.partitionBy("_text").orderBy(*_order(keep), "_s"))
    losers = split.select("_h", "_s", "_text", first.alias("_rank")).where("_rank > 1").drop("_rank")
    # losers: at most one row per piece of a frequent text, 8 x partitions in all
    left = heads.join(F.broadcast(losers), ["_h", "_s", "_text"], "left_anti")
    real = {id_col: F.col("_id.id"), text_col: F.when(~F.col("_row._no_text"), F.col("_text"))}
    return left.select(*[real.get(c, F.col(f"_row.`{c}`")).alias(c) for c in df.columns])
