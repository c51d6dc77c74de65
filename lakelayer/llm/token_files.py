"""Token ids as Parquet list columns in ascending id order.

One file per range partition of the id. The ``tokens`` column is dictionary-encoded, ``doc_id`` and ``first`` (ids of the
same file before the document) are delta-packed, row groups and pages have set sizes, and the writer leaves column and
offset indexes, so a reader can take the metadata columns alone or a few documents' pages. A document's place among
all ids is its file's base (the sum of the files before it, one number per file) plus ``first``.

Defined results: null text encodes as the empty text (only the end id); null ids come first; rows that repeat an id
follow each other, ordered by text; an empty table writes no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakelayer.llm.common import col, shuffle_partitions, small_batches, text_or_empty
from lakelayer.llm.tokens import chunks, encoder

SCHEMA = "doc_id long, first long, n_tokens int, tokens array<int>"


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", row_group_bytes: int = 32 << 20, page_bytes: int = 128 << 10,
                      page_rows: int = 1000) -> None:
    """Encode every whole text, append ``end_id`` and write the files under ``path``."""
    small_batches(df.sparkSession)
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, first = encoder(tokenizer), 0
        for b in batches:
            for i, j, texts in chunks(b.column(1)):
                ids, at = enc.encode_column(texts)
                flat = np.insert(ids, at[1:], end_id).astype("<i4")
                upto = at + np.arange(len(at))
                n = np.diff(upto).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(first + upto[:-1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(flat))],
                    ["doc_id", "first", "n_tokens", "tokens"])
                first += int(upto[-1])

    n = shuffle_partitions(df.sparkSession)
    (df.select(col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
     .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, SCHEMA)
     .write.options(**{"parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes),
                       "parquet.page.row.count.limit": str(page_rows), "parquet.writer.version": "v2",
                       "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false",
                       "parquet.enable.dictionary#first": "false", "compression": "zstd"})
     .parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens; the token pages are not read."""
    rows = spark.read.schema(SCHEMA).parquet(path).select(
        "doc_id", "first", "n_tokens",
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"))
    return _with_start(rows, spark, path).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens and tokens of the ids in [low, high]; the bounds reach the page indexes."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    rows = rows.select("*", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"))
    return _with_start(rows, spark, path).select("doc_id", "start", "n_tokens", "tokens")


def _with_start(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    sums = (spark.read.schema(SCHEMA).parquet(path)
            .select("n_tokens", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"))
            .groupBy("file").agg(F.sum("n_tokens").alias("ids")))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))   # one row per file
    return rows.join(F.broadcast(base), "file").withColumn("start", F.col("base") + F.col("first"))


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids read back."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").tobytes()
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(flat[4 * s:4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (tokens.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "tokens")
            .mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long"))
