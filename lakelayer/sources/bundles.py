"""Paged JSON bundles: request grid, page scan, entries, page audit.

Pages are stored as JSON documents (one bundle per line, or one per file with
``multi_line``) under ``raw/resource_name=<R>/date=<D>/``; a single scan covers all
resources and days, partition columns come from the folder names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.session import missing_path

from lakelayer.functions.dates import day_sequence
from lakelayer.operators.flatten import BUNDLE, RESOURCES, bundle_schema

# Records per page.
PAGE_SIZE = 50


def request_grid(spark: SparkSession, base_url: str, start: str, end: str,
                 resources: Sequence[str] = RESOURCES, page_size: int = PAGE_SIZE) -> DataFrame:
    """One request per (resource, day) for days in ``[start, end)`` (no join: two explodes)."""
    days = spark.range(1).select(F.explode(day_sequence(start, end)).alias("day"))
    return request_urls(days, base_url, resources, page_size)


def request_urls(days: DataFrame, base_url: str, resources: Sequence[str] = RESOURCES,
                 page_size: int = PAGE_SIZE) -> DataFrame:
    """Requests for every resource on every day of a ``day`` column."""
    grid = days.select(F.explode(F.array(*[F.lit(r) for r in resources])).alias("resource"), "day")
    day_s = F.date_format("day", "yyyy-MM-dd")
    next_s = F.date_format(F.date_add("day", 1), "yyyy-MM-dd")
    return grid.select("resource", "day",
                       F.format_string("%s/%s?_lastUpdated=ge%sT00:00:00Z&_lastUpdated=lt%sT00:00:00Z&_count=%d&_format=json", F.lit(base_url),
                                       F.col("resource"), day_s, next_s, F.lit(page_size)).alias("url"))


def empty_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BUNDLE).select(
        "*", F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("string").alias("resource_name"),
        F.lit(None).cast("date").alias("date"))


CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, multi_line: bool = False, resource: str | None = None) -> DataFrame:
    """Bundle pages with their file path; a missing folder gives no rows.

    A page that is no JSON, or whose fields have other types, comes as a row with its text in ``CORRUPT``: it has no
    entries (``entries``), is a failed row of the audit, and stops no other page. With ``resource`` only that
    type's folder is listed and its entries are parsed with the fields that type reads (less JSON work per page).
    """
    try:
        src = f"{path.rstrip('/')}/resource_name={resource}" if resource else path
        schema = T.StructType([*bundle_schema(resource).fields, T.StructField(CORRUPT, T.StringType())])
        df = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("basePath", path).json(src))
    except AnalysisException as exc:
        if missing_path(exc):
            return empty_pages(spark)
        raise
    # Spark refuses a scan of the corrupt text alone, so it is read with one more field (of which nothing is added)
    text = F.concat(F.col(CORRUPT), F.left(F.coalesce(F.col("total").cast("string"), F.lit("")), F.lit(0)))
    return df.withColumns({"file_path": F.col("_metadata.file_path"), CORRUPT: text})


def failed_pages(pages: DataFrame) -> DataFrame:
    """The quarantined pages: where each came from and its text."""
    return pages.where(_broken(pages)).select("resource_name", F.to_date("date").alias("ingest_date"), "file_path",
                                              F.col(CORRUPT).alias("body"))


def _broken(pages: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in pages.columns else F.lit(False)


def _link(relation: str):
    return F.try_element_at(F.filter("link", lambda l: l["relation"] == F.lit(relation)), F.lit(1))["url"]


def page_info(pages: DataFrame) -> DataFrame:
    """Per page: self URL (file path when absent), next URL, page number, counts."""
    self_url = F.coalesce(_link("self"), F.col("file_path"))
    return pages.select(
        "*",
        self_url.alias("api_url"),
        _link("next").alias("next_url"),
        F.regexp_extract(self_url, r"[?&]_page=([0-9]+)", 1).alias("_pg"),
        F.coalesce(F.size("entry"), F.lit(0)).alias("records_on_page"),
        F.coalesce(F.col("total"), F.lit(0)).alias("total_records"),
    ).withColumn("page_number", F.when(F.col("_pg") != "", F.col("_pg").cast("int"))).drop("_pg")


def entries(pages: DataFrame, keep: Sequence[str] = ("api_url",)) -> DataFrame:
    """One row per entry of the whole pages (a NULL or missing ``entry`` gives no rows)."""
    info = page_info(pages.where(~_broken(pages)))
    extra = [c for c in ("resource_name", "date") if c in pages.columns]
    return info.select(*keep, *extra, F.explode("entry").alias("e")).select(*keep, *extra, "e.resource")


def page_audit(pages: DataFrame, run_id: str, extraction_ts=None) -> DataFrame:
    """Audit row per page (the api_metadata table), one job for all pages."""
    info = page_info(pages).withColumn("_failed", _broken(pages))
    ts = F.current_timestamp() if extraction_ts is None else F.to_timestamp(F.lit(extraction_ts))
    return info.select(
        F.lit(run_id).alias("run_id"),
        F.col("resource_name"),
        F.to_date("date").alias("ingest_date"),
        "page_number", "api_url", F.when(F.col("_failed"), 0).otherwise(F.col("records_on_page")).alias("records_on_page"),
        F.when(F.col("_failed"), 0).otherwise(F.col("total_records")).cast("long").alias("total_records"),
        ts.alias("extraction_timestamp"),
        F.when(F.col("_failed"), "failed").otherwise("success").alias("status"),
        F.when(F.col("_failed"), "the page is no bundle in JSON").alias("error_message"),
        "next_url",
    )


def page_totals(pages: DataFrame) -> DataFrame:
    """Whole pages and their records per (resource, day)."""
    info = page_info(pages.where(~_broken(pages)))
    return (info.groupBy(F.col("resource_name"), F.to_date("date").alias("ingest_date"))
            .agg(F.count(F.lit(1)).alias("pages"), F.sum("records_on_page").alias("records")))
