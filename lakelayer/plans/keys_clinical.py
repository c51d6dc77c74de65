"""Queries over bundle pages synthesised from the driver tables (clinical layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.operators.flatten import RESOURCES, flatten
from lakelayer.plans.clinical import RESOURCE_BUILDERS, Context, bundle_pages, flat_sql, land_pages, run_medallion, synth_raw
from lakelayer.plans.keys_batch import summary_sql
from lakelayer.plans.registry import query
from lakelayer.plans.roles import OBSERVATION, CONDITION
from lakelayer.session import scratch_dir
from lakelayer.sources.bundles import entries, page_audit, page_totals, read_pages

DAY = "2024-01-01"


def _pages(spark, d, resources=None) -> DataFrame:
    raw = scratch_dir(spark, "raw")
    if resources:
        synth_raw(spark, d, raw, DAY, resources=resources)
    else:
        synth_raw(spark, d, raw, DAY)
    return read_pages(spark, raw)


_OBS_ID = dict(OBSERVATION)["observation_id"]
_COND_ID = dict(CONDITION)["condition_id"]
_IDS_SQL = f"""
SELECT 'Patient' AS resource_type, cast(c_custkey as string) AS id FROM customer
UNION ALL SELECT 'Encounter', cast(o_orderkey as string) FROM orders
UNION ALL SELECT 'Observation', {_OBS_ID} FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'Condition', {_COND_ID} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query("fhir_bundle_parse", oracle=f"""
SELECT resource_type, id, DATE '{DAY}' AS ingest_date FROM ({_IDS_SQL})""")
def q_bundle_parse(spark, d):
    e = entries(_pages(spark, d))
    return e.select(F.col("resource.resourceType").alias("resource_type"), F.col("resource.id").alias("id"),
                    F.to_date("date").alias("ingest_date"))


def _flat(resource: str):
    def run(spark, d):
        raw = scratch_dir(spark, "raw")
        synth_raw(spark, d, raw, DAY, resources=[resource])
        return flatten(entries(read_pages(spark, raw, resource=resource)), resource)
    run.__name__ = f"q_flatten_{resource.lower()}"
    run.__doc__ = f"{resource} pages synthesised from the tables, parsed and flattened."
    return run


for _r in ("Patient", "Encounter", "Observation", "Condition"):
    query(f"flatten_{_r.lower()}", oracle=flat_sql(_r.lower()))(_flat(_r))


_PAGES_SQL = """
WITH p AS (SELECT 'Patient' AS resource_name, c_custkey // 50 AS page FROM customer
  UNION ALL SELECT 'Encounter', o_orderkey // 50 FROM orders
  UNION ALL SELECT 'Observation', l_orderkey // 8 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'Condition', l_orderkey // 50 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("fhir_page_audit", oracle=_PAGES_SQL + f"""
SELECT resource_name, DATE '{DAY}' AS ingest_date,
       CASE WHEN page % 17 = 0 THEN NULL ELSE CAST(page AS INTEGER) END AS page_number,
       CAST(count(*) AS INTEGER) AS records_on_page, count(*) AS total_records, count(*) >= 50 AS has_next
FROM p GROUP BY resource_name, page""")
def q_page_audit(spark, d):
    a = page_audit(_pages(spark, d), run_id="audit")
    return a.select("resource_name", "ingest_date", "page_number", "records_on_page", "total_records",
                    F.col("next_url").isNotNull().alias("has_next"))


@query("fhir_page_totals", oracle=_PAGES_SQL + f"""
SELECT resource_name, DATE '{DAY}' AS ingest_date, count(DISTINCT page) AS pages, count(*) AS records
FROM p GROUP BY resource_name""")
def q_page_totals(spark, d):
    return page_totals(_pages(spark, d))


@query("fhir_page_landing", oracle=_PAGES_SQL + f""",
q AS (SELECT resource_name, page, count(*) AS n, page % 13 = 5 AS cut FROM p GROUP BY resource_name, page)
SELECT resource_name, DATE '{DAY}' AS ingest_date, CASE WHEN cut THEN 'failed' ELSE 'success' END AS status, count(*) AS pages,
       CAST(sum(CASE WHEN cut THEN 0 ELSE n END) AS BIGINT) AS records FROM q GROUP BY resource_name, cut""")
def q_page_landing(spark, d):
    """Landed pages of which some are cut in half: those are failed rows of the audit, and no other page is stopped."""
    pages = None
    for r in RESOURCES:
        p = bundle_pages(RESOURCE_BUILDERS[r](spark, d), DAY, keep_page=True)
        pages = p if pages is None else pages.unionByName(p)
    cut = F.when(F.col("page") % 13 == 5, F.expr("substring(body, 1, CAST(length(body) / 2 AS int))")).otherwise(F.col("body"))
    raw = scratch_dir(spark, "raw")
    land_pages(pages.withColumn("body", cut), raw)
    landed = read_pages(spark, raw)
    audit = page_audit(landed, run_id="landing").groupBy("resource_name", "ingest_date", "status").agg(
        F.count(F.lit(1)).alias("pages"))
    read = entries(landed).groupBy("resource_name", F.to_date("date").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("records")).withColumn("status", F.lit("success"))
    return (audit.join(read, ["resource_name", "ingest_date", "status"], "left")
            .select("resource_name", "ingest_date", "status", "pages", F.coalesce("records", F.lit(0)).alias("records")))


# three days: day 1 everything; days 2 and 3 patients again, with new given names for k % 4 = 0
def _rename(resource: str, res: DataFrame) -> DataFrame:
    k = F.col("_k")
    renamed = F.transform(F.col("res.name"), lambda n: n.withField(
        "given", F.transform(n["given"], lambda g: F.when(g == "X", F.lit("Y")).otherwise(g))))
    return res.withColumn("res", F.col("res").withField(
        "name", F.when(k % 4 == 0, renamed).otherwise(F.col("res.name"))))


_PAT_FINAL = flat_sql("patient").replace(
    "ELSE concat(c_mktsegment, ' X') END",
    "WHEN c_custkey % 4 = 0 THEN concat(c_mktsegment, ' Y') ELSE concat(c_mktsegment, ' X') END")


@query("medallion_end_to_end", oracle=summary_sql(_PAT_FINAL, flat_sql("encounter"), flat_sql("observation"),
                                                  flat_sql("condition"), distinct_ids=True))
def q_medallion(spark, d):
    ctx = Context(scratch_dir(spark, "medallion"))
    # three landing days (each replaces only its own day folders)
    synth_raw(spark, d, ctx.raw(), "2024-01-01")
    synth_raw(spark, d, ctx.raw(), "2024-01-02", resources=["Patient"], adjust=_rename)
    synth_raw(spark, d, ctx.raw(), "2024-01-03", resources=["Patient"], adjust=_rename)
    gold = run_medallion(spark, ctx, "2024-01-01", "2024-01-04", clock=lambda day: F.to_timestamp(day))
    return gold["gold_patient_health_summary"]
