import datetime as dt
import json
import os


from lakelayer.operators.dedup import first_seen
from lakelayer.plans.clinical import bronze_frames
from lakelayer.sinks.tables import ensure_table
from lakelayer.sources.bundles import read_pages
from lakelayer.sources.paged import fetch_pages, land_pages, recorded_name, request_url
from lakelayer.streaming.ingest import file_stream, run_to_parquet

BASE = "https://api.example.org/R4"


def _record(folder, url, doc):
    with open(os.path.join(folder, recorded_name(url)), "w") as f:
        f.write(json.dumps(doc))


def test_paged_source_follows_next_links_and_isolates_failures(spark, scratch, tmp_path):
    rec = tmp_path / "recorded"
    rec.mkdir()
    day = dt.date(2024, 1, 1)
    first = request_url(BASE, "Patient", day)
    second = BASE + "/Patient?page=2"
    _record(rec, first, {"resourceType": "Bundle", "total": 3,
                         "link": [{"relation": "self", "url": first}, {"relation": "next", "url": second}],
                         "entry": [{"resource": {"resourceType": "Patient", "id": "p1"}},
                                   {"resource": {"resourceType": "Patient", "id": "p2"}}]})
    _record(rec, second, {"resourceType": "Bundle", "total": 3, "link": [{"relation": "self", "url": second}],
                          "entry": [{"resource": {"resourceType": "Patient", "id": "p3"}}]})
    pages = fetch_pages(spark, BASE, "2024-01-01", "2024-01-02", f"folder:{rec}",
                        resources=["Patient", "Encounter"], retry_pause_s=0.0)
    root = scratch("landing")
    audit = {(r.resource_name, r.page_number): r for r in land_pages(spark, pages, root, "run-1").collect()}
    assert audit[("Patient", 1)].records_on_page == 2 and audit[("Patient", 2)].records_on_page == 1
    assert audit[("Encounter", 1)].status == "failed"             # no recorded response: failure row
    frames = bronze_frames(read_pages(spark, root + "/raw"))
    assert sorted(r.patient_id for r in frames["Patient"].collect()) == ["p1", "p2", "p3"]


def test_ensure_table_is_idempotent(spark, scratch):
    loc = scratch("tbl")
    for _ in range(2):
        ensure_table(spark, "ll_bronze.api_metadata", "run_id string, pages int, ingest_date date", loc,
                     ["ingest_date"])
    assert spark.table("ll_bronze.api_metadata").columns == ["run_id", "pages", "ingest_date"]


def test_bounded_stream_dedup(spark, scratch):
    src, tgt, ck = scratch("src"), scratch("tgt"), scratch("ck")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0), (1, t0 + dt.timedelta(seconds=5)), (2, t0)]
    spark.createDataFrame(rows, "k long, ts timestamp").write.parquet(src)
    s = first_seen(file_stream(spark, src), ["k"], event_time="ts", delay="1 hour")
    run_to_parquet(s, tgt, ck)
    assert sorted(r.k for r in spark.read.parquet(tgt).collect()) == [1, 2]


def test_gold_publish_registers_comment(spark, scratch):
    from lakelayer.plans.gold import publish
    df = spark.createDataFrame([(1, "a")], "patient_id long, family_name string")
    publish({"gold_patient": df}, scratch("gold"), schema="ll_gold")
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED ll_gold.gold_patient").collect()}
    assert desc.get("Comment", "").startswith("Current patient dimension")
    assert spark.table("ll_gold.gold_patient").count() == 1


def test_stream_from_catalog_table(spark, scratch):
    from lakelayer.streaming.ingest import table_stream
    loc = scratch("tbl")
    spark.range(5).write.parquet(loc)
    spark.sql(f"CREATE TABLE IF NOT EXISTS ll_stream_src (id bigint) USING parquet LOCATION '{loc}'")
    tgt, ck = scratch("tgt"), scratch("ck")
    run_to_parquet(table_stream(spark, "ll_stream_src"), tgt, ck)
    assert spark.read.parquet(tgt).count() == 5


def test_jdbc_reader_needs_table_or_query():
    import pytest
    from lakelayer.sources.cdc import jdbc_table
    with pytest.raises(ValueError):
        jdbc_table("jdbc:none:x")
    with pytest.raises(ValueError):
        jdbc_table("jdbc:none:x", table="t", query="select 1")
    assert callable(jdbc_table("jdbc:none:x", query="select max(c) from t"))


def test_summary_string_vs_parsed_dates(spark):
    import datetime as dt
    from lakelayer.plans.gold import gold_patient_health_summary
    pat = spark.createDataFrame([("p", "F", "G", "f", "1990", "c", "s", "x", True)],
                                "patient_id string, family_name string, given_name string, gender string, "
                                "birth_date string, city string, state string, country string, active boolean")
    enc = spark.createDataFrame([("e1", "p", "2024-1-9"), ("e2", "p", "2024-01-10")],
                                "encounter_id string, patient_id string, period_start string")
    obs = spark.createDataFrame([], "observation_id string, patient_id string")
    cnd = spark.createDataFrame([], "condition_id string, patient_id string, clinical_status string")
    a = gold_patient_health_summary(pat, enc, obs, cnd).first()
    assert (a.first_encounter_date, a.last_encounter_date) == ("2024-01-10", "2024-1-9")   # text order
    b = gold_patient_health_summary(pat, enc, obs, cnd, parse_dates=True).first()
    assert b.first_encounter_date == dt.datetime(2024, 1, 9) and b.last_encounter_date == dt.datetime(2024, 1, 10)
