import json

from pyspark.sql import functions as F

from lakelayer.operators.flatten import flatten
from lakelayer.plans.clinical import Context, bronze_frames
from lakelayer.sources.bundles import entries, page_audit, page_totals, read_pages, request_grid


def _write_pages(root, resource, day, bundles):
    import os
    d = f"{root}/resource_name={resource}/date={day}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/part-0.json", "w") as f:
        for b in bundles:
            f.write(json.dumps(b) + "\n")


PATIENTS = {
    "resourceType": "Bundle", "total": 4,
    "link": [{"relation": "self", "url": "http://x/Patient?_page=1"}, {"relation": "next", "url": "http://x/n"}],
    "entry": [
        {"resource": {"resourceType": "Patient", "id": "p1", "meta": {"lastUpdated": "t1"},
                      "name": [{"family": "F", "given": ["A", "B"]}],
                      "telecom": [{"system": "phone", "value": "1"}, {"system": "email", "value": "e"},
                                  {"system": "phone", "value": "2"}],
                      "communication": [{"language": {"coding": []}}], "active": True}},
        {"resource": {"resourceType": "Patient", "id": "p2", "name": [{"family": "G", "given": []}]}},
        {"resource": {"resourceType": "Patient", "id": "p3"}},
        {"resource": {"resourceType": "Encounter", "id": "e9"}},
    ]}
OBS = {
    "resourceType": "Bundle", "total": 3,
    "entry": [
        {"resource": {"resourceType": "Observation", "id": "o1", "subject": {"reference": "Patient/p1"},
                      "effectiveDateTime": "", "effectivePeriod": {"start": "2024-01-01"},
                      "valueQuantity": {"value": 1.5, "unit": "mg"},
                      "component": [{"code": {"coding": [{"code": "c1"}]}, "valueQuantity": {"value": 2}}]}},
        {"resource": {"resourceType": "Observation", "id": "o2",
                      "subject": {"reference": "https://h/Patient/p2"}, "encounter": {"reference": None}}},
        {"resource": {"resourceType": "Observation", "id": "o3", "subject": None}},
    ]}


def test_flatten_edge_cases(spark, tmp_path):
    root = str(tmp_path / "raw")
    _write_pages(root, "Patient", "2024-01-01", [PATIENTS])
    _write_pages(root, "Observation", "2024-01-01", [OBS])
    pages = read_pages(spark, root)
    ents = entries(pages)
    pat = {r.patient_id: r for r in flatten(ents, "Patient").collect()}
    assert set(pat) == {"p1", "p2", "p3"}                         # other resource types skipped
    assert pat["p1"].given_name == "A B" and pat["p1"].phone == "2" and pat["p1"].email == "e"
    assert pat["p1"].language is None and pat["p1"].active is True
    assert pat["p2"].given_name is None and pat["p3"].family_name is None
    obs = {r.observation_id: r for r in flatten(ents, "Observation").collect()}
    assert obs["o1"].effective_datetime == "2024-01-01" and obs["o1"].component_value == 2.0
    assert obs["o1"].patient_id == "p1" and obs["o2"].patient_id == "https://h/p2"
    assert obs["o2"].encounter_id == "" and obs["o3"].patient_id == ""
    audit = {r.resource_name: r for r in page_audit(pages, "r").collect()}
    assert audit["Patient"].page_number == 1 and audit["Patient"].next_url == "http://x/n"
    assert audit["Observation"].api_url.startswith("file:")      # no self link: file path
    tot = {r.resource_name: (r.pages, r.records) for r in page_totals(pages).collect()}
    assert tot == {"Patient": (1, 4), "Observation": (1, 3)}


def test_missing_raw_folder_is_empty(spark, tmp_path):
    assert read_pages(spark, str(tmp_path / "none")).count() == 0


def test_bronze_dedup_latest_per_day(spark, tmp_path):
    root = str(tmp_path / "raw")
    b1 = {"resourceType": "Bundle", "entry": [
        {"resource": {"resourceType": "Patient", "id": "p1", "gender": "f", "meta": {"lastUpdated": "t1"}}},
        {"resource": {"resourceType": "Patient", "id": "p1", "gender": "m", "meta": {"lastUpdated": "t2"}}}]}
    _write_pages(root, "Patient", "2024-01-01", [b1])
    frames = bronze_frames(read_pages(spark, root))
    rows = frames["Patient"].collect()
    assert len(rows) == 1 and rows[0].gender == "m" and str(rows[0].ingest_date) == "2024-01-01"


def test_request_grid(spark):
    g = request_grid(spark, "http://h", "2024-01-01", "2024-01-03").collect()
    assert len(g) == 8 and any(r.url == "http://h/Patient?_lastUpdated=ge2024-01-01T00:00:00Z"
                                        "&_lastUpdated=lt2024-01-02T00:00:00Z&_count=50&_format=json" for r in g)
    assert request_grid(spark, "http://h", "2024-01-03", "2024-01-03").count() == 0


def test_context_paths():
    c = Context("/r")
    assert (c.raw(), c.bronze("Patient"), c.silver("Encounter"), c.gold()) == \
        ("/r/raw", "/r/bronze/patient", "/r/silver/encounter", "/r/gold")


def test_silver_load_resumes_after_last_committed_day(spark, scratch):
    import datetime as dt
    from lakelayer.plans.clinical import load_bronze, load_silver
    from lakelayer.sinks.tables import HistoryStore, store_loaded_through, store_table
    root = scratch("med")
    ctx = Context(root)
    for i, given in enumerate(["A", "B", "B", "C"]):
        day = (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat()
        _write_pages(ctx.raw(), "Patient", day, [{"resourceType": "Bundle", "entry": [
            {"resource": {"resourceType": "Patient", "id": "p1", "name": [{"family": "F", "given": [given]}]}}]}])
    load_bronze(spark, ctx)
    clock = lambda d: F.to_timestamp(d)
    load_silver(spark, ctx, "2024-01-01", "2024-01-03", clock)      # first load: closed form, days 1-2
    load_silver(spark, ctx, "2024-01-01", "2024-01-05", clock)      # rerun over a wider range: days 3-4 only
    store = HistoryStore(ctx.silver("Patient"))
    assert store_loaded_through(spark, store) == "2024-01-04"
    got = sorted((r.given_name, r.record_version, r.is_current) for r in store_table(spark, store).collect())
    assert got == [("A", 1, False), ("B", 2, False), ("C", 3, True)]


def test_silver_takes_corrected_and_late_days(spark, scratch):
    from lakelayer.plans.clinical import load_bronze, load_silver
    from lakelayer.sinks.tables import HistoryStore, store_generation, store_table
    ctx = Context(scratch("med"))
    clock = lambda d: F.to_timestamp(d)
    store = HistoryStore(ctx.silver("Patient"))

    def load(*days):
        for day, given in days:
            _write_pages(ctx.raw(), "Patient", day, [{"resourceType": "Bundle", "entry": [
                {"resource": {"resourceType": "Patient", "id": "p1", "name": [{"family": "F", "given": [given]}]}}]}])
        load_bronze(spark, ctx)
        load_silver(spark, ctx, "2024-01-01", "2024-01-05", clock)
        rows = store_table(spark, store).collect()
        return sorted((r.record_version, r.given_name, str(r.effective_start_date), r.is_current) for r in rows)

    assert load(("2024-01-01", "A")) == [(1, "A", "2024-01-01", True)]       # the other days of the range are missing
    fixed = load(("2024-01-01", "B"))
    assert fixed == [(1, "A", "2024-01-01", False), (2, "B", "2024-01-01", True)]
    gen = store_generation(spark, store)
    assert load(("2024-01-01", "B")) == fixed and store_generation(spark, store) == gen   # nothing new, nothing written
    third = load(("2024-01-03", "C"))
    assert third == [(1, "A", "2024-01-01", False), (2, "B", "2024-01-01", False), (3, "C", "2024-01-03", True)]
    late = load(("2024-01-02", "D"))                                         # merged, then the day behind it again
    assert late == [(1, "A", "2024-01-01", False), (2, "B", "2024-01-01", False), (3, "C", "2024-01-03", False),
                    (4, "D", "2024-01-02", False), (5, "C", "2024-01-03", True)]


def test_raw_pages_round_trip_compressed(spark, scratch):
    from lakelayer.sinks.tables import write_raw_pages
    body = json.dumps({"resourceType": "Bundle", "total": 1,
                       "entry": [{"resource": {"resourceType": "Patient", "id": "p9"}}]})
    pages = spark.createDataFrame([("Patient", "2024-01-02", body)], "resource string, date string, body string")
    root = scratch("raw")
    write_raw_pages(pages, root, compression="gzip")
    got = flatten(entries(read_pages(spark, root, resource="Patient")), "Patient").collect()
    assert [r.patient_id for r in got] == ["p9"]


def test_bronze_reads_only_the_days_of_its_range(spark, scratch):
    from lakelayer.plans.clinical import load_bronze, raw_days
    from lakelayer.sinks.tables import write_raw_pages
    ctx = Context(scratch("range"))
    body = '{"resourceType":"Bundle","total":1,"entry":[{"resource":{"resourceType":"Patient","id":"%s"}}]}'
    write_raw_pages(spark.createDataFrame([("Patient", f"2024-01-0{k}", body % k) for k in (1, 2, 3)],
                                          "resource string, date string, body string"), ctx.raw())
    pages = raw_days(read_pages(spark, ctx.raw(), resource="Patient"), "2024-01-02", "2024-01-03")
    assert len(pages.inputFiles()) == 3 and pages.count() == 1
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-02" in plan.split("PartitionFilters: [")[1].split("]")[0]
    load_bronze(spark, ctx, start="2024-01-02", end="2024-01-03")
    assert [r.patient_id for r in spark.read.parquet(ctx.bronze("Patient")).collect()] == ["2"]
    load_bronze(spark, ctx, start="2024-01-03")
    assert sorted(r.patient_id for r in spark.read.parquet(ctx.bronze("Patient")).collect()) == ["2", "3"]


def test_partition_replace_writes_few_files(spark, scratch):
    from lakelayer.sinks.tables import replace_partitions
    path = scratch("few")
    df = spark.range(10_000).repartition(32).selectExpr("id", "id % 30 AS day")
    replace_partitions(df, path, ["day"])
    back = spark.read.parquet(path)
    assert back.count() == 10_000 and len(back.inputFiles()) <= 60
