import datetime as dt

import pytest

from lakelayer.operators.columns import dropping, with_ingest_metadata
from lakelayer.operators.scd import scd1_apply
from lakelayer.operators.star import parse_specs, star_join
from lakelayer.sources.cdc import max_watermark
from lakelayer.streaming.cdc_flow import suggest_buckets


def test_ingest_metadata_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    r = with_ingest_metadata(df, "2024-01-02", api_url="http://x", extraction_ts="2024-01-02 03:04:05",
                             load_ts="2024-01-02 04:00:00").first()
    assert r.ingest_date == dt.date(2024, 1, 2) and r.api_url == "http://x"
    assert r.extraction_timestamp == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.bronze_load_timestamp == dt.datetime(2024, 1, 2, 4, 0, 0)
    assert dropping(["api_url"])(with_ingest_metadata(df, "2024-01-02", api_url="u")).columns[-1] != "api_url"


def test_max_watermark(spark):
    df = spark.createDataFrame([(1,), (5,), (3,)], "c int")
    r = max_watermark(df, "c").first()
    assert (r.rows, r.new_watermark) == (3, "5")


def test_star_specs(spark):
    f = spark.createDataFrame([(1, 10)], "id int, d int")
    d = spark.createDataFrame([(10, "x")], "d int, name string")
    specs = parse_specs([{"table": "f", "alias": "f", "cols": "f.id"},
                         {"table": "d", "alias": "d", "cols": "d.name", "condition": "f.d = d.d"}])
    assert star_join(spark, specs, {"f": f, "d": d}).collect()[0] == (1, "x")
    with pytest.raises(ValueError):
        star_join(spark, [specs[1]], {"f": f, "d": d})
    with pytest.raises(ValueError):
        star_join(spark, [specs[0], parse_specs([{"table": "d", "alias": "d", "cols": "d.name"}])[0]],
                  {"f": f, "d": d})


def test_scd1_except_columns(spark):
    df = spark.createDataFrame([(1, 1, "a", "tmp")], "k int, s int, v string, scratch string")
    assert scd1_apply(df, ["k"], ["s"], except_columns=["scratch"]).columns == ["k", "s", "v"]


def test_suggest_buckets():
    assert suggest_buckets(0) == 1 and suggest_buckets(2_000_001) == 2 and suggest_buckets(10**15) == 500_000_000


def test_no_boolean_number_conversion(spark):
    from lakelayer.operators.columns import convert_types
    df = spark.createDataFrame([(1, True, "true")], "n int, b boolean, s string")
    with pytest.raises(TypeError):
        convert_types(df, {"n": "boolean"})
    with pytest.raises(TypeError):
        convert_types(df, {"b": "int"})
    assert convert_types(df, {"s": "boolean"}).first().s is True


def test_pretty_printed_page_is_one_document_and_a_cut_page_is_quarantined(spark, scratch):
    import json

    from lakelayer.sinks.tables import write_raw_pages
    from lakelayer.sources.bundles import entries, failed_pages, page_audit, read_pages
    page = json.dumps({"resourceType": "Bundle", "total": 1,
                       "entry": [{"resource": {"resourceType": "Patient", "id": "p1"}}]}, indent=2)
    path = scratch("pretty")
    df = spark.createDataFrame([("Patient", "2024-01-01", page)], "resource string, date string, body string")
    write_raw_pages(df, path)
    pages = read_pages(spark, path)
    assert pages.count() == 1 and entries(pages).count() == 1
    cut = scratch("cut")
    write_raw_pages(df.selectExpr("resource", "date", "substring(body, 1, 60) AS body").union(df), cut)
    mixed = read_pages(spark, cut)
    assert [r.resource.id for r in entries(mixed).collect()] == ["p1"]
    audit = page_audit(mixed, "run").orderBy("status").collect()
    assert [(r.status, r.records_on_page, r.error_message is None) for r in audit] == [("failed", 0, False), ("success", 1, True)]
    assert failed_pages(mixed).first().body.startswith("{") and failed_pages(mixed).count() == 1
    assert read_pages(spark, cut, resource="Patient").where("_corrupt_record IS NOT NULL").count() == 1


def test_watermark_keeps_the_newest_record(spark, scratch):
    from lakelayer.sources.cdc import read_watermark, write_watermark
    root = scratch("wm")
    assert read_watermark(spark, root, "t") is None
    for v in ("2024-01-09", "2024-01-10", "2024-01-02"):
        write_watermark(spark, root, "t", v)
    assert read_watermark(spark, root, "t") == "2024-01-02"


def test_second_load_of_a_day_keeps_closed_rows(spark, scratch):
    import datetime as dt
    from lakelayer.sinks.tables import HistoryStore, store_table, store_write
    store = HistoryStore(scratch("hist"))
    schema = "k int, v string, effective_start_date date, effective_end_date date"
    d = dt.date
    row = lambda v, s, e: spark.createDataFrame([(1, v, s, e)], schema)
    store_write(spark, store, row("x", d(2024, 1, 1), d(2024, 1, 1)), row("y", d(2024, 1, 2), None), 1)
    store_write(spark, store, row("y", d(2024, 1, 2), d(2024, 1, 1)), row("z", d(2024, 1, 2), None), 2)
    assert sorted(r.v for r in store_table(spark, store).collect()) == ["x", "y", "z"]


def test_bucket_count_is_never_made_up_for_existing_data(spark, scratch):
    import pytest
    from lakelayer.streaming.cdc_flow import CdcTarget, apply_batch, bucket_count
    t = CdcTarget(scratch("tgt"), keys=("k",), sequence_by="s", buckets=4)
    apply_batch(spark, t, spark.createDataFrame([(1, 1)], "k int, s int"), 0)
    assert bucket_count(spark, t) == 4 == bucket_count(spark, CdcTarget(t.root, keys=("k",), sequence_by="s", buckets=9))
    path = spark._jvm.org.apache.hadoop.fs.Path(t.path("meta"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    with pytest.raises(ValueError):
        bucket_count(spark, t)


def test_stream_counts_every_batch(spark, scratch):
    from lakelayer.streaming.ingest import ingest
    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    spark.range(120).repartition(120).write.parquet(src)
    run = ingest(spark, src, out, ck, schema=spark.range(1).schema, max_files_per_trigger=1)
    assert run.rows == 120 == spark.read.parquet(out).count()
