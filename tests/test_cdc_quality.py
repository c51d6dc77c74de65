from pyspark.sql import functions as F

from lakelayer.operators.columns import convert_types, drop_columns
from lakelayer.operators.quality import expect_all_or_drop, expect_metrics, expect_quarantine, observe_rules
from lakelayer.sources.cdc import (CdcSource, extract, read_bronze, read_watermark, run_incremental,
                                   write_watermark)
from lakelayer.sources.files import load_fixture


def _src(df, name="t", col="c", from_date=""):
    return CdcSource(table=name, cdc_col=col, read=lambda s: df, from_date=from_date)


def test_watermark_round_trip_strict_and_empty_gate(spark, scratch):
    root = scratch("cdc")
    assert read_watermark(spark, root, "t") is None
    df1 = spark.createDataFrame([(1, 10), (2, 20)], "id int, c int")
    a1 = run_incremental(spark, [_src(df1)], root, stamp="r1").first()
    assert (a1.rows, a1.new_watermark, a1.status) == (2, "20", "succeeded")
    # a row equal to the watermark is not read again (strict >), later rows are
    df2 = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "id int, c int")
    a2 = run_incremental(spark, [_src(df2)], root, stamp="r2").first()
    assert (a2.rows, a2.new_watermark) == (1, "30")
    a3 = run_incremental(spark, [_src(df2)], root, stamp="r3").first()
    assert (a3.rows, a3.status, a3.new_watermark) == (0, "empty", "30")
    assert read_watermark(spark, root, "t") == "30"
    assert sorted(r.id for r in read_bronze(spark, root, "t").collect()) == [1, 2, 4]


def test_backfill_override_and_failure_isolation(spark, scratch):
    root = scratch("cdc")
    write_watermark(spark, root, "t", "25")
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, c int")

    def boom(s):
        raise RuntimeError("source down")
    audit = run_incremental(spark, [CdcSource("bad", "c", boom), _src(df, from_date="15")], root)
    rows = {r.table_name: r for r in audit.collect()}
    assert rows["bad"].status == "failed" and "source down" in rows["bad"].error
    assert rows["t"].rows == 2 and rows["t"].old_watermark == "15"


def test_extract_filter_reaches_scan(spark, scratch):
    path = scratch("pq")
    spark.range(100).withColumn("c", F.col("id") * 2).write.parquet(path)
    plan = extract(spark.read.parquet(path), "c", "50")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c), GreaterThan(c,50)]" in plan


def test_type_conversion(spark):
    df = spark.createDataFrame([(1, "abcdefg", 2.345, "x")], "a int, s string, d double, t string")
    got = convert_types(df, {"a": "bigint", "d": "decimal(10,2)", "t": "int"}, truncate={"s": 3}).first()
    assert (got.a, got.s, float(got.d), got.t) == (1, "abc", 2.35, None)


def test_drop_columns_tolerant(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, _rescued_data int, c int")
    assert drop_columns(df, ["_RESCUED_DATA", "missing"]).columns == ["a", "c"]


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 5.0), (2, None), (3, 0.5)], "user_id int, value double")
    rules = {"r1": "user_id IS NOT NULL", "r2": "value >= 1"}
    assert [r.user_id for r in expect_all_or_drop(df, rules).collect()] == [1]
    q = {r.user_id: r.failed_rules for r in expect_quarantine(df, rules).collect()}
    assert q == {None: "r1", 2: "r2", 3: "r2"}
    m = {r.rule: (r.passed, r.failed) for r in expect_metrics(df, rules).collect()}
    assert m == {"r1": (3, 1), "r2": (2, 2)}
    observed, obs = observe_rules(df, rules)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 4, "failed_r1": 1, "failed_r2": 2}


def test_fixture_loader(spark, scratch, tmp_path):
    j = tmp_path / "f.json"
    j.write_text('[{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]')
    c = tmp_path / "f.csv"
    c.write_text("a,b\n1,x\n")
    assert load_fixture(spark, str(j)).count() == 2
    assert load_fixture(spark, str(c)).schema.simpleString() == "struct<a:string,b:string>"
    import pytest
    with pytest.raises(ValueError):
        load_fixture(spark, str(tmp_path / "f.txt"))


def test_inclusive_watermark_picks_up_late_boundary_rows(spark, scratch):
    root = scratch("cdc")
    df1 = spark.createDataFrame([(1, 10), (2, 20)], "id int, c int")
    run_incremental(spark, [_src(df1)], root, stamp="r1")
    late = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "id int, c int")
    src = CdcSource(table="t", cdc_col="c", read=lambda s: late, inclusive_key=("id",))
    a = run_incremental(spark, [src], root, stamp="r2").first()
    assert (a.rows, a.new_watermark) == (2, "30")                  # id 3 (boundary, late) and id 4
    assert sorted(r.id for r in read_bronze(spark, root, "t").collect()) == [1, 2, 3, 4]


def test_expect_or_fail(spark):
    import pytest
    from lakelayer.operators.quality import expect_or_fail
    ok = spark.createDataFrame([(1,)], "user_id int")
    assert expect_or_fail(ok, {"r1": "user_id IS NOT NULL"}).count() == 1
    bad = spark.createDataFrame([(None,)], "user_id int")
    with pytest.raises(Exception, match="expectation failed"):
        expect_or_fail(bad, {"r1": "user_id IS NOT NULL"}).collect()


def test_empty_extract_leaves_no_folder(spark, scratch):
    import os
    from lakelayer.sources.cdc import CdcSource, parquet_table, run_incremental
    src, root = scratch("src_empty"), scratch("lake_empty")
    spark.createDataFrame([(1, "2024-01-01")], "id long, c string").write.parquet(src)
    one = [CdcSource("t", "c", parquet_table(src))]
    assert run_incremental(spark, one, root, stamp="a").first().rows == 1
    second = run_incremental(spark, one, root, stamp="b").first()
    assert (second.status, second.rows, second.new_watermark) == ("empty", 0, "2024-01-01")
    assert sorted(os.listdir(f"{root}/bronze/t")) == ["t_a"]
