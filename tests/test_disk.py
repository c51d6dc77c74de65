"""What queries of many steps leave on disk while they run."""

import pytest
from pyspark.sql import functions as F

from lakelayer.plans import clinical
from lakelayer.session import LEAN_DISK, lean_disk
from lakelayer.sinks.tables import HistoryStore, store_current, store_first, store_table, store_write


@pytest.fixture(scope="module")
def tables(spark):
    from lakelayer.session import scratch_dir
    d = scratch_dir(spark, "disk-tables")
    spark.range(200).selectExpr("id AS o_orderkey", "id % 30 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice",
                                "timestamp'2024-01-05' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{d}/orders.parquet")
    spark.range(400).selectExpr("id % 200 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(1 + id % 2 AS int) AS l_linenumber",
                                "1.0D AS l_quantity", "0.1D AS l_discount", "'R' AS l_returnflag", "'F' AS l_linestatus",
                                "timestamp'2024-01-06' AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.range(30).selectExpr("id AS c_custkey", "concat('C#', id) AS c_name", "id % 2 AS c_nationkey", "'M' AS c_mktsegment",
                               "1.0D AS c_acctbal").write.parquet(f"{d}/customer.parquet")
    spark.sql("SELECT id AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey FROM range(2)").write.parquet(f"{d}/nation.parquet")
    spark.sql("SELECT 0L AS r_regionkey, 'R' AS r_name").write.parquet(f"{d}/region.parquet")
    return d


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.splitlines() if f.rsplit("/", 1)[-1].startswith("shuffle_")}


def test_lean_disk_ends_with_its_block(spark):
    before = {k: spark.conf.get(k, None) for k in LEAN_DISK}
    with pytest.raises(ZeroDivisionError), lean_disk(spark):
        assert {k: spark.conf.get(k) for k in LEAN_DISK} == LEAN_DISK
        1 / 0
    assert {k: spark.conf.get(k, None) for k in LEAN_DISK} == before


def test_a_medallion_run_leaves_no_moved_rows_behind(spark, tables, scratch):
    ctx = clinical.Context(scratch("medallion"))
    clinical.synth_raw(spark, tables, ctx.raw(), "2024-01-01")
    held = shuffle_files(spark)
    gold = clinical.run_medallion(spark, ctx, "2024-01-01", "2024-01-02", clock=lambda day: F.to_timestamp(day))
    left = shuffle_files(spark) - held
    assert not [f for f in left if f.endswith(".data")], left
    assert gold["gold_observation"].count() == 400 and gold["gold_patient_health_summary"].count() == 30
    assert all(".zstd." in f for f in spark.read.parquet(ctx.bronze("Observation")).inputFiles())


def test_bronze_moves_its_hash_as_bytes(spark, tables, scratch):
    from lakelayer.functions import record_hash
    raw = scratch("raw")
    clinical.synth_raw(spark, tables, raw)
    from lakelayer.sources.bundles import read_pages
    got = clinical.bronze_frames(lambda r: read_pages(spark, raw, resource=r))["Observation"]
    assert got.where(F.col("record_hash") != record_hash(got)).count() == 0 and got.count() == 400
    assert "unhex(sha2" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("changes", [False, True])
def test_a_first_load_is_not_held_for_its_two_parts(spark, scratch, changes):
    from lakelayer.operators.scd import scd2_hash_history
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [("a", "2024-01-01", "x"), ("a", "2024-01-02", "y" if changes else "x"), ("b", "2024-01-02", "z"), ("c", "2024-01-01", None)]
    snaps = (spark.createDataFrame(rows, "id string, day string, record_hash string")
             .selectExpr("id", "CAST(day AS date) AS ingest_date", "record_hash"))
    clock = lambda day: F.to_timestamp(day)
    want, got = HistoryStore(scratch("want")), HistoryStore(scratch("got"))
    hist = scd2_hash_history(snaps, "id", clock=clock)
    store_write(spark, want, hist.filter(~F.col("is_current")), hist.filter(F.col("is_current")), 0, "2024-01-02", {"2024-01-02": "m"})
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    source = snaps.mapInArrow(count, snaps.schema)
    once = scd2_hash_history(source, "id", clock=clock)
    once.write.format("noop").mode("overwrite").save()
    per_run, read.value = read.value, 0
    store_first(spark, got, [once], "2024-01-02", {"2024-01-02": "m"})
    assert read.value == per_run * (2 if changes else 1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    for part in (store_current, store_table):
        cols = sorted(part(spark, want).columns)
        assert sorted(part(spark, got).columns) == cols
        assert sorted(map(str, part(spark, got).select(cols).collect())) == sorted(map(str, part(spark, want).select(cols).collect()))


def test_silver_and_gold_in_turns_are_the_same_rows(spark, tables, scratch, monkeypatch):
    """Late days of patients too: closed rows of several turns are all kept."""
    ctx = {n: clinical.Context(scratch("turns")) for n in ("whole", "turns")}
    rename = lambda r, res: res.withColumn("res", F.col("res").withField("gender", F.when(F.col("_k") % 4 == 0, F.lit("x")).otherwise(F.col("res.gender"))))
    out = {}
    for n, c in ctx.items():
        clinical.synth_raw(spark, tables, c.raw(), "2024-01-01")
        clinical.synth_raw(spark, tables, c.raw(), "2024-01-02", resources=["Patient"], adjust=rename)
        if n == "turns":
            monkeypatch.setattr(clinical, "ROWS_PER_TURN", 25)
        gold = clinical.run_medallion(spark, c, "2024-01-01", "2024-01-03", clock=lambda day: F.to_timestamp(day))
        silver = {f"silver_{r}": store_table(spark, HistoryStore(c.silver(r))).drop("api_url", "extraction_timestamp", "bronze_load_timestamp")
                  for r in clinical.RESOURCES}
        out[n] = {k: sorted(map(str, df.select(sorted(df.columns)).collect())) for k, df in (gold | silver).items()}
    assert out["turns"] == out["whole"]
    assert len(out["turns"]["silver_Patient"]) == 30 + 8 and len(out["turns"]["gold_observation"]) == 400


def test_a_share_is_cut_out_before_rows_move(spark, scratch):
    from lakelayer.sinks.tables import shared
    ids = spark.createDataFrame([(i,) for i in range(50)] + [(None,), (None,)], "id long")
    parts = [p.collect() for p in shared(ids, "id", 4)]
    assert sorted(len(p) for p in parts)[-1] < 52 and sum(map(len, parts)) == 52
    assert sum(any(r.id is None for r in p) for p in parts) == 1


def texts(spark, raw) -> list[str]:
    """Every page as text; the order of a page's entries is that of the task that grouped them."""
    return sorted("".join(sorted(r.value)) + r.resource_name for r in spark.read.option("basePath", raw).text(raw).collect())


def test_pages_land_in_shares_of_their_rows(spark, tables, scratch, monkeypatch):
    """A share moves its own rows only; together they are the pages that one share lands, also when a day is landed again."""
    whole, raw = scratch("whole"), scratch("raw")
    clinical.synth_raw(spark, tables, whole)
    monkeypatch.setattr(clinical, "ROWS_PER_SHARE", 150)
    moved, write = [], clinical.land_pages

    def land(pages, root, add=False):
        moved.append((pages.select("resource").distinct().collect(), add))
        write(pages, root, add)

    monkeypatch.setattr(clinical, "land_pages", land)
    for _ in range(2):
        clinical.synth_raw(spark, tables, raw)
        assert texts(spark, raw) == texts(spark, whole)
    shares = [clinical.observation_resources(spark, tables, (i, 3)).count() for i in range(3)]
    assert sum(shares) == 400 and max(shares) < 400
    assert len(moved) == 2 * (1 + 2 + 3 + 3) and all(len(r) <= 1 for r, _ in moved)


def test_pages_that_land_leave_no_moved_rows_behind(spark, tables, scratch):
    held = shuffle_files(spark)
    clinical.synth_raw(spark, tables, scratch("raw"))
    assert not [f for f in shuffle_files(spark) - held if f.endswith(".data")]


def test_a_first_share_without_pages_does_not_keep_old_ones(spark, tables, scratch, monkeypatch):
    """All rows of one page are in one share, whichever it is: the folder's old pages go with the first pages written."""
    monkeypatch.setattr(clinical, "ROWS_PER_SHARE", 6)
    raw = scratch("raw")
    for _ in range(2):
        clinical.synth_raw(spark, tables, raw, resources=["Patient"])          # 30 keys, one page, five shares
        assert spark.read.text(raw).count() == 1
    empty = scratch("empty")
    for t in ("customer", "nation", "region"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    clinical.synth_raw(spark, empty, raw, resources=["Patient"])
    assert spark.read.text(raw).count() == 1


@pytest.mark.parametrize("how", ["left", "inner"])
def test_values_outside_all_intervals_are_not_moved_for_every_level(spark, how):
    from lakelayer.operators.ranges import range_join
    nan = float("nan")
    values = [(i, float(v)) for i, v in enumerate([*range(-500, 500), nan, float("inf")])] + [(9999, None)]
    left = spark.createDataFrame(values, "id long, v double").alias("f")
    ends = [(0, 10.0, 11.0), (1, 10.0, 14.0), (2, 12.0, 20.0), (3, None, 9.0), (4, 5.0, 5.0)]
    spans = spark.createDataFrame(ends, "sid long, lo double, hi double")
    for spare, ends_ in ((spans, ends), (spans.limit(0), []), (spans.union(spark.createDataFrame([(5, 15.0, nan)], spans.schema)),
                                                              [*ends, (5, 15.0, nan)])):
        got = range_join(left, spare.alias("s"), F.expr("f.v"), F.expr("s.lo"), F.expr("s.hi"), "s", None, how).select("f.id", "s.sid")
        want = set()
        for i, v in values:
            met = [s for s, lo, hi in ends_ if v is not None and lo is not None and v == v and lo <= v
                   and (hi != hi or v < hi) and (hi != hi or lo < hi)]
            want |= {(i, s) for s in met} or ({(i, None)} if how == "left" else set())
        assert {tuple(r) for r in got.collect()} == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert not ends_ or ("min(_ll_low" in plan and "max(_ll_high" in plan)
