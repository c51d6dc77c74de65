"""What large steps move between tasks: exchanges of the plans and bytes of the landing zone."""

import os

import pytest
from pyspark.sql import functions as F

from lakelayer.plans import clinical, roles
from lakelayer.sources.bundles import entries, read_pages


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def tables(spark, scratch):
    """Orders 0 to 199 of 30 patients, with two lines each."""
    d = scratch("tables")
    spark.range(200).selectExpr(
        "id AS o_orderkey", "id % 30 AS o_custkey", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority",
        "1.5D AS o_totalprice", "TIMESTAMP_NTZ '1995-01-01 00:00:00' AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(400).selectExpr(
        "id DIV 2 AS l_orderkey", "CAST(id % 2 + 1 AS INT) AS l_linenumber", "id % 9 AS l_partkey", "id % 4 AS l_suppkey",
        "2.0D AS l_quantity", "0.1D AS l_discount", "'R' AS l_returnflag", "'O' AS l_linestatus",
        "TIMESTAMP_NTZ '1995-01-02 00:00:00' AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.range(30).selectExpr("id AS c_custkey", "concat('C#', id) AS c_name", "id % 2 AS c_nationkey", "'M' AS c_mktsegment",
                               "1.0D AS c_acctbal").write.parquet(f"{d}/customer.parquet")
    spark.sql("SELECT id AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey FROM range(2)").write.parquet(f"{d}/nation.parquet")
    spark.sql("SELECT 0L AS r_regionkey, 'R' AS r_name").write.parquet(f"{d}/region.parquet")
    return d


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange " in line]


@pytest.mark.parametrize("resource", ["Observation", "Condition"])
def test_lines_are_moved_once_on_their_way_into_pages(spark, tables, no_broadcast, resource):
    pages = clinical.bundle_pages(clinical.RESOURCE_BUILDERS[resource](spark, tables), "2024-01-01")
    assert len(exchanges(pages)) == 2, exchanges(pages)               # lines and orders, both by page
    assert pages.selectExpr("count(*) AS n").first().n == {"Observation": 25, "Condition": 4}[resource]


def test_synthesised_pages_land_compressed_and_whole(spark, tables, scratch):
    raw = scratch("raw")
    clinical.synth_raw(spark, tables, raw)
    files = [os.path.join(a, f) for a, _, fs in os.walk(raw) for f in fs if not f.startswith((".", "_"))]
    assert files and all(f.endswith(".gz") for f in files)
    read = entries(read_pages(spark, raw)).groupBy("resource_name").count()
    assert {r[0]: r[1] for r in read.collect()} == {"Patient": 30, "Encounter": 200, "Observation": 400, "Condition": 400}


def test_tasks_that_group_pages_grow_with_the_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(clinical, "ROWS_PER_TASK", 100)
    assert clinical.observation_resources(spark, tables).rdd.getNumPartitions() == 4
    assert clinical.patient_resources(spark, tables).rdd.getNumPartitions() == 1
    assert clinical._page_tasks(roles.table(spark, tables, "lineitem").limit(0)) == 1


@pytest.mark.parametrize("name", ["gold_observation", "gold_condition"])
def test_facts_find_their_visit_where_their_order_put_them(spark, tables, no_broadcast, name):
    from lakelayer.plans import gold
    role = name.removeprefix("gold_")
    got = gold.build(name, {r: roles.ROLE_FRAMES[r](spark, tables) for r in (role, "encounter", "patient")})
    by_visit = [x for x in exchanges(got) if "encounter_id" in x or "orderkey" in x]
    assert len(by_visit) == 3, by_visit                               # lines, their orders and the visits, each once
    rows = got.selectExpr("count(*) AS n", "count(enc_class) AS visits", "count(patient_name) AS people").first()
    assert tuple(rows) == (400, 400, 400)


def test_range_join_does_not_move_its_pairs(spark, no_broadcast):
    """A hundred rows meet a hundred intervals each: no exchange sees the ten thousand pairs."""
    from lakelayer.operators.ranges import range_join
    f = spark.range(100).selectExpr("id", "500 + id AS v", "map('k', id) AS m").alias("f")
    s = spark.range(100).selectExpr("id AS sid", "id % 2 AS h", "id AS lo", "1000 + id AS hi").alias("s")
    for cond, how, n in ((None, "left", 10_000), (F.expr("f.id % 4 = s.h"), "left", 2_550), (None, "inner", 10_000)):
        got = range_join(f, s, F.expr("f.v"), F.expr("s.lo"), F.expr("s.hi"), "s", cond, how)
        rows = got.select("f.id", "s.sid").collect()
        assert len(rows) == n and set(got.columns) == {"id", "v", "m", "sid", "h", "lo", "hi"}
        plan = got._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0].splitlines()
        above = [x for x in final[:next(i for i, x in enumerate(final) if "SortMergeJoin" in x)] if "Exchange" in x]
        assert not above, plan


def test_daily_loop_makes_its_snapshots_once(spark, scratch):
    """Whatever making the snapshots costs, it is paid once and not for every day."""
    from lakelayer.operators.scd import scd2_hash_history
    from lakelayer.plans.keys_io import HASH_OUT, hash_daily_loop
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = [(u, f"2024-01-0{day}", "ab"[(u * day) % 2]) for u in range(5) for day in (1, 2, 4)] + [(None, "2024-01-02", "a"), (9, None, "a")]
    snaps = (spark.createDataFrame(rows, "user_id long, day string, event_type string")
             .selectExpr("user_id", "CAST(day AS date) AS ingest_date", "event_type", "event_type AS record_hash"))
    got = hash_daily_loop(spark, snaps.mapInArrow(count, snaps.schema), "user_id", scratch("silver")).select(*HASH_OUT)
    assert made.value == len(rows)
    want = scd2_hash_history(snaps.where("user_id IS NOT NULL AND ingest_date IS NOT NULL"), "user_id").select(*HASH_OUT)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    empty = hash_daily_loop(spark, snaps.limit(0), "user_id", scratch("silver"))
    assert empty.count() == 0 and set(HASH_OUT) <= set(empty.columns)


def test_bronze_rows_are_written_where_their_latest_one_was_chosen(spark, scratch, monkeypatch):
    from lakelayer.sinks.tables import replace_partitions
    rows = spark.range(300, numPartitions=3).withColumn("ingest_date", F.lit("2024-01-01").cast("date"))
    files = {}
    for gather in (True, False):
        path = scratch(f"bronze-{gather}")
        replace_partitions(rows, path, ["ingest_date"], gather=gather)
        files[gather] = len(spark.read.parquet(path).inputFiles())
        assert spark.read.parquet(path).count() == 300
    assert files == {True: 1, False: 3}
    asked = []
    monkeypatch.setattr(clinical, "bronze_frames", lambda pages, ts: dict.fromkeys(clinical.RESOURCES, rows))
    monkeypatch.setattr(clinical, "replace_partitions", lambda df, path, cols, gather=True: asked.append(gather))
    clinical.load_bronze(spark, clinical.Context(scratch("root")))
    assert asked == [False] * len(clinical.RESOURCES)
