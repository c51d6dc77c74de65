import datetime as dt
import random

from pyspark.sql import functions as F

from lakelayer.operators.scd import scd1_apply, scd2_apply
from lakelayer.sources.files import with_rescued_data
from lakelayer.streaming.cdc_flow import CdcTarget, read_target, run_cdc_stream
from lakelayer.streaming.ingest import file_stream, preview, run_to_parquet

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k long, seq timestamp_ntz, v string"


def _rows(seed, n=200):
    rng = random.Random(seed)
    return [(rng.randint(1, 8), T0 + dt.timedelta(minutes=rng.randint(0, 5000)), rng.choice("abcd"))
            for _ in range(n)]


def test_restart_is_exactly_once_and_full_reload(spark, scratch):
    src, tgt, ck = scratch("src"), scratch("tgt"), scratch("ck")
    df = spark.createDataFrame(_rows(1), SCHEMA).dropDuplicates(["k", "seq"])
    df.limit(50).write.parquet(src)
    schema = df.schema
    first = run_to_parquet(file_stream(spark, src, schema=schema), tgt, ck)
    assert first.rows == 50 and first.batches >= 1
    again = run_to_parquet(file_stream(spark, src, schema=schema), tgt, ck)      # nothing new: no duplicates
    assert again.rows == 0
    assert spark.read.parquet(tgt).count() == 50
    df.subtract(df.limit(50)).write.mode("append").parquet(src)
    run_to_parquet(file_stream(spark, src, schema=schema), tgt, ck)
    assert spark.read.parquet(tgt).count() == df.count()
    reload = run_to_parquet(file_stream(spark, src, schema=schema), tgt, ck, full_reload=True)
    assert reload.target != tgt and spark.read.parquet(reload.target).count() == df.count()


def test_stream_cdc_equals_batch_any_split_and_order(spark, scratch):
    rows = _rows(5, 400)
    allc = spark.createDataFrame(rows, SCHEMA)
    want1 = sorted(tuple(r) for r in scd1_apply(allc, ["k"], ["seq"]).collect())
    want2 = sorted(tuple(r) for r in scd2_apply(allc, ["k"], "seq").collect())
    for order in (1, -1):
        chunks = [rows[i:i + 100] for i in range(0, len(rows), 100)][::order]
        for scd_type, want in ((1, want1), (2, want2)):
            src, ck = scratch("src"), scratch("ck")
            t = CdcTarget(root=scratch("tgt"), keys=("k",), sequence_by="seq", scd_type=scd_type)
            for ch in chunks:
                spark.createDataFrame(ch, SCHEMA).repartition(2).write.mode("append").parquet(src)
                run_cdc_stream(file_stream(spark, src, schema=allc.schema, max_files_per_trigger=1), t, ck)
            got = sorted(tuple(r) for r in read_target(spark, t).collect())
            assert got == want, (scd_type, order)


def test_schema_evolution_and_rescue(spark, scratch):
    src, loc = scratch("src"), scratch("schema")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(src + "/p1")
    s1 = file_stream(spark, src + "/p1", schema_location=loc).schema
    assert s1.fieldNames() == ["id", "v"]
    spark.createDataFrame([(2, "b", 3)], "id long, v string, extra int").write.mode("append").parquet(src + "/p1")
    s2 = file_stream(spark, src + "/p1", schema_location=loc).schema
    assert s2.fieldNames() == ["id", "v", "extra"]
    raw = spark.createDataFrame([("1", "2.5", "z"), ("x", "3", None)], "id string, d string, other string")
    declared = spark.createDataFrame([], "id long, d double").schema
    got = with_rescued_data(raw, declared).collect()
    assert got[0]["_rescued_data"] == '{"other":"z"}' and got[0].d == 2.5
    assert got[1].id is None and got[1]["_rescued_data"] == '{"id":"x"}'


def test_preview_of_stream(spark, scratch):
    src = scratch("src")
    spark.range(30).write.parquet(src)
    s = file_stream(spark, src)
    assert preview(s, 5).count() == 5


def test_bucketed_target_delete_and_retry(spark, scratch):
    from lakelayer.streaming.cdc_flow import apply_batch
    t = CdcTarget(root=scratch("tgt"), keys=("k",), sequence_by="seq", scd_type=1, delete_when="v = 'DEL'",
                  buckets=1)
    apply_batch(spark, t, spark.createDataFrame([(1, T0, "a"), (2, T0, "b")], SCHEMA), 0)
    assert sorted(r.k for r in read_target(spark, t).collect()) == [1, 2]
    dels = spark.createDataFrame([(1, T0 + dt.timedelta(hours=1), "DEL"), (2, T0 + dt.timedelta(hours=1), "DEL")],
                                 SCHEMA)
    apply_batch(spark, t, dels, 1)
    assert read_target(spark, t).count() == 0             # the emptied bucket is still replaced
    apply_batch(spark, t, dels, 1)                         # a retried batch id changes nothing
    assert read_target(spark, t).count() == 0
    late = spark.createDataFrame([(1, T0 + dt.timedelta(minutes=30), "late")], SCHEMA)
    apply_batch(spark, t, late, 2)                         # older than the delete: still deleted
    assert read_target(spark, t).count() == 0


def test_batches_read_only_their_keys_and_runs_stay_few(spark, scratch):
    """Twenty batches of five keys each: what a batch reads does not grow with the table, and late rows land in place."""
    from lakelayer.streaming.cdc_flow import apply_batch, drop_merged, merge_runs, runs
    rng = random.Random(11)
    t = CdcTarget(root=scratch("tgt"), keys=("k",), sequence_by="seq", scd_type=2, buckets=64)
    rows, reads = [], []
    first = [(k, T0 + dt.timedelta(minutes=i), f"{k}-{i}") for k in range(1000) for i in range(4)]
    apply_batch(spark, t, spark.createDataFrame(first, SCHEMA), 0)
    rows += first
    for b in range(1, 20):
        keys = rng.sample(range(1000), 5)
        batch = [(k, T0 + dt.timedelta(minutes=rng.randint(-50, 50), seconds=b), f"late{b}") for k in keys for _ in range(3)]
        held = sum(r[0] in keys for r in rows)
        m = apply_batch(spark, t, spark.createDataFrame(batch, SCHEMA), b)
        rows += batch
        reads.append((m["read"], held))
        assert m["keys"] == 5 and m["written"] <= 2 * len(batch)
    # stored rows of the keys, each perhaps in several runs, and no rows of other keys
    assert all(read <= 3 * held for read, held in reads), reads
    assert len(runs(spark, t)) <= 8
    everything = spark.createDataFrame(rows, SCHEMA)
    want = sorted(tuple(r) for r in scd2_apply(everything, ["k"], "seq").collect())
    assert sorted(tuple(r) for r in read_target(spark, t).collect()) == want
    assert apply_batch(spark, t, spark.createDataFrame(rows[-1:], SCHEMA), 19) is None       # recorded before
    merge_runs(spark, t)
    assert drop_merged(spark, t) > 0
    assert sorted(tuple(r) for r in read_target(spark, t).collect()) == want


def test_batch_from_one_file_is_dealt_out_before_it_is_sorted(spark):
    from lakelayer.streaming.cdc_flow import spread
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one = spark.range(10_000, numPartitions=1).withColumn("v", F.lit(1))
        got = spread(one).groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n"), F.sum("id").alias("s")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread(one).columns == ["id", "v"] and sum(r.s for r in got) == sum(range(10_000))
    assert len(got) > 2 and max(r.n for r in got) < 2 * 10_000 / len(got)


def test_stored_rows_of_several_runs_are_sorted_once(spark):
    from lakelayer.streaming import cdc_flow
    t = CdcTarget(root="unused", keys=("k",), sequence_by="seq", scd_type=2)
    hour = [T0 + dt.timedelta(hours=h) for h in range(4)]
    new = spark.createDataFrame([(1, hour[1], "b"), (2, hour[0], "z"), (2, hour[3], "a")], SCHEMA)
    # the same point in three runs, and points that the batch brings again with a smaller and a greater row
    held = spark.createDataFrame([(1, hour[0], "old", 1), (1, hour[0], "newest", 5), (1, hour[0], "older", 2), (1, hour[2], "c", 1),
                                  (2, hour[0], "b", 4), (2, hour[3], "y", 4)], SCHEMA + f", {cdc_flow.BATCH} long")
    got = cdc_flow._merged(t, new, held, 6, new.schema).collect()
    assert sorted(map(tuple, got)) == [(1, hour[0], "newest", hour[1]), (1, hour[1], "b", hour[2]),
                                       (2, hour[0], "z", hour[3]), (2, hour[3], "y", None)]
    plan = cdc_flow._newest(t, held)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.index("SortAggregate") < plan.index("Exchange"), plan


def test_failed_batch_is_computed_again(spark, scratch, monkeypatch):
    from lakelayer.streaming import cdc_flow
    t = CdcTarget(root=scratch("tgt"), keys=("k",), sequence_by="seq", scd_type=2, buckets=2)
    one, two = ([(1, T0 + dt.timedelta(hours=h), v) for h, v in x] for x in ([(0, "a"), (4, "c")], [(2, "b"), (6, "d")]))
    cdc_flow.apply_batch(spark, t, spark.createDataFrame(one, SCHEMA), 0)
    before = sorted(map(tuple, read_target(spark, t).collect()))

    def dies(*a, **k):
        raise RuntimeError("lost before the record")
    with monkeypatch.context() as m:
        m.setattr(cdc_flow, "_record", dies)
        try:
            cdc_flow.apply_batch(spark, t, spark.createDataFrame(two, SCHEMA), 1)
        except RuntimeError:
            pass
    assert sorted(map(tuple, read_target(spark, t).collect())) == before      # nothing of the lost batch is seen
    cdc_flow.apply_batch(spark, t, spark.createDataFrame(two, SCHEMA), 1)
    want = sorted(map(tuple, scd2_apply(spark.createDataFrame(one + two, SCHEMA), ["k"], "seq").collect()))
    assert sorted(map(tuple, read_target(spark, t).collect())) == want


def test_target_with_untracked_columns_deletes_and_added_columns(spark, scratch):
    from lakelayer.streaming.cdc_flow import apply_batch
    schema, wide = "k long, seq long, v string, w int", "k long, seq long, v string, w int, extra string"
    rows = [(k, s, v, s) for k in (1, 2) for s, v in ((1, "a"), (3, "a"), (5, "b"), (7, "DEL"), (9, "b"))]
    late = [(1, 2, "a", 0, "x"), (1, 6, "a", 0, None), (2, 8, "DEL", 0, "y"), (2, 5, "c", 0, "z"), (None, 1, "a", 0, "")]
    t = CdcTarget(root=scratch("tgt"), keys=("k",), sequence_by="seq", scd_type=2, track_except=("seq", "w", "extra"),
                  delete_when="v = 'DEL'", buckets=3)
    apply_batch(spark, t, spark.createDataFrame(rows[::2], schema), 0)
    apply_batch(spark, t, spark.createDataFrame(late, wide), 1)
    apply_batch(spark, t, spark.createDataFrame(rows[1::2], schema), 2)
    everything = spark.createDataFrame([(*r, None) for r in rows] + late, wide)
    want = scd2_apply(everything, ["k"], "seq", track_except=["seq", "w", "extra"], delete_when="v = 'DEL'")
    got = read_target(spark, t)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_state_of_dedup_within_a_delay_is_released(spark, scratch):
    """Every batch brings new keys an hour later; with a delay of ten minutes the state holds a batch's keys or so, not all."""
    from lakelayer.operators.dedup import first_seen
    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    for b in range(6):
        rows = [(1000 * b + i % 50, T0 + dt.timedelta(hours=b, seconds=i), "v") for i in range(100)]
        spark.createDataFrame(rows, SCHEMA).selectExpr("k", "CAST(seq AS timestamp) AS seq", "v").coalesce(1).write.mode("append").parquet(src)
    stream = file_stream(spark, src, max_files_per_trigger=1)
    q = (first_seen(stream, ["k"], event_time="seq", delay="10 minutes").writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(out).count() == 300 and held[-1] <= 100
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
