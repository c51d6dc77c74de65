import datetime as dt
import random
from collections import Counter

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakelayer.operators.ordered import ISLAND, SEGMENT, scan, segmented
from lakelayer.operators.scd import (END_AT, START_AT, quarantine, scd1_apply, scd2_apply, scd2_bootstrap,
                                     scd2_hash_history, scd2_hash_merge)

T0 = dt.datetime(2024, 1, 1)


def _changes(spark, rows):
    return spark.createDataFrame(rows, "k long, seq timestamp_ntz, v string")


def test_scd1_latest_wins_order_independent_and_ties(spark):
    rows = [(1, T0, "a"), (1, T0 + dt.timedelta(hours=1), "b"), (2, T0, "x"), (2, T0, "y"),
            (None, T0, "q"), (3, None, "z")]
    a = scd1_apply(_changes(spark, rows), ["k"], ["seq"])
    b = scd1_apply(_changes(spark, list(reversed(rows))), ["k"], ["seq"])
    got = sorted(tuple(r) for r in a.collect())
    assert got == sorted(tuple(r) for r in b.collect())
    assert got == [(1, T0 + dt.timedelta(hours=1), "b"), (2, T0, "y")]  # tie -> greatest row
    assert quarantine(_changes(spark, rows), ["k"], "seq").count() == 2


def test_scd1_delete(spark):
    rows = [(1, T0, "a"), (1, T0 + dt.timedelta(hours=1), "DELETE"), (2, T0, "x")]
    got = scd1_apply(_changes(spark, rows), ["k"], ["seq"], delete_when="v = 'DELETE'")
    assert [r.k for r in got.collect()] == [2]


def test_scd2_intervals_and_invariants(spark):
    rng = random.Random(7)
    rows = [(rng.randint(1, 5), T0 + dt.timedelta(minutes=rng.randint(0, 3000)), rng.choice("abc"))
            for _ in range(300)]
    hist = scd2_apply(_changes(spark, rows), ["k"], "seq").collect()
    by_key = {}
    for r in hist:
        by_key.setdefault(r.k, []).append(r)
    for k, vs in by_key.items():
        vs.sort(key=lambda r: r[START_AT])
        assert sum(r[END_AT] is None for r in vs) == 1          # one open version
        for a, b in zip(vs, vs[1:]):
            assert a[END_AT] == b[START_AT]                    # contiguous, no overlap
    assert len(hist) == len({(k, s) for k, s, _ in rows})      # one version per (key, seq)


def test_scd2_delete_closes_version(spark):
    rows = [(1, T0, "a"), (1, T0 + dt.timedelta(hours=1), "DEL"), (1, T0 + dt.timedelta(hours=2), "b")]
    got = sorted(scd2_apply(_changes(spark, rows), ["k"], "seq", delete_when="v = 'DEL'").collect(),
                 key=lambda r: r[START_AT])
    assert [(r.v, r[END_AT]) for r in got] == [("a", T0 + dt.timedelta(hours=1)), ("b", None)]


def test_scd2_track_except_collapses(spark):
    rows = [(1, T0, "a", 1.0), (1, T0 + dt.timedelta(hours=1), "a", 2.0), (1, T0 + dt.timedelta(hours=2), "b", 3.0),
            (1, T0 + dt.timedelta(hours=3), "a", 4.0)]
    df = spark.createDataFrame(rows, "k long, seq timestamp_ntz, v string, w double")
    got = sorted(scd2_apply(df, ["k"], "seq", track_except=["seq", "w"]).collect(), key=lambda r: r[START_AT])
    assert [(r.v, r.w, r[START_AT], r[END_AT]) for r in got] == [
        ("a", 2.0, T0, T0 + dt.timedelta(hours=2)),
        ("b", 3.0, T0 + dt.timedelta(hours=2), T0 + dt.timedelta(hours=3)),
        ("a", 4.0, T0 + dt.timedelta(hours=3), None)]


SEQUENCES = {"timestamp": "seq", "text": "concat('s', lpad(i, 6, '0'))", "decimal": "cast(i / 7 as decimal(20,6))",
             "epoch ms": "unix_millis(timestamp(seq))", "double": "i / 3D", "struct": "named_struct('a', i div 10, 'b', i)"}


@pytest.mark.parametrize("kind", SEQUENCES)
def test_segmented_scan_equals_plain_window_on_hot_key(spark, kind):
    # one key holds most rows; a null key is a key; any orderable type
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.7 else rng.choice([None, *range(1, 9)]), T0 + dt.timedelta(seconds=i * 97), i,
             rng.random()) for i in range(2000)]
    df = (spark.createDataFrame(rows, "k long, t timestamp_ntz, i long, x double").withColumnRenamed("t", "seq")
          .withColumn("seq", F.expr(SEQUENCES[kind])).withColumn("one", F.lit(1)).repartition(5))
    w = Window.partitionBy("k").orderBy("seq")
    b = (df.withColumn("_prev_x", F.lag("x").over(w)).withColumn("_next_seq", F.lead("seq").over(w))
         .withColumn("n", F.sum("one").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    cols = ["k", "i", "x", "_prev_x", "_next_seq", "n"]
    want = Counter(tuple(r) for r in b.select(cols).collect())
    for cuts in (1, 16, 300):
        cut = segmented(df, ["k"], ["seq"], cuts=cuts)
        a = scan(cut, ["k"], ["seq"], prev_cols=["x"], next_cols=["seq"], island_of="i")     # i differs on every row
        a = a.withColumnRenamed(ISLAND, "n")
        assert Counter(tuple(r) for r in a.select(cols).collect()) == want, cuts
    shares = [r["count"] for r in cut.where("k = 0").groupBy(SEGMENT).count().collect()]
    assert len(shares) > 100 and max(shares) < 100               # the hot key is dealt out about evenly
    assert segmented(df.where("false"), ["k"], ["seq"]).collect() == []


def _snap(spark, rows):
    df = spark.createDataFrame(rows, "id string, v string, ingest_date date")
    from lakelayer.functions import record_hash
    return df.withColumn("record_hash", record_hash(df))


def _clock(day):
    return F.to_timestamp(day)


def _loop(spark, snaps, days):
    silver = scd2_bootstrap(snaps)
    for d in days:
        silver = scd2_hash_merge(silver, snaps.filter(F.col("ingest_date") == F.lit(d)), "id", F.lit(d),
                                 load_ts=_clock(F.lit(d)))
        silver = spark.createDataFrame(silver.collect(), silver.schema)  # fixed snapshot per day
    return silver


def test_hash_merge_rules(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [("a", "x", d1), ("b", "y", d1), ("c", "z", d1), ("a", "x", d2), ("b", "Y", d2), ("n", "w", d2)]
    s = {(r.id, r.record_version): r for r in _loop(spark, _snap(spark, rows), [d1, d2]).collect()}
    assert s[("a", 1)].is_current and s[("a", 1)].effective_end_date is None          # unchanged: no-op
    assert not s[("b", 1)].is_current and s[("b", 1)].effective_end_date == d1      # expired day-1
    assert s[("b", 2)].is_current and s[("b", 2)].effective_start_date == d2
    assert s[("c", 1)].is_current                                                     # absent: untouched
    assert s[("n", 1)].effective_start_date == d2 and ("a", 2) not in s


def test_hash_merge_same_day_twice(spark):
    d1 = dt.date(2024, 1, 1)
    first = _snap(spark, [("a", "x", d1)])
    silver = scd2_hash_merge(scd2_bootstrap(first), first, "id", F.lit(d1))
    again = scd2_hash_merge(silver, _snap(spark, [("a", "y", d1)]), "id", F.lit(d1))
    r = {x.record_version: x for x in again.collect()}
    assert r[1].effective_end_date == dt.date(2023, 12, 31) and r[2].effective_start_date == d1
    same = scd2_hash_merge(silver, first, "id", F.lit(d1))
    assert same.count() == 1                                                          # re-run: no-op


def test_hash_history_equals_daily_loop(spark):
    rng = random.Random(11)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    rows = [(f"id{i}", rng.choice("pq"), d) for d in days for i in range(12) if rng.random() < 0.7]
    snaps = _snap(spark, rows)
    cols = ["id", "v", "ingest_date", "effective_start_date", "effective_end_date", "is_current",
            "record_version", "silver_load_timestamp"]
    loop = sorted(tuple(r) for r in _loop(spark, snaps, days).select(cols).collect())
    closed = sorted(tuple(r) for r in scd2_hash_history(snaps, "id", clock=_clock).select(cols).collect())
    assert loop == closed


def test_segments_do_not_change_histories(spark):
    rng = random.Random(9)
    rows = [(0 if rng.random() < 0.6 else rng.randint(1, 20), 7 if rng.random() < 0.5 else 8,
             T0 + dt.timedelta(seconds=i * 61), rng.choice("ab")) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, k2 int, seq timestamp_ntz, v string")
    snaps = _snap(spark, [(f"id{i % 3}", rng.choice("pq"), dt.date(2024, 1, 1) + dt.timedelta(days=i // 3))
                          for i in range(600)])
    cols = ["id", "effective_start_date", "effective_end_date", "record_version", "is_current"]

    def histories():
        out = [scd2_apply(df, keys, "seq", track_except=te) for keys in (["k"], ["k", "k2"]) for te in (None, ["seq"])]
        return [sorted(map(str, x.collect())) for x in [*out, scd2_hash_history(snaps, "id").select(cols)]]

    found = []
    for cuts in ("1", "400"):
        spark.conf.set("lakelayer.segmentCuts", cuts)
        try:
            found.append(histories())
        finally:
            spark.conf.unset("lakelayer.segmentCuts")
    assert found[0] == found[1]


def test_no_job_runs_while_the_plan_is_built(spark):
    ran = []
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), F.lit("v").alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building a plan")
    try:
        scd2_apply(df, ["k"], "seq", track_except=["seq"])
        ran = tracker.getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not ran


def test_latest_row_with_map_and_variant_columns(spark):
    from lakelayer.operators.dedup import latest_per_key
    df = spark.sql("""SELECT * FROM VALUES (1, 1, map('a', 1), 'x'), (1, 2, map('b', 2), 'y'), (1, 2, map('b', 3), 'y'),
                      (2, 1, map('c', 1), NULL), (3, NULL, NULL, 'z') AS t(k, seq, m, v)""")
    df = df.withColumn("var", F.parse_json(F.to_json("m")))
    got = {r.k: (r.seq, r.m, r.v) for r in latest_per_key(df, ["k"], ["seq"]).collect()}
    assert got == {1: (2, {"b": 3}, "y"), 2: (1, {"c": 1}, None), 3: (None, None, "z")}
    assert latest_per_key(df.select("k"), ["k"], []).count() == 3
    scd1 = scd1_apply(df, ["k"], ["seq"])
    assert {r.k: r.m for r in scd1.collect()} == {1: {"b": 3}, 2: {"c": 1}}
    versions = scd2_apply(df, ["k"], "seq").select("k", "m", START_AT, END_AT).collect()
    assert sorted((r.k, str(r.m), r[START_AT], r[END_AT]) for r in versions) == [
        (1, "{'a': 1}", 1, 2), (1, "{'b': 3}", 2, None), (2, "{'c': 1}", 1, None)]


def test_hash_merge_same_day_replace(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = _snap(spark, [("a", "x", d1)])
    silver = scd2_hash_merge(scd2_bootstrap(first), first, "id", F.lit(d1))
    silver = spark.createDataFrame(silver.collect(), silver.schema)
    again = scd2_hash_merge(silver, _snap(spark, [("a", "y", d1)]), "id", F.lit(d1), same_day="replace").collect()
    assert [(r.v, r.record_version, r.is_current, r.effective_start_date) for r in again] == [("y", 1, True, d1)]
    nxt = scd2_hash_merge(silver, _snap(spark, [("a", "y", d2)]), "id", F.lit(d2), same_day="replace").collect()
    assert sorted((r.v, r.record_version, r.is_current) for r in nxt) == [("x", 1, False), ("y", 2, True)]


def test_history_store_daily_equals_closed_form(spark, scratch):
    from lakelayer.operators.scd import scd2_hash_merge_parts
    from lakelayer.sinks.tables import HistoryStore, store_current, store_table, store_write
    rng = random.Random(21)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    snaps = _snap(spark, [(f"id{i}", rng.choice("pq"), d) for d in days for i in range(10) if rng.random() < 0.75])
    store = HistoryStore(scratch("silver"))
    first = scd2_hash_history(snaps.filter(F.col("ingest_date") < days[3]), "id", clock=_clock)
    store_write(spark, store, first.filter(~F.col("is_current")), first.filter(F.col("is_current")), 0)
    for gen, d in enumerate(days[3:], start=1):
        closed, cur = scd2_hash_merge_parts(store_current(spark, store), snaps.filter(F.col("ingest_date") == d),
                                            "id", F.lit(d), load_ts=_clock(F.lit(d)))
        store_write(spark, store, closed, cur, gen)
    store_write(spark, store, closed, cur, gen)                  # re-running the last day changes nothing
    cols = ["id", "v", "ingest_date", "effective_start_date", "effective_end_date", "is_current",
            "record_version", "silver_load_timestamp"]
    got = sorted(tuple(r) for r in store_table(spark, store).select(cols).collect())
    want = sorted(tuple(r) for r in scd2_hash_history(snaps, "id", clock=_clock).select(cols).collect())
    assert got == want


def test_key_states_by_day_cover_every_day(spark):
    from lakelayer.operators.scd import key_states, key_states_by_day
    rng = random.Random(23)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(8)]
    rows = [(f"id{i}", rng.choice("pq"), d) for d in days for i in range(12) if d >= days[i % 7] and rng.random() < 0.7]
    snaps = _snap(spark, rows + [(None, "p", days[2]), ("late", "p", days[-1])])
    want = set()
    for d in days:
        before = scd2_hash_history(snaps.filter((F.col("ingest_date") < d) & F.col("id").isNotNull()), "id", clock=_clock)
        batch = snaps.filter((F.col("ingest_date") == d) & F.col("id").isNotNull())
        want |= {(d, r.id, r.state) for r in key_states(before, batch, "id").collect()}
    got = key_states_by_day(snaps, "id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert (days[-1], "late", "new") in want and {s for d, _, s in want if d == days[-1]} >= {"new", "changed"}
    spark.conf.set("lakelayer.segmentCuts", "60")
    try:
        split = {tuple(r) for r in key_states_by_day(snaps, "id").collect()}
    finally:
        spark.conf.unset("lakelayer.segmentCuts")
    assert split == want


def test_ids_by_day_hold_new_ids_and_late_days(spark):
    from lakelayer.plans.registry import QUERIES, load_all
    load_all()
    sf = "/root/testdata/sf0.001"
    new = QUERIES["scd2_new_ids_by_day"](spark, sf)
    users, last = spark.read.parquet(f"{sf}/events.parquet").agg(
        F.countDistinct("user_id"), F.max(F.to_date("ts"))).first()
    assert new.count() == new.select("user_id").distinct().count() == users > 0
    assert QUERIES["scd2_ids_to_insert_by_day"](spark, sf).where(F.col("ingest_date") == last).count() > 0
