"""Queries that write and read back files (CDC runs, streams, partitioned tables).

Scratch folders come from ``lakelayer.session.scratch_dir`` (under the session's
``spark.checkpoint.dir``), a fresh one per call.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelayer.functions import record_hash
from lakelayer.operators.dedup import first_seen, latest_per_key
from lakelayer.operators.quality import expect_all_or_drop
from lakelayer.operators.scd import (current_rows, key_states_by_day, scd2_bootstrap, scd2_hash_history,
                                     scd2_hash_merge_parts)
from lakelayer.plans.keys_batch import RULES, SCD1_SQL, SCD2_SQL, _STAGED_SQL, staged_events
from lakelayer.plans.registry import query
from lakelayer.plans.roles import table
from lakelayer.session import scratch_dir
from lakelayer.sinks.history import ReplayedHistory, read_history, replay
from lakelayer.sinks.tables import HistoryStore, read_slice, replace_partitions, store_current, store_table, store_write
from lakelayer.sources.cdc import CdcSource, read_bronze, run_incremental
from lakelayer.plans.streams import FLOWS, gold_stream, gold_target
from lakelayer.streaming.metrics import RuleMetrics
from lakelayer.streaming.cdc_flow import CdcTarget, read_target, run_cdc_stream, suggest_buckets
from lakelayer.sources.files import evolve_schema
from lakelayer.streaming.ingest import file_stream, read_rescued_table, run_rescued, run_to_parquet

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


# ── incremental extract with files ───────────────────────────────────────────

def _frame_source(df: DataFrame, name: str, cdc_col: str, from_date: str = "") -> CdcSource:
    return CdcSource(table=name, cdc_col=cdc_col, read=lambda spark: df, from_date=from_date)


@query("cdc_two_runs", oracle="SELECT * FROM orders")
def q_cdc_two_runs(spark, d):
    """Run 1 sees the table as of 1998-01-01, run 2 the whole table; bronze = all rows once."""
    root = scratch_dir(spark, "cdc")
    orders = table(spark, d, "orders")
    early = orders.filter(F.col("o_orderdate") <= F.lit("1998-01-01").cast("timestamp_ntz"))
    run_incremental(spark, [_frame_source(early, "orders", "o_orderdate")], root, stamp="run1")
    run_incremental(spark, [_frame_source(orders, "orders", "o_orderdate")], root, stamp="run2")
    return read_bronze(spark, root, "orders")


_MULTI = (("orders", "o_orderdate", ""), ("lineitem", "l_shipdate", "1998-01-01"),
          ("events", "ts", "2024-01-15"))


@query("cdc_multi_table", oracle="""
SELECT 'orders' AS table_name, count(*) AS rows, 'succeeded' AS status FROM orders
UNION ALL SELECT 'lineitem', count(*), 'succeeded' FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-01-01'
UNION ALL SELECT 'events', count(*), 'succeeded' FROM events WHERE ts > TIMESTAMP '2024-01-15'""")
def q_cdc_multi(spark, d):
    root = scratch_dir(spark, "cdc")
    srcs = [_frame_source(table(spark, d, t), t, c, f) for t, c, f in _MULTI]
    return run_incremental(spark, srcs, root, parallel=3).select("table_name", "rows", "status")


@query("cdc_run_audit", oracle="""
SELECT 'orders' AS table_name, count(*) AS rows, 'succeeded' AS status,
       CAST(max(o_orderdate) AS VARCHAR) AS new_watermark FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'
UNION ALL SELECT 'customer', 0, 'empty', '999999999999'""")
def q_cdc_audit(spark, d):
    root = scratch_dir(spark, "cdc")
    srcs = [_frame_source(table(spark, d, "orders"), "orders", "o_orderdate", "2001-01-01"),
            _frame_source(table(spark, d, "customer"), "customer", "c_custkey", "999999999999")]
    audit = run_incremental(spark, srcs, root)
    # the watermark text is Spark's cast; normalise to the same text the oracle prints
    wm = F.when(F.col("table_name") == "orders",
                F.date_format(F.col("new_watermark").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")) \
        .otherwise(F.col("new_watermark"))
    return audit.select("table_name", "rows", "status", wm.alias("new_watermark"))


# ── bronze partitions ────────────────────────────────────────────────────────

def _events_by_day(spark, d):
    return table(spark, d, "events").withColumn("ingest_date", F.to_date("ts"))


SLICE_DAY = "2024-01-15"


@query("bronze_day_slice", oracle=f"""
SELECT *, CAST(ts AS DATE) AS ingest_date FROM events WHERE CAST(ts AS DATE) = DATE '{SLICE_DAY}'""")
def q_bronze_day_slice(spark, d):
    path = scratch_dir(spark, "bronze")
    replace_partitions(_events_by_day(spark, d), path, ["ingest_date"])
    return read_slice(spark, path, "ingest_date", F.lit(SLICE_DAY).cast("date")).select(*EVENT_COLS, "ingest_date")


@query("bronze_partition_replace", oracle=f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN CAST(ts AS DATE) = DATE '{SLICE_DAY}' THEN value + 1 ELSE value END AS value,
       props, CAST(ts AS DATE) AS ingest_date FROM events""")
def q_bronze_replace(spark, d):
    path = scratch_dir(spark, "bronze")
    ev = _events_by_day(spark, d)
    replace_partitions(ev, path, ["ingest_date"])
    day = ev.filter(F.col("ingest_date") == F.lit(SLICE_DAY).cast("date")) \
        .withColumn("value", F.col("value") + 1)
    replace_partitions(day, path, ["ingest_date"])
    return spark.read.parquet(path).select(*EVENT_COLS, "ingest_date")


# ── hash-based SCD2 over daily snapshots ─────────────────────────────────────

def daily_snapshots(spark, d) -> DataFrame:
    """Last event per (user, day): the user's state on that day, with its record hash."""
    ev = table(spark, d, "events").withColumn("ingest_date", F.to_date("ts"))
    snap = latest_per_key(ev.select("user_id", "ingest_date", "ts", "event_type"),
                          ["user_id", "ingest_date"], ["ts"]).drop("ts")
    return snap.withColumn("record_hash", record_hash(snap))


def _clock(day_col):
    return F.to_timestamp(day_col)


HASH_OUT = ["user_id", "event_type", "ingest_date", "effective_start_date", "effective_end_date",
            "is_current", "record_version"]

_DAYS_SQL = ("d AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, ts) AS event_type "
             "FROM events GROUP BY 1, 2)")
HASH_HISTORY_SQL = f"""
WITH {_DAYS_SQL},
l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM d),
s AS (SELECT user_id, day, event_type FROM l WHERE prev IS NULL OR prev <> event_type)
SELECT user_id, event_type, day AS ingest_date, day AS effective_start_date,
       CAST(lead(day) OVER w - INTERVAL 1 DAY AS DATE) AS effective_end_date,
       lead(day) OVER w IS NULL AS is_current,
       CAST(row_number() OVER w AS INTEGER) AS record_version
FROM s WINDOW w AS (PARTITION BY user_id ORDER BY day)"""


@query("scd2_hash_multi_day", oracle=HASH_HISTORY_SQL)
def q_scd2_hash_multi(spark, d):
    return scd2_hash_history(daily_snapshots(spark, d), "user_id", clock=_clock).select(*HASH_OUT)


def hash_daily_loop(spark: SparkSession, snaps: DataFrame, key: str, root: str) -> DataFrame:
    """Apply the daily hash merge day after day; each day writes its closed rows and a new
    current generation (``HistoryStore``), so a day costs current rows + batch. The snapshots are made once and kept by
    day; otherwise every day would make its own from the whole input."""
    kept = scratch_dir(spark, "snapshots")
    replace_partitions(snaps, kept, ["ingest_date"])
    snaps = spark.read.schema(snaps.schema).parquet(kept).select(*snaps.columns)
    bounds = snaps.agg(F.min("ingest_date").alias("s"), F.max("ingest_date").alias("e")).first()
    store = HistoryStore(root)
    if bounds["s"] is None:
        return scd2_bootstrap(snaps)
    day, gen, current = bounds["s"], 0, scd2_bootstrap(snaps)
    while day <= bounds["e"]:
        batch = snaps.filter(F.col("ingest_date") == F.lit(day))
        closed, fresh = scd2_hash_merge_parts(current, batch, key, F.lit(day), load_ts=_clock(F.lit(day)))
        store_write(spark, store, closed, fresh, gen, loaded_through=day.isoformat())
        current = store_current(spark, store, gen)          # the generation just committed
        day, gen = day + _dt.timedelta(days=1), gen + 1
    return store_table(spark, store)


def _replayed(spark, loads: list[DataFrame]) -> DataFrame:
    """A history brought up to one state of the daily folders after the other; a state is written and read as bronze."""
    h = ReplayedHistory(scratch_dir(spark, "replayed"), "user_id", buckets=4)
    for snaps in loads:
        bronze = scratch_dir(spark, "bronze-days")
        replace_partitions(snaps, bronze, ["ingest_date"])
        replay(spark, h, spark.read.parquet(bronze), clock=_clock)
    return read_history(spark, h).select(*HASH_OUT)


def _day(text: str):
    return F.lit(text).cast("date")


@query("silver_late_day", oracle=HASH_HISTORY_SQL)
def q_silver_late_day(spark, d):
    """2024-01-10 arrives after every other day."""
    snaps = daily_snapshots(spark, d)
    return _replayed(spark, [snaps.where(F.col("ingest_date") != _day("2024-01-10")), snaps])


@query("silver_same_day_reload", oracle=HASH_HISTORY_SQL)
def q_silver_same_day_reload(spark, d):
    """2024-01-08 first comes without a third of its users and with wrong values for another third, then right."""
    snaps = daily_snapshots(spark, d)
    on = F.col("ingest_date") == _day("2024-01-08")
    wrong = snaps.where(~(on & (F.col("user_id") % 3 == 0))).withColumn(
        "event_type", F.when(on & (F.col("user_id") % 3 == 1), "wrong").otherwise(F.col("event_type")))
    return _replayed(spark, [wrong.withColumn("record_hash", record_hash(wrong.drop("record_hash"))), snaps])


@query("silver_gap_first_load", oracle=HASH_HISTORY_SQL)
def q_silver_gap_first_load(spark, d):
    """The first load holds 2024-01-10 to 2024-01-20 without the 15th; the days before, the gap and the rest follow."""
    snaps = daily_snapshots(spark, d)
    day = F.col("ingest_date")
    middle = (day >= _day("2024-01-10")) & (day <= _day("2024-01-20")) & (day != _day("2024-01-15"))
    return _replayed(spark, [snaps.where(middle), snaps.where(middle | (day < _day("2024-01-10"))), snaps])


@query("scd2_hash_daily", oracle=HASH_HISTORY_SQL)
def q_scd2_hash_daily(spark, d):
    root = scratch_dir(spark, "silver")
    return hash_daily_loop(spark, daily_snapshots(spark, d), "user_id", root).select(*HASH_OUT)


@query("scd2_current_view", oracle=f"""
WITH {_DAYS_SQL},
l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM d),
s AS (SELECT user_id, day, event_type FROM l WHERE prev IS NULL OR prev <> event_type),
v AS (SELECT user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER)
             AS record_version, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS nxt FROM s)
SELECT user_id, event_type, record_version FROM v WHERE nxt IS NULL""")
def q_scd2_current(spark, d):
    hist = scd2_hash_history(daily_snapshots(spark, d), "user_id", clock=_clock)
    return current_rows(hist).select("user_id", "event_type", "record_version")


# ids that the batch of every day brings or changes, each against the state before it
_BY_DAY_SQL = f"""WITH {_DAYS_SQL},
p AS (SELECT *, lag(day) OVER w AS prev_day, lag(event_type) OVER w AS prev FROM d WHERE user_id IS NOT NULL
      WINDOW w AS (PARTITION BY user_id ORDER BY day)),
chg AS (SELECT day AS ingest_date, user_id FROM p WHERE prev_day IS NOT NULL AND prev <> event_type),
nw AS (SELECT day AS ingest_date, user_id FROM p WHERE prev_day IS NULL)"""


def _by_day(spark, d, *states: str) -> DataFrame:
    return (key_states_by_day(daily_snapshots(spark, d), "user_id").where(F.col("state").isin(*states))
            .select("ingest_date", "user_id"))


@query("scd2_changed_ids_by_day", oracle=_BY_DAY_SQL + " SELECT ingest_date, user_id FROM chg")
def q_changed_ids_by_day(spark, d):
    return _by_day(spark, d, "changed")


@query("scd2_new_ids_by_day", oracle=_BY_DAY_SQL + " SELECT ingest_date, user_id FROM nw")
def q_new_ids_by_day(spark, d):
    return _by_day(spark, d, "new")


@query("scd2_ids_to_insert_by_day", oracle=_BY_DAY_SQL + " SELECT * FROM chg UNION ALL SELECT * FROM nw")
def q_ids_to_insert_by_day(spark, d):
    return _by_day(spark, d, "changed", "new")


@query("scd2_empty_bootstrap", oracle="""
SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint'
                    WHEN 'DATE' THEN 'date' ELSE lower(column_type) END AS data_type, CAST(0 AS BIGINT) AS n_rows
FROM (DESCRIBE SELECT user_id, CAST(ts AS DATE) AS ingest_date, event_type, 'h' AS record_hash FROM events)
UNION ALL SELECT * FROM (VALUES ('effective_start_date', 'date', CAST(0 AS BIGINT)),
  ('effective_end_date', 'date', 0), ('is_current', 'boolean', 0), ('record_version', 'int', 0),
  ('silver_load_timestamp', 'timestamp', 0))""")
def q_scd2_bootstrap(spark, d):
    empty = scd2_bootstrap(daily_snapshots(spark, d))
    n = empty.count()
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), n) for f in empty.schema.fields],
                                 "column_name string, data_type string, n_rows long")


# ── streams ──────────────────────────────────────────────────────────────────

def _write_chunks(df: DataFrame, path: str, files: int) -> None:
    df.repartition(files).write.mode("append").parquet(path)


def _event_stream_source(spark, d, split_day: str | None = None, late_first: bool = False) -> tuple[str, list]:
    """Events as bronze files written in two arrivals (by day), each arrival several files."""
    src = scratch_dir(spark, "bronze-events")
    ev = table(spark, d, "events")
    if split_day is None:
        return src, [ev]
    cut = F.to_date("ts") < F.lit(split_day).cast("date")
    early, late = ev.filter(cut), ev.filter(~cut)
    return src, ([late, early] if late_first else [early, late])


@query("stream_ingest_passthrough", oracle="SELECT * FROM events")
def q_stream_passthrough(spark, d):
    src, chunks = _event_stream_source(spark, d, "2024-01-15")
    tgt, ck = scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    schema = table(spark, d, "events").schema
    for c in chunks:
        _write_chunks(c, src, 3)
        run_to_parquet(file_stream(spark, src, schema=schema, max_files_per_trigger=2), tgt, ck)
    return spark.read.parquet(tgt)


@query("stream_dedup_keys", oracle="""
SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def q_stream_dedup(spark, d):
    """The first row of a key that a stream sees survives: the first arrival holds each user's first event, the second
    arrival all others."""
    src, tgt, ck = scratch_dir(spark, "bronze-events"), scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    ev = table(spark, d, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    numbered = ev.withColumn("n", F.row_number().over(order))
    for c in (numbered.where("n = 1"), numbered.where("n > 1")):
        _write_chunks(c.drop("n"), src, 3)
        s = first_seen(file_stream(spark, src, schema=ev.schema, max_files_per_trigger=2), ["user_id"])
        run_to_parquet(s, tgt, ck)
    return spark.read.parquet(tgt).select("event_id", "user_id")


@query("expect_stream_metrics", oracle=f"""
WITH s AS ({_STAGED_SQL})
SELECT rule, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(failed) AS BIGINT) AS failed FROM (
""" + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS rows, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed FROM s"
                         for n, p in RULES.items()) + ") GROUP BY rule")
def q_expect_stream_metrics(spark, d):
    """Counters of every rule and micro-batch, stored by a streaming listener; summed over the batches."""
    src, metrics = scratch_dir(spark, "bronze-staged"), scratch_dir(spark, "metrics")
    tgt, ck = scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    staged = staged_events(spark, d)
    _write_chunks(staged, src, 4)
    stream = file_stream(spark, src, schema=staged.schema, max_files_per_trigger=1)
    with RuleMetrics(spark, metrics) as listener:
        run_to_parquet(expect_all_or_drop(listener.watch(stream, RULES), RULES), tgt, ck)
    return listener.read().groupBy("rule").agg(F.sum("rows").alias("rows"), F.sum("failed").alias("failed"))


@query("expect_stream_drop", oracle=f"""
WITH s AS ({_STAGED_SQL})
SELECT * FROM s WHERE coalesce(user_id IS NOT NULL, false) AND coalesce(value >= 1.0, false)""")
def q_expect_stream(spark, d):
    src = scratch_dir(spark, "bronze-staged")
    tgt, ck = scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    staged = staged_events(spark, d)
    _write_chunks(staged, src, 4)
    s = expect_all_or_drop(file_stream(spark, src, schema=staged.schema, max_files_per_trigger=2), RULES)
    run_to_parquet(s, tgt, ck)
    return spark.read.parquet(tgt)


@query("schema_evolution_add_columns", oracle="""
SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 2 = 1 THEN props END AS props
FROM events""")
def q_schema_evolution(spark, d):
    src, loc = scratch_dir(spark, "bronze-evolving"), scratch_dir(spark, "schema")
    tgt, ck = scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    ev = table(spark, d, "events")
    odd = F.col("event_id") % 2 == 1
    # first arrival has no props column; the second one brings it
    _write_chunks(ev.filter(~odd).drop("props"), src, 2)
    run_to_parquet(file_stream(spark, src, schema_location=loc), tgt, ck)
    _write_chunks(ev.filter(odd), src, 2)
    run_to_parquet(file_stream(spark, src, schema_location=loc), tgt, ck)
    return spark.read.option("mergeSchema", True).parquet(tgt).select(*EVENT_COLS)


_BAD = "CASE WHEN event_id % 10 = 0 THEN concat('bad-', cast(event_id as string)) ELSE cast(value as string) END"


@query("rescued_data", oracle=f"""
WITH r AS (SELECT event_id, ts, user_id, event_type, {_BAD.replace('cast(value as string)', 'CAST(value AS VARCHAR)')}
           AS value_text, props FROM events)
SELECT event_id, ts, user_id, event_type, TRY_CAST(value_text AS DOUBLE) AS value, props,
       CASE WHEN TRY_CAST(value_text AS DOUBLE) IS NULL THEN '{{"value":"' || value_text || '"}}' END
         AS _rescued_data
FROM r""")
def q_rescued(spark, d):
    """Files whose ``value`` is a double and files whose ``value`` is text, in one stream."""
    src = scratch_dir(spark, "bronze-drift")
    tgt, ck = scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    ev = table(spark, d, "events")
    _write_chunks(ev.where("event_id % 2 = 1"), src, 2)
    _write_chunks(ev.selectExpr("event_id", "ts", "user_id", "event_type", f"{_BAD} AS value", "props")
                  .where("event_id % 2 = 0"), src, 2)
    run_rescued(spark, src, ev.schema, tgt, ck, max_files_per_trigger=3)
    return read_rescued_table(spark, tgt)


def _cdc_stream(spark, d, scd_type: int, late_first: bool) -> DataFrame:
    src, chunks = _event_stream_source(spark, d, "2024-01-15", late_first=late_first)
    root, ck = scratch_dir(spark, "gold"), scratch_dir(spark, "ckpt")
    events = table(spark, d, "events")
    schema = events.schema
    # the target is sized from the change volume it will hold
    t = CdcTarget(root=root, keys=("user_id",), sequence_by=("ts", "event_id") if scd_type == 1 else "ts",
                  scd_type=scd_type, buckets=suggest_buckets(events.count()))
    for c in chunks:
        _write_chunks(c, src, 3)
        run_cdc_stream(file_stream(spark, src, schema=schema, max_files_per_trigger=2), t, ck)
    return read_target(spark, t)


@query("scd1_stream", oracle=SCD1_SQL)
def q_scd1_stream(spark, d):
    return _cdc_stream(spark, d, 1, late_first=False).select(*EVENT_COLS)


@query("scd2_stream", oracle=SCD2_SQL)
def q_scd2_stream(spark, d):
    return _cdc_stream(spark, d, 2, late_first=False)


@query("scd2_out_of_order", oracle=SCD2_SQL)
def q_scd2_out_of_order(spark, d):
    return _cdc_stream(spark, d, 2, late_first=True)


def _gold_flow(spark, d, name: str, changes: DataFrame) -> DataFrame:
    flow = next(f for f in FLOWS if f.name == name)
    src, root = scratch_dir(spark, f"silver-{name}"), scratch_dir(spark, "gold")
    _write_chunks(changes, src, 3)
    gold_stream(flow, file_stream(spark, src, schema=changes.schema, max_files_per_trigger=2), root)
    return read_target(spark, gold_target(flow, root))


@query("gold_dimtrack", oracle="""
SELECT event_id AS track_id, track_name, updated_at, updated_at AS __START_AT,
       lead(updated_at) OVER (PARTITION BY event_id ORDER BY updated_at) AS __END_AT
FROM (SELECT event_id % 200 AS event_id, ts AS updated_at, max(event_type) AS track_name FROM events GROUP BY 1, 2)""")
def q_gold_dimtrack(spark, d):
    """The track dimension's flow over a stream of track changes."""
    return _gold_flow(spark, d, "dimtrack", table(spark, d, "events").selectExpr(
        "event_id % 200 AS track_id", "event_type AS track_name", "ts AS updated_at"))


@query("gold_dimdate", oracle="""
SELECT date_key, date, label, date AS __START_AT, lead(date) OVER (PARTITION BY date_key ORDER BY date) AS __END_AT
FROM (SELECT CAST(strftime(ts, '%Y%m') AS INTEGER) AS date_key, CAST(ts AS DATE) AS date, max(event_type) AS label
      FROM events GROUP BY 1, 2)""")
def q_gold_dimdate(spark, d):
    """The date dimension's flow: changes of a month's row by day."""
    return _gold_flow(spark, d, "dimdate", table(spark, d, "events").selectExpr(
        "CAST(date_format(ts, 'yyyyMM') AS INT) AS date_key", "CAST(ts AS DATE) AS date", "event_type AS label"))


@query("scd2_stream_late_repair", oracle=SCD2_SQL)
def q_scd2_late_repair(spark, d):
    """Ten micro-batches in which every file mixes all days, so most changes are late and split stored versions; sixteen
    buckets, runs merged on the way."""
    src, root, ck = scratch_dir(spark, "bronze-events"), scratch_dir(spark, "gold"), scratch_dir(spark, "ckpt")
    events = table(spark, d, "events")
    events.repartition(10, F.xxhash64("event_id")).write.parquet(src)
    t = CdcTarget(root=root, keys=("user_id",), sequence_by="ts", scd_type=2, buckets=16)
    run_cdc_stream(file_stream(spark, src, schema=events.schema, max_files_per_trigger=1), t, ck)
    return read_target(spark, t)


@query("schema_kept_everywhere", oracle="""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate > DATE '1998-01-01' THEN o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, CASE WHEN o_orderdate <= DATE '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def q_schema_kept(spark, d):
    """Two extract runs that each bring a column the other lacks, through bronze, a stream and its type 1 target."""
    root, gold, ck = scratch_dir(spark, "cdc"), scratch_dir(spark, "gold"), scratch_dir(spark, "ckpt")
    orders = table(spark, d, "orders")
    early = orders.where(F.col("o_orderdate") <= F.lit("1998-01-01").cast("timestamp_ntz")).drop("o_orderstatus")
    late = orders.drop("o_orderpriority")
    t = CdcTarget(root=gold, keys=("o_orderkey",), sequence_by="o_orderdate", buckets=4)
    for stamp, df in (("run1", early), ("run2", late)):
        run_incremental(spark, [_frame_source(df, "orders", "o_orderdate")], root, stamp=stamp)
        schema = evolve_schema(spark, f"{root}/bronze/orders/orders_{stamp}", f"{gold}/stream-schema")
        run_cdc_stream(file_stream(spark, f"{root}/bronze/orders/*", schema=schema), t, ck)
    # the extract's own table must tell the same of the two columns
    bronze = read_bronze(spark, root, "orders").select("o_orderkey", F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    both = read_target(spark, t).join(bronze, "o_orderkey")
    return (both.where(F.col("o_orderstatus").eqNullSafe(F.col("s")) & F.col("o_orderpriority").eqNullSafe(F.col("p")))
            .select(*orders.columns))
