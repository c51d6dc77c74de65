"""Batch queries over the driver tables (no files written)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelayer.functions import (day_sequence, duration_flag, email_valid, hyphen_to_space, record_hash,
                                 upper_name)
from lakelayer.operators.columns import convert_types, drop_columns
from lakelayer.operators.dedup import latest_per_key
from lakelayer.operators.quality import expect_all_or_drop, expect_metrics, expect_quarantine
from lakelayer.operators.scd import scd1_apply, scd2_apply
from lakelayer.operators.star import JoinSpec, star_join
from lakelayer.plans import gold, roles
from lakelayer.plans.registry import query
from lakelayer.plans.roles import role_sql, table
from lakelayer.sources.bundles import request_urls
from lakelayer.sources.cdc import effective_watermark, extract

# ── gold models (role mapping in roles.py) ───────────────────────────────────

_PERSON_SQL = ("(SELECT patient_id, concat_ws(' ', given_name, family_name) AS patient_name, gender, birth_date "
               "FROM pat) USING (patient_id)")
_ROLES_CTE = (f"WITH pat AS ({role_sql('patient')}), enc AS ({role_sql('encounter')}), "
              f"obs AS ({role_sql('observation')}), cnd AS ({role_sql('condition')})")


def _silver(spark, d):
    return {k: f(spark, d) for k, f in roles.ROLE_FRAMES.items()}


@query("gold_patient", oracle=f"""{_ROLES_CTE}
SELECT {', '.join(gold.PATIENT_COLS)} FROM pat""")
def q_gold_patient(spark, d):
    return gold.gold_patient(roles.patient(spark, d))


@query("gold_encounter", oracle=f"""{_ROLES_CTE}
SELECT {', '.join(gold.ENCOUNTER_COLS)} FROM enc LEFT JOIN {_PERSON_SQL}""")
def q_gold_encounter(spark, d):
    return gold.gold_encounter(roles.encounter(spark, d), roles.patient(spark, d))


@query("gold_observation", oracle=f"""{_ROLES_CTE}
SELECT {', '.join(gold.OBSERVATION_COLS)}
FROM obs LEFT JOIN {_PERSON_SQL}
LEFT JOIN (SELECT encounter_id, class_code AS enc_class, period_start AS enc_start FROM enc) USING (encounter_id)""")
def q_gold_observation(spark, d):
    return gold.gold_observation(roles.observation(spark, d), roles.patient(spark, d), roles.encounter(spark, d))


@query("gold_condition", oracle=f"""{_ROLES_CTE}
SELECT {', '.join(gold.CONDITION_COLS)} FROM cnd LEFT JOIN {_PERSON_SQL}
LEFT JOIN (SELECT encounter_id, class_code AS enc_class FROM enc) USING (encounter_id)""")
def q_gold_condition(spark, d):
    return gold.gold_condition(roles.condition(spark, d), roles.patient(spark, d), roles.encounter(spark, d))


def summary_sql(pat: str, enc: str, obs: str, cnd: str, distinct_ids: bool = False) -> str:
    """Oracle text of the per-patient summary over four current-row queries.

    ``distinct_ids``: the facts went through bronze, which keeps one row per id
    and day, so each id counts once.
    """
    dis = "DISTINCT " if distinct_ids else ""
    return f"""WITH pat AS ({pat}), enc AS ({enc}), obs AS ({obs}), cnd AS ({cnd}),
ea AS (SELECT patient_id, count(encounter_id) AS total_encounters, min(period_start) AS first_encounter_date,
              max(period_start) AS last_encounter_date FROM enc GROUP BY patient_id),
oa AS (SELECT patient_id, count({dis}observation_id) AS total_observations FROM obs GROUP BY patient_id),
ca AS (SELECT patient_id, count({dis}condition_id) AS total_conditions,
              count({dis}CASE WHEN clinical_status = 'active' THEN condition_id END) AS active_conditions
       FROM cnd GROUP BY patient_id)
SELECT pat.patient_id, family_name, given_name, gender, birth_date, city, state, country, active,
       coalesce(total_encounters, 0) AS total_encounters, first_encounter_date, last_encounter_date,
       coalesce(total_observations, 0) AS total_observations,
       coalesce(total_conditions, 0) AS total_conditions, coalesce(active_conditions, 0) AS active_conditions
FROM pat LEFT JOIN ea ON pat.patient_id = ea.patient_id LEFT JOIN oa ON pat.patient_id = oa.patient_id
LEFT JOIN ca ON pat.patient_id = ca.patient_id"""


SUMMARY_SQL = summary_sql(role_sql("patient"), role_sql("encounter"), role_sql("observation"),
                          role_sql("condition"))


@query("gold_patient_health_summary", oracle=SUMMARY_SQL)
def q_gold_summary(spark, d):
    return gold.build_gold(_silver(spark, d))["gold_patient_health_summary"]


# ── streaming-domain cleansing ───────────────────────────────────────────────

@query("silver_user_clean", oracle="SELECT c_custkey AS user_id, upper(c_name) AS user_name FROM customer")
def q_silver_user_clean(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                              upper_name("c_name").alias("user_name"))


@query("silver_track_clean", oracle="""
SELECT o_orderkey AS track_id, regexp_replace(o_orderpriority, '-', ' ', 'g') AS track_name FROM orders""")
def q_silver_track_clean(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("track_id"),
                                            hyphen_to_space("o_orderpriority").alias("track_name"))


_DURATION = "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size * 10 END"


@query("duration_flag", oracle=f"""
WITH t AS (SELECT p_partkey AS track_id, p_name AS track_name, {_DURATION} AS duration_sec FROM part)
SELECT track_id, track_name, duration_sec,
       CASE WHEN duration_sec < 150 THEN 'low' WHEN duration_sec < 300 THEN 'medium' ELSE 'high' END
         AS durationFlag
FROM t""")
def q_duration_flag(spark, d):
    t = table(spark, d, "part").selectExpr("p_partkey AS track_id", "p_name AS track_name",
                                           f"{_DURATION} AS duration_sec")
    return t.withColumn("durationFlag", duration_flag("duration_sec"))


@query("drop_columns", oracle="SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def q_drop_columns(spark, d):
    return drop_columns(table(spark, d, "part"), ["P_BRAND", "p_type", "_rescued_data"])


_EMAIL = ("CASE c_custkey % 4 "
          "WHEN 0 THEN concat(lower(replace(c_name, '#', '.')), '@example.com') "
          "WHEN 1 THEN concat(lower(replace(c_name, '#', '.')), '.example.com') "
          "WHEN 2 THEN NULL "
          "ELSE concat(lower(replace(c_name, '#', '.')), '@example.c') END")


@query("email_valid", oracle=f"""
WITH t AS (SELECT c_custkey, {_EMAIL} AS email FROM customer)
SELECT c_custkey, email,
       coalesce(regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}'), false)
         AS is_valid
FROM t""")
def q_email_valid(spark, d):
    t = table(spark, d, "customer").selectExpr("c_custkey", f"{_EMAIL} AS email")
    return t.withColumn("is_valid", email_valid("email"))


# ── expectations ─────────────────────────────────────────────────────────────

RULES = {"rule_1": "user_id IS NOT NULL", "rule_2": "value >= 1.0"}
_STAGED_EVENTS = ("event_id", "ts", "CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id",
                  "event_type", "value", "props")
_STAGED_SQL = f"SELECT {', '.join(_STAGED_EVENTS)} FROM events"


def staged_events(spark, d):
    return table(spark, d, "events").selectExpr(*_STAGED_EVENTS)


@query("expect_all_or_drop", oracle=f"""
WITH s AS ({_STAGED_SQL})
SELECT * FROM s WHERE coalesce(user_id IS NOT NULL, false) AND coalesce(value >= 1.0, false)""")
def q_expect_drop(spark, d):
    return expect_all_or_drop(staged_events(spark, d), RULES)


@query("expect_quarantine", oracle=f"""
WITH s AS ({_STAGED_SQL})
SELECT *, concat_ws(',', CASE WHEN NOT coalesce(user_id IS NOT NULL, false) THEN 'rule_1' END,
                         CASE WHEN NOT coalesce(value >= 1.0, false) THEN 'rule_2' END) AS failed_rules
FROM s WHERE NOT (coalesce(user_id IS NOT NULL, false) AND coalesce(value >= 1.0, false))""")
def q_expect_quarantine(spark, d):
    return expect_quarantine(staged_events(spark, d), RULES)


@query("expect_metrics", oracle=f"""
WITH s AS ({_STAGED_SQL})
SELECT 'rule_1' AS rule, count(*) FILTER (WHERE coalesce(user_id IS NOT NULL, false)) AS passed,
       count(*) FILTER (WHERE NOT coalesce(user_id IS NOT NULL, false)) AS failed FROM s
UNION ALL
SELECT 'rule_2', count(*) FILTER (WHERE coalesce(value >= 1.0, false)),
       count(*) FILTER (WHERE NOT coalesce(value >= 1.0, false)) FROM s""")
def q_expect_metrics(spark, d):
    return expect_metrics(staged_events(spark, d), RULES)


# ── preview / aggregates / JSON ──────────────────────────────────────────────

@query("preview_limit", oracle="SELECT * FROM events ORDER BY event_id LIMIT 20")
def q_preview_limit(spark, d):
    return table(spark, d, "events").orderBy("event_id").limit(20)


@query("agg_first_last", oracle="""
SELECT o_custkey, count(*) AS n_orders,
       min(cast(cast(o_orderdate AS date) AS string)) AS first_order_date,
       max(cast(cast(o_orderdate AS date) AS string)) AS last_order_date
FROM orders GROUP BY o_custkey""")
def q_agg_first_last(spark, d):
    day = F.col("o_orderdate").cast("date").cast("string")
    return (table(spark, d, "orders").groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.min(day).alias("first_order_date"),
                 F.max(day).alias("last_order_date")))


@query("agg_conditional_count", oracle="""
SELECT l_orderkey, count(*) AS lines, count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS open_lines,
       count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned_lines
FROM lineitem GROUP BY l_orderkey""")
def q_agg_conditional_count(spark, d):
    return (table(spark, d, "lineitem").groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("open_lines"),
                 F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned_lines")))


@query("json_props_extract", oracle="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_props(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


# ── star join ────────────────────────────────────────────────────────────────

STAR_SPECS = [
    JoinSpec("lineitem", "li", "li.l_orderkey, li.l_linenumber, li.l_quantity"),
    JoinSpec("orders", "o", "o.o_orderdate, o.o_orderpriority", "li.l_orderkey = o.o_orderkey"),
    JoinSpec("part", "p", "p.p_name, p.p_brand", "li.l_partkey = p.p_partkey"),
]


@query("star_join", oracle="""
SELECT li.l_orderkey, li.l_linenumber, li.l_quantity, o.o_orderdate, o.o_orderpriority, p.p_name, p.p_brand
FROM lineitem AS li LEFT JOIN orders AS o ON li.l_orderkey = o.o_orderkey
LEFT JOIN part AS p ON li.l_partkey = p.p_partkey""")
def q_star_join(spark, d):
    return star_join(spark, STAR_SPECS, lambda name: table(spark, d, name))


THETA_SPECS = [
    JoinSpec("events", "e", "e.event_id, e.user_id, e.value"),
    JoinSpec("customer", "c", "c.c_name, c.c_acctbal",
             "e.user_id = c.c_custkey AND e.value * 100 > c.c_acctbal"),
]


@query("star_join_theta", oracle="""
SELECT e.event_id, e.user_id, e.value, c.c_name, c.c_acctbal
FROM events AS e LEFT JOIN customer AS c ON e.user_id = c.c_custkey AND e.value * 100 > c.c_acctbal""")
def q_star_join_theta(spark, d):
    return star_join(spark, THETA_SPECS, lambda name: table(spark, d, name))


RANGE_SPECS = [
    JoinSpec("orders", "o", "o.o_orderkey, coalesce(o.o_orderpriority, 'none') AS priority"),
    JoinSpec("part", "p", "p.p_partkey, concat(p.p_brand, ',', p.p_name) AS part",
             condition="p.p_partkey % 5 = o.o_custkey % 5",
             within=("o.o_totalprice", "p.p_retailprice * 100", "p.p_retailprice * 100 + p.p_size * 10")),
]


@query("star_join_range", oracle="""
SELECT o.o_orderkey, coalesce(o.o_orderpriority, 'none') AS priority, p.p_partkey, p.p_brand || ',' || p.p_name AS part
FROM orders AS o LEFT JOIN part AS p ON p.p_partkey % 5 = o.o_custkey % 5
 AND p.p_retailprice * 100 <= o.o_totalprice AND o.o_totalprice < p.p_retailprice * 100 + p.p_size * 10""")
def q_star_join_range(spark, d):
    """Each order's price among intervals of part prices: no column is equal on both sides."""
    return star_join(spark, RANGE_SPECS, lambda name: table(spark, d, name))


SEQUENCE_SQL = {
    "text": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
    "decimal": "CAST(CAST(epoch_us(ts) AS DECIMAL(20,0)) AS VARCHAR)",
    "epoch_ms": "CAST(epoch_us(ts) // 1000 AS VARCHAR)",
}
SEQUENCES = {
    "text": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "decimal": "CAST(unix_micros(CAST(ts AS timestamp)) AS DECIMAL(20,0))",
    "epoch_ms": "unix_millis(CAST(ts AS timestamp))",
}


@query("scd2_hot_key_sequences", oracle=" UNION ALL ".join(f"""
SELECT '{kind}' AS kind, k, event_id, seq AS start_at, lead(seq) OVER (PARTITION BY k ORDER BY seq) AS end_at
FROM (SELECT k, seq, max(event_id) AS event_id FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k, event_id,
      {sql} AS seq FROM events) GROUP BY k, seq)""" for kind, sql in SEQUENCE_SQL.items()))
def q_scd2_hot_key_sequences(spark, d):
    """Histories in which one key holds a third of all rows, by a text, a decimal and an epoch-millisecond sequence."""
    out = None
    for kind, expr in SEQUENCES.items():
        ev = table(spark, d, "events").selectExpr("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k", "event_id",
                                                  f"{expr} AS seq")
        v = scd2_apply(ev, ["k"], "seq").select(F.lit(kind).alias("kind"), "k", "event_id",
                                                F.col("__START_AT").cast("string").alias("start_at"),
                                                F.col("__END_AT").cast("string").alias("end_at"))
        out = v if out is None else out.unionByName(v)
    return out


LATEST_SQL = """
SELECT user_id, event_id, element AS kind_of_event FROM (SELECT user_id, arg_max(event_id, ts) AS event_id,
  arg_max(event_type, ts) AS element FROM events GROUP BY user_id)"""


@query("latest_row_any_type", oracle=LATEST_SQL)
def q_latest_row_any_type(spark, d):
    """Rows that hold a map and a variant column: the latest per user, and the same through the type 1 target."""
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", F.create_map(F.lit("kind"), "event_type").alias("m"))
    ev = ev.withColumn("v", F.parse_json(F.to_json("m")))
    latest = latest_per_key(ev, ["user_id"], ["ts"]).select("user_id", F.col("m")["kind"].alias("kind_of_event"))
    applied = scd1_apply(ev, ["user_id"], "ts").select("user_id", "event_id",
                                                       F.variant_get("v", "$.kind", "string").alias("kind_of_event"))
    return applied.join(latest, ["user_id", "kind_of_event"]).select("user_id", "event_id", "kind_of_event")


# ── incremental extract (pure parts) ─────────────────────────────────────────

@query("cdc_incremental_extract", oracle="SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'")
def q_cdc_extract(spark, d):
    return extract(table(spark, d, "orders"), "o_orderdate", effective_watermark("2001-01-01", ""))


@query("cdc_backfill_override", oracle="SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def q_cdc_backfill(spark, d):
    return extract(table(spark, d, "orders"), "o_orderdate", effective_watermark("2001-01-01", "2000-01-01"))


CDC_SOURCES = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))


@query("cdc_max_watermark", oracle=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, max({c}) AS new_watermark FROM {t}"
    for t, c in CDC_SOURCES))
def q_cdc_max(spark, d):
    out = None
    for t, c in CDC_SOURCES:
        part = table(spark, d, t).agg(F.count(F.lit(1)).alias("rows"), F.max(c).alias("new_watermark")) \
            .select(F.lit(t).alias("table_name"), "rows", "new_watermark")
        out = part if out is None else out.unionByName(part)
    return out


@query("copy_type_conversion", oracle="""
SELECT p_partkey, left(p_name, 5) AS p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
       TRY_CAST(p_retailprice AS DECIMAL(10,2)) AS p_retailprice FROM part""")
def q_copy_types(spark, d):
    return convert_types(table(spark, d, "part"), {"p_size": "bigint", "p_retailprice": "decimal(10,2)"},
                         truncate={"p_name": 5})


# ── request grid over the event days ─────────────────────────────────────────

BASE_URL = "https://fhir.example.org/R4"


@query("request_grid", oracle=f"""
WITH b AS (SELECT min(cast(ts AS date)) AS s, max(cast(ts AS date)) AS e FROM events),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
res AS (SELECT unnest(['Patient', 'Encounter', 'Observation', 'Condition']) AS resource)
SELECT resource, day,
       '{BASE_URL}/' || resource || '?_lastUpdated=ge' || strftime(day, '%Y-%m-%d') || 'T00:00:00Z' ||
       '&_lastUpdated=lt' || strftime(day + 1, '%Y-%m-%d') || 'T00:00:00Z&_count=50&_format=json' AS url
FROM res, days""")
def q_request_grid(spark, d):
    b = table(spark, d, "events").agg(F.min(F.to_date("ts")).alias("s"), F.max(F.to_date("ts")).alias("e"))
    days = b.select(F.explode(day_sequence(F.col("s"), F.date_add("e", 1))).alias("day"))
    return request_urls(days, BASE_URL)


# ── dedup / CDC apply (batch) ────────────────────────────────────────────────

@query("bronze_dedup_latest", oracle="""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""")
def q_bronze_dedup_latest(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id"], ["ts"])


SCD1_SQL = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


@query("scd1_batch", oracle=SCD1_SQL)
def q_scd1_batch(spark, d):
    return scd1_apply(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])


SCD2_SQL = """
SELECT event_id, ts, user_id, event_type, value, props, ts AS __START_AT,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT FROM events"""


@query("scd2_batch", oracle=SCD2_SQL)
def q_scd2_batch(spark, d):
    return scd2_apply(table(spark, d, "events"), ["user_id"], "ts")


@query("scd2_track_except", oracle="""
WITH e AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR prev IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS flag FROM e),
g AS (SELECT *, sum(flag) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM f),
v AS (SELECT user_id, island, min(ts) AS start_at, arg_max(event_id, ts) AS event_id, max(ts) AS ts,
             arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value, arg_max(props, ts) AS props
      FROM g GROUP BY user_id, island)
SELECT event_id, ts, user_id, event_type, value, props, start_at AS __START_AT,
       lead(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS __END_AT FROM v""")
def q_scd2_track_except(spark, d):
    return scd2_apply(table(spark, d, "events"), ["user_id"], "ts",
                      track_except=["event_id", "ts", "value", "props"])


@query("record_hash", oracle="SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0")
def q_record_hash(spark, d):
    c = table(spark, d, "customer")
    changed = c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 1)
                           .otherwise(F.col("c_acctbal")))
    a = c.select("c_custkey", record_hash(c).alias("h1"))
    b = changed.select("c_custkey", record_hash(changed).alias("h2"))
    return a.join(b, "c_custkey").filter(F.col("h1") != F.col("h2")).select("c_custkey")


@query("bronze_enrich", oracle="""
SELECT *, CAST(ts AS DATE) AS ingest_date, 'file:events' AS api_url FROM events""")
def q_bronze_enrich(spark, d):
    ev = table(spark, d, "events")
    return ev.withColumn("ingest_date", F.to_date("ts")).withColumn("api_url", F.lit("file:events"))
