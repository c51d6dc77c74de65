"""How the driver tables play the reference's roles.

The clinical domain (patient / encounter / observation / condition) is mapped
onto customer / orders / lineitem; the streaming domain (users, tracks, streams)
onto customer / part / events. Column expressions are plain SQL text that both
Spark (``selectExpr``) and the DuckDB oracle accept, so the two sides cannot
drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

LOAD_DAY = "2024-01-01"
LAST_UPDATED = "'2024-01-01T00:00:00Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# (output column, SQL expression) — shared by Spark and the oracle.
PATIENT = [
    ("patient_id", "cast(c_custkey as string)"),
    ("family_name", "c_name"),
    ("given_name", "c_mktsegment"),
    ("gender", "CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END"),
    ("birth_date", "concat('19', lpad(cast(c_custkey % 100 as string), 2, '0'), '-01-01')"),
    ("city", "n_name"),
    ("state", "cast(c_nationkey as string)"),
    ("country", "r_name"),
    ("postal_code", "lpad(cast(c_custkey % 100000 as string), 5, '0')"),
    ("phone", "concat('+1-', lpad(cast(c_custkey % 10000000 as string), 7, '0'))"),
    ("email", "concat(lower(replace(c_name, '#', '.')), '@example.com')"),
    ("language", "'en'"),
    ("active", "c_acctbal >= 0"),
    ("last_updated", LAST_UPDATED),
]

ENCOUNTER = [
    ("encounter_id", "cast(o_orderkey as string)"),
    ("status", "CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress' ELSE 'planned' END"),
    ("class_code", "o_orderstatus"),
    ("class_display", "o_orderpriority"),
    ("type_code", "substring(o_orderpriority, 1, 1)"),
    ("type_display", "o_orderpriority"),
    ("patient_id", "cast(o_custkey as string)"),
    ("period_start", "cast(cast(o_orderdate as date) as string)"),
    ("period_end", "cast(NULL as string)"),
    ("reason_code", "cast(NULL as string)"),
    ("reason_display", "cast(NULL as string)"),
    ("service_provider", "concat('org-', o_orderstatus)"),
    ("last_updated", LAST_UPDATED),
]

OBSERVATION = [
    ("observation_id", "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
                       "cast(l_partkey as string), cast(l_suppkey as string))"),
    ("status", "CASE l_returnflag WHEN 'R' THEN 'amended' ELSE 'final' END"),
    ("category", "'laboratory'"),
    ("code", "cast(l_partkey as string)"),
    ("code_display", "concat('part ', cast(l_partkey as string))"),
    ("patient_id", "cast(o_custkey as string)"),
    ("encounter_id", "cast(l_orderkey as string)"),
    ("effective_datetime", "cast(cast(l_shipdate as date) as string)"),
    ("issued", "cast(NULL as string)"),
    ("value_quantity", "l_quantity"),
    ("value_unit", "'unit'"),
    ("value_string", "cast(NULL as string)"),
    ("value_code", "cast(NULL as string)"),
    ("component_code", "cast(l_suppkey as string)"),
    ("component_value", "l_discount"),
    ("component_unit", "'%'"),
    ("last_updated", LAST_UPDATED),
]

CONDITION = [
    ("condition_id", "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
                     "cast(l_partkey as string), cast(l_suppkey as string))"),
    ("clinical_status", "CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'resolved' END"),
    ("verification_status", "'confirmed'"),
    ("category", "'problem-list-item'"),
    ("code", "cast(l_partkey as string)"),
    ("code_display", "concat('part ', cast(l_partkey as string))"),
    ("patient_id", "cast(o_custkey as string)"),
    ("encounter_id", "cast(l_orderkey as string)"),
    ("onset_datetime", "cast(cast(l_shipdate as date) as string)"),
    ("abatement_datetime", "cast(NULL as string)"),
    ("recorded_date", "cast(NULL as string)"),
    ("severity", "l_returnflag"),
    ("last_updated", LAST_UPDATED),
]

# Silver audit columns of a first load (one version per id).
SILVER_AUDIT_SPARK = [
    ("effective_start_date", f"DATE '{LOAD_DAY}'"),
    ("record_version", "1"),
    ("silver_load_timestamp", f"TIMESTAMP_NTZ '{LOAD_DAY} 00:00:00'"),
]
SILVER_AUDIT_SQL = [
    ("effective_start_date", f"DATE '{LOAD_DAY}'"),
    ("record_version", "1"),
    ("silver_load_timestamp", f"TIMESTAMP '{LOAD_DAY} 00:00:00'"),
]

# FROM clauses (oracle side); the Spark side builds the same joins below.
FROM_SQL = {
    "patient": "customer LEFT JOIN nation ON c_nationkey = n_nationkey "
               "LEFT JOIN region ON n_regionkey = r_regionkey",
    "encounter": "orders",
    "observation": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "condition": "lineitem JOIN orders ON l_orderkey = o_orderkey",
}
ROLE_COLUMNS = {"patient": PATIENT, "encounter": ENCOUNTER, "observation": OBSERVATION,
                "condition": CONDITION}


def select_sql(cols) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in cols)


def role_sql(role: str, with_audit: bool = True) -> str:
    """Oracle text of one role's current silver table."""
    cols = ROLE_COLUMNS[role] + (SILVER_AUDIT_SQL if with_audit else [])
    return f"SELECT {select_sql(cols)} FROM {FROM_SQL[role]}"


def _exprs(cols, with_audit: bool) -> list[str]:
    return [f"{e} AS {n}" for n, e in cols + (SILVER_AUDIT_SPARK if with_audit else [])]


def patient(spark: SparkSession, sf_dir: str, with_audit: bool = True) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # nation / region are tiny; the planner and AQE broadcast them from their
    # measured size (runtime statistics), with a shuffle join beyond the threshold
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
         .join(r, n.n_regionkey == r.r_regionkey, "left"))
    return j.selectExpr(*_exprs(PATIENT, with_audit))


def encounter(spark: SparkSession, sf_dir: str, with_audit: bool = True) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_exprs(ENCOUNTER, with_audit))


def _line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order, joined by the key as the text it becomes (``encounter_id``): a later join by that id
    finds the rows where they lie."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey.cast("string") == o.o_orderkey.cast("string"), "inner")


def observation(spark: SparkSession, sf_dir: str, with_audit: bool = True) -> DataFrame:
    return _line_orders(spark, sf_dir).selectExpr(*_exprs(OBSERVATION, with_audit))


def condition(spark: SparkSession, sf_dir: str, with_audit: bool = True) -> DataFrame:
    return _line_orders(spark, sf_dir).selectExpr(*_exprs(CONDITION, with_audit))


ROLE_FRAMES = {"patient": patient, "encounter": encounter, "observation": observation, "condition": condition}
