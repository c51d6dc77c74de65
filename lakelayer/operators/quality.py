"""Data-quality expectations: named SQL predicates applied as filters and counters.

A row passes a rule only when the predicate is TRUE (NULL counts as a failure).
Works unchanged on streaming DataFrames; for stream metrics use ``observe_rules``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _passes(pred: str) -> Column:
    return F.coalesce(F.expr(pred), F.lit(False))


def _all_pass(rules: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for pred in rules.values():
        cond = cond & _passes(pred)
    return cond


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep only rows on which every rule holds."""
    return df.filter(_all_pass(rules))


def expect_quarantine(df: DataFrame, rules: Mapping[str, str], column: str = "failed_rules") -> DataFrame:
    """The complement of ``expect_all_or_drop``, with the comma-joined names of failed rules."""
    names = F.concat_ws(",", *[F.when(~_passes(p), F.lit(n)) for n, p in rules.items()])
    return df.filter(~_all_pass(rules)).withColumn(column, names)


def expect_or_fail(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Raise at execution time when a row breaks a rule.

    The check is a filter predicate (a projected check column would be pruned
    by the optimizer and never evaluated); passing rows flow through unchanged.
    """
    cond = _all_pass(rules)
    return df.filter(F.when(cond, F.lit(True)).otherwise(
        F.raise_error(F.lit("expectation failed: " + ", ".join(rules)))))


def expect_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: (rule, passed, failed), from a single aggregate pass."""
    aggs = []
    for name, pred in rules.items():
        ok = _passes(pred)
        aggs.append(F.count_if(ok).alias(f"p_{len(aggs)}"))
        aggs.append(F.count_if(~ok).alias(f"f_{len(aggs) - 1}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"p_{2 * i}").alias("passed"),
                     F.col(f"f_{2 * i}").alias("failed")) for i, n in enumerate(rules)]
    return wide.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def observe_rules(df: DataFrame, rules: Mapping[str, str], name: str = "expectations"):
    """Attach per-rule failure counters to any (batch or streaming) plan.

    Returns (observed DataFrame, Observation); the counters are filled by the
    action (or micro-batch) that runs the plan.
    """
    obs = Observation(name)
    counters = [F.count_if(~_passes(p)).alias(f"failed_{n}") for n, p in rules.items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *counters), obs
