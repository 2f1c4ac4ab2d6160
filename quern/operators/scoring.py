"""Completeness, contract and development scores, and promotion gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def capped(value: Column, target: Column | float, weight: float) -> Column:
    """weight times the share of a target, kept in 0..1; null counts as 0."""
    target = target if isinstance(target, Column) else F.lit(float(target))
    share = F.coalesce(F.try_divide(value.cast("double"), F.nullif(target, F.lit(0.0))), F.lit(0.0))
    return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * weight


def weighted(parts: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for c in parts.values():
        total = total + c
    return F.round(total, 3)


#: Fixed weights of the 100-point contract.
CONTRACT = {"accuracy": 50.0, "coverage": 30.0, "freshness": 12.0, "operations": 8.0}


def contract_score(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("score", weighted({k: capped(F.col(k), 1.0, w) for k, w in CONTRACT.items()}))


#: Fixed development components: points and the signals that earn them.
DEVELOPMENT = {
    "profile_metrics": (10.0, ("profile_metrics",)), "places_identity": (5.0, ("place_summary",)), "places_reviews": (10.0, ("review", "review_summary")),
    "workforce_jobs": (10.0, ("job_posting", "workforce_snapshot")), "public_buzz": (10.0, ("public_post", "public_mention", "buzz_metrics")),
}


def development_score(rows: DataFrame, key: str) -> DataFrame:
    """rows: accepted observations with signal_type, platform. Identity needs
    any accepted row, handles earn five points each up to fifteen."""
    g = rows.groupBy(key).agg(F.collect_set("signal_type").alias("s"), F.countDistinct(F.when(F.col("signal_type") == "profile_handle", F.col("platform"))).alias("handles"), F.count("*").alias("accepted"))
    parts = {k: F.when(F.arrays_overlap("s", F.array(*(F.lit(x) for x in names))), points).otherwise(0.0) for k, (points, names) in DEVELOPMENT.items()}
    parts |= {"identity": F.when(F.col("accepted") > 0, 20.0).otherwise(0.0), "handles": F.least(F.lit(15.0), F.col("handles") * 5.0), "evidence": F.when(F.col("accepted") > 0, 5.0).otherwise(0.0)}
    return g.withColumn("score", weighted(parts)).drop("s")


#: Fixed gates after the fatal first one: name, metric, direction.
GATES = (("claim_precision", "precision", ">="), ("evidence_grounding", "grounding", ">="), ("recall_or_coverage", "recall", ">"), ("refresh", "refresh", ">="), ("budget", "within_budget", ">="))
GATE_ROW = ("gate", "name", "passed", "evaluated")


def gate_rows(pair: DataFrame) -> DataFrame:
    """pair: one row with base_* and new_* metrics. Six rows; a failed first
    gate (more wrong companies than before, or any where there were none) skips
    the others; a gate whose metric is null passes unevaluated."""
    fatal = (F.col("new_wrong") > F.col("base_wrong")) | ((F.col("new_wrong") > 0) & (F.col("base_wrong") == 0))
    rows = [F.struct(F.lit(1).alias("gate"), F.lit("zero_wrong_company").alias("name"), (~fatal).alias("passed"), F.lit(True).alias("evaluated"))]
    for i, (name, metric, op) in enumerate(GATES, 2):
        b, n = F.col(f"base_{metric}"), F.col(f"new_{metric}")
        ok = F.coalesce(n >= b if op == ">=" else n > b, F.lit(True))
        rows.append(F.struct(F.lit(i).alias("gate"), F.lit(name).alias("name"), (~fatal & ok).alias("passed"), (~fatal & b.isNotNull() & n.isNotNull()).alias("evaluated")))
    return pair.select(F.explode(F.array(*rows)).alias("g")).select("g.*")


def verdict(gates: DataFrame) -> DataFrame:
    return gates.agg(F.count_if("passed").alias("gates_passed"), F.bool_and("passed").alias("promoted"))
