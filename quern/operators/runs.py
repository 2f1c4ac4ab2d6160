"""Run summaries and deltas, attempts, suites, histories and cumulative views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def attempt_summary(attempts: DataFrame) -> DataFrame:
    """attempts: status, quarantined, request_count, cost_usd, runtime_seconds,
    accepted_claims array<struct<evidence_span,source_url,...>>."""
    ok = lambda c: (F.length(F.trim(F.coalesce(c["evidence_span"], F.lit("")))) >= 5) & (F.coalesce(c["source_url"], F.lit("")) != "")
    a = attempts.agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == "success").alias("successful"), F.count_if(F.col("quarantined") | (F.col("status") == "quarantined")).alias("quarantined"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum(F.size("accepted_claims")), F.lit(0)).alias("claims"), F.coalesce(F.sum(F.size(F.filter("accepted_claims", ok))), F.lit(0)).alias("grounded"),
        F.coalesce(F.sum("request_count"), F.lit(0)).alias("requests"), F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 5).alias("cost_usd"), F.round(F.coalesce(F.sum("runtime_seconds"), F.lit(0.0)), 3).alias("runtime_seconds"),
    )
    return a.withColumn("grounded_rate", F.round(F.coalesce(F.try_divide("grounded", F.nullif("claims", F.lit(0))), F.lit(1.0)), 4))


def run_delta(old: DataFrame, new: DataFrame, field: str, value: str) -> DataFrame:
    """Per-field difference of two runs; a missing side counts as 0."""
    j = old.select(field, F.col(value).alias("old")).join(new.select(field, F.col(value).alias("new")), field, "full_outer").fillna(0, ["old", "new"])
    return j.withColumn("delta", F.col("new") - F.col("old"))


def suite_score(found: DataFrame, expected: DataFrame, case: str, item: str, place: str) -> DataFrame:
    """Ordered equality of each case's items; lists are bounded by the suite."""
    listed = lambda df, name: df.groupBy(case).agg(F.transform(F.array_sort(F.collect_list(F.struct(place, item))), lambda x: x[item]).alias(name))
    j = listed(expected, "want").join(listed(found, "got"), case, "left")
    return j.select(case, F.coalesce(F.col("want") == F.col("got"), F.lit(False)).alias("passed"))


def sequence_digest(rows: DataFrame, key: str, order: str, cut: int = 1000) -> DataFrame:
    """Order-true digest over blocks of `cut` positions, then over the blocks'
    digests, so that no task holds the whole sequence."""
    d = rows.withColumn("_b", F.floor(F.col(order) / cut))
    blocks = d.groupBy("_b").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).cast("string").alias("k")))), lambda x: x["k"]), "\n"), 256).alias("h"))
    return blocks.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "h"))), lambda x: x["h"]), "\n"), 256).alias("digest"))


def last_entries(history: DataFrame, owner: str, at: list, n: int = 100) -> DataFrame:
    w = W.partitionBy(owner).orderBy(*at)
    return history.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def cumulative_signals(rows: DataFrame, key: str, step: str, signal: str) -> DataFrame:
    """Distinct signals seen up to each step (fixed order of strategies)."""
    first = rows.groupBy(key, signal).agg(F.min(step).alias(step))
    steps = rows.select(key, step).distinct().join(first.groupBy(key, step).agg(F.count("*").alias("fresh")), [key, step], "left").fillna(0, ["fresh"])
    return steps.withColumn("seen", F.sum("fresh").over(W.partitionBy(key).orderBy(step)))


def promotion(rows: DataFrame, key: str) -> DataFrame:
    """rows: strategy, reviewed, wrong, unsupported, gain flags per observation."""
    g = rows.groupBy("strategy").agg(F.count_if("reviewed").alias("reviewed"), F.count_if("wrong").alias("wrong"), F.count_if("unsupported").alias("unsupported"), F.countDistinct(F.when(F.col("gain"), F.col(key))).alias("gain"))
    why = F.array_compact(F.array(F.when(F.col("reviewed") == 0, "not reviewed"), F.when(F.col("wrong") > 0, "wrong entity"), F.when(F.col("unsupported") > 0, "unsupported claim"), F.when(F.col("gain") == 0, "no gain")))
    return g.withColumn("reasons", F.array_join(why, ",")).withColumn("promoted", F.size(why) == 0)


def audit_gates(rows: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """(gate, failures, passed) of row predicates, in one pass."""
    a = rows.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in gates.items()))
    return a.select(F.explode(F.array(*(F.struct(F.lit(k).alias("gate"), F.col(k).alias("failures")) for k in gates))).alias("g")).select("g.*", (F.col("g.failures") == 0).alias("passed"))


def skip_passive(profiles: DataFrame) -> DataFrame:
    """Entities worth enriching: not bankrupt or liquidating, and with staff, a
    site or accounts."""
    active = ~F.coalesce("bankrupt", F.lit(False)) & ~F.coalesce("liquidating", F.lit(False))
    busy = (F.coalesce("employees", F.lit(0)) > 0) | (F.coalesce("website", F.lit("")) != "") | F.col("latest_submitted_accounts").isNotNull()
    return profiles.where(active & busy)
