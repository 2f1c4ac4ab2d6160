"""Claims, evidence linkage, envelopes and their validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def repair_linkage(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Drop dangling evidence ids; an available claim left with none becomes
    ambiguous. Claims join evidence by id, so no list of all ids is needed."""
    ids = claims.select("key", "field", F.explode_outer("evidence_ids").alias("evidence_id"))
    known = evidence.select("key", "evidence_id").distinct().withColumn("known", F.lit(1))
    linked = ids.join(known, ["key", "evidence_id"], "left").groupBy("key", "field").agg(F.sort_array(F.collect_list(F.when(F.col("known") == 1, F.col("evidence_id")))).alias("ids"), F.count("evidence_id").alias("given"))
    out = claims.drop("evidence_ids").join(linked, ["key", "field"])
    state = F.when((F.col("availability") == "available") & (F.size("ids") == 0), "ambiguous").otherwise(F.col("availability"))
    return out.withColumns({"availability": state, "dropped": F.col("given") - F.size("ids")}).drop("given")


def by_field(claims: DataFrame) -> DataFrame:
    """Coverage and abstention per field."""
    g = claims.groupBy("field").agg(F.count("*").alias("claims"), F.count_if(F.col("availability") == "available").alias("available"), F.count_if(F.col("availability") == "not_available").alias("not_available"), F.count_if(~F.col("availability").isin("available", "not_available")).alias("abstained"))
    return g.withColumn("coverage", F.round(F.col("available") / F.col("claims"), 6))


#: Fixed terminal states.
TERMINAL = ("available", "not_available", "ambiguous", "blocked", "failed", "not_applicable")


def company_state(states: Column) -> Column:
    """Registry first, then the best of the modules (a map of states)."""
    has = lambda s: F.exists(F.map_values(states), lambda x: x == s)
    return F.when(F.element_at(states, "registry") != "available", F.element_at(states, "registry")).when(has("failed"), "failed").when(has("ambiguous"), "ambiguous").otherwise("available")


def envelopes(claims: DataFrame) -> DataFrame:
    """One nested row per key; claims are bounded by the number of fields."""
    packed = F.sort_array(F.collect_list(F.struct("field", "value", "availability", "ids")))
    return claims.groupBy("key").agg(packed.alias("claims"), F.count_if(F.col("availability") == "available").alias("available"), F.count("*").alias("fields"))


def validate(rows: DataFrame, key: str, state: str, expected: int | None = None) -> DataFrame:
    """Count, uniqueness and terminal states, in one row."""
    a = rows.agg(F.count("*").alias("n"), F.countDistinct(key).alias("distinct_keys"), F.count_if(~F.coalesce(F.col(state).isin(*TERMINAL), F.lit(False))).alias("bad_states"))
    ok = (F.col("n") == F.col("distinct_keys")) & (F.col("bad_states") == 0)
    return a.withColumn("valid", ok if expected is None else ok & (F.col("n") == expected))
