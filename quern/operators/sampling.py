"""Deterministic samples by hash rank, strata, splits and quotas."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.tables import shared_folder
from .accounts import employee_band


def hash_rank(key: Column, seed) -> Column:
    """Hex sha256 of seed:key; its order is the rank."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def hash_sample(df: DataFrame, key: str, n: int, seed) -> DataFrame:
    """n rows of the smallest ranks (a bounded heap a task, no full sort)."""
    return df.withColumn("rank_hash", hash_rank(F.col(key), seed)).orderBy("rank_hash").limit(n)


def preserved_sample(df: DataFrame, preserved: DataFrame, key: str, n: int, seed) -> DataFrame:
    """Preserved keys first, the rest by rank."""
    p = preserved.select(key).distinct().withColumn("_p", F.lit(0))
    ranked = df.join(p, key, "left").withColumn("rank_hash", hash_rank(F.col(key), seed)).withColumn("_p", F.coalesce("_p", F.lit(1)))
    return ranked.orderBy("_p", "rank_hash").limit(n).withColumn("preserved", F.col("_p") == 0).drop("_p")


def stratified_sample(df: DataFrame, key: str, stratum: Column, per_stratum: int, seed) -> DataFrame:
    w = W.partitionBy("stratum").orderBy("rank_hash")
    return df.withColumn("stratum", stratum).withColumn("rank_hash", hash_rank(F.col(key), seed)).withColumn("place", F.row_number().over(w)).where(F.col("place") <= per_stratum)


def round_robin(df: DataFrame, key: str, stratum: Column, n: int, seed) -> DataFrame:
    """Strata in turn: all first places, then all second ones, up to n rows."""
    return stratified_sample(df, key, stratum, n, seed).orderBy("place", hash_rank(F.col("stratum"), seed)).limit(n)


def quota_then_fill(df: DataFrame, key: str, group: str, quota: int, n: int, seed) -> DataFrame:
    """Up to quota rows of each group, then the best ranks of the rest."""
    w = W.partitionBy(group).orderBy("rank_hash")
    ranked = df.withColumn("rank_hash", hash_rank(F.col(key), seed)).withColumn("place", F.row_number().over(w))
    return ranked.withColumn("fill", F.col("place") > quota).orderBy("fill", "rank_hash").limit(n)


def split_by_position(df: DataFrame, key: str, seed, shares=(("development", 0.6), ("validation", 0.8), ("holdout", 1.0))) -> DataFrame:
    """Split by place in hash order. Places come from range-partitioned counts,
    so that no window holds all rows: ranks are cut at their first two hex
    digits, the 256 counts are summed before and places are counted inside."""
    d = df.withColumn("rank_hash", hash_rank(F.col(key), seed)).withColumn("cut", F.substring("rank_hash", 1, 2))
    cuts = d.groupBy("cut").agg(F.count("*").alias("k")).withColumn("one", F.lit(1))
    before = W.partitionBy("one").orderBy("cut")
    cuts = cuts.select("cut", (F.sum("k").over(before) - F.col("k")).alias("ahead"), F.sum("k").over(W.partitionBy("one")).alias("n"))
    d = d.join(F.broadcast(cuts), "cut")  # 256 rows at most
    place = F.col("ahead") + F.row_number().over(W.partitionBy("cut").orderBy("rank_hash")) - 1
    d = d.withColumn("place", place)
    split = None
    for name, share in shares:
        hit = F.col("place") < F.round(F.col("n") * F.lit(share))
        split = F.when(hit, name) if split is None else split.when(hit, name)
    return d.withColumn("split", split).drop("cut", "ahead", "n", "rank_hash")


def first_per_host(df: DataFrame, key: str, host: Column, n: int, seed, seen: DataFrame | None = None) -> DataFrame:
    """Hash order, one row per host, hosts already seen left out."""
    d = df.withColumn("host", host).withColumn("rank_hash", hash_rank(F.col(key), seed)).where(F.col("host") != "")
    if seen is not None:
        d = d.join(seen.select("host").distinct(), "host", "left_anti")
    d = d.groupBy("host").agg(F.min_by(key, "rank_hash").alias(key), F.min("rank_hash").alias("rank_hash"))
    return d.orderBy("rank_hash").limit(n)


def chunks(df: DataFrame, key: str, size: int) -> DataFrame:
    """Fixed-size batches in key order, by range-partitioned places.

    The ranges' bounds come from a sample that every run of a plan draws anew, and the
    count of a range has other columns than its rows; so rows and their range are written
    once, and both read from there."""
    spark, path, w = df.sparkSession, f"{shared_folder(df.sparkSession)}/ranges-{uuid.uuid4().hex}", W.partitionBy("_part").orderBy(key)
    df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    parts = spark.read.parquet(path)
    counts = parts.groupBy("_part").agg(F.count("*").alias("k")).withColumn("one", F.lit(1))
    ahead = counts.select("_part", (F.sum("k").over(W.partitionBy("one").orderBy("_part")) - F.col("k")).alias("ahead"))
    return parts.join(F.broadcast(ahead), "_part").withColumn("chunk", F.floor((F.col("ahead") + F.row_number().over(w) - 1) / size)).drop("_part", "ahead")


def registry_stratum(state: bool = False) -> Column:
    """Form, employee band, state of affairs (where asked for) and web presence."""
    form = F.when(F.col("legal_form").isin("AS", "ASA", "ENK"), F.col("legal_form")).otherwise("OTHER")
    adverse = [F.when(F.col("bankrupt") | F.col("liquidating"), "adverse").otherwise("active")] if state else []
    return F.concat_ws("|", form, employee_band(F.col("employees")), *adverse, F.when(F.col("website"), "web").otherwise("no-web"))


def financial_stratum() -> Column:
    """Form, employee band, industry division (before the dot), first two characters of the municipality number, web presence."""
    text = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("missing"))
    division, place = F.substring_index(text("industry_code"), ".", 1), F.substring(text("municipality_number"), 1, 2)
    return F.concat_ws("|", text("legal_form"), employee_band(F.col("employees")), division, place, F.when(F.col("website"), "web").otherwise("no-web"))
