"""Lookups, fills, anti-joins and order-true deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def left_fill(manifest: DataFrame, registry: DataFrame, live: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Every manifest row once: bulk values, else live ones, else not found."""
    b = registry.select(key, F.struct(*fields).alias("_b"))
    l = live.select(key, F.struct(*fields).alias("_l"))
    j = manifest.join(b, key, "left").join(l, key, "left")
    origin = F.when(F.col("_b").isNotNull(), "bulk").when(F.col("_l").isNotNull(), "live").otherwise("not_found")
    return j.select(*manifest.columns, *(F.coalesce(f"_b.{f}", f"_l.{f}").alias(f) for f in fields), origin.alias("origin"))


def live_over_bulk(bulk: Column, live: Column) -> Column:
    return F.coalesce(F.when(live != "", live), bulk)


def join_or_raise(left: DataFrame, right: DataFrame, key: str, what: str) -> DataFrame:
    """Inner join that fails on a left row without partner."""
    j = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    message = F.concat(F.lit(f"{what} has no row for "), F.col(key).cast("string"))
    return j.withColumn(key, F.when(F.col("_found").isNull(), F.raise_error(message)).otherwise(F.col(key))).drop("_found")


def unknown_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of left that right doesn't have."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def same_members(a: DataFrame, b: DataFrame, key: str) -> bool:
    one_sided = a.select(key).distinct().join(b.select(key).distinct().withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "full_outer").where(F.col(key).isNull() | F.col("_k").isNull())
    return one_sided.isEmpty()


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def keep_last(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Dictionary overwrite: the last row of each key (partial aggregation)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r")).select(*keys, "_r.*")


def union_first_wins(parts: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """Bag union in which an earlier list wins a key; ties by order."""
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("priority", F.lit(i))
        every = p if every is None else every.unionByName(p, allowMissingColumns=True)
    rest = [c for c in every.columns if c not in keys]
    return every.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("priority", *order)).alias("_r")).select(*keys, "_r.*")


def unique_best(df: DataFrame, key: str, score: str, candidate: str) -> DataFrame:
    """Best candidate of each key, none where the best score is shared."""
    top = df.groupBy(key).agg(F.max(score).alias("best"))
    at = df.join(top, key).where(F.col(score) == F.col("best"))
    return at.groupBy(key).agg(F.count("*").alias("_n"), F.min(candidate).alias(candidate), F.max("best").alias(score)).where("_n = 1").drop("_n")


def first_accepted(df: DataFrame, key: str, level: str, accepted: Column, order: list[str]) -> DataFrame:
    """Waterfall: the accepted candidate of the lowest level."""
    ok = df.where(accepted)
    rest = [c for c in df.columns if c != key]
    return ok.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(level, *order)).alias("_r")).select(key, "_r.*")
