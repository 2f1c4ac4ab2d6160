"""Change detection between two snapshots and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str], strict: bool = False) -> DataFrame:
    """(key, field, old_value, new_value) of unequal fields. One shuffle on the
    key; strict fails on members that one snapshot lacks, else they are changes
    of field `membership`."""
    pack = lambda df, tag: df.select(F.col(key).alias(f"{tag}_key"), F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias(tag))
    j = pack(old, "o").join(pack(new, "n"), F.col("o_key") == F.col("n_key"), "full_outer").withColumn(key, F.coalesce("o_key", "n_key"))
    one_sided = F.col("o_key").isNull() | F.col("n_key").isNull()
    if strict:
        j = j.withColumn(key, F.when(one_sided, F.raise_error(F.concat(F.lit("snapshots differ in "), F.col(key).cast("string")))).otherwise(F.col(key)))
    side = lambda c: F.when(F.col(c).isNull(), "absent").otherwise("present")
    cells = [F.struct(F.lit("membership").alias("field"), side("o_key").alias("old_value"), side("n_key").alias("new_value"))]
    cells += [F.struct(F.lit(f).alias("field"), F.when(~one_sided, F.col(f"o.{f}")).alias("old_value"), F.when(~one_sided, F.col(f"n.{f}")).alias("new_value")) for f in fields]
    long = j.select(key, F.explode(F.array(*cells)).alias("c")).select(key, "c.*")
    return long.where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def replay_evaluation(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """TP, FP, FN, precision and recall of distinct changes; 1.0 on none."""
    e = expected.select(*keys).distinct().withColumn("e", F.lit(1))
    o = observed.select(*keys).distinct().withColumn("o", F.lit(1))
    j = e.join(o, keys, "full_outer").agg(F.count_if(F.col("e").isNotNull() & F.col("o").isNotNull()).alias("tp"), F.count_if(F.col("e").isNull()).alias("fp"), F.count_if(F.col("o").isNull()).alias("fn"))
    share = lambda rest: F.round(F.coalesce(F.try_divide(F.col("tp").cast("double"), F.nullif(F.col("tp") + F.col(rest), F.lit(0))), F.lit(1.0)), 6)
    j = j.withColumns({"precision": share("fp"), "recall": share("fn")})
    return j.withColumn("qualified", (F.col("precision") >= 0.95) & (F.col("recall") >= 0.95))
