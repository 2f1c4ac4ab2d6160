"""Evaluation, coverage and operations metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), F.nullif(bottom, F.lit(0))), F.lit(empty).cast("double"))


def sentiment_rollup(rows: DataFrame, key: str, label: str = "label", source: str = "source", least: int = 2) -> DataFrame:
    """Abstain under `least` sources; one non-neutral label stands, several are
    mixed, none is neutral."""
    g = rows.groupBy(key).agg(F.countDistinct(source).alias("sources"), F.count(label).alias("items"), F.collect_set(F.when(F.col(label) != "neutral", F.col(label))).alias("_l"))
    verdict = F.when(F.col("sources") < least, "abstain").when(F.size("_l") == 0, "neutral").when(F.size("_l") == 1, F.element_at("_l", 1)).otherwise("mixed")
    return g.withColumn("verdict", verdict).drop("_l")


def confusion(rows: DataFrame, gold: str = "gold", predicted: str = "predicted") -> DataFrame:
    """Per-label counts, precision, recall and F1; one pass over the rows."""
    sides = rows.select(F.explode(F.array(F.struct(F.col(gold).alias("label"), F.lit("g").alias("side")), F.struct(F.col(predicted).alias("label"), F.lit("p").alias("side")))).alias("x"), (F.col(gold) == F.col(predicted)).alias("hit"))
    g = sides.where("x.label is not null").groupBy("x.label").agg(
        F.count_if((F.col("x.side") == "g") & F.coalesce("hit", F.lit(False))).alias("tp"), F.count_if((F.col("x.side") == "p") & ~F.coalesce("hit", F.lit(False))).alias("fp"),
        F.count_if((F.col("x.side") == "g") & ~F.coalesce("hit", F.lit(False))).alias("fn"),
    )
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    g = g.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6)})
    return g.withColumn("f1", F.round(F.coalesce(F.try_divide(2 * p * r, F.nullif(p + r, F.lit(0.0))), F.lit(0.0)), 6))


def macro_f1(per_label: DataFrame) -> DataFrame:
    """Mean F1 over labels that gold has."""
    return per_label.where("tp + fn > 0").agg(F.count("*").alias("labels"), F.round(F.avg("f1"), 6).alias("macro_f1"))


def nearest_rank(col: str, *shares: float) -> list[Column]:
    return [F.expr(f"percentile_disc({s}) WITHIN GROUP (ORDER BY {col})").alias(f"p{round(100 * s)}") for s in shares]


def latency(rows: DataFrame, col: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(col).alias("n"), *nearest_rank(col, 0.5, 0.95), F.max(col).alias("max"))


def count_percentiles(rows: DataFrame, key: str) -> DataFrame:
    """Two levels: rows per key, then the spread of these counts."""
    return latency(rows.groupBy(key).agg(F.count("*").alias("requests")), "requests")


def coverage(entities: DataFrame, signals: DataFrame, key: str, groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """Shares over all entities, those without any signal included."""
    per = signals.groupBy(key).agg(F.collect_set("signal").alias("s"))
    j = entities.select(key).distinct().join(per, key, "left").withColumn("s", F.coalesce("s", F.array().cast("array<string>")))
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    return j.agg(
        F.count("*").alias("entities"), share(F.size("s") > 0).alias("any_signal"), share(F.size("s") >= 2).alias("two_signals"),
        *(share(F.arrays_overlap("s", F.array(*(F.lit(x) for x in v)))).alias(k) for k, v in groups.items()),
    )


def membership_digest(df: DataFrame, key: str, cut: int = 2) -> DataFrame:
    """Digest of all sorted members as a two-level hash tree: members are
    digested per prefix group of their own hash, group digests in order. No
    task holds all members (a flat digest over one sorted list would)."""
    d = df.select(F.col(key).cast("string").alias("m")).distinct().withColumn("g", F.substring(F.sha2("m", 256), 1, cut))
    groups = d.groupBy("g").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("m")), "\n"), 256).alias("h"), F.count("*").alias("k"))
    parts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", "h"))), lambda x: x["h"]), "\n")
    return groups.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("members"), F.sha2(parts, 256).alias("digest"))


def admit_in_order(rows: DataFrame, owner: str, order: list[str], cost: str, budget: float, reserve: float = 0.0) -> DataFrame:
    """Requests of an owner in order against its budget less the reserve. One that no longer
    fits is refused and not charged, so that a smaller one may follow: spent is what the admitted ones cost.

    The rule is sequential, hence one owner's requests (a run's log) are walked in one task."""
    import pyarrow as pa
    from pyspark.sql import types as t

    schema = t.StructType([*rows.schema, t.StructField("spent", t.DoubleType()), t.StructField("admitted", t.BooleanType())])
    most = budget - reserve

    def walk(key, log):
        log = log.sort_by([(c, "ascending") for c in order])
        spent, ok, total = [], [], 0.0
        for c in log[cost].to_pylist():
            fits = total + (c or 0.0) <= most
            total += (c or 0.0) if fits else 0.0
            spent.append(round(total, 2))
            ok.append(fits)
        return log.append_column("spent", pa.array(spent, pa.float64())).append_column("admitted", pa.array(ok))

    return rows.groupBy(owner).applyInArrow(walk, schema)


def explore_order(history: DataFrame, strategy: str, gain: str, weight: float = 0.35) -> DataFrame:
    """Mean gain plus weight * sqrt(ln(N + 1) / (n + 1)); ties by name."""
    g = history.groupBy(strategy).agg(F.count("*").alias("runs"), F.avg(gain).alias("mean"), F.count_if(F.col(gain) > 0).alias("successes"))
    everything = W.partitionBy(F.lit(1))  # one row per strategy
    bonus = F.sqrt(F.log(F.sum("runs").over(everything) + 1) / (F.col("runs") + 1))
    g = g.withColumn("priority", F.col("mean") + F.lit(weight) * bonus)
    return g.withColumn("place", F.row_number().over(everything.orderBy(F.desc("priority"), strategy)))


def gold_evaluation(gold: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Claim precision and recall, company recall, weighted coverage. found has
    claims, right_claims, grounded per key."""
    j = gold.select(key).join(found, key, "left")
    z = lambda c: F.coalesce(F.sum(c), F.lit(0))
    a = j.agg(F.count("*").alias("gold"), F.count("claims").alias("matched"), z("claims").alias("claims"), z("right_claims").alias("right_claims"), z("grounded").alias("grounded"))
    a = a.withColumns({"precision": F.round(ratio(F.col("right_claims"), F.col("claims"), 1.0), 6), "recall": F.round(ratio(F.col("right_claims"), 3 * F.col("gold")), 6), "company_recall": F.round(ratio(F.col("matched"), F.col("gold")), 6), "grounding": F.round(ratio(F.col("grounded"), F.col("claims"), 1.0), 6)})
    return a.withColumn("coverage", F.round(0.7 * F.col("company_recall") + 0.3 * F.col("recall"), 6))
