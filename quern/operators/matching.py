"""Candidates to targets by name: an inverted index of rare tokens, then one-to-one assignment that abstains on ties.

Rows with equal tokens and equal marks are one class, so that a name that
many rows bear is compared once and never expands to pairs of rows. A class is
indexed under its rarest tokens only: two sets whose Jaccard similarity is
`least` or more share one of the first n - ceil(least * n) + 1 tokens of either
in the order of rarity, so that no match is lost. A token under which more than
BLOCK candidate classes stand is cut into blocks. There is no cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T

#: Candidate classes of one token that meet in one task.
BLOCK = 10_000


def _classes(rows: DataFrame, key: str, name: str, marks: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, classes): class, tokens, marks, n rows, the least key."""
    rows = rows.select(F.col(key).alias("id"), F.array_sort(F.array_distinct(T.tokens(F.col(name)))).alias("tokens"), *marks)
    rows = rows.withColumn("class", F.sha2(F.to_json(F.struct("tokens", *marks)), 256))
    least = rows.where(F.size("tokens") > 0).groupBy("class").agg(F.first("tokens").alias("tokens"), *(F.first(m).alias(m) for m in marks), F.count("*").alias("n"), F.min("id").alias("id"))
    return rows.select("id", "class"), least


def _indexed(classes: DataFrame, often: DataFrame, least: float) -> DataFrame:
    """One row for each class and token of its prefix; tokens and prefix by rising frequency."""
    each = classes.select("class", F.explode("tokens").alias("token")).join(often, "token")
    order = each.groupBy("class").agg(F.transform(F.array_sort(F.collect_list(F.struct("often", "token"))), lambda x: x["token"]).alias("ordered"))
    n = F.size("ordered")
    prefix = F.slice("ordered", F.lit(1), (n - F.ceil(n * least - 1e-9).cast("int") + 1))
    return classes.drop("tokens").join(order, "class").withColumn("prefix", prefix).withColumn("token", F.explode("prefix"))


def similar_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(l, r, similarity) of classes (class, tokens, ...) whose token sets have a Jaccard similarity of `least` or more."""
    both = left.select("tokens").unionByName(right.select("tokens"))
    often = both.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("often"))
    a, b = _indexed(left, often, least), _indexed(right, often, least)
    hot = b.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1))
    a = a.join(hot, "token", "left").select(F.struct(*left.drop("tokens").columns).alias("l"), F.col("ordered").alias("x"), F.col("prefix").alias("p"), "token", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    b = b.join(hot, "token", "left").select(F.struct(*right.drop("tokens").columns).alias("r"), F.col("ordered").alias("y"), F.col("prefix").alias("q"), "token", F.pmod(F.xxhash64("class"), blocks).cast("int").alias("block"))
    shared = F.size(F.array_intersect("x", "y"))
    similarity = shared / (F.size("x") + F.size("y") - shared)
    # a pair counts under the rarest token that both prefixes hold
    pairs = a.join(b, ["token", "block"]).where(F.col("token") == F.element_at(F.array_intersect("p", "q"), 1))
    return pairs.select("l", "r", similarity.alias("similarity")).where(F.col("similarity") >= least - 1e-12)


def _best(pairs: DataFrame, own: str, other: str) -> DataFrame:
    """The best score of each class, how many rows of the other side have it, and their least key."""
    at = pairs.groupBy(F.col(f"{own}.class").alias(own), "score").agg(F.sum(f"{other}.n").alias("n"), F.min(F.struct(f"{other}.id", f"{other}.class")).alias("who"))
    return at.groupBy(own).agg(F.max(F.struct("score", "n", "who")).alias(f"best_{own}"))


def assign(targets: DataFrame, candidates: DataFrame, key: str, name: str, marks: dict[str, float], least: float = 0.5, weight: float = 4.0) -> DataFrame:
    """(target, status, candidate, score): every target once.

    The score is weight * similarity of the names plus the weights of the marks that are equal (nulls never are).
    assigned: target and candidate are each other's only best; ambiguous: several candidates are best;
    contested: the only best candidate has another best target, or several; no_match: no similar name, or none at all.
    """
    columns = list(marks)
    rows, left = _classes(targets, key, name, columns)
    _, right = _classes(candidates, key, name, columns)

    def bit(m: str) -> Column:
        return F.when(F.col(f"l.{m}") == F.col(f"r.{m}"), marks[m]).otherwise(0.0)

    pairs = similar_pairs(left, right, least)
    pairs = pairs.select("l", "r", F.round(sum((bit(m) for m in columns), F.col("similarity") * weight), 4).alias("score"))
    mine, theirs = _best(pairs, "l", "r"), _best(pairs, "r", "l")
    met = mine.join(theirs, mine["best_l.who.class"] == theirs["r"], "left")
    sole = (F.col("best_r.n") == 1) & (F.col("best_r.who.class") == F.col("l"))
    status = F.when(F.col("best_l").isNull(), "no_match").when(F.col("best_l.n") > 1, "ambiguous").when(F.coalesce(sole, F.lit(False)), "assigned").otherwise("contested")
    out = rows.join(met, rows["class"] == met["l"], "left").withColumn("status", status)
    return out.select(F.col("id").alias("target"), "status", F.when(F.col("status") == "assigned", F.col("best_l.who.id")).alias("candidate"), F.col("best_l.score").alias("score"))
