"""Samples of the registry by hash rank: eligibility, preserved rows, holdouts, slices.

Every rank is a sha256 of a seed and a key, so membership does not depend on the order
of the input. Where a sequential generator would draw, a rank of its own seed stands in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .sampling import hash_rank

#: Shares of development and validation; the rest is held out.
DEVELOPMENT, VALIDATION = 0.6, 0.2


def eligible(latest_accounts: Column, year, bankrupt: Column, liquidating: Column, active_only: bool = True) -> Column:
    """A filer of that year's accounts that is not being wound up."""
    filed = F.coalesce(latest_accounts.cast("string"), F.lit("")) == F.lit(str(year))
    return filed & ~(F.coalesce(bankrupt, F.lit(False)) | F.coalesce(liquidating, F.lit(False))) if active_only else filed


def _splits(selected: DataFrame, order: Column, n: int) -> DataFrame:
    """Split by place in an order; the selection has n rows at most."""
    place = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(order)) - 1
    first, second = round(n * DEVELOPMENT), round(n * VALIDATION)
    return selected.withColumn("place", place).withColumn("evaluation_split", F.when(F.col("place") < first, "development").when(F.col("place") < first + second, "validation").otherwise("held_out"))


def filer_sample(rows: DataFrame, preserved: DataFrame, excluded: DataFrame, key: str, n: int, seed) -> DataFrame:
    """rows: the eligible ones. Preserved rows first (the best ranks of them if there are
    more than n), then the best ranks of the rest; the selection is put in an order
    of its own, along which the splits are dealt."""
    d = rows.join(excluded.select(key), key, "left_anti").join(preserved.select(key).distinct().withColumn("_kept", F.lit(True)), key, "left")
    kept = F.coalesce("_kept", F.lit(False))
    rank = F.when(kept, hash_rank(F.col(key), f"{seed}:preserved")).otherwise(hash_rank(F.col(key), seed))
    d = d.withColumn("sample_slice", F.when(kept, "preserved_eligible").otherwise("financial_filer_population")).withColumn("_rank", rank)
    chosen = d.orderBy(~kept, "_rank").limit(n).drop("_kept", "_rank")
    return _splits(chosen, hash_rank(F.col(key), f"{seed}:order"), n)


def extension_sample(rows: DataFrame, excluded: DataFrame, key: str, n: int, seed) -> DataFrame:
    """A holdout of the best ranks among rows that no earlier sample has."""
    rest = rows.join(excluded.select(key), key, "left_anti").withColumn("rank_hash", hash_rank(F.col(key), seed))
    return rest.orderBy("rank_hash").limit(n).withColumn("sample_slice", F.lit("extension")).withColumn("evaluation_split", F.lit("extension_holdout"))


def population_and_stress(rows: DataFrame, key: str, stratum: Column, n: int, seed) -> DataFrame:
    """70 % by rank over everything; of every stratum a few that are not among them, then the
    best stress ranks of what is left, up to n. Splits go along the rank."""
    d = rows.withColumn("stratum", stratum).withColumn("rank_hash", hash_rank(F.col(key), seed)).withColumn("_stress", hash_rank(F.col(key), f"{seed}:stress"))
    population = d.orderBy("rank_hash").limit(round(n * 0.7)).withColumn("sample_slice", F.lit("population"))
    strata = d.select("stratum").distinct().count()
    stress = n - round(n * 0.7)
    least = max(1, min(3, stress // max(1, strata)))
    rest = d.join(population.select(key), key, "left_anti")
    rest = rest.withColumn("_fill", F.row_number().over(W.partitionBy("stratum").orderBy("_stress")) > least)
    chosen = rest.orderBy("_fill", "_stress").limit(stress).withColumn("sample_slice", F.lit("stress")).drop("_fill")
    return _splits(population.unionByName(chosen).drop("_stress"), F.col("rank_hash"), n)


def priority_then_fill(lists: list[DataFrame], rows: DataFrame, key: str, n: int, seed) -> DataFrame:
    """Members of earlier lists before those of later ones, each once, then the best ranks of the rest."""
    every = rows.select(key, F.lit(len(lists)).alias("priority"))
    for i, part in enumerate(lists):
        every = every.unionByName(part.select(key, F.lit(i).alias("priority")))
    first = every.groupBy(key).agg(F.min("priority").alias("priority")).withColumn("rank_hash", hash_rank(F.col(key), seed))
    slice_ = F.when(F.col("priority") < len(lists), "priority_benchmark").otherwise("population_fill")
    return first.orderBy("priority", "rank_hash").limit(n).withColumn("sample_slice", slice_)


def unseen_active(rows: DataFrame, seen: DataFrame, key: str, n: int, seed) -> DataFrame:
    """Active limited companies that no earlier batch has, by rank over all of them."""
    active = rows.where((F.col("legal_form") == "AS") & ~F.coalesce("bankrupt", F.lit(False)) & ~F.coalesce("liquidating", F.lit(False)))
    return active.join(seen.select(key), key, "left_anti").withColumn("rank_hash", hash_rank(F.col(key), seed)).orderBy("rank_hash").limit(n)


def overlaps(samples: dict[str, DataFrame], key: str) -> DataFrame:
    """(a, b, n): members that two samples share, for each pair of samples."""
    every = None
    for name, s in samples.items():
        s = s.select(F.col(key).alias("_k"), F.lit(name).alias("sample")).distinct()
        every = s if every is None else every.unionByName(s)
    sets = every.groupBy("_k").agg(F.array_sort(F.collect_set("sample")).alias("s"))  # as many names as there are samples
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return sets.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def spread_sample(rows: DataFrame, key: str, owner: str, stratum: Column, n: int, seed) -> DataFrame:
    """Strata in turn, owners that the sample doesn't have yet first.

    The rule is sequential: a stratum's next row depends on all rows before. Every
    stratum's rows are cut to its n best ranks of new owners and of all (no more can be
    taken), and the turns run over these at most 2 n rows a stratum in one task."""
    import pyarrow as pa

    d = rows.select(F.col(key).cast("string").alias("k"), F.col(owner).cast("string").alias("o"), stratum.alias("s"))
    d = d.withColumn("r", hash_rank(F.col("k"), seed)).withColumn("sr", hash_rank(F.col("s"), seed))
    # each list is ranked for itself: then every task passes on its n best of a stratum, and no task sorts a stratum
    first = d.groupBy("s", "o").agg(F.min("r").alias("r"), F.min_by("k", "r").alias("k"), F.first("sr").alias("sr"))
    cut = lambda x: x.withColumn("_n", F.row_number().over(W.partitionBy("s").orderBy("r"))).where(F.col("_n") <= n).select("k", "o", "s", "r", "sr")
    best = cut(d).unionByName(cut(first)).distinct()

    def turns(key, t):
        strata: dict = {}
        for r in sorted(t.to_pylist(), key=lambda r: (r["sr"], r["r"])):
            strata.setdefault(r["sr"], []).append(r)
        taken, ids, owners = [], set(), set()
        for fresh in (True, False):
            moved = True
            while moved and len(taken) < n:
                moved = False
                for own in strata.values():
                    hit = next((r for r in own if r["k"] not in ids and not (fresh and r["o"] in owners)), None)
                    if hit and len(taken) < n:
                        taken.append(hit)
                        ids.add(hit["k"])
                        owners.add(hit["o"])
                        moved = True
        return pa.table([[r["k"] for r in taken], [r["o"] for r in taken], [r["s"] for r in taken], list(range(1, len(taken) + 1))], schema=pa.schema([("k", pa.string()), ("o", pa.string()), ("s", pa.string()), ("turn", pa.int32())]))

    return best.withColumn("_one", F.lit(1)).groupBy("_one").applyInArrow(turns, "k string, o string, s string, turn int").withColumnsRenamed({"k": key, "o": owner, "s": "stratum"})
