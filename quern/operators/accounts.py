"""Account records: best per year, growth, ratios, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def best_per_year(records: DataFrame, newest: int = 5) -> DataFrame:
    """Company accounts before group accounts, then the highest record id; the
    newest years of each key. Records without a period end are dropped."""
    own = (F.col("account_type") == "SELSKAP").cast("int")
    per_year = W.partitionBy("key", "year").orderBy(F.desc(own), F.desc("record_id"))
    by_age = W.partitionBy("key").orderBy(F.desc("period_end"), F.desc("record_id"))
    best = records.where(F.col("period_end").isNotNull()).withColumn("n", F.row_number().over(per_year)).where("n = 1").drop("n")
    return best.withColumn("age", F.row_number().over(by_age)).where(F.col("age") <= newest)


def latest(records: DataFrame) -> DataFrame:
    """The newest record of each key (ties: highest record id)."""
    fields = [c for c in records.columns if c != "key"]
    top = F.max_by(F.struct(*fields), F.struct("period_end", "record_id"))
    return records.groupBy("key").agg(top.alias("r")).select("key", "r.*")


def growth(best: DataFrame) -> DataFrame:
    """Positional growth over the previous and the second previous record."""
    order = W.partitionBy("key").orderBy("period_end", "record_id")
    one, two = F.lag("revenue", 1).over(order), F.lag("revenue", 2).over(order)
    yoy = F.when(one > 0, F.round((F.col("revenue") - one) / one, 4))
    cagr = F.when((two > 0) & (F.col("revenue") > 0), F.round(F.pow(F.col("revenue") / two, F.lit(0.5)) - 1, 4))
    gap = F.year("period_end") - F.year(F.lag("period_end", 1).over(order))
    out = best.withColumns({"yoy": yoy, "cagr": cagr, "consecutive": gap == 1})
    return out.withColumn("growth_label", F.format_string("%+.1f%%", F.col("yoy") * 100))


def guarded_ratio(top: Column, bottom: Column, digits: int = 4, zero_top: bool = True) -> Column:
    """Null unless the bottom is positive; zero_top=False reads a zero top as missing."""
    ok = (bottom > 0) & top.isNotNull()
    return F.when(ok if zero_top else ok & (top != 0), F.round(top / bottom, digits))


def solvency(ratio: Column) -> Column:
    return F.when(ratio >= 0.40, "Strong").when(ratio >= 0.20, "Adequate").when(ratio.isNotNull(), "Vulnerable")


def employee_band(n: Column) -> Column:
    return F.when(n.isNull(), "missing").when(n == 0, "0").when(n < 5, "1-4").when(n < 20, "5-19").when(n < 100, "20-99").otherwise("100+")


#: Fixed legal forms by their duty to keep accounts.
ALWAYS_OBLIGED = ("AS", "ASA", "BRL", "BBL", "STI", "SF", "VPFO")
CONDITIONALLY_OBLIGED = ("ENK", "ANS", "DA", "SA", "FLI", "ESEK", "NUF", "UTLA", "ORGL", "SAM", "SPA", "KS", "BO")


def obligation(form: Column, latest_accounts: Column) -> Column:
    """Filing seen, required by form, dependent on thresholds, or for review."""
    f = F.upper(F.coalesce(form, F.lit("")))
    seen = F.coalesce(latest_accounts.cast("string"), F.lit("")) != ""
    return F.when(seen, "filing_observed").when(f.isin(*ALWAYS_OBLIGED), "required_by_legal_form").when(f.isin(*CONDITIONALLY_OBLIGED), "threshold_or_activity_dependent").otherwise("special_rule_or_review_required")
