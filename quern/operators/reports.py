"""Audits, budgets and proxy scores over observations, labels, envelopes and request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .metrics import ratio

#: Fixed verdicts that a reviewed label has.
VERDICTS = ("exact_entity", "metric_correct", "evidence_supported", "evidence_span_valid", "connector_policy_passed")


def reviewed(labelled_sentiment: Column) -> Column:
    """A label with all verdicts, a reviewer and a time; a sentiment verdict too where a sentiment was given."""
    ok = F.lit(True)
    for v in VERDICTS:
        ok = ok & F.col(v).isNotNull()
    return ok & (~labelled_sentiment | F.col("sentiment_correct").isNotNull()) & (F.trim(F.coalesce("reviewer", F.lit(""))) != "") & F.col("reviewed_at").isNotNull()


def audit_precision(observations: DataFrame, labels: DataFrame, published: Column, least: int = 100) -> DataFrame:
    """observations: id, sentiment_label and what `published` needs; labels: id, verdicts, reviewer, reviewed_at. One row; rates are null where nothing is published."""
    j = labels.join(observations.withColumn("_published", published), "id", "left")
    done = reviewed(F.col("sentiment_label").isNotNull())
    at = done & F.coalesce("_published", F.lit(False))
    wrong = lambda v: F.count_if(at & ~F.col(v))
    felt = at & F.col("sentiment_label").isNotNull()
    a = j.agg(
        F.count("*").alias("labels"), F.count_if(~done).alias("incomplete_labels"), F.count_if(at).alias("published_audited"), wrong("exact_entity").alias("wrong_entity"), wrong("metric_correct").alias("wrong_metric"),
        wrong("evidence_supported").alias("unsupported"), wrong("evidence_span_valid").alias("invalid_spans"), F.count_if(felt).alias("sentiment_audited"), F.count_if(felt & F.col("sentiment_correct")).alias("sentiment_correct"),
    )
    n = F.col("published_audited")
    share = lambda bad: F.when(n > 0, F.round(1 - F.col(bad) / n, 6))
    return a.withColumns({"audit_size_gate": n >= least, "entity_precision": share("wrong_entity"), "metric_precision": share("wrong_metric"), "support_rate": share("unsupported"), "span_validity": share("invalid_spans"), "sentiment_accuracy": F.round(ratio(F.col("sentiment_correct"), F.col("sentiment_audited"), None), 6)})


def points(weight: float, value: Column) -> Column:
    return F.round(F.lit(weight) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.cast("double"), F.lit(0.0)))), 3)


#: Fixed weights of the proxy score: external parts by their metric, foundation parts by theirs.
EXTERNAL = {"multi_source_breadth": (10.0, "two_platforms"), "workforce_and_jobs": (7.0, "workforce_jobs"), "ratings_and_reviews": (8.0, "ratings_reviews"), "buzz_and_engagement": (7.0, "buzz_engagement"), "external_freshness": (3.0, "fresh_coverage")}
FOUNDATION = {"official_identity": (4.0, "exact_registry"), "annual_accounts": (4.0, "financial"), "roles_and_locations": (4.0, "roles_locations"), "website_terminal": (3.0, "website_terminal")}


def proxy_score(m: DataFrame) -> DataFrame:
    """m: one row or more of metrics and flags. Adds the category points, raw_score and qualified."""
    on = lambda flag, c: F.when(F.coalesce(flag, F.lit(False)), c).otherwise(0.0)
    right = (F.col("published_audited") > 0) & (F.col("wrong_entity") == 0)
    sentiment = F.col("sentiment_qualified") & (F.col("sentiment_wrong") == 0) & (F.col("sentiment_support") == 1.0)
    external = on(F.col("external_qualified") & right, F.lit(10.0)) + on(sentiment, points(10.0, F.col("sentiment")))
    for weight, metric in EXTERNAL.values():
        external = external + on(F.col("external_qualified"), points(weight, F.col(metric)))
    foundation = F.lit(0.0)
    for weight, metric in FOUNDATION.values():
        foundation = foundation + points(weight, F.col(metric))
    research = F.round(F.least(F.lit(10.0), F.least(F.lit(12.0), F.col("research_score")) * 10 / 12), 3)
    research = F.when(F.col("research_external"), research).otherwise(F.least(F.lit(5.0), research))
    daily = on(F.col("batch_valid"), F.lit(4.0)) + on(F.col("resume_valid"), F.lit(2.0)) + on(F.col("refresh_valid"), F.lit(3.0)) + on(F.col("batch_valid") & (F.col("p95_ms") <= 10_000), F.lit(1.0)) + on(F.col("connector_policy"), F.lit(2.0))
    product = F.least(F.lit(8.0), F.col("ux_score"))
    product = F.when(F.col("ux_external"), product).otherwise(F.least(F.lit(4.0), product))
    supported = (F.col("published_audited") > 0) & (F.col("unsupported") == 0) & (F.col("span_validity") == 1.0)
    gates = F.col("audit_size_gate") & right & supported & F.col("connector_policy") & (F.col("exact_registry") == 1.0) & F.col("batch_valid") & F.col("refresh_valid")
    out = m.withColumns({"external_points": F.round(external, 3), "foundation_points": F.round(foundation, 3), "research_points": research, "daily_points": F.round(daily, 3), "product_points": F.round(product, 3)})
    total = F.col("external_points") + F.col("foundation_points") + F.col("research_points") + F.col("daily_points") + F.col("product_points")
    return out.withColumns({"raw_score": F.round(total, 3), "qualified": F.coalesce(gates & F.col("external_qualified"), F.lit(False))})


def budget_report(requests: DataFrame, run: str, limit: int, latency: str = "elapsed_ms", cost: str = "cost_usd", size: str = "bytes") -> DataFrame:
    """One row a run: totals, what remains, and the latencies at places n div 2 and 0.95 n of the sorted list (a
    reading of percentiles of its own). The places are found by counts of equal values, so no list is gathered."""
    from pyspark.sql import Window as W

    totals = requests.groupBy(run).agg(F.count("*").alias("total_requests"), F.round(F.sum(cost), 4).alias("total_cost"), F.sum(size).alias("total_bytes"))
    values = requests.where(F.col(latency).isNotNull()).groupBy(run, latency).agg(F.count("*").alias("k"))
    upto = values.withColumn("upto", F.sum("k").over(W.partitionBy(run).orderBy(latency))).withColumn("n", F.sum("k").over(W.partitionBy(run)))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col(latency)))
    spread = upto.groupBy(run).agg(at(F.floor(F.col("n") / 2)).alias("p50_ms"), at(F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(0.95)))).alias("p95_ms"))
    return totals.join(spread, run, "left").withColumn("remaining_requests", F.greatest(F.lit(0), F.lit(limit) - F.col("total_requests")))


def owner_attribution(requests: DataFrame, run: str, owner: str, cost: str = "cost_usd", size: str = "bytes") -> DataFrame:
    """Requests, cost and bytes of each owner of a run; rows without an owner are shared."""
    return requests.groupBy(run, F.coalesce(F.col(owner).cast("string"), F.lit("shared")).alias("owner")).agg(F.count("*").alias("requests"), F.round(F.sum(cost), 4).alias("cost"), F.sum(size).alias("bytes"))


#: Fixed states in which an envelope may end.
TERMINAL = ("available", "not_available", "blocked", "not_applicable", "ambiguous", "failed")


def results_audit(envelopes: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """envelopes: key, state, name, financials, roles, summary; claims: key, field, availability. One row of counts over all envelopes."""
    has = claims.where("availability = 'available'").groupBy(key).agg(F.collect_set("field").alias("fields"))
    e = envelopes.join(has, key, "left")
    of = lambda field: F.count_if(F.array_contains("fields", field)).alias(field)
    some = lambda c: F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return e.agg(
        F.count("*").alias("envelopes"), F.count_if(F.col("state").isin(*TERMINAL)).alias("terminal"), some("name").alias("names"), F.count_if(F.col("financials") == "available").alias("accounts"), F.count_if(F.col("roles") == "available").alias("role_modules"),
        of("operating_locations"), of("registered_address"), of("official_website"), of("dated_news"), of("job_postings"), some("summary").alias("syntheses"),
    )


def score_summary(scores: DataFrame, score: str, parts: list[str]) -> DataFrame:
    """Mean, companies at 50, 70 and 90 points or more, and the mean share of each part's best."""
    a = scores.agg(F.count("*").alias("companies"), F.round(F.avg(score), 3).alias("mean"), *(F.count_if(F.col(score) >= t).alias(f"at_least_{t}") for t in (50, 70, 90)), *(F.round(F.avg((F.col(p) > 0).cast("int")), 6).alias(f"{p}_coverage") for p in parts))
    return a


def score_distribution(scores: DataFrame, score: str) -> DataFrame:
    return scores.groupBy(score).agg(F.count("*").alias("companies"))
