"""Observation validation, publication policy, quarantine and footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.urls import host

#: Fixed allow-lists.
PLATFORMS = (
    "company_site", "google_places", "linkedin", "facebook", "instagram", "x", "youtube", "tiktok", "glassdoor", "indeed", "job_board", "news", "openstreetmap", "brreg",
    "apple_app_store", "google_play", "wikidata", "wikipedia", "company_directory", "patentstyret", "dibk", "norid", "kartverket",
)
SIGNALS = (
    "company_profile", "profile_handle", "profile_metrics", "place_summary", "registered_address", "registered_address_geocode", "review", "review_summary", "job_posting",
    "workforce_snapshot", "public_post", "public_mention", "buzz_metrics", "dated_news", "patent_trademark_record", "regulatory_license_record", "official_notice", "legal_domain_ownership",
)
MODES = ("official_api", "licensed_api", "company_authorized_export", "permitted_public_page")
INDEPENDENT = ("customer_review", "employee_review", "licensed_news", "public_news", "public_mention", "official_notice")
NEEDS_SPAN = ("review", "public_post", "public_mention")
LABELS = ("positive", "neutral", "negative", "mixed")
RESTRICTED = ("linkedin", "facebook", "instagram", "glassdoor", "indeed", "tiktok", "x")
OFFICIAL = ("company_site", "company_owned", "official", "official_api", "official_registry", "official_subunits")
UNTRUSTED_MODES = ("unofficial_scraper", "guest_api", "public_directory")


def reasons() -> Column:
    """All failed checks of a row, in fixed order; empty means publishable."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    absent = lambda c, allowed: ~F.coalesce(F.col(c).isin(*allowed), F.lit(False))
    labelled = F.col("sentiment_label").isNotNull()
    checks = [
        (blank("id"), "missing observation id"),
        (~F.coalesce(F.col("organisation_number").rlike("^[0-9]+$"), F.lit(False)), "missing or invalid organisation number"),
        (absent("platform", PLATFORMS), "unsupported platform"), (absent("signal_type", SIGNALS), "unsupported signal type"),
        (host(F.col("source_url")) == "", "missing or invalid source URL"), (F.col("retrieved_at").isNull(), "missing retrieval time"),
        (F.coalesce(F.length("content_sha256"), F.lit(0)) != 64, "missing content hash"), (~F.coalesce("exact_entity", F.lit(False)), "exact legal entity is not verified"),
        (blank("identity_proof"), "missing exact-entity proof"), (absent("acquisition_mode", MODES), "acquisition mode is not approved for publication"),
        (absent("rights_status", ("approved",)), "source rights are not approved"), (F.col("signal_type").isin(*NEEDS_SPAN) & blank("evidence_span"), "missing evidence span"),
        (labelled & absent("sentiment_label", LABELS), "unsupported sentiment label"), (labelled & absent("source_class", INDEPENDENT), "sentiment source is not independent"),
        (labelled & blank("sentiment_model_version"), "missing sentiment model version"),
    ]
    return F.array_compact(F.array(*(F.when(bad, F.lit(why)) for bad, why in checks)))


def policy_reason(rights: DataFrame | None = None) -> Column:
    """First matching publication reason; `publication` (official_safe,
    experimental, conditional, discovery_only) comes from a rights join."""
    return (
        F.when(F.col("platform").isin(*RESTRICTED), F.concat(F.lit("restricted_platform:"), F.col("platform")))
        .when(F.col("publication") == "official_safe", "source_rights_registry_official_safe")
        .when(F.col("publication").isin("experimental", "conditional", "discovery_only"), F.concat(F.lit("registry_"), F.col("publication"), F.lit(":"), F.col("strategy")))
        .when(F.col("source_class").isin(*OFFICIAL) & ~F.col("acquisition_mode").isin(*UNTRUSTED_MODES), "verified_company_or_official_source")
        .otherwise("undeclared_source_route")
    )


def publishable_reason(reason: Column) -> Column:
    return reason.isin("source_rights_registry_official_safe", "declared_official_safe_strategy", "verified_company_or_official_source", "experimental_mode")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) by the policy reason; every row is in one."""
    d = rows.withColumn("reason", policy_reason())
    ok = publishable_reason(F.col("reason"))
    return d.where(ok).drop("reason"), d.where(~ok).withColumn("publication_status", F.lit("quarantined")).withColumnRenamed("reason", "quarantine_reason")


def footprint(rows: DataFrame, as_of: Column, days: int = 45) -> DataFrame:
    """One row per organisation of accepted observations. Counts of distinct
    urls come from one extra aggregation level, all in partial aggregates."""
    from ..functions.dates import fresh

    d = rows.withColumn("ok", F.size(reasons()) == 0)
    ok = F.col("ok")
    kind = lambda *names: ok & F.col("signal_type").isin(*names)
    sentiment = ok & F.col("sentiment_label").isNotNull()
    scalar = F.when(F.col("sentiment_label") == "positive", 1).when(F.col("sentiment_label") == "neutral", 0).when(F.col("sentiment_label") == "negative", -1)
    out = d.groupBy("organisation_number").agg(
        F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), F.count_if(ok & fresh(F.col("retrieved_at"), as_of, days)).alias("fresh"),
        F.count_if(kind("review", "review_summary", "place_summary")).alias("reviews"),
        F.countDistinct(F.when(kind("job_posting"), F.col("source_url"))).alias("jobs"),
        F.countDistinct(F.when(kind("public_post", "public_mention", "buzz_metrics"), F.col("source_url"))).alias("public_items"),
        F.countDistinct(F.when(ok, F.col("platform"))).alias("platforms"),
        F.count_if(sentiment).alias("sentiment_items"), F.countDistinct(F.when(sentiment, host(F.col("source_url")))).alias("sentiment_hosts"),
        F.countDistinct(F.when(sentiment, F.col("reviewer_id"))).alias("sentiment_reviewers"), F.avg(F.when(sentiment, scalar)).alias("mean"),
    )
    ready = (F.col("sentiment_items") >= 10) & ((F.col("sentiment_hosts") >= 2) | (F.col("sentiment_reviewers") >= 10))
    return out.withColumn("sentiment_score", F.when(ready, F.round(F.lit(50) + F.lit(50) * F.col("mean"), 1))).drop("mean")
