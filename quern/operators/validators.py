"""Ordered-reason validators of news, jobs, attempts, claim values and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import named
from ..functions.urls import host, is_hub, path, registrable

#: Fixed marks.
RECRUITMENT_STEPS = ("karriere", "career", "careers", "job", "jobs", "jobb", "stillinger", "ledige-stillinger", "vacancies", "work-with-us")
POLICY_STEPS = ("privacy", "personvern", "cookies", "terms", "vilkar")
GENERIC_TITLES = ("nyheter", "aktuelt", "news", "les mer", "read more")
NON_NEWS_HOSTS = ("facebook.com", "linkedin.com", "proff.no", "purehelp.no", "1881.no", "gulesider.no")
MAX_NEWS_AGE = 3 * 365 + 31
#: Fixed patterns of leaked secrets in outputs.
LEAKS = (r"sk-[A-Za-z0-9]{20,}", r"AKIA[0-9A-Z]{16}", r"ghp_[A-Za-z0-9]{36}", r"AIza[0-9A-Za-z_-]{35}", r"-----BEGIN [A-Z ]*PRIVATE KEY-----")


def has_step(url: Column, steps: tuple[str, ...]) -> Column:
    return F.arrays_overlap(F.split(F.lower(path(url)), "/"), F.array(*(F.lit(s) for s in steps)))


def news_reason(today: Column, max_age: int = MAX_NEWS_AGE) -> Column:
    """rows: url, title, content_sha256, published_at, site_url, verification,
    company_name, article_text. The first failing rule, or article_verified."""
    url, title = F.trim(F.coalesce("url", F.lit(""))), F.trim(F.coalesce("title", F.lit("")))
    own = (host(F.col("site_url")) != "") & (registrable(host(url)) == registrable(host(F.col("site_url"))))
    foreign = F.lit(False)
    for h in NON_NEWS_HOSTS:
        foreign = foreign | F.contains(host(url), F.lit(h))
    age = F.datediff(today, F.col("published_at"))
    return (
        F.when(~url.rlike("^https?://"), "no_url").when(has_step(url, RECRUITMENT_STEPS), "recruitment_page_not_news").when(has_step(url, POLICY_STEPS), "website_policy_page_not_news")
        .when((F.length(title) < 8) | F.lower(title).isin(*GENERIC_TITLES), "generic_title").when(F.coalesce("content_sha256", F.lit("")) == "", "no_evidence_hash")
        .when(~F.coalesce(own, F.lit(False)) & foreign, "non_news_host").when(F.col("published_at").isNull(), "no_publication_date").when(age < 0, "future_date").when(age > max_age, "too_old")
        .when(is_hub(url), "hub_or_listing_url").when(F.coalesce("verification", F.lit("")) != "article_fetched", "article_not_refetched")
        .when(~named(F.col("company_name"), F.col("article_text")), "company_not_named_in_article").otherwise("article_verified")
    )


def job_reason(today: Column) -> Column:
    """rows: url, title, content_sha256, deadline, employer, company_name."""
    title = F.trim(F.coalesce("title", F.lit("")))
    generic = F.lower(title).isin("jobs", "careers", "ledige stillinger", "karriere", "stillinger") | (F.length(title) < 4)
    return (
        F.when(~F.coalesce(F.col("url").rlike("^https?://"), F.lit(False)), "no_url").when(generic, "generic_title").when(F.coalesce("content_sha256", F.lit("")) == "", "no_evidence_hash")
        .when(F.col("deadline") < today, "expired").when(~named(F.col("company_name"), F.col("employer")), "other_employer").otherwise("job_verified")
    )


def attempt_errors() -> Column:
    """rows: attempt_id, run_id, organisation_number, route_name, status,
    snapshot_hash, runtime_seconds, request_count, cost_usd,
    accepted_claims array<struct<field,evidence_span,source_url>>."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    checks = [(blank(c), f"Missing required field: '{c}'") for c in ("attempt_id", "run_id", "organisation_number", "route_name")]
    checks += [
        (~F.coalesce(F.col("status").isin("abstained", "blocked", "failed"), F.lit(False)) & blank("snapshot_hash"), "Active attempt record lacks required 'snapshot_hash'"),
        (~blank("snapshot_hash") & ~F.col("snapshot_hash").rlike("^[0-9a-fA-F]{64}$"), "Invalid snapshot_hash"),
        (F.exists("accepted_claims", lambda c: F.length(F.trim(F.coalesce(c["evidence_span"], F.lit("")))) < 5), "Accepted claim lacks a span of 5 characters"),
        (F.exists("accepted_claims", lambda c: F.trim(F.coalesce(c["source_url"], F.lit(""))) == ""), "Accepted claim lacks 'source_url'"),
        *((F.coalesce(F.col(c), F.lit(0)) < 0, f"{c} cannot be negative") for c in ("runtime_seconds", "request_count", "cost_usd")),
    ]
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(why)) for bad, why in checks)))


#: Fixed claim fields by the JSON form their values have.
URL_FIELDS, TEXT_FIELDS = ("official_website", "website", "social_profile"), ("hiring_signal", "accounting_obligation")
LIST_FIELDS, OBJECT_FIELDS = ("social_profiles", "roles", "operating_locations"), ("legal_identity", "annual_accounts", "hiring_status", "dated_news", "news", "job_postings", "jobs")
NEEDED_KEYS = {"legal_identity": ("organisation_number", "name"), "hiring_status": ("appears_to_be_hiring",), "dated_news": ("title",), "news": ("title",), "job_postings": ("title",), "jobs": ("title",)}


def value_format_error(field: Column, value: Column) -> Column:
    """Null if an available claim's JSON value has its field's form."""
    v = F.trim(value)
    lacks = F.lit(False)
    for name, keys in NEEDED_KEYS.items():
        for k in keys:
            lacks = lacks | ((field == name) & F.coalesce(F.get_json_object(v, f"$.{k}"), F.lit("")).isin("", "null"))
    return (
        F.when(value.isNull() | (v == "null"), "Value cannot be None").when(field.isin(*URL_FIELDS) & ~v.rlike('^"?https?://'), "Expected HTTP(S) URL string")
        .when(field.isin(*LIST_FIELDS) & ~v.startswith("["), "Expected list").when(field.isin(*OBJECT_FIELDS) & ~v.startswith("{"), "Expected dict")
        .when(field.isin(*TEXT_FIELDS) & v.isin("", '""'), "Expected non-empty string").when(lacks, "Missing key")
    )


def leaks(text: Column) -> Column:
    """Patterns of secrets that a published text shows."""
    return F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(p)) for p in LEAKS)))


def confusers_in(profiles: DataFrame, confusers: DataFrame, key: str) -> DataFrame:
    """(key, confuser) whose name stands in the key's own serialised profile."""
    text = profiles.select(key, F.lower(F.to_json(F.struct(*profiles.columns))).alias("_t"))
    return confusers.join(text, key).where(F.contains("_t", F.lower("confuser"))).select(key, "confuser")
