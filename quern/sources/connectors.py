"""Connector sources as projections of captured responses to observations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F


@dataclass(frozen=True)
class Connector:
    platform: str
    signal: str
    mode: str
    source_class: str
    publication: str
    records: str = "$.items"
    url: str = "url"
    span: str = "text"
    limit: int = 50


def _official(platform: str, signal: str, publication: str = "conditional") -> Connector:
    return Connector(platform, signal, "official_api", "official_registry", publication)


#: Fixed signals and publication states of the known sources.
CONNECTORS = {
    "vacancy_feed": Connector("job_board", "job_posting", "official_api", "official_api", "official_safe"), "vacancy_search": Connector("job_board", "job_posting", "official_api", "public_directory", "experimental"),
    "ats_discovery": Connector("job_board", "job_posting", "permitted_public_page", "company_owned", "experimental"), "career_adverts": Connector("company_site", "job_posting", "permitted_public_page", "company_site", "official_safe"),
    "public_job_boards": Connector("job_board", "job_posting", "permitted_public_page", "company_site", "official_safe"), "web_search": Connector("company_directory", "company_profile", "licensed_api", "search", "discovery_only"),
    "indeed_jobs": Connector("indeed", "job_posting", "unofficial_scraper", "public_directory", "experimental"), "finn_jobs": Connector("job_board", "job_posting", "unofficial_scraper", "public_directory", "experimental"),
    "linkedin_jobs": Connector("linkedin", "job_posting", "guest_api", "public_directory", "experimental"), "linkedin_company": Connector("linkedin", "profile_handle", "guest_api", "public_directory", "experimental"),
    "news_rss": Connector("news", "dated_news", "permitted_public_page", "public_news", "experimental"), "press_wire": Connector("news", "dated_news", "permitted_public_page", "public_news", "discovery_only"),
    "presence_page": Connector("company_site", "company_profile", "permitted_public_page", "company_site", "official_safe"), "press_release": Connector("company_site", "dated_news", "permitted_public_page", "company_site", "official_safe"),
    "places": Connector("google_places", "place_summary", "official_api", "customer_review", "official_safe"), "youtube_linked": Connector("youtube", "profile_metrics", "official_api", "company_owned", "official_safe"),
    "youtube_search": Connector("youtube", "buzz_metrics", "official_api", "public_mention", "conditional"), "social_probe": Connector("facebook", "profile_handle", "permitted_public_page", "company_owned", "official_safe"),
    "wikidata": Connector("wikidata", "profile_metrics", "official_api", "public_mention", "conditional"), "subunits": _official("brreg", "workforce_snapshot", "official_safe"),
    "public_notices": _official("brreg", "public_mention", "official_safe"), "insolvency": _official("brreg", "legal_gazette_notice"), "liens": _official("brreg", "registered_mortgage_lien"),
    "patents": _official("patentstyret", "patent_trademark_record", "official_safe"), "domain_verify": _official("norid", "legal_domain_ownership", "official_safe"),
    "domain_discover": _official("norid", "candidate_domain_discovery", "discovery_only"), "geocode": _official("kartverket", "registered_address_geocode", "official_safe"),
    "construction_approval": _official("dibk", "regulatory_license_record", "official_safe"), "licences": _official("brreg", "regulatory_license_record", "official_safe"), "esg_certificate": _official("company_directory", "esg_certification_record"),
    "food_inspections": _official("brreg", "food_safety_inspection"), "emission_permits": _official("brreg", "environmental_permit_record"), "rnd_grants": _official("brreg", "public_rnd_grant"), "innovation_grants": _official("brreg", "innovation_grant_award"),
    "procurement": _official("brreg", "public_procurement_award"), "exchange_disclosures": _official("news", "stock_exchange_disclosure"), "lei": _official("brreg", "global_legal_entity_identifier"),
    "industry_benchmark": _official("brreg", "industry_macro_benchmark"), "commercial_directory": Connector("company_directory", "commercial_directory_record", "public_directory", "public_directory", "experimental"),
    "annual_report_workforce": Connector("company_site", "workforce_snapshot", "permitted_public_page", "company_site", "not_declared"), "reviews_directory": Connector("company_directory", "review_summary", "permitted_public_page", "customer_review", "not_declared"),
    "maps_results": Connector("google_places", "place_summary", "licensed_api", "customer_review", "not_declared"),
}


def observations_from(responses: DataFrame, name: str) -> DataFrame:
    """responses: organisation_number, url, status, body (JSON), retrieved_at.
    One observation per record of a 200 response; ids are name-org-sha16 of the
    record, the first `limit` records (by id) of each organisation stay, as the
    sources cap their rows."""
    c = CONNECTORS[name]
    items = F.from_json(F.get_json_object("body", c.records), "array<string>")
    rows = responses.where("status = 200").select("organisation_number", "url", "retrieved_at", "body", F.explode(items).alias("item"))
    rows = rows.select(
        F.concat_ws("-", F.lit(name), "organisation_number", F.substring(F.sha2("item", 256), 1, 16)).alias("id"), "organisation_number", F.lit(c.platform).alias("platform"), F.lit(c.signal).alias("signal_type"),
        F.coalesce(F.get_json_object("item", f"$.{c.url}"), "url").alias("source_url"), "retrieved_at", F.sha2(F.col("body").cast("binary"), 256).alias("content_sha256"),
        F.lit(c.mode).alias("acquisition_mode"), F.lit(c.source_class).alias("source_class"), F.lit(c.publication).alias("publication"), F.get_json_object("item", f"$.{c.span}").alias("evidence_span"), F.lit(name).alias("strategy"), F.col("item").alias("metrics"),
    ).dropDuplicates(["id"])
    w = W.partitionBy("organisation_number").orderBy("id")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= c.limit).drop("_n")


def rights(spark) -> DataFrame:
    """The publication dimension (one row a connector)."""
    return spark.createDataFrame([(k, c.publication) for k, c in CONNECTORS.items()], "strategy string, publication string")
