"""Registers with one record a company: approvals, licences, rights, domains, addresses, channels, knowledge bases, adverts.

responses as in registers.py: organisation_number, name, status, body, url, retrieved_at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_J = F.get_json_object


def _id(prefix: str, digest: Column) -> Column:
    return F.concat_ws("-", F.lit(prefix), "organisation_number", F.substring(digest, 1, 16))


def _body_hash() -> Column:
    return F.sha2(F.col("body").cast("binary"), 256)


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def approvals(responses: DataFrame, today: Column) -> DataFrame:
    """Construction approvals that are the company's own and have not run out."""
    b = F.coalesce(_J("body", "$.dibk-sgdata"), F.col("body"))
    until = _J(b, "$.status.approval_period_to")
    areas = F.filter(F.from_json(_J(b, "$.valid_approval_areas"), "array<struct<function: string, subject_area: string, grade: string>>"), lambda a: F.coalesce(a["subject_area"], F.lit("")) != "")
    ok = (_J(b, "$.enterprise.organizational_number") == F.col("organisation_number")) & (_J(b, "$.status.approved") == "true") & (F.try_to_date(until, "yyyy-MM-dd") >= today)
    company = _J(b, "$.enterprise.name")
    return responses.where((F.col("status") == 200) & ok).select(
        F.concat(F.lit("approval-dibk-"), "organisation_number").alias("id"), "organisation_number", until.alias("valid_through"), F.size(F.coalesce(areas, F.array().cast("array<struct<function:string,subject_area:string,grade:string>>"))).alias("areas"),
        F.concat(company, F.lit(" ("), "organisation_number", F.lit("): DiBK status.approved=true; status.approval_period_to="), until).alias("evidence_span"),
    )


#: Fixed industries that need a labour inspection licence, and the states that are one.
LICENSED, LICENCE = ("81.2", "78.1", "78.2", "78.3"), ("godkjent", "godkjent med vilkår")


def licences(responses: DataFrame, industry: str = "industry_code") -> DataFrame:
    """Labour inspection licences of cleaning and staffing companies."""
    needs = F.lit(False)
    for p in LICENSED:
        needs = needs | F.startswith(F.coalesce(F.col(industry), F.lit("")), F.lit(p))
    state = F.trim(F.coalesce(_some(_J("body", "$.status")), _J("body", "$.godkjenningsstatus"), F.lit("")))
    number = F.replace(F.coalesce(_some(_J("body", "$.organisasjonsnummer")), _J("body", "$.orgnr"), F.lit("")), F.lit(" "), F.lit(""))
    return responses.where((F.col("status") == 200) & needs & (number == F.col("organisation_number")) & F.lower(state).isin(*LICENCE)).select(
        _id("license-arbeidstilsynet", _body_hash()).alias("id"), "organisation_number", state.alias("licence_status"), F.concat(F.lit("Arbeidstilsynet godkjenning for "), "name", F.lit(": "), state).alias("evidence_span"))


_CASE = "struct<applicationNumber: string, registrationNumber: string, patentNumber: string, markVerbalElementText: string, title: string, currentStatusEn: string, currentStatusNo: string, currentStatusDate: string, caseUrl: string>"


def property_rights(responses: DataFrame, limit: int = 5) -> DataFrame:
    """Trademarks, then patents, then designs of a 9-digit company number: the first `limit`, those with a case number."""
    bag = lambda key: F.coalesce(F.from_json(_J("body", f"$.{key}"), f"array<{_CASE}>"), F.array().cast(f"array<{_CASE}>"))
    said = lambda x: F.coalesce(_some(x["currentStatusEn"]), x["currentStatusNo"])
    one = lambda kind, number, title: lambda x: F.struct(F.lit(kind).alias("ip_type"), F.coalesce(number(x), F.lit("")).alias("application_number"), F.coalesce(title(x), F.lit("")).alias("title"), said(x).alias("status"), x["caseUrl"].alias("case_url"))
    every = F.concat(
        F.transform(bag("trademarkBag"), one("trademark", lambda x: F.coalesce(_some(x["applicationNumber"]), x["registrationNumber"]), lambda x: F.coalesce(_some(x["markVerbalElementText"]), x["title"]))),
        F.transform(bag("patentBag"), one("patent", lambda x: F.coalesce(_some(x["applicationNumber"]), x["patentNumber"]), lambda x: F.coalesce(_some(x["title"]), F.lit("Patent registration")))),
        F.transform(bag("designBag"), one("design", lambda x: x["applicationNumber"], lambda x: F.coalesce(_some(x["title"]), F.lit("Design registration")))),
    )
    rows = responses.where((F.col("status") == 200) & F.col("organisation_number").rlike("^[0-9]{9}$")).select("organisation_number", "name", F.explode(F.slice(every, 1, limit)).alias("h")).select("organisation_number", "name", "h.*").where("application_number <> ''")
    digest = F.sha2(F.concat_ws("|", "organisation_number", F.lit("patentstyret"), "application_number", "title").cast("binary"), 256)
    return rows.select(
        F.concat_ws("-", F.lit("ip"), "ip_type", "organisation_number", F.substring(digest, 1, 16)).alias("id"), "organisation_number", "ip_type", "application_number", "title",
        F.coalesce(_some(F.col("case_url")), F.concat(F.lit("https://services.patentstyret.no/search-details/"), "ip_type", F.lit("/"), "application_number")).alias("case_url"),
        F.concat(F.lit("Patentstyret returned "), "ip_type", F.lit(" case "), "application_number", F.lit(" for company number "), "organisation_number", F.lit(" ("), "name", F.lit("). Registry status: "), F.coalesce(_some(F.col("status")), F.lit("unreported")), F.lit(".")).alias("evidence_span"),
    )


#: Fixed reference averages by industry division: sector, margin in per cent, median monthly salary, growth. A dimension, never evidence.
BENCHMARKS = {
    "62": ("Informasjonsteknologi og datatjenester", 8.5, 72500, "+6.2%"), "78": ("Arbeidskrafttjenester og rekruttering", 3.8, 48200, "+2.1%"), "81": ("Eiendomsservice og renhold", 4.2, 42100, "+3.0%"), "41": ("Oppføring av bygninger", 4.9, 51500, "+1.8%"),
    "43": ("Spesialisert bygge- og anleggsvirksomhet", 5.4, 52800, "+2.5%"), "46": ("Engroshandel", 3.6, 58900, "+1.5%"), "47": ("Detaljhandel", 2.9, 41800, "+0.8%"), "56": ("Serveringsvirksomhet (restaurant og kafé)", 3.1, 36500, "+4.1%"),
    "69": ("Juridisk og regnskapsmessig tjenesteyting", 14.2, 68400, "+5.0%"), "70": ("Hovedkontortjenester og bedriftsrådgivning", 9.8, 76200, "+4.8%"), "71": ("Arkitektvirksomhet og teknisk konsulentvirksomhet", 7.6, 69100, "+3.4%"),
}
OTHER = (5.0, 50000, "+2.5%")


def benchmarks(companies: DataFrame, industry: str = "industry_code") -> DataFrame:
    """companies: organisation_number, industry_code. The division's reference averages, or general ones under the code itself."""
    code = F.trim(F.col(industry))
    pick = lambda i, other: F.coalesce(*(F.when(F.substring(code, 1, 2) == k, F.lit(v[i])) for k, v in BENCHMARKS.items()), other)
    rows = companies.where(F.coalesce(F.col(industry), F.lit("")) != "").select("organisation_number", code.alias("code"), pick(0, F.concat(F.lit("Næringskode "), code)).alias("sector"), pick(1, F.lit(OTHER[0])).alias("margin_pct"), pick(2, F.lit(OTHER[1])).alias("median_salary"), pick(3, F.lit(OTHER[2])).alias("growth"))
    digest = F.sha2(F.concat_ws("|", "organisation_number", F.lit("ssb"), "code", "sector").cast("binary"), 256)
    return rows.select(_id("benchmark-ssb", digest).alias("id"), "organisation_number", "sector", "margin_pct", "median_salary", "growth")


_ENTITY = "array<struct<roles: array<string>, vcardArray: array<string>, publicIds: array<struct<identifier: string>>>>"


def domain_records(responses: DataFrame) -> DataFrame:
    """Domain registry records of a site's .no domain: by number, by the registrant's name, or unverified."""
    d = responses.withColumn("domain", F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim("site")), "^.*://", ""), "[/:].*$", ""), r"^www\.", ""))
    d = d.where((F.col("status") == 200) & F.endswith("domain", F.lit(".no")) & (F.length("domain") >= 4))
    holders = F.filter(F.from_json(_J("body", "$.entities"), _ENTITY), lambda e: F.arrays_overlap(e["roles"], F.array(F.lit("registrant"), F.lit("registrant contact"))))
    names = F.flatten(F.transform(holders, lambda e: F.transform(F.filter(F.from_json(F.try_element_at(e["vcardArray"], F.lit(2)), "array<array<string>>"), lambda p: (F.size(p) > 3) & p[0].isin("fn", "org")), lambda p: p[3])))
    plain = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")
    d = d.withColumns({"registrant": F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit("")), "_own": F.coalesce(F.exists(holders, lambda e: F.exists(e["publicIds"], lambda p: p["identifier"] == F.col("organisation_number"))), F.lit(False))})
    same = (F.col("registrant") != "") & (plain(F.col("registrant")) == plain(F.col("name")))
    said = F.when(F.col("_own"), F.concat(F.lit("registrant organisation number matches "), "organisation_number")).when(same, F.concat(F.lit("registrant display name matches "), "name", F.lit("; organisation number was not exposed"))).otherwise("registrant record checked; no exact organisation-number match exposed")
    return d.select(
        _id("norid", _body_hash()).alias("id"), "organisation_number", "domain", F.when(F.col("_own"), "legal_domain_ownership").otherwise("candidate_domain_discovery").alias("signal_type"), F.when(F.col("_own"), "org_number_match").when(same, "registrant_name_match").otherwise("registrant_unverified").alias("ownership_state"),
        F.concat(F.lit("Norid .no registry verification for "), "domain", F.lit(": "), said).alias("evidence_span"),
    )


def geocodes(responses: DataFrame) -> DataFrame:
    """The first address hit: text, place, coordinates and cadastral number."""
    hit = lambda k: _J("body", f"$.adresser[0].{k}")
    parcel = F.when((F.coalesce(hit("gardsnummer"), F.lit("0")) != "0") & (F.coalesce(hit("bruksnummer"), F.lit("0")) != "0"), F.concat(F.lit("Gnr "), hit("gardsnummer"), F.lit(", Bnr "), hit("bruksnummer"))).otherwise("")
    section = F.when(F.coalesce(hit("seksjonsnummer"), F.lit("0")) != "0", F.concat(F.lit(", Snr "), hit("seksjonsnummer"))).otherwise("")
    return responses.where((F.col("status") == 200) & hit("adressetekst").isNotNull()).select(
        "organisation_number", hit("adressetekst").alias("formatted_address"), hit("postnummer").alias("postcode"), hit("kommunenummer").alias("municipality_number"), hit("representasjonspunkt.lat").cast("double").alias("latitude"), hit("representasjonspunkt.lon").cast("double").alias("longitude"), F.concat(parcel, section).alias("cadastral_id"))


def linked_channel(link: Column) -> Column:
    """Struct(kind, value) of how a company-linked channel address is looked up; null for addresses that only a name search could solve."""
    part = lambda p: F.regexp_extract(link, r"^https?://(?:www\.)?youtube\.com/" + p + r"/?(?:[?#].*)?$", 1)
    by = {"id": part("channel/(UC[A-Za-z0-9_-]{22})"), "forHandle": part("(@[^/?#]+)"), "forUsername": part("user/([^/?#]+)")}
    return F.coalesce(*(F.when(v != "", F.struct(F.lit(k).alias("kind"), v.alias("value"))) for k, v in by.items()))


def channels(responses: DataFrame) -> DataFrame:
    """responses also have link. Statistics of the one channel that the linked address names; a hidden subscriber count stays null."""
    d = responses.withColumn("by", linked_channel(F.col("link"))).withColumn("channel_id", _J("body", "$.items[0].id")).withColumn("n", F.size(F.from_json(_J("body", "$.items"), "array<string>")))
    d = d.where((F.col("status") == 200) & F.col("by").isNotNull() & (F.col("n") == 1) & F.col("channel_id").rlike("^UC[A-Za-z0-9_-]{22}$") & ((F.col("by.kind") != "id") | (F.col("by.value") == F.col("channel_id"))))
    number = lambda k: _J("body", f"$.items[0].statistics.{k}").cast("long")
    hidden = F.coalesce(_J("body", "$.items[0].statistics.hiddenSubscriberCount"), F.lit("")) == "true"
    return d.select(F.concat_ws("-", F.lit("yt-linked"), "organisation_number", "channel_id").alias("id"), "organisation_number", F.concat(F.lit("https://www.youtube.com/channel/"), "channel_id").alias("source_url"), F.when(~hidden, number("subscriberCount")).alias("subscribers"), number("videoCount").alias("videos"), number("viewCount").alias("views"))


#: Fixed properties of social profiles and the address each stands for.
HANDLES = {"linkedin": ("P4264", "https://www.linkedin.com/company/"), "youtube": ("P2397", "https://www.youtube.com/channel/"), "facebook": ("P2013", "https://www.facebook.com/"), "twitter": ("P2002", "https://x.com/"), "github": ("P2037", "https://github.com/")}


def knowledge_entity(responses: DataFrame) -> DataFrame:
    """The first knowledge base item that claims the organisation's number."""
    v = lambda k: F.coalesce(_J("body", f"$.results.bindings[0].{k}.value"), F.lit(""))
    qid, label = F.element_at(F.split(v("item"), "/"), -1), F.coalesce(_some(v("itemLabel")), F.col("name"))
    return responses.where((F.col("status") == 200) & _J("body", "$.results.bindings[0]").isNotNull()).select(
        _id("wikidata-entity", _body_hash()).alias("id"), "organisation_number", F.coalesce(_some(v("item")), F.concat(F.lit("https://www.wikidata.org/wiki/Special:EntityData/"), qid)).alias("source_url"), qid.alias("qid"), label.alias("label"), v("website").alias("website"),
        F.concat(F.lit("Wikidata entity "), qid, F.lit(" ("), label, F.lit(") matches Norwegian organization "), "organisation_number").alias("evidence_span"))


def knowledge_handles(responses: DataFrame) -> DataFrame:
    """Social profiles that the item asserts."""
    v = lambda k: F.trim(_J("body", f"$.results.bindings[0].{k}.value"))
    rows = F.array(*(F.struct(F.lit(k).alias("platform"), F.lit(p).alias("property"), F.when(F.startswith(v(k), F.lit("http")), v(k)).otherwise(F.concat(F.lit(u), v(k))).alias("source_url")) for k, (p, u) in HANDLES.items()))
    d = responses.where("status = 200").select("organisation_number", _body_hash().alias("h"), F.explode(rows).alias("r")).where("r.source_url is not null and not endswith(r.source_url, '/')")
    return d.select(F.concat_ws("-", F.lit("social"), F.col("r.platform"), "organisation_number", F.substring("h", 1, 16)).alias("id"), "organisation_number", "r.platform", "r.property", "r.source_url")


def vacancies(responses: DataFrame, wanted: DataFrame, now: Column) -> DataFrame:
    """responses: uuid, status, body of adverts; wanted: org (company), number (its own or a subunit's). Active adverts of
    a wanted employer number that have not run out; an expiry without an offset counts by its day."""
    until = _J("body", "$.ad_content.expires")
    zoned = until.rlike(r"(?:Z|[+-][0-9]{2}:?[0-9]{2})$")
    live = F.when(zoned, F.try_to_timestamp(until) > now).otherwise(F.try_to_date(F.substring(until, 1, 10), "yyyy-MM-dd") >= F.to_date(now))
    title = F.trim(F.coalesce(_some(_J("body", "$.ad_content.title")), _J("body", "$.ad_content.jobtitle"), F.lit("")))
    employer = F.regexp_replace(F.coalesce(_J("body", "$.ad_content.employer.orgnr"), F.lit("")), "[^0-9]", "")
    d = responses.where((F.col("status") == 200) & (F.upper(_J("body", "$.status")) == "ACTIVE") & (_J("body", "$.uuid") == F.col("uuid")) & F.coalesce(live, F.lit(False)) & (title != "")).withColumn("number", employer)
    j = d.join(wanted.select("org", "number").distinct(), "number")
    digest = F.sha2(F.concat_ws("|", "org", "uuid").cast("binary"), 256)
    return j.select(F.concat(F.lit("nav-feed-job-"), F.substring(digest, 1, 24)).alias("id"), F.col("org").alias("organisation_number"), "uuid", F.col("number").alias("employer_org"), title.alias("job_title"), F.concat(F.lit("https://arbeidsplassen.nav.no/stillinger/stilling/"), "uuid").alias("source_url"), F.concat(F.lit("Active NAV vacancy '"), title, F.lit("' for employer organisation number "), "number").alias("evidence_span"))
