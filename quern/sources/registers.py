"""Public registers: captured JSON and HTML responses as observations, by the register's own shape.

responses: organisation_number, name, status, body, retrieved_at (timestamp). A
register's records stand under the first of several keys that has any; each field
under the first of several names that is not empty (nested names by dots), else its
default. Texts are templates over the fields, {org}, {name}, {day} and {year} of retrieval.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Register:
    platform: str
    signal: str
    source_class: str
    strategy: str
    prefix: str
    digest: str
    url: str
    published: str
    span: str
    records: tuple[str, ...] = ()
    fields: dict = field(default_factory=dict)  # name -> (field names, default template or None)
    derived: dict = field(default_factory=dict)  # name -> function of the row's columns
    mode: str = "official_api"
    limit: int = 5


def day8(col: Column) -> Column:
    """YYYYMMDD as YYYY-MM-DD, else as given."""
    return F.when(col.rlike("^[0-9]{8}$"), F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))).otherwise(col)


def amount(col: Column, unit: Column, missing: str) -> Column:
    """Whole amount with blanks between thousands and its unit, or what stands for none."""
    n = col.try_cast("double")
    return F.when(n.isNotNull(), F.concat(F.replace(F.format_number(n, 0), F.lit(","), F.lit(" ")), F.lit(" "), unit)).otherwise(missing)


#: Fixed food inspection grades.
GRADES = {"0": "Smil (Ingen avvik funnet - Meget bra)", "1": "Strek (Mindre avvik - Oppfølging kreves)", "2": "Sur munn (Betydelige avvik)", "3": "Sur munn (Alvorlige avvik / Vedtak fattet)"}
#: Fixed marks of insolvency notices.
INSOLVENCY = ("åpning av konkurs", "konkursåpning", "tvangsoppløsning", "innstilling av bobehandling")


def _grade(row: dict[str, Column]) -> Column:
    out = F.concat(F.lit("Karakter "), row["grade"])
    for k, v in GRADES.items():
        out = F.when(row["grade"] == k, v).otherwise(out)
    return out


#: Fixed shapes of the registers: keys, field names, defaults, identifiers and texts.
REGISTERS = {
    "procurement": Register(
        "doffin", "public_procurement_award", "official_procurement_registry", "doffin_procurement_search", "procurement", "{org}|doffin|{notice_id}|{title}", "{case_url}", "{publication_date}",
        "Doffin {notice_type} '{title}' (Notice #{notice_id}) linked to {name} ({org})", ("items", "notices", "results"),
        {"notice_id": (("id", "noticeId", "reference"), ""), "title": (("title", "heading"), "Offentlig kontrakt: {name}"), "notice_type": (("noticeType", "type"), "Kontraktstildeling"), "publication_date": (("publicationDate", "date"), "{day}"), "given_url": (("url",), ""), "estimated_value": (("estimatedValue", "value"), None)},
        {"case_url": lambda r: F.when(r["notice_id"] == "", "https://doffin.no/Notice").when(r["given_url"] != "", r["given_url"]).otherwise(F.concat(F.lit("https://doffin.no/Notice/Details/"), r["notice_id"]))},
    ),
    "rnd_grants": Register(
        "forskningsradet", "public_rnd_grant", "research_funding_authority", "forskningsradet_project_lookup", "rnd-grant", "{org}|forskningsradet|{project_number}|{title}", "{project_url}", "{published_year}",
        "Norges forskningsråd tildeling ({funding_scheme}) til {name}: '{title}' ({amount_label}, {start_year}–{end_year})", ("projects", "items", "results"),
        {"project_number": (("projectNumber", "id"), ""), "title": (("title", "projectTitle"), "Forskningsprosjekt: {name}"), "funding_scheme": (("fundingScheme", "program"), "Forskningsrådet"), "amount_nok": (("allocatedAmount", "totalBudget"), None), "start_year": (("startYear", "startDate:4"), ""), "end_year": (("endYear", "endDate:4"), "")},
        {"project_url": lambda r: F.when(r["project_number"] != "", F.concat(F.lit("https://prosjektbanken.forskningsradet.no/project/FORISS/"), r["project_number"])).otherwise("https://prosjektbanken.forskningsradet.no"), "amount_label": lambda r: amount(r["amount_nok"], F.lit("NOK"), "Tildelt støtte"), "published_year": lambda r: F.when(r["start_year"] != "", r["start_year"]).otherwise(r["day"])},
    ),
    "innovation_grants": Register(
        "innovasjon_norge", "innovation_grant_award", "innovation_agency", "innovasjon_norge_grant_lookup", "in-grant", "{org}|in|{grant_id}|{project_name}|{amount_text}", "{case_url}", "{grant_year}",
        "Innovasjon Norge tildeling ({scheme}) til {name}: '{project_name}' ({amount_label}, år {grant_year})", ("tildelinger", "items", "results"),
        {"grant_id": (("id", "tildelingId"), ""), "project_name": (("prosjektnavn", "title"), "Innovasjonsprosjekt: {name}"), "scheme": (("ordning", "program"), "Innovasjon Norge Tilskudd"), "amount_nok": (("tilsagn", "belop"), None), "grant_year": (("ar", "year"), "{year}"), "region": (("fylke", "kommune"), "")},
        {"case_url": lambda r: F.when(r["grant_id"] != "", F.concat(F.lit("https://tildeling.innovasjonnorge.no/tildelinger/"), r["grant_id"])).otherwise("https://www.innovasjonnorge.no"), "amount_label": lambda r: amount(r["amount_nok"], F.lit("NOK"), "Innvilget tilskudd"), "amount_text": lambda r: F.coalesce(r["amount_nok"], F.lit("None"))},
    ),
    "exchange_disclosures": Register(
        "oslo_bors", "stock_exchange_disclosure", "stock_exchange", "", "bors", "{org}|oslobors|{message_id}|{title}", "{case_url}", "{published_day}",
        "Oslo Børs ({market}) børsmelding for {name} [{ticker}]: '{title}' ({published_day})", ("data", "messages", "items"),
        {"message_id": (("messageId", "id"), ""), "title": (("title", "header"), "Børsmelding: {name}"), "ticker": (("issuerSign", "ticker"), ""), "market": (("market", "segment"), "Oslo Børs"), "published_time": (("publishedTime", "date"), "{day}"), "category": (("categoryName", "category"), "Informasjonspliktig pressemelding")},
        {"case_url": lambda r: F.when(r["message_id"] != "", F.concat(F.lit("https://newsweb.oslobors.no/message/"), r["message_id"])).otherwise("https://newsweb.oslobors.no"), "published_day": lambda r: F.substring(r["published_time"], 1, 10)},
    ),
    "emission_permits": Register(
        "miljodirektoratet", "environmental_permit_record", "environmental_authority", "miljodirektoratet_permit_lookup", "permit-env", "{org}|miljodir|{permit_id}|{permit_type}", "https://www.norskeutslipp.no/virksomhet/{org}", "{decided}",
        "Miljødirektoratet {permit_type} for {name} ({facility_name}): Status {status_text} (Vedtatt {decided})", ("tillatelser", "items", "anlegg"),
        {"permit_id": (("tillatelseId", "id"), ""), "facility_name": (("anleggsnavn", "navn"), "{name}"), "permit_type": (("tillatelsestype", "type"), "Utslippstillatelse etter forurensningsloven"), "status_text": (("status",), "Gjeldende"), "decided_at": (("vedtaksdato", "dato"), "{day}")},
        {"decided": lambda r: F.substring(r["decided_at"], 1, 10)},
    ),
    "food_inspections": Register(
        "mattilsynet", "food_safety_inspection", "official_inspection_authority", "mattilsynet_smilefjes_lookup", "foodsafety", "{org}|mattilsynet|{inspection_id}|{date_given}|{grade}", "https://smilefjes.mattilsynet.no/tilsyn/{org}", "{inspected}",
        "Mattilsynet Smilefjes-tilsyn for {name}: {grade_label} (dato {inspected})", ("entries",),
        {"inspection_id": (("tilsynid", "id"), ""), "date_given": (("dato",), ""), "grade": (("total_karakter",), "0"), "location_name": (("navn",), "{name}"), "street": (("adr",), ""), "place": (("poststed",), "")},
        {"grade_label": _grade, "inspected": lambda r: F.when(r["date_given"] == "", r["day"]).otherwise(day8(r["date_given"])), "address": lambda r: F.regexp_replace(F.concat(r["street"], F.lit(", "), r["place"]), "^[, ]+|[, ]+$", "")},
    ),
    "liens": Register(
        "losoreregisteret", "registered_mortgage_lien", "official_mortgage_registry", "", "lien", "{org}|losore|{document_id}|{mortgage_type}|{amount_text}", "https://data.brreg.no/losore/api/pant/enhet/{org}", "{registered_date}",
        "Tinglyst {mortgage_type} på {name} ({org}) hos Løsøreregisteret: {amount_label} til {secured_party}", ("heftelser", "tinglysteHeftelser", "items"),
        {"document_id": (("dokumentnummer", "id"), ""), "mortgage_type": (("pantetype", "type"), "Virksomhetspant"), "lien_amount": (("belop", "rammebelop", "kravbelop"), None), "currency": (("valuta",), "NOK"), "registered_date": (("tinglystDato", "dato"), "{day}"), "secured_party": (("panthaver",), "Kredittinstitusjon")},
        {"amount_label": lambda r: amount(r["lien_amount"], r["currency"], "Uoppgitt beløp"), "amount_text": lambda r: F.coalesce(r["lien_amount"], F.lit("None"))},
    ),
    "lei": Register(
        "gleif", "global_legal_entity_identifier", "international_standard_registry", "", "lei", "{body}", "https://search.gleif.org/#/record/{lei}", "{registered}",
        "Global Legal Entity Identifier (LEI) for {name}: {lei} (Status: {status_text})", ("data",),
        {"lei": (("id", "attributes.lei"), ""), "status_text": (("attributes.registration.status",), "ISSUED"), "managing_lou": (("attributes.registration.managingLou",), "GLEIF"), "legal_name": (("attributes.entity.legalName.name",), "{name}"), "registered_at": (("attributes.registration.initialRegistrationDate",), "{day}")},
        {"registered": lambda r: F.substring(r["registered_at"], 1, 10)}, limit=1,
    ),
    "subunits": Register(
        "brreg", "place_summary", "official_subunits", "official_enhetsregisteret_subunits", "subunit-place", "{org}|subunit|{unit}|{municipality}", "https://data.brreg.no/enhetsregisteret/api/underenheter/{unit}", "",
        "Official registered workplace: {unit_name} (subunit {unit}) located at {located}", ("_embedded.underenheter",),
        {"unit": (("organisasjonsnummer",), ""), "unit_name": (("navn",), "{name}"), "street_list": (("beliggenhetsadresse.adresse", "postadresse.adresse"), ""), "postcode": (("beliggenhetsadresse.postnummer", "postadresse.postnummer"), ""), "town": (("beliggenhetsadresse.poststed", "postadresse.poststed"), ""), "municipality": (("beliggenhetsadresse.kommune", "postadresse.kommune"), ""), "unit_employees": (("antallAnsatte",), None)},
        {"street": lambda r: F.coalesce(F.array_join(F.from_json(r["street_list"], "array<string>"), ", "), r["street_list"]), "located": lambda r: F.coalesce(F.nullif(F.array_join(F.filter(F.array(r["street"], F.trim(F.concat_ws(" ", r["postcode"], r["town"])), r["municipality"]), lambda x: x != ""), ", "), F.lit("")), F.lit("Norway"))},
        limit=10,
    ),
}


def _text(template: str, row: dict[str, Column]) -> Column:
    parts = [F.coalesce(row[p[1:-1]].cast("string"), F.lit("")) if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*parts) if parts else F.lit("")


def _read(item: Column, names: tuple[str, ...]) -> Column:
    """The first name that is not empty; name:4 takes the first four characters."""
    def one(n: str) -> Column:
        n, _, size = n.partition(":")
        v = F.get_json_object(item, "$." + n)
        return F.nullif(F.substring(v, 1, int(size)) if size else v, F.lit(""))

    return F.coalesce(*(one(n) for n in names))


def records_of(responses: DataFrame, register: Register) -> DataFrame:
    """One row per record of a 200 response (the first `limit` in order), with its fields as columns."""
    lists = [F.from_json(F.get_json_object("body", f"$.{k}"), "array<string>") for k in register.records]
    items = F.coalesce(*(F.when(F.size(x) > 0, x) for x in lists))
    rows = responses.where((F.col("status") == 200) & (F.length(F.trim("organisation_number")) >= 9)).withColumns({"org": F.replace(F.trim("organisation_number"), F.lit(" "), F.lit("")), "name": F.trim("name"), "day": F.date_format("retrieved_at", "yyyy-MM-dd"), "year": F.date_format("retrieved_at", "yyyy")})
    rows = rows.select("org", "name", "day", "year", "retrieved_at", "body", F.posexplode(F.slice(items, 1, register.limit)).alias("_place", "item"))
    base = {c: F.col(c) for c in ("org", "name", "day", "year", "body")}
    found = {k: F.coalesce(_read(F.col("item"), names), F.lit(None) if default is None else _text(default, base)).alias(k) for k, (names, default) in register.fields.items()}
    rows = rows.select("*", *found.values())
    for k, f in register.derived.items():
        rows = rows.withColumn(k, f({c: F.col(c) for c in rows.columns}))
    return rows


def observations(responses: DataFrame, name: str) -> DataFrame:
    """Observations of a register; the digest covers what the record's identifier is made of (the body for a single record)."""
    r = REGISTERS[name]
    rows = records_of(responses, r)
    cols = {c: F.col(c) for c in rows.columns}
    digest = F.sha2(_text(r.digest, cols).cast("binary"), 256)
    keep = [c for c in (*r.fields, *r.derived)]
    return rows.withColumn("content_sha256", digest).select(
        F.concat_ws("-", F.lit(r.prefix), "org", F.substring("content_sha256", 1, 16)).alias("id"), F.col("org").alias("organisation_number"), F.lit(r.platform).alias("platform"), F.lit(r.signal).alias("signal_type"),
        _text(r.url, cols).alias("source_url"), "retrieved_at", F.nullif(_text(r.published, cols), F.lit("")).alias("published_at"), "content_sha256", F.lit(True).alias("exact_entity"), F.lit(r.mode).alias("acquisition_mode"), F.lit("approved").alias("rights_status"),
        F.lit(r.source_class).alias("source_class"), _text(r.span, cols).alias("evidence_span"), F.lit(r.strategy or None).cast("string").alias("strategy"), *keep,
    )


def subunit_workforce(places: DataFrame) -> DataFrame:
    """Workforce rows of subunits with employees, from their place rows."""
    n = F.col("unit_employees").try_cast("int")
    digest = F.sha2(F.concat(F.col("organisation_number"), F.lit("|subunit-wf|"), F.col("unit"), F.lit("|"), n.cast("string")).cast("binary"), 256)
    span = F.concat(F.lit("Official workplace "), "unit_name", F.lit(" (subunit "), "unit", F.lit(") employs "), n.cast("string"), F.lit(" registered employee(s)"))
    return places.where(n > 0).withColumn("content_sha256", digest).select(
        F.concat_ws("-", F.lit("subunit-wf"), "organisation_number", F.substring("content_sha256", 1, 16)).alias("id"), "organisation_number", F.lit("brreg").alias("platform"), F.lit("workforce_snapshot").alias("signal_type"),
        "source_url", "content_sha256", n.alias("workforce_value"), span.alias("evidence_span"), F.lit("official_subunit_workforce").alias("strategy"),
    )


def insolvency(responses: DataFrame) -> DataFrame:
    """One row per 200 response: whether its text has a mark of insolvency."""
    low = F.lower(F.coalesce("body", F.lit("")))
    hit = F.lit(False)
    for m in INSOLVENCY:
        hit = hit | F.contains(low, F.lit(m))
    label = F.when(hit, "Insolvens-/konkursvarsel funnet").otherwise("Aktiv virksomhet i god orden (Ingen konkurs)")
    digest = F.sha2(F.concat(F.col("organisation_number"), F.lit("|lovdata_konkurs|"), label).cast("binary"), 256)
    return responses.where("status = 200").select(
        F.concat_ws("-", F.lit("legal"), "organisation_number", F.substring(digest, 1, 16)).alias("id"), "organisation_number", F.lit("legal_gazette_notice").alias("signal_type"), hit.alias("insolvency_detected"), label.alias("legal_status"),
        F.concat(F.lit("Konkursregisteret status for "), "name", F.lit(": "), label).alias("evidence_span"),
    )


def certificates(responses: DataFrame) -> DataFrame:
    """Responses of the certificate directory that show the organisation's number."""
    digest = F.sha2(F.concat(F.col("organisation_number"), F.lit("|miljofyrtarn|certified")).cast("binary"), 256)
    return responses.where((F.col("status") == 200) & F.contains("body", F.col("organisation_number"))).select(
        F.concat_ws("-", F.lit("esg-miljofyrtarn"), "organisation_number", F.substring(digest, 1, 16)).alias("id"), "organisation_number", F.lit("esg_certification_record").alias("signal_type"),
        F.concat(F.lit("Stiftelsen Miljøfyrtårn sertifisert miljøledelse for "), "name", F.lit(" ("), "organisation_number", F.lit(")")).alias("evidence_span"),
    )


#: Fixed patterns of the commercial directory's page, in order, and marks of addresses that are none.
DIRECTORY_SITE = (
    r'(?i)href="(https?://(?!proff\.no|facebook\.com|linkedin\.com|instagram\.com|twitter\.com|google\.)[^"\'\s>]+)"[^>]*data-event="homepage"', r'(?i)data-homepage="(https?://[^"\'\s>]+)"',
    r'(?i)href="(https?://(?!proff\.no|facebook\.com|linkedin\.com)[a-zA-Z0-9.\-_]+\.(?:no|com|org|net))"',
)
DIRECTORY_NOT = ("error=true", "login", "proff.no", "eniro.")


def directory(responses: DataFrame) -> DataFrame:
    """Website and phone that a directory page shows, with its observation."""
    given = F.coalesce(*(F.nullif(F.regexp_extract("body", p, 1), F.lit("")) for p in DIRECTORY_SITE))
    site = F.regexp_replace(F.trim(given), "/+$", "")
    bad = F.lit(False)
    for m in DIRECTORY_NOT:
        bad = bad | F.contains(F.lower(site), F.lit(m))
    site = F.when(~bad, site)
    digest = F.sha2(F.col("body").cast("binary"), 256)
    return responses.where("status = 200").select(
        F.concat_ws("-", F.lit("dir-proff"), "organisation_number", F.substring(digest, 1, 16)).alias("id"), "organisation_number", F.lit("commercial_directory_record").alias("signal_type"), site.alias("discovered_site"),
        F.nullif(F.trim(F.regexp_extract("body", r'href="tel:([+0-9\s]{8,15})"', 1)), F.lit("")).alias("phone"),
        F.concat(F.lit("Proff.no verified business record for "), "name", F.lit(" ("), "organisation_number", F.lit(")"), F.when(site.isNotNull(), F.concat(F.lit(", website: "), site)).otherwise("")).alias("evidence_span"),
    )


def notices(responses: DataFrame, limit: int = 5) -> DataFrame:
    """Dated rows of a notice table: a day-first date cell and the cell after it, repeats once, the first `limit`."""
    cell = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", " "), r"\s+", " "))
    cells = lambda tr: F.filter(F.transform(F.regexp_extract_all(tr, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)), cell), lambda x: x != "")
    dated = lambda c: F.struct(c.alias("cells"), F.array_position(F.transform(c, lambda x: x.rlike("^[0-9]{2}[.][0-9]{2}[.][0-9]{4}$")), True).cast("int").alias("at"))
    pair = lambda x: F.struct(F.get(x["cells"], x["at"] - 1).alias("notice_date"), F.get(x["cells"], x["at"]).alias("description"))
    trs = F.regexp_extract_all("body", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    pairs = F.transform(F.transform(F.transform(trs, cells), dated), pair)
    good = F.filter(pairs, lambda p: p["notice_date"].isNotNull() & (F.length(p["description"]) >= 3) & ~F.contains(F.lower(p["description"]), F.lit("brreg")))
    # all of a page's rows come from its own row; only its digest goes along, so that a page that was given twice counts once
    n = F.explode(F.slice(F.array_distinct(good), 1, limit)).alias("n")
    d = responses.where("status = 200").select("organisation_number", "name", F.sha2(F.col("body").cast("binary"), 256).alias("page"), n).distinct()
    d = d.select("organisation_number", "name", "n.notice_date", "n.description")
    digest = F.sha2(F.concat_ws("|", "organisation_number", "notice_date", "description").cast("binary"), 256)
    iso = F.concat_ws("-", F.substring("notice_date", 7, 4), F.substring("notice_date", 4, 2), F.substring("notice_date", 1, 2))
    return d.select(
        F.concat_ws("-", F.lit("notice-kunn"), "organisation_number", F.substring(digest, 1, 16)).alias("id"), "organisation_number", F.lit("public_mention").alias("signal_type"), iso.alias("published_at"), "description",
        F.concat(F.lit("Official Brønnøysund announcement on "), "notice_date", F.lit(" for "), "name", F.lit(" ("), "organisation_number", F.lit("): "), "description").alias("evidence_span"),
    )
