"""Queries of the registers with one record a company."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import profiles as P
from ..sources.tables import table
from .catalogue import query

ORG = "lpad(c_custkey::VARCHAR, 9, '0')"
OK = "c_custkey % 11 <> 0"


def _answers(spark, d, body: str, **more: str) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("lpad(cast(c_custkey as string), 9, '0') AS organisation_number", "c_name AS name", "CASE WHEN c_custkey % 11 = 0 THEN 404 ELSE 200 END AS status", "*")
    return c.withColumn("body", F.expr(body)).withColumns({k: F.expr(v) for k, v in more.items()})


@query("register_approvals", f"SELECT 'approval-dibk-' || {ORG} AS id, {ORG} AS organisation_number, '2027-0' || (1 + c_custkey % 9) || '-01' AS valid_through, 2::INT AS areas, c_name || ' (' || {ORG} || '): DiBK status.approved=true; status.approval_period_to=2027-0' || (1 + c_custkey % 9) || '-01' AS evidence_span FROM customer WHERE {OK} AND c_custkey % 4 = 0")
def register_approvals(spark, d):
    body = """concat('{"dibk-sgdata":{"enterprise":{"organizational_number":"', lpad(cast(c_custkey + if(c_custkey % 4 = 1, 1, 0) as string), 9, '0'), '","name":"', c_name, '"},"status":{"approved":', c_custkey % 4 <> 2, ',"approval_period_to":"', if(c_custkey % 4 = 3, '2020', '2027'), '-0', 1 + c_custkey % 9,
        '-01"},"valid_approval_areas":[{"function":"UTF","subject_area":"Grunn","grade":"1"},{"function":"PRO","subject_area":""},{"subject_area":"Tak"}]}}')"""
    return P.approvals(_answers(spark, d, body), F.lit("2026-08-01").cast("date"))


@query("register_licences", f"""SELECT 'license-arbeidstilsynet-' || {ORG} || '-' || left(sha256('{{"orgnr":"' || {ORG} || '","status":"Godkjent"}}'), 16) AS id, {ORG} AS organisation_number, 'Godkjent' AS licence_status, 'Arbeidstilsynet godkjenning for ' || c_name || ': Godkjent' AS evidence_span FROM customer WHERE {OK} AND c_custkey % 6 = 0""")
def register_licences(spark, d):
    body = """concat('{"orgnr":"', lpad(cast(c_custkey as string), 9, '0'), '","status":"', if(c_custkey % 6 = 2, 'Under behandling', 'Godkjent'), '"}')"""
    return P.licences(_answers(spark, d, body, industry_code="CASE WHEN c_custkey % 2 = 0 THEN if(c_custkey % 3 = 1, '62.010', '81.210') ELSE '47.1' END"))


@query("register_rights", f"""WITH c AS (SELECT *, {ORG} AS org FROM customer WHERE {OK}), r AS (SELECT org, c_name, 'trademark' AS t, 'T' || c_custkey AS n, 'Mark ' || c_custkey AS title, 'https://case/' || c_custkey AS u, 'Registered' AS s FROM c WHERE c_custkey % 2 = 0
UNION ALL SELECT org, c_name, 'patent', 'P' || c_custkey, 'Patent registration', NULL, 'unreported' FROM c WHERE c_custkey % 3 = 0) SELECT 'ip-' || t || '-' || org || '-' || left(sha256(org || '|patentstyret|' || n || '|' || title), 16) AS id, org AS organisation_number, t AS ip_type, n AS application_number, title,
coalesce(u, 'https://services.patentstyret.no/search-details/' || t || '/' || n) AS case_url, 'Patentstyret returned ' || t || ' case ' || n || ' for company number ' || org || ' (' || c_name || '). Registry status: ' || s || '.' AS evidence_span FROM r""")
def register_rights(spark, d):
    body = """concat('{"trademarkBag":[', if(c_custkey % 2 = 0, concat('{"registrationNumber":"T', c_custkey, '","markVerbalElementText":"Mark ', c_custkey, '","currentStatusNo":"Registered","caseUrl":"https://case/', c_custkey, '"}'), ''), '],"patentBag":[', if(c_custkey % 3 = 0, concat('{"patentNumber":"P', c_custkey, '"}'), ''), '],"designBag":[{"title":"no number"}]}')"""
    return P.property_rights(_answers(spark, d, body))


CODE = "CASE WHEN c_custkey % 5 = 0 THEN '62.0' || (c_custkey % 9) WHEN c_custkey % 5 = 1 THEN '47.1' WHEN c_custkey % 5 = 2 THEN '99.9' END"


@query("industry_benchmark", f"""WITH c AS (SELECT {ORG} AS org, {CODE} AS code FROM customer), s AS (SELECT *, CASE left(code, 2) WHEN '62' THEN 'Informasjonsteknologi og datatjenester' WHEN '47' THEN 'Detaljhandel' ELSE 'Næringskode ' || code END AS sector FROM c WHERE code IS NOT NULL)
SELECT 'benchmark-ssb-' || org || '-' || left(sha256(org || '|ssb|' || code || '|' || sector), 16) AS id, org AS organisation_number, sector, CASE left(code, 2) WHEN '62' THEN 8.5 WHEN '47' THEN 2.9 ELSE 5.0 END::DOUBLE AS margin_pct, CASE left(code, 2) WHEN '62' THEN 72500 WHEN '47' THEN 41800 ELSE 50000 END::INT AS median_salary,
CASE left(code, 2) WHEN '62' THEN '+6.2%' WHEN '47' THEN '+0.8%' ELSE '+2.5%' END AS growth FROM s""")
def industry_benchmark(spark, d):
    c = table(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("organisation_number"), F.expr(CODE.replace("'62.0' || (c_custkey % 9)", "concat('62.0', c_custkey % 9)")).alias("industry_code"))
    return P.benchmarks(c)


DOMAIN_BODY = """concat('{"entities":[{"roles":["registrar"],"publicIds":[{"identifier":"', lpad(cast(c_custkey as string), 9, '0'), '"}]},{"roles":["registrant"],"vcardArray":["vcard",[["version",{},"text","4.0"],["fn",{},"text","', CASE WHEN c_custkey % 3 = 1 THEN upper(c_name) ELSE 'Other' END, '"]]]', CASE WHEN c_custkey % 3 = 0 THEN concat(',"publicIds":[{"type":"x","identifier":"', lpad(cast(c_custkey as string), 9, '0'), '"}]') ELSE '' END, '}]}')"""


@query("register_domains", f"""SELECT {ORG} AS organisation_number, 'firma' || c_custkey || '.no' AS domain, CASE c_custkey % 3 WHEN 0 THEN 'legal_domain_ownership' ELSE 'candidate_domain_discovery' END AS signal_type, CASE c_custkey % 3 WHEN 0 THEN 'org_number_match' WHEN 1 THEN 'registrant_name_match' ELSE 'registrant_unverified' END AS ownership_state,
'Norid .no registry verification for firma' || c_custkey || '.no: ' || CASE c_custkey % 3 WHEN 0 THEN 'registrant organisation number matches ' || {ORG} WHEN 1 THEN 'registrant display name matches ' || c_name || '; organisation number was not exposed' ELSE 'registrant record checked; no exact organisation-number match exposed' END AS evidence_span FROM customer WHERE {OK} AND c_custkey % 5 <> 0""")
def register_domains(spark, d):
    site = "CASE WHEN c_custkey % 5 = 0 THEN 'https://firma.com' WHEN c_custkey % 5 = 1 THEN concat('HTTPS://www.Firma', c_custkey, '.no:443/x') ELSE concat('firma', c_custkey, '.no/') END"
    return P.domain_records(_answers(spark, d, DOMAIN_BODY, site=site)).drop("id")


@query("register_geocodes", f"SELECT {ORG} AS organisation_number, 'Gate ' || c_custkey AS formatted_address, '0150' AS postcode, '0301' AS municipality_number, 59.5::DOUBLE AS latitude, 10.25::DOUBLE AS longitude, 'Gnr ' || (1 + c_custkey % 90) || ', Bnr 7' || CASE WHEN c_custkey % 2 = 0 THEN ', Snr 3' ELSE '' END AS cadastral_id FROM customer WHERE {OK} AND c_custkey % 3 <> 0")
def register_geocodes(spark, d):
    body = """if(c_custkey % 3 = 0, '{"adresser":[]}', concat('{"adresser":[{"adressetekst":"Gate ', c_custkey, '","postnummer":"0150","kommunenummer":"0301","representasjonspunkt":{"lat":59.5,"lon":10.25},"gardsnummer":', 1 + c_custkey % 90, ',"bruksnummer":7', if(c_custkey % 2 = 0, ',"seksjonsnummer":3', ''), '},{"adressetekst":"second"}]}'))"""
    return P.geocodes(_answers(spark, d, body))


CHANNEL = "concat('UC', lpad(cast(c_custkey as string), 22, 'x'))"


@query("linked_channels", f"SELECT {ORG} AS organisation_number, 'https://www.youtube.com/channel/UC' || lpad(c_custkey::VARCHAR, 22, 'x') AS source_url, CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 10 END AS subscribers, c_custkey AS videos, c_custkey * 100 AS views FROM customer WHERE {OK} AND c_custkey % 5 < 2")
def linked_channels(spark, d):
    body = f"""concat('{{"items":[{{"id":"', {CHANNEL}, '","statistics":{{"subscriberCount":"', c_custkey * 10, '","hiddenSubscriberCount":', c_custkey % 2 = 1, ',"videoCount":"', c_custkey, '","viewCount":"', c_custkey * 100, '"}}}}]}}')"""
    link = f"CASE c_custkey % 5 WHEN 0 THEN concat('https://www.youtube.com/channel/', {CHANNEL}) WHEN 1 THEN concat('https://youtube.com/@firma', c_custkey) WHEN 2 THEN 'https://www.youtube.com/c/vanity' WHEN 3 THEN concat('https://www.youtube.com/channel/UC', lpad('', 22, 'z')) ELSE 'https://vimeo.com/x' END"
    return P.channels(_answers(spark, d, body, link=link)).drop("id")


KNOWLEDGE = """if(c_custkey % 4 = 3, '{"results":{"bindings":[]}}', concat('{"results":{"bindings":[{"item":{"value":"http://www.wikidata.org/entity/Q', c_custkey, '"}', if(c_custkey % 4 = 0, concat(',"itemLabel":{"value":"Label ', c_custkey, '"}'), ''), ',"website":{"value":"https://w.no"}',
 if(c_custkey % 4 = 1, concat(',"linkedin":{"value":"l', c_custkey, '"},"twitter":{"value":"https://x.com/t', c_custkey, '"}'), ''), '}]}}'))"""


@query("knowledge_entities", f"SELECT {ORG} AS organisation_number, 'http://www.wikidata.org/entity/Q' || c_custkey AS source_url, 'Q' || c_custkey AS qid, CASE WHEN c_custkey % 4 = 0 THEN 'Label ' || c_custkey ELSE c_name END AS label, 'https://w.no' AS website, 'Wikidata entity Q' || c_custkey || ' (' || CASE WHEN c_custkey % 4 = 0 THEN 'Label ' || c_custkey ELSE c_name END || ') matches Norwegian organization ' || {ORG} AS evidence_span FROM customer WHERE {OK} AND c_custkey % 4 <> 3")
def knowledge_entities(spark, d):
    return P.knowledge_entity(_answers(spark, d, KNOWLEDGE)).drop("id")


@query("knowledge_handles", f"SELECT {ORG} AS organisation_number, 'linkedin' AS platform, 'P4264' AS property, 'https://www.linkedin.com/company/l' || c_custkey AS source_url FROM customer WHERE {OK} AND c_custkey % 4 = 1 UNION ALL SELECT {ORG}, 'twitter', 'P2002', 'https://x.com/t' || c_custkey FROM customer WHERE {OK} AND c_custkey % 4 = 1")
def knowledge_handles(spark, d):
    return P.knowledge_handles(_answers(spark, d, KNOWLEDGE)).drop("id")


@query("vacancy_adverts", f"""SELECT 'nav-feed-job-' || left(sha256({ORG} || '|u' || o_orderkey), 24) AS id, {ORG} AS organisation_number, 'u' || o_orderkey AS uuid, CASE WHEN o_orderkey % 2 = 0 THEN '9' || lpad(c_custkey::VARCHAR, 8, '0') ELSE {ORG} END AS employer_org, 'Job ' || o_orderkey AS job_title, 'https://arbeidsplassen.nav.no/stillinger/stilling/u' || o_orderkey AS source_url,
'Active NAV vacancy ''Job ' || o_orderkey || ''' for employer organisation number ' || CASE WHEN o_orderkey % 2 = 0 THEN '9' || lpad(c_custkey::VARCHAR, 8, '0') ELSE {ORG} END AS evidence_span FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' AND o_orderkey % 7 NOT IN (1, 2) AND o_orderkey % 5 <> 0""")
def vacancy_adverts(spark, d):
    number = "if(o_orderkey % 2 = 0, concat('9', lpad(cast(o_custkey as string), 8, '0')), lpad(cast(o_custkey as string), 9, '0'))"
    until = "CASE o_orderkey % 7 WHEN 1 THEN '2026-08-01T11:00:00+02:00' WHEN 2 THEN '2026-07-31T23:00:00' WHEN 3 THEN '2026-08-01T00:00:00' ELSE '2026-09-01T00:00:00+02:00' END"
    body = f"""concat('{{"uuid":"u', o_orderkey, '","status":"', if(o_orderstatus = 'P', 'INACTIVE', 'active'), '","ad_content":{{"jobtitle":"', if(o_orderkey % 5 = 0, ' ', concat(' Job ', o_orderkey)), '","expires":"', {until}, '","employer":{{"orgnr":"NO ', {number}, '"}}}}}}')"""
    r = table(spark, d, "orders").select(F.concat(F.lit("u"), "o_orderkey").alias("uuid"), F.lit(200).alias("status"), F.expr(body).alias("body"))
    c = table(spark, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("org"), F.concat(F.lit("9"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("unit"))
    wanted = c.select("org", F.explode(F.array("org", "unit")).alias("number"))
    return P.vacancies(r, wanted, F.lit("2026-08-01 10:00:00").cast("timestamp"))
