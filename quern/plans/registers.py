"""Queries of the public registers: responses are built from orders and customers.

An organisation is a customer, a register's record one of its orders; every
eleventh customer's request failed. Odd orders use a register's second field names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import registers as G
from ..sources.tables import table
from .catalogue import query

DAY = "2026-08-01"
#: SQL of the records: orders of customers whose request succeeded, in order.
RECORDS = """x AS (SELECT o.*, 'Clerk ' || o_orderkey AS o_clerk, lpad(c_custkey::VARCHAR, 9, '0') AS org, c_name AS name, c_custkey,
 row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS n FROM orders o JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 11 <> 0)"""


def _responses(spark, d, key: str, item: str) -> DataFrame:
    """item: a JSON object as a SQL expression over orders."""
    o = table(spark, d, "orders").withColumn("o_clerk", F.concat(F.lit("Clerk "), "o_orderkey")).select(F.col("o_custkey").alias("c_custkey"), F.struct("o_orderkey", F.expr(item).alias("item")).alias("i"))
    o = o.groupBy("c_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("i")), lambda i: i["item"]), ",").alias("items"))
    c = table(spark, d, "customer").select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("organisation_number"), F.col("c_name").alias("name"))
    opening, closing = "".join(f'{{"{k}":' for k in key.split(".")), "}" * len(key.split("."))
    status = F.when(F.col("c_custkey") % 11 == 0, 404).otherwise(200)
    return c.join(o, "c_custkey").select("organisation_number", "name", status.alias("status"), F.concat(F.lit(opening + "["), "items", F.lit("]" + closing)).alias("body"), F.lit(f"{DAY} 10:00:00").cast("timestamp").alias("retrieved_at"))


def _amount(v: str, unit: str, missing: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN '{missing}' ELSE replace(format('{{:,}}', round({v})::BIGINT), ',', ' ') || ' ' || {unit} END"


def _sql(prefix: str, digest: str, url: str, published: str, span: str, limit: int = 5, more: str = "") -> str:
    return f"WITH {RECORDS}, y AS (SELECT *, sha256({digest}) AS h FROM x WHERE n <= {limit}) SELECT '{prefix}-' || org || '-' || left(h, 16) AS id, org AS organisation_number, {url} AS source_url, {published} AS published_at, h AS content_sha256, {span} AS evidence_span{more} FROM y"


COLUMNS = ("id", "organisation_number", "source_url", "published_at", "content_sha256", "evidence_span")
ODD = "o_orderkey % 2 = 1"


@query("register_procurement", _sql(
    "procurement", "org || '|doffin|' || o_orderkey || '|' || CASE WHEN o_orderkey % 3 = 0 THEN 'Offentlig kontrakt: ' || name ELSE o_clerk END",
    "CASE WHEN o_orderkey % 5 = 0 THEN 'https://n.example/' || o_orderkey ELSE 'https://doffin.no/Notice/Details/' || o_orderkey END", "strftime(o_orderdate, '%Y-%m-%d')",
    "'Doffin ' || o_orderpriority || ' ''' || CASE WHEN o_orderkey % 3 = 0 THEN 'Offentlig kontrakt: ' || name ELSE o_clerk END || ''' (Notice #' || o_orderkey || ') linked to ' || name || ' (' || org || ')'"))
def register_procurement(spark, d):
    item = f"""concat('{{', CASE WHEN {ODD} THEN '"noticeId":"' ELSE '"id":"' END, o_orderkey, '","', CASE WHEN {ODD} THEN 'heading' ELSE 'title' END, '":"', CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_clerk END,
        '","type":"', o_orderpriority, '","date":"', date_format(o_orderdate, 'yyyy-MM-dd'), '","url":"', CASE WHEN o_orderkey % 5 = 0 THEN concat('https://n.example/', o_orderkey) ELSE '' END, '","value":', o_totalprice, '}}')"""
    return G.observations(_responses(spark, d, "notices", item), "procurement").select(*COLUMNS)


@query("register_rnd_grants", _sql(
    "rnd-grant", "org || '|forskningsradet|' || o_orderkey || '|' || o_clerk", "'https://prosjektbanken.forskningsradet.no/project/FORISS/' || o_orderkey", "year(o_orderdate)::VARCHAR",
    f"'Norges forskningsråd tildeling (Forskningsrådet) til ' || name || ': ''' || o_clerk || ''' (' || {_amount('CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey * 1000 END', repr('NOK'), 'Tildelt støtte')} || ', ' || year(o_orderdate) || '–' || CASE WHEN {ODD} THEN (year(o_orderdate) + 2)::VARCHAR ELSE '' END || ')'"))
def register_rnd_grants(spark, d):
    item = f"""concat('{{"projectNumber":', o_orderkey, ',"', CASE WHEN {ODD} THEN 'projectTitle' ELSE 'title' END, '":"', o_clerk, '","startDate":"', date_format(o_orderdate, 'yyyy-MM-dd'), '"',
        CASE WHEN {ODD} THEN concat(',"endYear":', year(o_orderdate) + 2) ELSE '' END, CASE WHEN o_orderkey % 4 <> 0 THEN concat(',"totalBudget":', o_orderkey * 1000) ELSE '' END, '}}')"""
    return G.observations(_responses(spark, d, "projects", item), "rnd_grants").select(*COLUMNS)


@query("register_innovation_grants", _sql(
    "in-grant", "org || '|in|' || o_orderkey || '|Innovasjonsprosjekt: ' || name || '|' || CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey::VARCHAR ELSE 'None' END", "'https://tildeling.innovasjonnorge.no/tildelinger/' || o_orderkey",
    f"CASE WHEN {ODD} THEN '2026' ELSE year(o_orderdate)::VARCHAR END",
    f"'Innovasjon Norge tildeling (' || o_orderpriority || ') til ' || name || ': ''Innovasjonsprosjekt: ' || name || ''' (' || {_amount('CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END', repr('NOK'), 'Innvilget tilskudd')} || ', år ' || CASE WHEN {ODD} THEN '2026' ELSE year(o_orderdate)::VARCHAR END || ')'"))
def register_innovation_grants(spark, d):
    item = f"""concat('{{"tildelingId":"', o_orderkey, '","program":"', o_orderpriority, '"', CASE WHEN o_orderkey % 4 <> 0 THEN concat(',"belop":', o_orderkey) ELSE '' END, CASE WHEN {ODD} THEN '' ELSE concat(',"ar":', year(o_orderdate)) END, '}}')"""
    return G.observations(_responses(spark, d, "results", item), "innovation_grants").select(*COLUMNS)


@query("register_exchange_disclosures", _sql(
    "bors", "org || '|oslobors|' || o_orderkey || '|' || o_clerk", "'https://newsweb.oslobors.no/message/' || o_orderkey", "strftime(o_orderdate, '%Y-%m-%d')",
    f"'Oslo Børs (' || CASE WHEN {ODD} THEN o_orderpriority ELSE 'Oslo Børs' END || ') børsmelding for ' || name || ' [T' || o_custkey || ']: ''' || o_clerk || ''' (' || strftime(o_orderdate, '%Y-%m-%d') || ')'"))
def register_exchange_disclosures(spark, d):
    item = f"""concat('{{"messageId":', o_orderkey, ',"header":"', o_clerk, '","issuerSign":"T', o_custkey, '","publishedTime":"', date_format(o_orderdate, 'yyyy-MM-dd'), 'T08:00:00Z"', CASE WHEN {ODD} THEN concat(',"segment":"', o_orderpriority, '"') ELSE '' END, '}}')"""
    return G.observations(_responses(spark, d, "messages", item), "exchange_disclosures").select(*COLUMNS)


@query("register_emission_permits", _sql(
    "permit-env", "org || '|miljodir|' || o_orderkey || '|' || o_orderpriority", "'https://www.norskeutslipp.no/virksomhet/' || org", f"CASE WHEN {ODD} THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '{DAY}' END",
    f"'Miljødirektoratet ' || o_orderpriority || ' for ' || name || ' (' || CASE WHEN {ODD} THEN o_clerk ELSE name END || '): Status ' || CASE WHEN o_orderstatus = 'P' THEN 'Gjeldende' ELSE o_orderstatus END || ' (Vedtatt ' || CASE WHEN {ODD} THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '{DAY}' END || ')'"))
def register_emission_permits(spark, d):
    item = f"""concat('{{"tillatelseId":', o_orderkey, ',"type":"', o_orderpriority, '","status":"', CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '"', CASE WHEN {ODD} THEN concat(',"navn":"', o_clerk, '","dato":"', date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00"') ELSE '' END, '}}')"""
    return G.observations(_responses(spark, d, "anlegg", item), "emission_permits").select(*COLUMNS)


GRADE = "(o_orderkey % 5)::VARCHAR"
GRADE_LABEL = f"CASE {GRADE} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in G.GRADES.items()) + f" ELSE 'Karakter ' || {GRADE} END"


@query("register_food_inspections", _sql(
    "foodsafety", f"org || '|mattilsynet|' || o_orderkey || '|' || CASE WHEN {ODD} THEN strftime(o_orderdate, '%Y%m%d') ELSE '' END || '|' || {GRADE}", "'https://smilefjes.mattilsynet.no/tilsyn/' || org", f"CASE WHEN {ODD} THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '{DAY}' END",
    f"'Mattilsynet Smilefjes-tilsyn for ' || name || ': ' || {GRADE_LABEL} || ' (dato ' || CASE WHEN {ODD} THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '{DAY}' END || ')'", more=f", CASE WHEN {ODD} THEN 'Gate ' || o_custkey || ', OSLO' ELSE 'OSLO' END AS address"))
def register_food_inspections(spark, d):
    item = f"""concat('{{"tilsynid":', o_orderkey, ',"total_karakter":"', o_orderkey % 5, '","poststed":"OSLO"', CASE WHEN {ODD} THEN concat(',"adr":"Gate ', o_custkey, '","dato":"', date_format(o_orderdate, 'yyyyMMdd'), '"') ELSE '' END, '}}')"""
    return G.observations(_responses(spark, d, "entries", item), "food_inspections").select(*COLUMNS, "address")


@query("register_liens", _sql(
    "lien", "org || '|losore|' || o_orderkey || '|Virksomhetspant|' || CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey * 1000)::VARCHAR ELSE 'None' END", "'https://data.brreg.no/losore/api/pant/enhet/' || org", "strftime(o_orderdate, '%Y-%m-%d')",
    f"'Tinglyst Virksomhetspant på ' || name || ' (' || org || ') hos Løsøreregisteret: ' || {_amount('CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey * 1000 END', f'CASE WHEN {ODD} THEN {chr(39)}EUR{chr(39)} ELSE {chr(39)}NOK{chr(39)} END', 'Uoppgitt beløp')} || ' til ' || o_clerk"))
def register_liens(spark, d):
    item = f"""concat('{{"id":', o_orderkey, ',"tinglystDato":"', date_format(o_orderdate, 'yyyy-MM-dd'), '","panthaver":"', o_clerk, '"', CASE WHEN o_orderkey % 4 <> 0 THEN concat(',"rammebelop":', o_orderkey * 1000) ELSE '' END, CASE WHEN {ODD} THEN ',"valuta":"EUR"' ELSE '' END, '}}')"""
    return G.observations(_responses(spark, d, "tinglysteHeftelser", item), "liens").select(*COLUMNS)


LEI_ITEM = """concat('{"id":"LEI', o_orderkey, '","attributes":{"entity":{"legalName":{"name":"', o_clerk, '"}},"registration":{"status":"', o_orderstatus, '","initialRegistrationDate":"', %s, 'T00:00:00Z"}}}')"""


@query("register_lei", f"""WITH {RECORDS}, b AS (SELECT c_custkey, '{{"data":[' || string_agg({LEI_ITEM % "strftime(o_orderdate, '%Y-%m-%d')"}, ',' ORDER BY o_orderkey) || ']}}' AS body FROM x GROUP BY 1),
y AS (SELECT x.*, sha256(body) AS h FROM x JOIN b USING (c_custkey) WHERE n = 1)
SELECT 'lei-' || org || '-' || left(h, 16) AS id, org AS organisation_number, 'https://search.gleif.org/#/record/LEI' || o_orderkey AS source_url, strftime(o_orderdate, '%Y-%m-%d') AS published_at, h AS content_sha256,
'Global Legal Entity Identifier (LEI) for ' || name || ': LEI' || o_orderkey || ' (Status: ' || o_orderstatus || ')' AS evidence_span, o_clerk AS legal_name, 'GLEIF' AS managing_lou FROM y""")
def register_lei(spark, d):
    return G.observations(_responses(spark, d, "data", LEI_ITEM % "date_format(o_orderdate, 'yyyy-MM-dd')"), "lei").select(*COLUMNS, "legal_name", "managing_lou")


SUBUNIT_ITEM = f"""concat('{{"organisasjonsnummer":"', lpad(cast(o_orderkey as string), 9, '9'), '","navn":"', o_clerk, '"', CASE WHEN {ODD} THEN concat(',"beliggenhetsadresse":{{"adresse":["Gate ', o_custkey, '","2. etg"],"postnummer":"0150","poststed":"OSLO","kommune":"OSLO"}}')
    WHEN o_orderkey % 4 = 0 THEN ',"postadresse":{{"adresse":"Boks 1","kommune":"BERGEN"}}' ELSE '' END, CASE WHEN o_orderkey % 3 <> 0 THEN concat(',"antallAnsatte":', o_orderkey % 7) ELSE '' END, '}}')"""
SUBUNITS = f"""{RECORDS}, u AS (SELECT *, lpad(o_orderkey::VARCHAR, 9, '9') AS unit, CASE WHEN {ODD} THEN 'OSLO' WHEN o_orderkey % 4 = 0 THEN 'BERGEN' ELSE '' END AS kommune,
 CASE WHEN {ODD} THEN 'Gate ' || o_custkey || ', 2. etg, 0150 OSLO, OSLO' WHEN o_orderkey % 4 = 0 THEN 'Boks 1, BERGEN' ELSE 'Norway' END AS located, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 7 END AS employees FROM x WHERE n <= 10)"""


@query("register_subunits", f"""WITH {SUBUNITS} SELECT 'subunit-place-' || org || '-' || left(sha256(org || '|subunit|' || unit || '|' || kommune), 16) AS id, org AS organisation_number, 'https://data.brreg.no/enhetsregisteret/api/underenheter/' || unit AS source_url,
'Official registered workplace: ' || o_clerk || ' (subunit ' || unit || ') located at ' || located AS evidence_span FROM u""")
def register_subunits(spark, d):
    return G.observations(_responses(spark, d, "_embedded.underenheter", SUBUNIT_ITEM), "subunits").select("id", "organisation_number", "source_url", "evidence_span")


@query("register_subunit_workforce", f"""WITH {SUBUNITS} SELECT 'subunit-wf-' || org || '-' || left(sha256(org || '|subunit-wf|' || unit || '|' || employees), 16) AS id, org AS organisation_number, employees::INT AS workforce_value,
'Official workplace ' || o_clerk || ' (subunit ' || unit || ') employs ' || employees || ' registered employee(s)' AS evidence_span FROM u WHERE employees > 0""")
def register_subunit_workforce(spark, d):
    places = G.observations(_responses(spark, d, "_embedded.underenheter", SUBUNIT_ITEM), "subunits")
    return G.subunit_workforce(places).select("id", "organisation_number", "workforce_value", "evidence_span")


def _pages(spark, d, body: str) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("lpad(cast(c_custkey as string), 9, '0') AS organisation_number", "c_name AS name", "CASE WHEN c_custkey % 11 = 0 THEN 404 ELSE 200 END AS status", "*")
    return c.withColumn("body", F.expr(body))


PAGES = "c AS (SELECT lpad(c_custkey::VARCHAR, 9, '0') AS org, c_name AS name, * FROM customer WHERE c_custkey % 11 <> 0)"
LABEL = "CASE WHEN c_custkey % 7 IN (1, 2) THEN 'Insolvens-/konkursvarsel funnet' ELSE 'Aktiv virksomhet i god orden (Ingen konkurs)' END"


@query("register_insolvency", f"WITH {PAGES} SELECT 'legal-' || org || '-' || left(sha256(org || '|lovdata_konkurs|' || {LABEL}), 16) AS id, org AS organisation_number, c_custkey % 7 IN (1, 2) AS insolvency_detected, {LABEL} AS legal_status, 'Konkursregisteret status for ' || name || ': ' || {LABEL} AS evidence_span FROM c")
def register_insolvency(spark, d):
    body = "concat('<p>', CASE c_custkey % 7 WHEN 1 THEN 'Åpning av konkurs' WHEN 2 THEN 'TVANGSOPPLØSNING' WHEN 3 THEN 'konkurranse' ELSE 'ingen' END, '</p>')"
    return G.insolvency(_pages(spark, d, body)).select("id", "organisation_number", "insolvency_detected", "legal_status", "evidence_span")


@query("register_certificates", f"WITH {PAGES} SELECT 'esg-miljofyrtarn-' || org || '-' || left(sha256(org || '|miljofyrtarn|certified'), 16) AS id, org AS organisation_number, 'Stiftelsen Miljøfyrtårn sertifisert miljøledelse for ' || name || ' (' || org || ')' AS evidence_span FROM c WHERE c_custkey % 5 = 0")
def register_certificates(spark, d):
    body = "concat('<li>', CASE WHEN c_custkey % 5 = 0 THEN lpad(cast(c_custkey as string), 9, '0') ELSE lpad(cast(c_custkey + 1 as string), 8, '0') END, '</li>')"
    return G.certificates(_pages(spark, d, body)).select("id", "organisation_number", "evidence_span")


SITE = "CASE c_custkey % 5 WHEN 0 THEN 'https://site' || c_custkey || '.no' WHEN 1 THEN 'http://home' || c_custkey || '.com/x' WHEN 2 THEN 'https://shop' || c_custkey || '.org' END"


@query("register_directory", f"""WITH {PAGES}, s AS (SELECT *, {SITE} AS site FROM c) SELECT org AS organisation_number, site AS discovered_site, CASE WHEN c_custkey % 2 = 0 THEN '+47 2212' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS phone,
'Proff.no verified business record for ' || name || ' (' || org || ')' || CASE WHEN site IS NULL THEN '' ELSE ', website: ' || site END AS evidence_span FROM s""")
def register_directory(spark, d):
    body = """concat(CASE c_custkey % 5 WHEN 0 THEN concat('<a href="https://facebook.com/x" data-event="homepage"><a href="https://site', c_custkey, '.no/" class="c" data-event="homepage">')
        WHEN 1 THEN concat('<div data-homepage="http://home', c_custkey, '.com/x/">') WHEN 2 THEN concat('<a href="https://proff.no/y"><a href="https://shop', c_custkey, '.org">')
        WHEN 3 THEN '<div data-homepage="https://x.no/login">' ELSE '<p>none</p>' END, CASE WHEN c_custkey % 2 = 0 THEN concat('<a href="tel:+47 2212', lpad(cast(c_custkey % 10000 as string), 4, '0'), '">') ELSE '' END)"""
    return G.directory(_pages(spark, d, body)).select("organisation_number", "discovered_site", "phone", "evidence_span")


@query("register_notices", f"""WITH {RECORDS}, y AS (SELECT *, strftime(o_orderdate, '%d.%m.%Y') AS day FROM x WHERE o_orderkey % 4 <> 0),
z AS (SELECT org, name, day, o_orderpriority AS description, o_orderdate, min(o_orderkey) AS o_orderkey FROM y GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY org ORDER BY o_orderkey) AS k FROM z)
SELECT 'notice-kunn-' || org || '-' || left(sha256(org || '|' || day || '|' || description), 16) AS id, org AS organisation_number, strftime(o_orderdate, '%Y-%m-%d') AS published_at, description,
'Official Brønnøysund announcement on ' || day || ' for ' || name || ' (' || org || '): ' || description AS evidence_span FROM r WHERE k <= 5""")
def register_notices(spark, d):
    row = """concat('<tr class="r"><td>', CASE WHEN o_orderkey % 4 = 0 THEN 'no date' ELSE date_format(o_orderdate, 'dd.MM.yyyy') END, '</td><td> </td><td><b>', o_orderpriority, '</b></td></tr>')"""
    return G.notices(_responses(spark, d, "x", row)).select("id", "organisation_number", "published_at", "description", "evidence_span")
