"""Queries of the identity rules: every rule of the ladder meets names from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import identity as I
from ..sources.tables import table
from .catalogue import query

LONG = "' - vi leverer varer og tjenester til kunder over hele landet hver eneste dag'"
#: One case a rule: key % 16 -> (name, url, title, text, declared host, footer, form), as Spark SQL over key and brand.
CASES = {
    0: ("concat(brand, ' Fjell AS')", "'https://x.no'", "'Buy this domain'", "''", "''", "''", "'AS'"),
    1: ("concat(brand, ' Fjell AS')", "'https://x.no/logg-inn'", "'Innlogging'", "''", "''", "''", "'AS'"),
    2: ("concat(brand, ' B.I.L.')", "'https://x.no'", f"concat(brand, {LONG})", "''", "''", "''", "'FLI'"),
    3: ("concat(brand, ' Fjell AS')", "'https://x.no'", "'Kontakt'", "concat('Org.nr. ', org)", "''", "''", "'AS'"),
    4: ("concat(brand, ' Fjell AS')", "'https://x.no'", "'Kontakt'", "'Org.nr. 999888777'", "''", "''", "'AS'"),
    5: ("concat(brand, ' Fjell AS')", "'https://x.no'", "concat('Velkommen til ', brand, ' Fjell')", "''", "''", "''", "'AS'"),
    6: ("concat(brand, ' Fjell AS')", "'https://decl.no/a'", "'Hjem'", f"concat('Om ', brand, ' og fjell', {LONG})", "'decl.no'", "''", "'AS'"),
    7: ("concat(brand, ' AS')", "concat('https://www.', brand, '.no')", "'Hjem'", f"{LONG}", "concat(brand, '.no')", "''", "'AS'"),
    8: ("concat(brand, ' AS')", "'https://x.no'", f"concat(brand, {LONG})", "''", "''", "''", "'AS'"),
    9: ("concat(brand, ' AS')", "'https://x.no'", f"concat(brand, {LONG})", "', Havbris Mek AS'", "''", "''", "'AS'"),
    10: ("concat(brand, ' Fjell AS')", "concat('https://', brand, 'fjell.no')", "'Hjem'", "''", "concat(brand, 'fjell.no')", "''", "'AS'"),
    11: ("concat(brand, ' Eiendom AS')", "concat('https://', brand, '.no')", f"concat(brand, {LONG})", "''", "concat(brand, '.no')", "''", "'AS'"),
    12: ("'Vest Borettslag'", "'https://www.obos.no/vest'", "'Forvaltning av borettslag'", "''", "'obos.no'", "''", "'BRL'"),
    13: ("concat(brand, ' Fjell Havn Dal AS')", "'https://x.no'", "'Hjem'", f"concat(brand, ' fjell havn', {LONG})", "''", "''", "'AS'"),
    14: ("concat(brand, ' Fjell Havn Dal AS')", "'https://x.no'", "'Hjem'", f"concat(brand, ' fjell', {LONG})", "''", "''", "'AS'"),
    15: ("concat(brand, ' Fjell AS')", "'https://x.no'", "'Hjem'", "'noe annet'", "''", "''", "'AS'"),
}
SCORES = {0: 0.1, 1: 0.2, 2: 0.3, 3: 1.0, 4: 0.0, 5: 0.95, 6: 0.95, 7: 0.94, 8: 0.95, 9: 0.75, 10: 0.94, 11: 0.93, 12: 0.91, 13: 0.85, 14: 0.65, 15: 0.3}
RELATIONS = {4: "unrelated_or_confuser", 9: "public_brand_or_related_entity", 12: "housing_management_portal"}
FIELDS = ("name", "url", "title", "text", "declared_host", "identity_text", "legal_form")
#: SQL of the verdicts that the rules give.
EXPECTED = "x AS (SELECT c_custkey AS key, CASE c_custkey % 16 " + " ".join(f"WHEN {k} THEN {v}" for k, v in SCORES.items()) + " END::DOUBLE AS score, CASE " + " ".join(f"WHEN c_custkey % 16 = {k} THEN '{v}'" for k, v in RELATIONS.items()) + " WHEN score >= 0.9 THEN 'exact_legal_entity' ELSE 'ambiguous_or_unproven' END AS relationship FROM customer)"


def _sites(spark, d) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("c_custkey AS key", "concat('9', lpad(cast(c_custkey as string), 8, '0')) AS org", "concat('brand', translate(cast(c_custkey as string), '0123456789', 'abcdefghij')) AS brand")
    pick = lambda i: "CASE key % 16 " + " ".join(f"WHEN {k} THEN {v[i]}" for k, v in CASES.items()) + " END"
    return c.select("key", "brand", F.col("org").alias("organisation_number"), *(F.expr(pick(i)).alias(f) for i, f in enumerate(FIELDS)))


@query("identity_rules", f"WITH {EXPECTED} SELECT key, score, CASE WHEN score >= 0.9 THEN 'exact' WHEN score >= 0.8 THEN 'review' ELSE 'related_or_uncertain' END AS status, relationship FROM x")
def identity_rules(spark, d):
    return I.website_ladder(_sites(spark, d)).select("key", "score", "status", "relationship")


@query("website_gate", f"WITH {EXPECTED} SELECT key, score >= 0.9 AS publishable FROM x")
def website_gate(spark, d):
    return I.website_gate(I.website_ladder(_sites(spark, d))).select("key", "publishable")


@query("gate_counts", f"WITH {EXPECTED} SELECT CASE WHEN score >= 0.9 THEN 'exact' WHEN score >= 0.8 THEN 'review' ELSE 'related_or_uncertain' END AS status, relationship, count(*) AS profiles, count(*) FILTER (score >= 0.9) AS publishable FROM x GROUP BY 1, 2")
def gate_counts(spark, d):
    return I.gate_counts(I.website_ladder(_sites(spark, d)))


#: SQL of handle scores: key % 8 -> the rule that the handle meets.
HANDLES = "CASE c_custkey % 8 WHEN 0 THEN 0.98 WHEN 1 THEN 0.96 WHEN 2 THEN 0.98 WHEN 3 THEN 0.95 WHEN 4 THEN 0.94 WHEN 5 THEN 0.9 WHEN 6 THEN 0.1 ELSE 0.3 END::DOUBLE"


def _handles(spark, d) -> DataFrame:
    return _sites(spark, d).selectExpr(
        "key", "CASE key % 8 WHEN 2 THEN concat(brand, ' AS') WHEN 4 THEN concat(brand, ' Bygg AS') WHEN 5 THEN concat(brand, ' Xa Norge Ya AS') ELSE concat(brand, ' Fjell AS') END AS name",
        "CASE key % 8 WHEN 0 THEN concat('https://facebook.com/', brand, '.fjell') WHEN 1 THEN 'https://instagram.com/merket.vart' WHEN 2 THEN concat('https://x.com/ny', brand) WHEN 3 THEN 'https://facebook.com/nettsiden' WHEN 4 THEN concat('https://tiktok.com/@', brand) WHEN 5 THEN concat('https://facebook.com/', brand, '-xa-norge') WHEN 6 THEN concat('https://facebook.com/share/', brand) ELSE 'https://facebook.com/annet' END AS url",
        "CASE key % 8 WHEN 3 THEN 'https://www.nettsiden.no' ELSE '' END AS website", "CASE WHEN key % 8 = 1 THEN array('Merket') ELSE array() END AS trademarks",
    )


@query("social_handles", f"SELECT c_custkey AS key, {HANDLES} AS handle_score, {HANDLES} >= 0.9 AS handle_publishable FROM customer")
def social_handles(spark, d):
    return I.social_handle(_handles(spark, d)).select("key", "handle_score", "handle_publishable")


@query("social_gate", f"WITH {EXPECTED} SELECT key, NOT (score >= 0.9 AND {HANDLES} >= 0.9) AS quarantined FROM x JOIN customer ON c_custkey = key")
def social_gate(spark, d):
    sites = I.website_gate(I.website_ladder(_sites(spark, d)))
    return I.social_gate(_handles(spark, d), sites, "key").select("key", "quarantined")


@query("operator_conflict", "SELECT c_custkey AS key, 'Havbris Drift AS' AS operator, 'https://site.no/privacy-policy' AS source_url, 'Havbris Drift AS (\"we\", \"our\") operates this site' AS claim_span FROM customer WHERE c_custkey % 5 = 0")
def operator_conflict(spark, d):
    text = """CASE key % 5 WHEN 0 THEN concat('Intro.', chr(10), ' Havbris Drift AS ("we", "our") operates this site. More') WHEN 1 THEN concat(brand, ' Fjell AS (we) operates this site') WHEN 2 THEN 'Havbris Drift AS sells things' ELSE 'Havbris Drift AS (us) provides it' END"""
    rows = _sites(spark, d).selectExpr(
        "key", "concat(upper(brand), ' Fjell AS') AS name", "'https://www.site.no' AS site", "CASE key % 5 WHEN 3 THEN 'https://site.no/about' WHEN 4 THEN 'https://other.no/privacy' ELSE 'https://site.no/privacy-policy' END AS url",
        f"{text} AS text", "sha2(brand, 256) AS content_sha256",
    )
    return I.operator_conflict(rows, "key")


@query("operator_proof", "SELECT c_custkey AS key, c_custkey % 6 IN (0, 3, 4) AS proven FROM customer")
def operator_proof(spark, d):
    footer = F.expr("CASE key % 6 WHEN 0 THEN concat('Org.nr: ', left(organisation_number, 3), ' ', substr(organisation_number, 4, 3), ' ', right(organisation_number, 3), ' MVA') WHEN 1 THEN concat('Org nr ', organisation_number, ', organisasjonsnummer 999 888 777') WHEN 2 THEN 'Org.nr. 999888777' WHEN 3 THEN concat('Drives av ', brand, ' FJELL as, Oslo') ELSE '' END")
    title = F.expr("CASE WHEN key % 6 >= 4 THEN concat(brand, ' Fjell AS - hjem') ELSE '' END")
    url = F.expr("CASE WHEN key % 6 = 5 THEN 'https://site.no/butikk/x' ELSE 'https://site.no/en/' END")
    return _sites(spark, d).select("key", I.operator_proof(F.col("organisation_number"), F.expr("concat(brand, ' Fjell AS')"), title, footer, url).alias("proven"))


#: SQL of the credibility rules over the news rows of events.
NEWS = """v AS (SELECT event_id, user_id % 6 AS site, event_id % 5 AS kind, event_id % 4 AS age FROM events),
p AS (SELECT *, CASE site WHEN 0 THEN 0.35 WHEN 1 THEN 0.35 WHEN 2 THEN 0.30 WHEN 3 THEN 0.12 ELSE 0.0 END + CASE site WHEN 0 THEN 0.20 WHEN 1 THEN 0.20 WHEN 2 THEN 0.05 WHEN 3 THEN 0.20 WHEN 4 THEN 0.05 ELSE 0 END + CASE age WHEN 0 THEN 0.15 WHEN 1 THEN 0.05 WHEN 2 THEN -0.20 ELSE 0 END
 + CASE kind WHEN 3 THEN -0.06 WHEN 4 THEN -0.12 ELSE 0.15 END + CASE kind WHEN 0 THEN 0.15 WHEN 1 THEN 0.10 ELSE 0.02 END AS t FROM v),
q AS (SELECT *, CASE WHEN site = 5 THEN 0.0 ELSE round(greatest(0, least(1, t)), 2) END::DOUBLE AS score FROM p)"""


@query("news_credibility", f"WITH {NEWS} SELECT event_id, score, CASE WHEN score >= 0.70 THEN 'high' WHEN score >= 0.50 THEN 'medium' WHEN score >= 0.25 THEN 'low' ELSE 'rejected' END AS tier, score >= 0.60 AND kind < 2 AND age <> 2 AND site <> 5 AS publishable FROM q")
def news_credibility(spark, d):
    rows = table(spark, d, "events").selectExpr(
        "event_id", "'Nordlys Fjell Bygg AS' AS name", "CASE user_id % 6 WHEN 2 THEN 'VG Pluss' WHEN 3 THEN 'Lokalavisa' ELSE '' END AS publisher",
        "CASE user_id % 6 WHEN 0 THEN 'https://www.dagbladet.no/a' WHEN 1 THEN 'https://kommunikasjon.reuters.com/b' WHEN 2 THEN 'https://blogg.example.com/c' WHEN 3 THEN 'https://lokal.avis.no/d' WHEN 4 THEN 'https://news.example.org/e' ELSE 'https://x.zerohedge.com/f' END AS url",
        "CASE event_id % 5 WHEN 0 THEN 'Nordlys Fjell Bygg AS vokser raskt - VG' WHEN 1 THEN 'Nordlys Fjell Bygg vokser raskt' WHEN 2 THEN 'En helt annen bedrift vokser' WHEN 3 THEN 'En annen bedrift vokser!! Les' ELSE 'DETTE ER KATASTROFE NÅ' END AS title",
        "CASE event_id % 4 WHEN 0 THEN date'2026-07-01' WHEN 1 THEN date'2020-01-01' WHEN 2 THEN date'2026-09-01' END AS published_at",
    )
    return I.news_credibility(rows, F.lit("2026-08-01").cast("date")).select("event_id", "score", "tier", "publishable")
