"""Queries of scalar functions, small operators and file sources over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions import dates as D, html as H, names as N, text as T, urls as U
from ..operators import evidence as E, hiring as J, identity as I, lookup as L, observations as O, sampling as S, validators as V
from ..sources import files
from ..sources.tables import observations, profiles, shared_folder, table
from .catalogue import HOST, OBS, PATH, PROFILES, query, sql_tokens

LEGAL = "(as|asa|sa|ba|da|ans|enk|nuf|sti)"
#: SQL of names with Norwegian letters and legal suffixes.
NAMES = "n AS (SELECT p_partkey AS key, upper(left(p_name, 1)) || substr(p_name, 2) || CASE p_partkey % 4 WHEN 0 THEN ' Ås AS' WHEN 1 THEN ' Bygg Sør DA' WHEN 2 THEN ' AS SA' ELSE '' END AS name, p_brand FROM part)"


def _names(spark, d) -> DataFrame:
    tail = "CASE p_partkey % 4 WHEN 0 THEN ' Ås AS' WHEN 1 THEN ' Bygg Sør DA' WHEN 2 THEN ' AS SA' ELSE '' END"
    return table(spark, d, "part").selectExpr("p_partkey AS key", f"concat(upper(left(p_name, 1)), substr(p_name, 2), {tail}) AS name", "p_brand")


#: SQL of a name's words without trailing legal suffixes.
WORDS = f"""list_filter(string_split(regexp_replace(array_to_string({sql_tokens('name', 1, True)}, ' '), '( {LEGAL})+$', ''), ' '), lambda w: w <> '')"""


@query("homepage_normaliser", r"""SELECT page_id, CASE page_id % 5 WHEN 0 THEN regexp_extract(url, '^https?://[^/?#]+[^?#]*', 0) WHEN 1 THEN 'https://' || regexp_extract(url, '^https?://([^/?#]+[^?#]*)', 1) WHEN 2 THEN 'http://Www.' || page_id || '.no/' WHEN 4 THEN 'https://mailto:x@y.no/' END AS homepage FROM pages""")
def homepage_normaliser(spark, d):
    v = F.expr("CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN concat('HTTP://Www.', page_id, '.no?x=1') WHEN 3 THEN '  ' ELSE 'mailto:x@y.no' END")
    return table(spark, d, "pages").select("page_id", N.homepage(v).alias("homepage"))


SOCIAL = """CASE key % 12 WHEN 0 THEN 'https://www.facebook.com/brand' || key WHEN 1 THEN 'https://facebook.com/sharer.php?u=x' WHEN 2 THEN 'https://no.linkedin.com/company/c' || key || '/about' WHEN 3 THEN 'https://linkedin.com/in/p' || key
 WHEN 4 THEN 'https://youtube.com/@b' || key || '/videos' WHEN 5 THEN 'https://youtube.com/watch?v=1' WHEN 6 THEN 'https://twitter.com/t' || key WHEN 7 THEN 'https://x.com/t/status/1' WHEN 8 THEN 'https://tiktok.com/@k' || key
 WHEN 9 THEN 'https://instagram.com/p/abc' WHEN 10 THEN 'https://youtu.be/z' ELSE 'https://example.com/a' END"""


@query("social_canonical", """SELECT p_partkey AS key, CASE p_partkey % 12 WHEN 0 THEN 'facebook' WHEN 2 THEN 'linkedin' WHEN 4 THEN 'youtube' WHEN 6 THEN 'x' WHEN 8 THEN 'tiktok' END AS platform,
CASE p_partkey % 12 WHEN 0 THEN 'https://facebook.com/brand' || p_partkey WHEN 2 THEN 'https://linkedin.com/company/c' || p_partkey WHEN 4 THEN 'https://youtube.com/@b' || p_partkey WHEN 6 THEN 'https://x.com/t' || p_partkey WHEN 8 THEN 'https://tiktok.com/@k' || p_partkey END AS url FROM part""")
def social_canonical(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("key")).withColumn("given", F.expr(SOCIAL))
    return p.select("key", N.social_profile(F.col("given")).alias("s")).select("key", "s.platform", "s.url")


@query("brand_tokens", f"""WITH {NAMES}, w AS (SELECT key, {WORDS} AS words, 'site' || key AS label FROM n)
SELECT key, array_to_string(list_sort(list_distinct(list_filter(list_concat(words, [array_to_string(words, ''), label]), lambda x: length(x) >= 4))), ',') AS brands FROM w""")
def brand_tokens(spark, d):
    n = _names(spark, d)
    return n.select("key", F.array_join(N.brand_tokens(F.col("name"), F.concat(F.lit("https://www.site"), "key", F.lit(".no/x"))), ",").alias("brands"))


TEXT = "CASE key % 3 WHEN 0 THEN 'About ' || name || ' and more' WHEN 1 THEN lower(replace(name, ' ', '')) || ' news' ELSE 'other text' END"


@query("full_name_in_text", f"""WITH {NAMES}, w AS (SELECT *, {WORDS} AS words, {TEXT} AS t FROM n), x AS (SELECT key, words, {sql_tokens('t', 1, True)} AS seen FROM w)
SELECT key, NOT (len(words) = 1 AND length(array_to_string(words, '')) < 5) AND ((len(words) > 0 AND contains(' ' || array_to_string(seen, ' ') || ' ', ' ' || array_to_string(words, ' ') || ' '))
 OR (length(array_to_string(words, '')) >= 6 AND list_contains(seen, array_to_string(words, '')))) AS named FROM x""")
def full_name_in_text(spark, d):
    n = _names(spark, d)
    t = F.expr("CASE key % 3 WHEN 0 THEN concat('About ', name, ' and more') WHEN 1 THEN concat(lower(replace(name, ' ', '')), ' news') ELSE 'other text' END")
    return n.select("key", N.named(F.col("name"), t).alias("named"))


@query("headline_match", """SELECT p_partkey AS key, CASE WHEN p_partkey % 4 = 0 THEN 'exact_legal_name' WHEN p_partkey % 4 = 1 THEN 'multi_token_base_name' ELSE 'none' END AS match FROM part""")
def headline_match(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.concat_ws(" ", F.initcap("p_name"), F.lit("As")).alias("name"))
    base = F.expr("replace(name, ' As', '')")
    title = F.when(F.col("key") % 4 == 0, F.concat(F.lit("Nytt fra "), "name", F.lit(" - Avisen"))).when(F.col("key") % 4 == 1, F.concat(base, F.lit(" vokser - Avisen"))).when(F.col("key") % 4 == 2, F.concat(F.lit("Vekst - "), base)).otherwise("noe helt annet")
    return p.select("key", I.name_match(title, F.col("name")).alias("match"))


@query("phone_normaliser", "SELECT c_custkey, right(CASE WHEN c_custkey % 3 = 0 THEN '4722' || lpad(c_custkey::VARCHAR, 6, '0') WHEN c_custkey % 3 = 1 THEN '22' || lpad(c_custkey::VARCHAR, 6, '0') ELSE c_custkey::VARCHAR END, 8) AS phone FROM customer")
def phone_normaliser(spark, d):
    given = F.expr("CASE WHEN c_custkey % 3 = 0 THEN concat('+47 22 ', lpad(cast(c_custkey as string), 6, '0')) WHEN c_custkey % 3 = 1 THEN concat('(22) ', lpad(cast(c_custkey as string), 6, '0')) ELSE concat('x', c_custkey) END")
    return table(spark, d, "customer").select("c_custkey", T.phone(given).alias("phone"))


@query("email_domain", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'firma' || c_custkey || '.no' END AS domain FROM customer")
def email_domain(spark, d):
    given = F.expr("CASE c_custkey % 4 WHEN 0 THEN concat('Post@Firma', c_custkey, '.NO ') WHEN 1 THEN 'x@gmail.com' WHEN 2 THEN 'no address' ELSE 'a@localhost' END")
    return table(spark, d, "customer").select("c_custkey", T.email_domain(given).alias("domain"))


@query("workforce_number", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey::DOUBLE WHEN 1 THEN o_orderkey + 0.5::DOUBLE WHEN 2 THEN CASE WHEN o_orderkey * 10 <= 100000 THEN o_orderkey * 10.0::DOUBLE END END AS n FROM orders WHERE o_orderkey < 100000")
def workforce_number(spark, d):
    given = F.expr("CASE o_orderkey % 5 WHEN 0 THEN cast(o_orderkey as string) WHEN 1 THEN concat(o_orderkey, ',5') WHEN 2 THEN concat(o_orderkey, 'O') WHEN 3 THEN '1.2.3' ELSE 'ingen' END")
    return table(spark, d, "orders").where("o_orderkey < 100000").select("o_orderkey", T.number_nb(given).alias("n"))


@query("sitemap_urls", "SELECT c_custkey, 'https://s.no/' || c_custkey || ',https://s.no/b' || c_custkey AS urls FROM customer")
def sitemap_urls(spark, d):
    xml = F.expr("concat('<urlset><url><loc> https://s.no/', c_custkey, '</loc></url><url><loc>https://s.no/b', c_custkey, ' </loc></url><loc></loc></urlset>')")
    return table(spark, d, "customer").select("c_custkey", F.array_join(H.sitemap_urls(xml), ",").alias("urls"))


ORG_TEXT = "CASE c_custkey % 5 WHEN 0 THEN 'Org.nr. 987 654 ' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') WHEN 1 THEN 'NO987654' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') || 'MVA' WHEN 2 THEN '1987654321 x' WHEN 3 THEN '987.654.321 og 987654321, tlf 22 33 44 55' ELSE 'ingen' END"


@query("org_numbers", "SELECT c_custkey, CASE WHEN c_custkey % 5 < 2 THEN '987654' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') WHEN c_custkey % 5 = 3 THEN '987654321' ELSE '' END AS numbers FROM customer")
def org_numbers(spark, d):
    given = F.expr(ORG_TEXT.replace("::VARCHAR", "").replace("lpad((c_custkey % 1000)", "lpad(cast(c_custkey % 1000 as string)"))
    return table(spark, d, "customer").select("c_custkey", F.array_join(F.array_sort(T.org_numbers(given)), ",").alias("numbers"))


@query("tokens_c", r"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(translate(replace(lower(coalesce(text, '')), 'æ', 'ae'), 'øå', 'oa'), '[a-z0-9]+'), lambda t: t NOT IN ('as','asa','sa','ba','da','ans','enk','nuf','sti') AND (length(t) >= 3 OR regexp_full_match(t, '[0-9]+'))) AS k FROM documents)
SELECT doc_id, len(k) AS tokens, sha256(array_to_string(k, ' ')) AS digest FROM t""")
def tokens_c(spark, d):
    k = T.plain_tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", k.alias("k")).select("doc_id", F.size("k").cast("long").alias("tokens"), F.sha2(F.array_join("k", " "), 256).alias("digest"))


@query("legal_mentions", "SELECT p_partkey AS key, CASE p_partkey % 4 WHEN 0 THEN 'nordlys' WHEN 1 THEN 'fjord havn' WHEN 2 THEN 'aa blaa bb,nordlys' ELSE '' END AS entities FROM part")
def legal_mentions(spark, d):
    given = F.expr("CASE p_partkey % 4 WHEN 0 THEN '1. Nordlys AS (Nordlys as)' WHEN 1 THEN '2: Fjord & Havn NUF, Oslo' WHEN 2 THEN 'NORDLYS ASA; Aa Blåå Bb ENK' ELSE 'Ingen her, AS' END")
    return table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.array_join(T.legal_mentions(given), ",").alias("entities"))


@query("search_queries", f"WITH {PROFILES} SELECT organisation_number, '\"' || name || '\" ' || organisation_number || CASE WHEN municipality IS NULL THEN '' ELSE ' ' || municipality END AS query FROM p")
def search_queries(spark, d):
    return profiles(spark, d).select("organisation_number", T.search_query(F.concat(F.lit(" "), F.replace("name", F.lit(" "), F.lit("  "))), F.concat(F.lit("NO "), "organisation_number"), F.col("municipality")).alias("query"))


@query("domain_slugs", f"""WITH {NAMES}, w AS (SELECT key, string_split(lower(trim(regexp_replace(name, '(^| )(AS|ASA|ANS|DA|ENK|NUF|SA)\\b', ' ', 'gi'))), ' ') AS words, name FROM n),
a AS (SELECT key, list_filter(regexp_extract_all({"translate(replace(array_to_string(words, ' '), 'æ', 'ae'), 'øå', 'oa')"}, '[a-z0-9]+'), lambda x: x <> '') AS f FROM w)
SELECT key, array_to_string(f, '') AS first_slug, array_to_string(f, '') || 'as' AS with_suffix FROM a WHERE key % 4 IN (2, 3)""")
def domain_slugs(spark, d):
    s = N.domain_labels(F.col("name"))
    return _names(spark, d).where("key % 4 IN (2, 3)").select("key", s.alias("s")).select("key", F.element_at("s", 1).alias("first_slug"), F.element_at("s", -2).alias("with_suffix"))


@query("hiring_assessment", """WITH s AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS pages, count(*) FILTER (event_type = 'purchase' AND value > 150) AS open_jobs FROM events GROUP BY 1)
SELECT c_custkey AS user_id, coalesce(pages, 0)::BIGINT AS pages, coalesce(open_jobs, 0)::BIGINT AS open_jobs, CASE WHEN coalesce(open_jobs, 0) > 0 THEN 'actively_recruiting' WHEN coalesce(pages, 0) > 0 THEN 'recruitment_page_present' ELSE 'unknown' END AS status FROM customer LEFT JOIN s ON c_custkey = user_id""")
def hiring_assessment(spark, d):
    e = table(spark, d, "events")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return J.assessment(c, e.where("event_type = 'view'"), e.where("event_type = 'purchase' AND value > 150"), "user_id")


@query("search_candidate_score", "SELECT event_id, round(least(1.0::DOUBLE, (event_id % 2)::DOUBLE * 0.75 + CASE WHEN user_id % 3 = 0 THEN 0.45 WHEN user_id % 3 = 1 THEN 0.25 ELSE 0 END + (value > 100)::INT * 0.3 + (value < 50)::INT * 0.1), 6) AS score FROM events")
def search_candidate_score(spark, d):
    total = I.search_score(F.col("event_id") % 2 == 1, F.col("user_id") % 3 == 0, F.col("user_id") % 3 == 1, F.col("value") > 100, F.col("value") < 50)
    return table(spark, d, "events").select("event_id", F.round(total, 6).alias("score"))


@query("address_match", "SELECT c_custkey, c_custkey % 4 = 0 AND c_nationkey IS NOT NULL AS same FROM customer")
def address_match(spark, d):
    street = F.concat(F.lit("Storgata "), "c_custkey", F.lit(" B"))
    found = F.expr("concat('STORGATA ', c_custkey, CASE WHEN c_custkey % 4 = 1 THEN 'C' ELSE 'b' END)")
    town = F.concat(F.lit("T"), "c_nationkey")
    code = F.lit("0150")
    other = F.when(F.col("c_custkey") % 4 == 2, "0151").otherwise("0150")
    place = F.when(F.col("c_custkey") % 4 == 3, "ELSEWHERE").otherwise(town)
    return table(spark, d, "customer").select("c_custkey", E.same_address(street, code, town, found, other, place).alias("same"))


@query("link_priority", """WITH l AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'news' WHEN 'view' THEN 'career' WHEN 'error' THEN 'about' END AS kind, 'u' || (event_id % 40) AS url, min(event_id % 7) AS score FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY ALL)
SELECT user_id, kind, url, score, row_number() OVER (PARTITION BY user_id, kind ORDER BY score, url)::INT AS place FROM l QUALIFY place <= 4""")
def link_priority(spark, d):
    e = table(spark, d, "events").withColumn("url", F.concat(F.lit("u"), F.col("event_id") % 40))
    kind = F.expr("CASE event_type WHEN 'click' THEN 'news' WHEN 'view' THEN 'career' WHEN 'error' THEN 'about' END")
    return J.link_priority(e, "user_id", "url", F.col("event_id") % 7, kind)


@query("keep_last_per_key", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def keep_last_per_key(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return L.keep_last(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("keep_first_per_url", "SELECT p, event_id FROM (SELECT event_id, 'https://' || lower(event_type) || '.example.com/' || (event_id % 97) AS p, ts FROM events) QUALIFY row_number() OVER (PARTITION BY p ORDER BY ts, event_id) = 1")
def keep_first_per_url(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", F.concat(F.lit("https://"), F.lower("event_type"), F.lit(".example.com/"), F.col("event_id") % 97).alias("p"))
    return L.keep_first(e, ["p"], ["ts", "event_id"]).select("p", "event_id")


POLICY = """CASE WHEN platform IN ('linkedin','facebook','instagram','x','twitter','tiktok','glassdoor','indeed') THEN 'restricted_platform:' || platform WHEN k % 3 = 0 THEN 'source_rights_registry_official_safe'
 WHEN k % 3 = 1 THEN 'registry_experimental:' || signal_type ELSE 'undeclared_source_route' END"""


@query("policy_split", f"WITH {OBS}, q AS (SELECT *, {POLICY} AS reason FROM o) SELECT id, reason = 'source_rights_registry_official_safe' AS accepted, CASE WHEN reason <> 'source_rights_registry_official_safe' THEN reason END AS quarantine_reason FROM q")
def policy_split(spark, d):
    o = observations(spark, d).withColumns({"publication": F.expr("CASE k % 3 WHEN 0 THEN 'official_safe' WHEN 1 THEN 'experimental' END"), "strategy": F.col("signal_type"), "source_class": F.lit("independent_news")})
    good, bad = O.split(o)
    return good.select("id", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("quarantine_reason")).unionByName(bad.select("id", F.lit(False).alias("accepted"), "quarantine_reason"))


@query("results_joined", f"WITH {PROFILES}, r AS (SELECT o_custkey AS key, count(*) AS results FROM orders GROUP BY 1) SELECT p.organisation_number, r.results FROM r JOIN p USING (key)")
def results_joined(spark, d):
    r = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("results"))
    return L.join_or_raise(r, profiles(spark, d), "key", "profiles").select("organisation_number", "results")


@query("unknown_labels", "SELECT l.doc_id FROM labels l LEFT JOIN documents d USING (doc_id) WHERE d.doc_id IS NULL")
def unknown_labels(spark, d):
    return L.unknown_keys(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id")


@query("same_members", "SELECT true AS orders_of_customers, (SELECT count(DISTINCT o_custkey) FROM orders) = (SELECT count(*) FROM customer) AS orders_of_all")
def same_members(spark, d):
    o, c = table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    both = [L.same_members(o.join(c, "k", "left_semi"), o, "k"), L.same_members(o, c, "k")]
    return spark.createDataFrame([tuple(both)], "orders_of_customers boolean, orders_of_all boolean")


@query("union_social_links", """WITH l AS (SELECT user_id, event_type AS platform, event_id % 11 AS u, 0 AS list, event_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT user_id, event_type, event_id % 11, 1, event_id FROM events WHERE event_id % 2 = 1)
SELECT user_id, platform, u, list AS priority, event_id FROM l QUALIFY row_number() OVER (PARTITION BY user_id, platform, u ORDER BY list, event_id) = 1""")
def union_social_links(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_type").alias("platform"), (F.col("event_id") % 11).alias("u"), "event_id")
    return L.union_first_wins([e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")], ["user_id", "platform", "u"], ["event_id"])


@query("passive_entities", "SELECT c_custkey, c_custkey % 7 = 0 OR c_custkey % 130 = 0 AS employees_missing_or_zero FROM customer")
def passive_entities(spark, d):
    return profiles(spark, d).select(F.col("key").alias("c_custkey"), F.coalesce(F.col("employees") == 0, F.lit(True)).alias("employees_missing_or_zero"))


# --- file sources: written to the shared folder and read back -------------------------------------------------


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


REGISTRY = """SELECT lpad(c_custkey::VARCHAR, 9, '0') AS organisation_number, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'AS' ELSE '' END AS legal_form, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey % 130)::INT END AS employees,
c_custkey % 13 = 0 AS bankrupt, c_mktsegment AS industry_label FROM customer WHERE c_custkey % 17 <> 0"""


def _registry(spark, d) -> DataFrame:
    number = "CASE WHEN c_custkey % 17 = 0 THEN '12' ELSE lpad(cast(c_custkey as string), 9, '0') END"
    return table(spark, d, "customer").selectExpr(
        f"CASE WHEN c_custkey % 5 = 0 THEN {number} END AS organisasjonsnummer", f"CASE WHEN c_custkey % 5 <> 0 THEN {number} END AS `Organisasjonsnummer2`", "c_name AS navn", "CASE WHEN c_custkey % 2 = 0 THEN 'AS' END AS `organisasjonsform.kode`",
        "CASE WHEN c_custkey % 3 = 0 THEN 'ukjent' ELSE cast(c_custkey % 130 as string) END AS antallAnsatte", "CASE WHEN c_custkey % 13 = 0 THEN 'True' ELSE 'false' END AS konkurs", "c_mktsegment AS `naeringskode1.beskrivelse`",
    ).withColumn("organisasjonsnummer", F.coalesce("organisasjonsnummer", "Organisasjonsnummer2")).drop("Organisasjonsnummer2")


def _read_registry(spark, path: str) -> DataFrame:
    return files.normalise_registry(files.read_registry(spark, path)).select("organisation_number", "name", "legal_form", "employees", "bankrupt", "industry_label")


@query("registry_scan_csv", REGISTRY)
def registry_scan_csv(spark, d):
    path = _folder(spark)
    _registry(spark, d).coalesce(1).write.option("header", True).option("sep", ";").csv(path)
    return _read_registry(spark, path)


@query("registry_scan_jsonl_gz", REGISTRY)
def registry_scan_jsonl_gz(spark, d):
    path = _folder(spark) + ".jsonl"
    files.write_json_lines(_registry(spark, d), path, "gzip")
    return _read_registry(spark, path)


@query("json_lines_strict", "SELECT c_custkey, c_name FROM customer")
def json_lines_strict(spark, d):
    path = _folder(spark)
    files.write_json_lines(table(spark, d, "customer").select("c_custkey", "c_name"), path)
    return files.read_json_lines(spark, path, "c_custkey long, c_name string")


@query("json_lines_lenient", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 <> 0")
def json_lines_lenient(spark, d):
    path = _folder(spark)
    line = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit('{"c_custkey": '), "c_custkey")).otherwise(F.to_json(F.struct("c_custkey", "c_name")))
    table(spark, d, "customer").select(line.alias("value")).write.text(path)
    return files.read_json_lines(spark, path, "c_custkey long, c_name string", strict=False)


@query("batch_archive", "SELECT o_orderkey, o_totalprice FROM orders")
def batch_archive(spark, d):
    path = _folder(spark)
    files.write_json_lines(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), path, "gzip")
    return files.read_json_lines(spark, path + "/*.gz", "o_orderkey long, o_totalprice double")


@query("attempt_log", "SELECT event_id, lpad((user_id % 5)::VARCHAR, 9, '0') AS organisation_number FROM events WHERE user_id % 5 = 3 AND event_type = 'view' AND event_id % 3 = 1")
def attempt_log(spark, d):
    path = _folder(spark)
    e = table(spark, d, "events").select("event_id", F.lpad((F.col("user_id") % 5).cast("string"), 9, "0").alias("organisation_number"), F.col("event_type").alias("route"), (F.col("event_id") % 3).alias("run_id"))
    for half in (e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")):
        files.append_attempts(half, path)
    return files.read_attempts(spark, path, organisation="000000003", run="1", route="view").select("event_id", "organisation_number")


@query("manifest_reader", """WITH m AS (SELECT row_number() OVER (ORDER BY c_custkey) AS position, c_custkey FROM customer) SELECT position, CASE WHEN c_custkey % 6 = 5 THEN 'input_' || position ELSE '9' || lpad(c_custkey::VARCHAR, 8, '0') END AS organisation_number FROM m""")
def manifest_reader(spark, d):
    path = _folder(spark)
    number = "concat('9', lpad(cast(c_custkey as string), 8, '0'))"
    spaced = f"concat(left({number}, 3), ' ', substr({number}, 4, 3), ' ', right({number}, 3))"
    line = F.expr(f"""CASE c_custkey % 6 WHEN 0 THEN {number} WHEN 1 THEN concat('{{"orgnr": "', {number}, '"}}') WHEN 2 THEN concat('{{"organisasjonsnummer": ', {number}, '}}') WHEN 3 THEN {spaced}
        WHEN 4 THEN concat('{{"organization_number": "', {spaced}, '", "name": "x"}}') ELSE '{{"organisation_number": ""}}' END""")
    table(spark, d, "customer").orderBy("c_custkey").select(line.alias("value")).coalesce(1).write.text(path)
    return files.read_manifest(spark, path)


SNAPSHOT = "CASE page_id % 6 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 500 ELSE 200 END"


@query("snapshot_source", f"SELECT page_id, CASE WHEN page_id % 6 = 5 THEN 0 ELSE {SNAPSHOT} END::INT AS status, CASE WHEN page_id % 6 <> 5 THEN sha256(coalesce(html, '')) END AS content_sha256 FROM pages")
def snapshot_source(spark, d):
    p = table(spark, d, "pages").withColumn("url", F.concat_ws("#", "url", "page_id"))
    stored = p.where("page_id % 6 <> 5").select("url", F.expr(SNAPSHOT).alias("status"), F.coalesce("html", F.lit("")).alias("body"), F.lit(None).cast("timestamp").alias("retrieved_at"))
    return files.serve_snapshot(p.select("page_id", "url"), stored).select("page_id", "status", "content_sha256")


@query("official_modules", f"SELECT page_id, CASE WHEN page_id % 6 = 1 THEN 'not_found' WHEN page_id % 6 = 2 THEN 'blocked' WHEN page_id % 6 IN (3, 5) THEN 'source_error' ELSE 'available' END AS state FROM pages")
def official_modules(spark, d):
    p = table(spark, d, "pages").withColumn("url", F.concat_ws("#", "url", "page_id"))
    stored = p.where("page_id % 6 <> 5").select("url", F.expr(SNAPSHOT).alias("status"), F.col("html").alias("body"), F.lit(None).cast("timestamp").alias("retrieved_at"))
    return files.serve_snapshot(p.select("page_id", "url"), stored).select("page_id", files.fetch_state(F.col("status")).alias("state"))


@query("file_manifest", "SELECT c_custkey, sha256('line 1' || chr(10) || c_name || chr(10)) AS sha256 FROM customer")
def file_manifest(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("line 1"), F.when(F.col("c_custkey") % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\n")), "c_name", F.lit("\r\n")).alias("body"))
    return c.select("c_custkey", files.text_digest(F.col("body").cast("binary")).alias("sha256"))
