"""Queries of registry samples, official records, page extraction and reports over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..operators import accounts as A, extraction as X, records as R, registry as G, reports as P
from ..sources.tables import observations, profiles, table
from .catalogue import BAND, OBS, PROFILES, query

# --- registry samples ----------------------------------------------------------------------------------------

#: SQL of registry rows: customers with the year of their last order as that of their accounts.
REGISTRY = """q AS (SELECT c_custkey AS key, ['AS','ASA','ENK','NUF'][(c_custkey % 4 + 1)::INT] AS legal_form, c_custkey % 13 = 0 AS bankrupt, c_custkey % 17 = 0 AS liquidating, c_acctbal > 0 AS website,
 CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 130)::INT END AS employees, lpad(c_nationkey::VARCHAR, 2, '0') || '.' || (c_custkey % 90) AS industry_code, '0' || (3 + c_nationkey)::VARCHAR || '01' AS municipality_number,
 (SELECT max(year(o_orderdate)) FROM orders WHERE o_custkey = c_custkey)::VARCHAR AS latest FROM customer)"""
ELIGIBLE = "e AS (SELECT * FROM q WHERE latest = '2001' AND NOT (bankrupt OR liquidating))"


def _registry(spark, d) -> DataFrame:
    last = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max(F.year("o_orderdate")).cast("string").alias("latest"))
    q = table(spark, d, "customer").selectExpr(
        "c_custkey AS key", "element_at(array('AS','ASA','ENK','NUF'), int(c_custkey % 4 + 1)) AS legal_form", "c_custkey % 13 = 0 AS bankrupt", "c_custkey % 17 = 0 AS liquidating", "c_acctbal > 0 AS website",
        "CASE WHEN c_custkey % 7 <> 0 THEN int(c_custkey % 130) END AS employees", "concat(lpad(cast(c_nationkey as string), 2, '0'), '.', c_custkey % 90) AS industry_code", "concat('0', 3 + c_nationkey, '01') AS municipality_number",
    )
    return q.join(last, "key", "left")


def _eligible(spark, d) -> DataFrame:
    return _registry(spark, d).where(G.eligible(F.col("latest"), 2001, F.col("bankrupt"), F.col("liquidating")))


@query("eligible_filers", f"WITH {REGISTRY}, {ELIGIBLE} SELECT key, latest FROM e")
def eligible_filers(spark, d):
    return _eligible(spark, d).select("key", "latest")


@query("financial_strata", f"WITH {REGISTRY} SELECT concat_ws('|', legal_form, {BAND}, split_part(industry_code, '.', 1), left(municipality_number, 2), CASE WHEN website THEN 'web' ELSE 'no-web' END) AS stratum, count(*) AS n FROM q GROUP BY 1")
def financial_strata(spark, d):
    from ..operators.sampling import financial_stratum

    return _registry(spark, d).groupBy(financial_stratum().alias("stratum")).agg(F.count("*").alias("n"))


@query("registry_strata", f"""WITH {REGISTRY} SELECT concat_ws('|', CASE WHEN legal_form IN ('AS','ASA','ENK') THEN legal_form ELSE 'OTHER' END, {BAND}, CASE WHEN bankrupt OR liquidating THEN 'adverse' ELSE 'active' END, CASE WHEN website THEN 'web' ELSE 'no-web' END) AS stratum, count(*) AS n FROM q GROUP BY 1""")
def registry_strata(spark, d):
    from ..operators.sampling import registry_stratum

    return _registry(spark, d).groupBy(registry_stratum(state=True).alias("stratum")).agg(F.count("*").alias("n"))


@query("filer_sample", f"""WITH {REGISTRY}, {ELIGIBLE}, k AS (SELECT key, key % 19 = 0 AS kept, CASE WHEN key % 19 = 0 THEN sha256('5:preserved:' || key) ELSE sha256('5:' || key) END AS r FROM e WHERE key % 23 <> 0),
c AS (SELECT * FROM k ORDER BY NOT kept, r LIMIT 40), o AS (SELECT *, row_number() OVER (ORDER BY sha256('5:order:' || key)) - 1 AS place FROM c)
SELECT key, CASE WHEN kept THEN 'preserved_eligible' ELSE 'financial_filer_population' END AS sample_slice, place::INT AS place, CASE WHEN place < 24 THEN 'development' WHEN place < 32 THEN 'validation' ELSE 'held_out' END AS evaluation_split FROM o""")
def filer_sample(spark, d):
    e = _eligible(spark, d)
    return G.filer_sample(e, e.where("key % 19 = 0"), e.where("key % 23 = 0"), "key", 40, 5).select("key", "sample_slice", "place", "evaluation_split")


@query("extension_sample", f"WITH {REGISTRY} SELECT key, sha256('20260824:' || key) AS rank_hash, 'extension_holdout' AS evaluation_split FROM q WHERE key % 3 <> 0 ORDER BY rank_hash LIMIT 50")
def extension_sample(spark, d):
    q = _registry(spark, d)
    return G.extension_sample(q, q.where("key % 3 = 0"), "key", 50, 20260824).select("key", "rank_hash", "evaluation_split")


@query("population_and_stress", f"""WITH {REGISTRY}, s AS (SELECT key, legal_form AS stratum, sha256('9:' || key) AS r, sha256('9:stress:' || key) AS t FROM q), p AS (SELECT * FROM s ORDER BY r LIMIT 35),
x AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY t) > 3 AS fill FROM s WHERE key NOT IN (SELECT key FROM p)), y AS (SELECT * FROM x ORDER BY fill, t LIMIT 15),
u AS (SELECT key, stratum, r, 'population' AS sample_slice FROM p UNION ALL SELECT key, stratum, r, 'stress' FROM y), v AS (SELECT *, row_number() OVER (ORDER BY r) - 1 AS place FROM u)
SELECT key, stratum, sample_slice, CASE WHEN place < 30 THEN 'development' WHEN place < 40 THEN 'validation' ELSE 'held_out' END AS evaluation_split FROM v""")
def population_and_stress(spark, d):
    return G.population_and_stress(_registry(spark, d), "key", F.col("legal_form"), 50, 9).select("key", "stratum", "sample_slice", "evaluation_split")


@query("priority_then_fill", f"""WITH {REGISTRY}, p AS (SELECT key, CASE WHEN key % 29 = 0 THEN 0 WHEN key % 31 = 0 THEN 1 ELSE 2 END AS priority, sha256('3:' || key) AS r FROM q) SELECT key, priority, CASE WHEN priority < 2 THEN 'priority_benchmark' ELSE 'population_fill' END AS sample_slice FROM p ORDER BY priority, r LIMIT 80""")
def priority_then_fill(spark, d):
    q = _registry(spark, d)
    return G.priority_then_fill([q.where("key % 29 = 0"), q.where("key % 31 = 0")], q, "key", 80, 3).select("key", "priority", "sample_slice")


@query("unseen_active_sample", f"WITH {REGISTRY} SELECT key, sha256('20261001:' || key) AS rank_hash FROM q WHERE legal_form = 'AS' AND NOT bankrupt AND NOT liquidating AND key % 5 <> 0 ORDER BY rank_hash LIMIT 20")
def unseen_active_sample(spark, d):
    q = _registry(spark, d)
    return G.unseen_active(q, q.where("key % 5 = 0"), "key", 20, 20261001).select("key", "rank_hash")


@query("sample_overlaps", "SELECT * FROM (SELECT 'a' AS a, 'b' AS b, count(*) AS n FROM customer WHERE c_custkey % 6 = 0 UNION ALL SELECT 'a', 'c', count(*) FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT 'b', 'c', count(*) FROM customer WHERE c_custkey % 15 = 0) WHERE n > 0")
def sample_overlaps(spark, d):
    q = _registry(spark, d)
    return G.overlaps({"a": q.where("key % 2 = 0"), "b": q.where("key % 3 = 0"), "c": q.where("key % 5 = 0")}, "key")


@query("spread_sample")
def spread_sample(spark, d):
    e = table(spark, d, "events")
    return G.spread_sample(e, "event_id", "user_id", F.col("event_type"), 60, 17)


# --- official records ----------------------------------------------------------------------------------------

#: SQL of role rows: an order is a group of roles, its lines are the roles, in line order.
ROLE_CODE = "CASE l_linenumber % 5 WHEN 0 THEN 'LEDE' WHEN 1 THEN 'DAGL' WHEN 2 THEN 'medl' WHEN 3 THEN 'NEST' ELSE '' END"
ROLE_SAID = "CASE WHEN l_linenumber % 5 = 4 THEN ' Styreleder ' ELSE 'rolle' END"


def _roles(spark, d) -> DataFrame:
    person = """CASE WHEN l_partkey % 3 = 0 THEN concat('"person":{"navn":{"fornavn":"P', l_partkey, '","etternavn":"E', l_suppkey, '"},"fodselsdato":"1970-01-01"}') ELSE concat('"enhet":{"organisasjonsnummer":"', l_partkey, '","navn":"', CASE WHEN l_partkey % 7 = 0 THEN '' ELSE concat('U', l_partkey) END, '"}') END"""
    item = f"""concat('{{"type":{{"kode":"', {ROLE_CODE}, '","beskrivelse":"', {ROLE_SAID}, '"}},', {person}, ',"avregistrert":', l_returnflag = 'R', '}}')"""
    l = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", F.expr(item).alias("item")).alias("i"))
    l = l.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("i")), lambda i: i["item"]), ",").alias("items"))
    return l.select("l_orderkey", F.concat(F.lit('{"rollegrupper":[{"type":{"kode":"STYR","beskrivelse":"Styre"},"sistEndret":"2024-01-02","roller":['), "items", F.lit("]}]}")).alias("body"))


ROLES = f"""r AS (SELECT *, {ROLE_CODE} AS code, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n, CASE WHEN l_partkey % 3 = 0 THEN 'P' || l_partkey || ' E' || l_suppkey WHEN l_partkey % 7 = 0 THEN NULL ELSE 'U' || l_partkey END AS name FROM lineitem)"""


@query("role_rows", f"WITH {ROLES} SELECT l_orderkey, n::INT - 1 AS place, name, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey::VARCHAR END AS organisation_number, code AS role_code, 'STYR' AS group_code, '2024-01-02' AS last_changed, l_returnflag = 'R' AS inactive FROM r")
def role_rows(spark, d):
    r = _roles(spark, d).select("l_orderkey", F.posexplode(R.roles(F.col("body"))).alias("place", "r"))
    return r.select("l_orderkey", "place", "r.name", "r.organisation_number", "r.role_code", "r.group_code", "r.last_changed", "r.inactive")


@query("role_leaders", f"""WITH {ROLES}, v AS (SELECT * FROM r WHERE l_returnflag <> 'R' AND name IS NOT NULL) SELECT l_orderkey, (SELECT name FROM v WHERE v.l_orderkey = o.l_orderkey AND l_linenumber % 5 IN (0, 4) ORDER BY n LIMIT 1) AS chair,
(SELECT name FROM v WHERE v.l_orderkey = o.l_orderkey AND code = 'DAGL' ORDER BY n LIMIT 1) AS ceo, coalesce((SELECT string_agg(DISTINCT name, ',' ORDER BY name) FROM v WHERE v.l_orderkey = o.l_orderkey AND l_linenumber % 5 IN (2, 3)), '') AS board FROM (SELECT DISTINCT l_orderkey FROM lineitem) o""")
def role_leaders(spark, d):
    r = _roles(spark, d).select("l_orderkey", R.leaders(R.roles(F.col("body"))).alias("l"))
    return r.select("l_orderkey", "l.chair", "l.ceo", F.array_join("l.board", ",").alias("board"))


def _groups(spark, d) -> DataFrame:
    item = """concat('{"organisasjonsnummer":"', s_suppkey, '","navn":"', s_name, '"', CASE s_suppkey % 3 WHEN 0 THEN concat(',"eierandel":', s_suppkey % 100) WHEN 1 THEN concat(',"andel":', s_suppkey % 50) ELSE '' END, '}')"""
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", F.expr(item).alias("item")))), lambda i: i["item"]), ",").alias("items"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return n.select("n_nationkey", F.expr("""concat('{"', CASE WHEN n_nationkey % 2 = 0 THEN 'morselskap' ELSE 'parent' END, '":{"organisasjonsnummer":"N', n_nationkey, '","', CASE WHEN n_nationkey % 2 = 0 THEN 'navn' ELSE 'name' END, '":"', n_name, '"},"',
        CASE n_nationkey % 3 WHEN 0 THEN 'datterselskaper' WHEN 1 THEN 'subsidiaries' ELSE 'underenheter' END, '":[', coalesce(items, ''), ']}')""").alias("body"))


@query("group_structure", "SELECT n_nationkey, 'N' || n_nationkey AS parent, n_name AS parent_name, count(s_suppkey)::INT AS subsidiary_count FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY ALL")
def group_structure(spark, d):
    g = _groups(spark, d).select("n_nationkey", R.group_links(F.col("body")).alias("g"))
    return g.select("n_nationkey", "g.parent", "g.parent_name", F.size("g.subsidiaries").alias("subsidiary_count"))


@query("parent_links", "SELECT s_suppkey::VARCHAR AS organisation_number, 'N' || s_nationkey AS parent, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey % 100 WHEN 1 THEN s_suppkey % 50 END::DOUBLE AS ownership_percentage FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def parent_links(spark, d):
    return R.parents(_groups(spark, d).select(R.group_links(F.col("body")).alias("g")).select("g.*"))


@query("location_rows", """SELECT o_custkey, 'L' || o_orderkey AS organisation_number, CASE WHEN o_orderkey % 2 = 0 THEN 'Gate 1, B' || o_orderkey WHEN o_orderkey % 3 = 0 THEN 'Boks ' || o_orderkey END AS street, CASE WHEN o_orderkey % 2 = 0 THEN 'OSLO' WHEN o_orderkey % 3 = 0 THEN 'BERGEN' END AS town,
CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 50)::INT END AS employees, left(o_orderpriority, 1) AS industry FROM orders""")
def location_rows(spark, d):
    item = """concat('{"organisasjonsnummer":"L', o_orderkey, '"', CASE WHEN o_orderkey % 2 = 0 THEN concat(',"beliggenhetsadresse":{"adresse":["Gate 1","B', o_orderkey, '"],"poststed":"OSLO"}') ELSE '' END,
        CASE WHEN o_orderkey % 3 = 0 THEN concat(',"postadresse":{"adresse":["Boks ', o_orderkey, '"],"poststed":"BERGEN"}') ELSE '' END, CASE WHEN o_orderkey % 4 <> 0 THEN concat(',"antallAnsatte":', o_orderkey % 50) ELSE '' END, ',"naeringskode1":{"kode":"', left(o_orderpriority, 1), '"}}')"""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.collect_list(F.expr(item)), ",").alias("items"))
    rows = o.select("o_custkey", F.explode(R.locations(F.concat(F.lit('{"_embedded":{"underenheter":['), "items", F.lit("]}}")))).alias("u"))
    return rows.select("o_custkey", "u.organisation_number", F.array_join("u.address.adresse", ", ").alias("street"), "u.address.poststed", "u.employees", F.col("u.industry.kode").alias("industry")).withColumnRenamed("poststed", "town")


ENTITY = """concat('{"organisasjonsnummer":"', c_custkey, '","navn":"', CASE WHEN c_custkey % 3 = 0 THEN concat('New ', c_name) ELSE c_name END, '","organisasjonsform":{"kode":"AS"},"konkurs":', c_custkey % 13 = 0, ',"underAvvikling":false,"antallAnsatte":', c_custkey % 130,
 CASE WHEN c_custkey % 4 = 0 THEN concat(',"historiskeNavn":[{"navn":"Old ', c_custkey, '"},{"navn":" "},{"navn":"', c_name, '"}]') ELSE '' END, '}')"""


@query("entity_rows", "SELECT c_custkey, c_custkey::VARCHAR AS organisation_number, CASE WHEN c_custkey % 3 = 0 THEN 'New ' || c_name ELSE c_name END AS name, 'AS' AS legal_form, (c_custkey % 130)::INT AS employees, c_custkey % 13 = 0 AS bankrupt, false AS liquidating FROM customer")
def entity_rows(spark, d):
    e = table(spark, d, "customer").select("c_custkey", R.entity(F.expr(ENTITY)).alias("e"))
    return e.select("c_custkey", "e.organisation_number", "e.name", "e.legal_form", "e.employees", "e.bankrupt", "e.liquidating")


@query("live_precedence", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'New ' || c_name ELSE c_name END AS name, array_to_string(list_concat(list_concat(CASE WHEN c_custkey % 6 = 0 THEN ['Known'] ELSE [] END, CASE WHEN c_custkey % 3 = 0 THEN [c_name] ELSE [] END),
CASE WHEN c_custkey % 4 = 0 THEN ['Old ' || c_custkey] ELSE [] END), ',') AS former_names FROM customer""")
def live_precedence(spark, d):
    c = table(spark, d, "customer").withColumn("e", R.entity(F.expr(ENTITY))).withColumn("known", F.when(F.col("c_custkey") % 6 == 0, F.array(F.lit("Known"))))
    return c.select("c_custkey", F.col("e.name").alias("name"), F.array_join(R.former_names(F.col("e.name"), F.col("c_name"), F.col("known"), F.col("e.historic_names")), ",").alias("former_names"))


@query("history_years", "SELECT o_custkey, string_agg(DISTINCT year(o_orderdate)::VARCHAR, ',' ORDER BY year(o_orderdate)::VARCHAR) AS years, string_agg(DISTINCT year(o_orderdate)::VARCHAR, ',' ORDER BY year(o_orderdate)::VARCHAR DESC) AS pdf_years FROM orders GROUP BY 1")
def history_years(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.concat(F.lit('["x1",'), F.array_join(F.collect_list(F.year("o_orderdate").cast("string")), ","), F.lit(',"utkast"]')).alias("body"))
    return o.select("o_custkey", R.history_years(F.col("body")).alias("h")).select("o_custkey", F.array_join("h.years", ",").alias("years"), F.array_join("h.pdf_years", ",").alias("pdf_years"))


@query("financial_ratios", """WITH x AS (SELECT l_orderkey AS id, sum(l_extendedprice) AS assets, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS debt, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS equity, sum(l_extendedprice * l_discount) AS result,
 sum(l_quantity * 1000) AS wages, sum(CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END) AS staff FROM lineitem GROUP BY 1)
SELECT id, round(result / assets, 4) AS operating_margin, CASE WHEN debt <> 0 AND equity > 0 THEN round(debt / equity, 4) END AS debt_to_equity, CASE WHEN staff > 0 THEN round(wages / staff) END AS wage_per_employee, round(equity / assets, 4) AS equity_ratio FROM x""")
def financial_ratios(spark, d):
    l = table(spark, d, "lineitem")
    of = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice")).otherwise(0.0))
    x = l.groupBy(F.col("l_orderkey").alias("id")).agg(F.sum("l_extendedprice").alias("assets"), of("R").alias("debt"), of("A").alias("equity"), F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("result"), F.sum(F.col("l_quantity") * 1000).alias("wages"), F.count_if(F.col("l_linenumber") % 2 == 0).alias("staff"))
    return x.select("id", A.guarded_ratio(F.col("result"), F.col("assets")).alias("operating_margin"), A.guarded_ratio(F.col("debt"), F.col("equity"), zero_top=False).alias("debt_to_equity"), A.guarded_ratio(F.col("wages"), F.col("staff"), 0).alias("wage_per_employee"), A.guarded_ratio(F.col("equity"), F.col("assets")).alias("equity_ratio"))


# --- page extraction ------------------------------------------------------------------------------------------

BASE = "'https://www.firma' || c_custkey || '.no/'"


def _site(spark, d, html: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.expr("concat('https://www.firma', c_custkey, '.no/')").alias("url"), F.expr(html).alias("html"))


@query("json_ld_jobs", f"""SELECT c_custkey, place::INT AS place, title, url, published_at, hiring_org, employer_org, valid_through FROM (
SELECT c_custkey, 0 AS place, 'Job ' || c_custkey AS title, {BASE} || 'jobs/' || c_custkey AS url, '2024-03-0' || (1 + c_custkey % 9) AS published_at, c_name AS hiring_org, lpad(c_custkey::VARCHAR, 9, '0') AS employer_org, '2024-05-01' AS valid_through FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END, 'Nested', {BASE}, '2024-02-05', 'X', '', NULL FROM customer WHERE c_custkey % 4 = 0)""")
def json_ld_jobs(spark, d):
    html = """concat('<script type="application/ld+json">{broken</script>', CASE WHEN c_custkey % 3 = 0 THEN concat('<SCRIPT type="application/ld+json">{"@type":["JobPosting"],"title":" Job ', c_custkey, '","url":"/jobs/', c_custkey, '","datePosted":"2024-3-', 1 + c_custkey % 9,
        'T08:00","validThrough":"2024-05-01T00:00","hiringOrganization":{"name":"', c_name, '","identifier":{"value":"NO ', lpad(cast(c_custkey as string), 9, '0'), '"}}}</SCRIPT>') ELSE '' END,
        CASE WHEN c_custkey % 4 = 0 THEN '<script type="application/ld+json">[{"@graph":[{"@type":"JobPosting","name":"Nested","datePosted":"5. februar 2024","hiringOrganization":"X"},{"@type":"JobPosting"}]}]</script>' ELSE '' END)"""
    return X.json_ld_jobs(_site(spark, d, html), "c_custkey")


@query("json_ld_news", f"SELECT c_custkey, 'Headline ' || c_custkey AS title, {BASE} || 'n/' || c_custkey AS url, '2025-01-1' || (c_custkey % 9) AS published_at FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 10 <> 0")
def json_ld_news(spark, d):
    html = """concat('<script type="application/ld+json">{"@type":"WebPage","mainEntity":{"@type":"', CASE WHEN c_custkey % 2 = 0 THEN 'NewsArticle' ELSE 'Thing' END, '","headline":"Headline ', c_custkey, '","url":"n/', c_custkey, '","datePublished":"1', c_custkey % 9, '.01.2025"},"other":{"@type":"BlogPosting","name":"undated"}}</script>')"""
    return X.json_ld_news(_site(spark, d, html), "c_custkey", F.col("c_custkey") % 10 == 0).select("c_custkey", "title", "url", "published_at")


@query("feed_news", f"""SELECT c_custkey, 'Long title ' || c_custkey AS title, {BASE} || 'p/' || c_custkey AS url, '2024-06-0' || (1 + c_custkey % 9) AS published_at FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, 'Atom title ' || c_custkey, 'https://other.no/a', '2023-11-30' FROM customer WHERE c_custkey % 3 = 1 UNION ALL SELECT c_custkey, 'By address only', {BASE} || '2022/07/x', '2022-07-01' FROM customer WHERE c_custkey % 3 = 0""")
def feed_news(spark, d):
    rss = """concat('<rss><channel><title>t</title><item><title> Long title ', c_custkey, '</title><link>/p/', c_custkey, '</link><pubDate>Mon, 0', 1 + c_custkey % 9, ' Jun 2024 10:00:00 +0200</pubDate></item><item><title>short</title><link>/q</link><pubDate>Mon, 03 Jun 2024 10:00:00 +0200</pubDate></item>',
        '<item><title>By address only</title><link>/2022/07/x</link></item><item><title>No date at all</title><link>/z</link></item></channel></rss>')"""
    atom = """concat('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Atom title ', c_custkey, '</title><link href="https://other.no/a"/><updated>2023-11-30T23:00:00Z</updated></entry></feed>')"""
    return X.feed_news(_site(spark, d, f"CASE c_custkey % 3 WHEN 0 THEN {rss} WHEN 1 THEN {atom} ELSE '<rss><item>' END"), "c_custkey").drop("place")


@query("wp_news", f"SELECT c_custkey, 'A & title ' || c_custkey AS title, {BASE} || 'blog/post-' || c_custkey AS url, '2024-0' || (1 + c_custkey % 9) || '-15' AS published_at FROM customer WHERE c_custkey % 2 = 0")
def wp_news(spark, d):
    body = """concat('[{"title":{"rendered":"<b>A &</b> title ', c_custkey, '"},"link":"', CASE WHEN c_custkey % 2 = 0 THEN concat('https://www.firma', c_custkey, '.no/blog/post-', c_custkey) ELSE 'https://elsewhere.no/blog/post' END, '","date":"2024-0', 1 + c_custkey % 9, '-15T10:00:00"},{"title":{"rendered":"Hub page"},"link":"https://www.firma', c_custkey, '.no/","date":"2024-01-01T00:00"},{"title":"odd"}]')"""
    s = _site(spark, d, body)
    return s.select("c_custkey", F.explode(X.wp_news(F.col("html"), F.col("url"))).alias("n")).select("c_custkey", "n.*")


@query("local_business", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '22' || c_custkey END AS telephone, CASE WHEN c_custkey % 3 = 0 THEN 'a' || c_custkey || '@b.no' END AS email, CASE WHEN c_custkey % 2 = 0 THEN 'Gate ' || c_custkey END AS street, CASE WHEN c_custkey % 2 = 0 THEN '0150' END AS postal_code, NULL::VARCHAR AS locality, CASE WHEN c_custkey % 3 = 0 THEN '$$' END AS price_range FROM customer")
def local_business(spark, d):
    html = """concat(CASE WHEN c_custkey % 2 = 0 THEN concat('<script type="application/ld+json">{"@type":"Organization","telephone":" 22', c_custkey, ' ","address":{"streetAddress":"Gate ', c_custkey, '","postalCode":"0150"}}</script>') ELSE '' END,
        CASE WHEN c_custkey % 3 = 0 THEN concat('<script type="application/ld+json">{"x":[{"@type":["Store"],"telephone":"', CASE WHEN c_custkey % 2 = 0 THEN 'second' ELSE '' END, '","email":"a', c_custkey, '@b.no","priceRange":"$$"},{"@type":"Person","email":"p@q.no"}]}</script>') ELSE '' END)"""
    return X.local_business(_site(spark, d, html), "c_custkey")


@query("same_as_links", "SELECT c_custkey, 'facebook' AS platform, 'https://facebook.com/f' || c_custkey AS url FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'linkedin', 'https://linkedin.com/company/c' || c_custkey FROM customer WHERE c_custkey % 3 = 0")
def same_as_links(spark, d):
    html = """concat('<script type="application/ld+json">{"@type":"Organization"', CASE WHEN c_custkey % 2 = 0 THEN concat(',"sameAs":"https://www.facebook.com/f', c_custkey, '"') ELSE '' END, ',"member":{"sameAs":["https://example.com/", 5',
        CASE WHEN c_custkey % 3 = 0 THEN concat(',"https://no.linkedin.com/company/c', c_custkey, '/about","https://linkedin.com/company/c', c_custkey, '"') ELSE '' END, ']}}</script>')"""
    return X.same_as_links(_site(spark, d, html), "c_custkey")


DAY = "strftime(o_orderdate::DATE + ((2024 - year(o_orderdate)) * 366)::INT, '%Y-%m-%d')"


@query("job_deadlines", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN make_date(2024, 1 + (o_orderkey % 12)::INT, 5) WHEN 1 THEN make_date(2025, 3, 1 + (o_orderkey % 28)::INT) WHEN 2 THEN DATE '2026-08-12' END AS deadline FROM orders")
def job_deadlines(spark, d):
    text = F.expr("""CASE o_orderkey % 4 WHEN 0 THEN concat('Publisert 01.01.2020. Søknadsfrist: 5.', 1 + o_orderkey % 12, '.2024 kl 12') WHEN 1 THEN concat('Application deadline 2025-3-', 1 + o_orderkey % 28) WHEN 2 THEN 'søk senest 12. august 2026' ELSE 'Søknadsfrist: snarest' END""")
    return table(spark, d, "orders").select("o_orderkey", X.deadline(text).alias("deadline"))


@query("staff_in_notes", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN o_orderkey % 90 WHEN 2 THEN 7 WHEN 3 THEN o_orderkey % 40 END::INT AS staff FROM orders")
def staff_in_notes(spark, d):
    notes = F.expr("""CASE o_orderkey % 5 WHEN 0 THEN 'Selskapet har ingen ansatte. 3 årsverk innleid' WHEN 1 THEN concat('Vi hadde 12 årsverk. Selskapet har sysselsatt ', o_orderkey % 90, ' årsverk') WHEN 2 THEN 'Omtrent 7 årsverk' WHEN 3 THEN concat('Antall ansatte var ', o_orderkey % 40) ELSE 'ingen tall' END""")
    return table(spark, d, "orders").select("o_orderkey", X.staff_in_notes(notes).alias("staff"))


@query("tech_stack", "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Cloudflare,Vipps,WordPress' WHEN 1 THEN 'Next.js,React' WHEN 2 THEN 'Nuxt.js,Vue.js' WHEN 3 THEN 'AWS,Talentech/Easycruit' ELSE '' END AS technologies FROM customer")
def tech_stack(spark, d):
    html = F.expr("CASE c_custkey % 5 WHEN 0 THEN '<link href=\"/wp-content/x.css\">VIPPS' WHEN 1 THEN '<div id=\"__next\">React' WHEN 2 THEN '<div id=\"__nuxt\">' WHEN 3 THEN 'https://x.easycruit.com' ELSE '<p>plain</p>' END")
    server = F.expr("CASE c_custkey % 5 WHEN 0 THEN 'Cloudflare' WHEN 3 THEN 'CloudFront' END")
    return table(spark, d, "customer").select("c_custkey", F.array_join(X.technologies(html, server), ",").alias("technologies"))


@query("ats_tenants", "SELECT c_custkey, c_custkey % 4 < 3 AS is_ats, c_custkey % 4 IN (0, 1) AS tenant FROM customer")
def ats_tenants(spark, d):
    url = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'https://nordbyen.teamtailor.com/jobs/1' WHEN 1 THEN 'https://www.jobbnorge.no/Nordby-EN/x' WHEN 2 THEN 'https://other.easycruit.com/vacancy' ELSE 'https://notteamtailor.com/abc' END")
    return table(spark, d, "customer").select("c_custkey", X.is_ats(url).alias("is_ats"), X.ats_tenant(url, F.array(F.lit("nordbyen"), F.lit("by"))).alias("tenant"))


# --- reports --------------------------------------------------------------------------------------------------


@query("audit_precision", f"""WITH {OBS}, l AS (SELECT id, r.sentiment_label, len(reasons) = 0 AS published, event_id % 50 <> 0 AS done, event_id % 11 <> 0 AS ok, event_id % 13 <> 0 AS metric FROM r WHERE event_id % 3 = 0), p AS (SELECT * FROM l WHERE done AND published)
SELECT (SELECT count(*) FROM l) AS labels, (SELECT count(*) FROM l WHERE NOT done) AS incomplete_labels, count(*) AS published_audited, count(*) FILTER (NOT ok) AS wrong_entity, count(*) FILTER (NOT metric) AS wrong_metric, 0::BIGINT AS unsupported,
count(*) FILTER (NOT ok) AS invalid_spans, count(*) >= 100 AS audit_size_gate, round(1 - count(*) FILTER (NOT ok) / count(*), 6) AS entity_precision FROM p""")
def audit_precision(spark, d):
    from ..operators.observations import reasons

    o = observations(spark, d).withColumn("published_at", F.col("retrieved_at"))
    labels = table(spark, d, "events").where("event_id % 3 = 0").select(
        F.col("event_id").cast("string").alias("id"), (F.col("event_id") % 11 != 0).alias("exact_entity"), (F.col("event_id") % 13 != 0).alias("metric_correct"), F.lit(True).alias("evidence_supported"), (F.col("event_id") % 11 != 0).alias("evidence_span_valid"),
        F.lit(True).alias("connector_policy_passed"), F.lit(True).alias("sentiment_correct"), F.when(F.col("event_id") % 50 != 0, "reviewer").otherwise(" ").alias("reviewer"), F.col("ts").alias("reviewed_at"),
    )
    o = o.withColumn("_p", F.size(reasons()) == 0).select("id", "sentiment_label", "_p")
    a = P.audit_precision(o, labels, F.col("_p"))
    return a.select("labels", "incomplete_labels", "published_audited", "wrong_entity", "wrong_metric", "unsupported", "invalid_spans", "audit_size_gate", "entity_precision")


#: SQL of observations whose sources may carry a sentiment.
FELT = OBS.replace("'company_owned'", "'public_news'").replace("'independent_news'", "'public_news'").replace("'review_site'", "'customer_review'")


@query("sentiment_readiness", f"""WITH {FELT}, s AS (SELECT *, regexp_extract(source_url, '//([^/]+)', 1) AS host FROM r WHERE len(reasons) = 0 AND sentiment_label IS NOT NULL),
g AS (SELECT organisation_number, count(*) AS items, count(DISTINCT host) AS hosts, count(DISTINCT reviewer_id) AS reviewers, avg(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 WHEN 'negative' THEN -1 END) AS mean FROM s GROUP BY 1)
SELECT o.organisation_number, coalesce(items, 0)::BIGINT AS sentiment_items, coalesce(hosts, 0)::BIGINT AS sentiment_hosts, CASE WHEN items >= 10 AND (hosts >= 2 OR reviewers >= 10) THEN round(50 + 50 * mean, 1) END AS sentiment_score FROM (SELECT DISTINCT organisation_number FROM o) o LEFT JOIN g ON g.organisation_number = o.organisation_number""")
def sentiment_readiness(spark, d):
    from ..operators.observations import footprint

    o = observations(spark, d).withColumn("source_class", F.when(F.col("source_class") == "review_site", "customer_review").when(F.col("source_class") == "scraped", "scraped").otherwise("public_news"))
    return footprint(o, F.lit("2024-03-01").cast("timestamp")).select("organisation_number", "sentiment_items", "sentiment_hosts", "sentiment_score")


@query("proxy_score", """WITH m AS (SELECT c_custkey AS k, (c_custkey % 10) / 8.0::DOUBLE AS x, c_custkey % 2 = 0 AS q, c_custkey % 5 <> 0 AS b FROM customer),
p AS (SELECT k, CASE WHEN q THEN 10 ELSE 0 END + CASE WHEN q THEN round(10 * least(1, x), 3) ELSE 0 END + CASE WHEN q THEN round(10 * least(1, x), 3) + round(7 * least(1, x), 3) + round(8 * least(1, x), 3) + round(7 * least(1, x), 3) + round(3 * least(1, x), 3) ELSE 0 END AS e,
 4 + round(4 * least(1, x), 3) + 4 + 3 AS f, CASE WHEN b THEN 10 ELSE 5 END AS r, CASE WHEN b THEN 4 ELSE 0 END + CASE WHEN q THEN 2 ELSE 0 END + 3 + CASE WHEN b AND k % 7 < 5 THEN 1 ELSE 0 END + 2 AS d, CASE WHEN b THEN 6 ELSE 4 END AS u, q, b FROM m)
SELECT k, round(e, 3)::DOUBLE AS external_points, round(f, 3)::DOUBLE AS foundation_points, round(e + f + r + d + u, 3)::DOUBLE AS raw_score, q AND b AS qualified FROM p""")
def proxy_score(spark, d):
    x, q, b = (F.col("k") % 10) / F.lit(8.0), F.col("k") % 2 == 0, F.col("k") % 5 != 0
    m = table(spark, d, "customer").select(F.col("c_custkey").alias("k")).withColumns({
        **{c: x for c in ("two_platforms", "workforce_jobs", "ratings_reviews", "buzz_engagement", "fresh_coverage", "sentiment", "financial")}, "exact_registry": F.lit(1.0), "roles_locations": F.lit(1.0), "website_terminal": F.lit(1.0),
        "external_qualified": q, "published_audited": F.lit(120), "wrong_entity": F.lit(0), "unsupported": F.lit(0), "span_validity": F.lit(1.0), "sentiment_qualified": q, "sentiment_wrong": F.lit(0), "sentiment_support": F.lit(1.0), "research_score": F.lit(12.0), "research_external": b,
        "batch_valid": b, "resume_valid": q, "refresh_valid": F.lit(True), "p95_ms": (F.col("k") % 7) * 2500, "connector_policy": F.lit(True), "ux_score": F.lit(6.0), "ux_external": b, "audit_size_gate": F.lit(True),
    })
    return P.proxy_score(m).select("k", "external_points", "foundation_points", "raw_score", "qualified")


@query("budget_report", """WITH s AS (SELECT event_type AS run, list_sort(list(value)) AS v, count(*) AS n, round(sum((event_id % 7) * 0.25::DOUBLE), 4) AS c, sum(event_id % 1000) AS b FROM events GROUP BY 1)
SELECT run, n AS total_requests, c AS total_cost, b::BIGINT AS total_bytes, v[(n // 2) + 1] AS p50_ms, v[least(n - 1, floor(n * 0.95::DOUBLE)::BIGINT) + 1] AS p95_ms, greatest(0, 5000 - n) AS remaining_requests FROM s""")
def budget_report(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("run"), F.col("value").alias("elapsed_ms"), ((F.col("event_id") % 7) * F.lit(0.25)).alias("cost_usd"), (F.col("event_id") % 1000).alias("bytes"))
    return P.budget_report(e, "run", 5000)


@query("owner_attribution", "SELECT event_type AS run, CASE WHEN user_id % 9 = 0 THEN 'shared' ELSE user_id::VARCHAR END AS owner, count(*) AS requests, round(sum((event_id % 7) * 0.25::DOUBLE), 4) AS cost, sum(event_id % 1000)::BIGINT AS bytes FROM events GROUP BY 1, 2")
def owner_attribution(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("run"), F.when(F.col("user_id") % 9 != 0, F.col("user_id")).alias("owner"), ((F.col("event_id") % 7) * F.lit(0.25)).alias("cost_usd"), (F.col("event_id") % 1000).alias("bytes"))
    return P.owner_attribution(e, "run", "owner")


@query("results_audit", """WITH c AS (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS jobs, bool_or(o_orderstatus = 'F' AND o_orderpriority = '2-HIGH') AS news FROM orders GROUP BY 1)
SELECT count(*) AS envelopes, count(*) FILTER (c_custkey % 9 <> 0) AS terminal, count(*) AS names, count(*) FILTER (c_custkey % 2 = 0) AS accounts, count(*) FILTER (c_custkey % 3 = 0) AS role_modules, 0::BIGINT AS operating_locations, 0::BIGINT AS registered_address, 0::BIGINT AS official_website,
count(*) FILTER (coalesce(news, false)) AS dated_news, count(*) FILTER (coalesce(jobs, false)) AS job_postings, count(*) FILTER (c_custkey % 4 = 0) AS syntheses FROM customer LEFT JOIN c ON c_custkey = k""")
def results_audit(spark, d):
    e = table(spark, d, "customer").selectExpr("c_custkey AS k", "CASE WHEN c_custkey % 9 = 0 THEN 'running' ELSE 'available' END AS state", "c_name AS name", "CASE WHEN c_custkey % 2 = 0 THEN 'available' ELSE 'blocked' END AS financials", "CASE WHEN c_custkey % 3 = 0 THEN 'available' END AS roles", "CASE WHEN c_custkey % 4 = 0 THEN 'text' ELSE '' END AS summary")
    claims = table(spark, d, "orders").selectExpr("o_custkey AS k", "CASE o_orderpriority WHEN '1-URGENT' THEN 'job_postings' WHEN '2-HIGH' THEN 'dated_news' ELSE 'other' END AS field", "CASE WHEN o_orderstatus = 'F' THEN 'available' ELSE 'ambiguous' END AS availability")
    return P.results_audit(e, claims, "k")


SCORES = "s AS (SELECT o_custkey AS k, least(100.0, count(*) * 7.5)::DOUBLE AS score, sum((o_orderstatus = 'F')::INT) AS filed FROM orders GROUP BY 1)"


def _scores(spark, d) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.least(F.lit(100.0), F.count("*") * F.lit(7.5)).alias("score"), F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("filed"))


@query("completeness_summary", f"WITH {SCORES} SELECT count(*) AS companies, round(avg(score), 3) AS mean, count(*) FILTER (score >= 50) AS at_least_50, count(*) FILTER (score >= 70) AS at_least_70, count(*) FILTER (score >= 90) AS at_least_90, round(avg((filed > 0)::INT), 6) AS filed_coverage FROM s")
def completeness_summary(spark, d):
    return P.score_summary(_scores(spark, d), "score", ["filed"])


@query("completeness_distribution", f"WITH {SCORES} SELECT score, count(*) AS companies FROM s GROUP BY 1")
def completeness_distribution(spark, d):
    return P.score_distribution(_scores(spark, d), "score")
