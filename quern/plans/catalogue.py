"""The query catalogue over the test tables, with the equal DuckDB SQL.

Roles: company = customer, municipality = nation, account record = order,
observation = event, web page = pages, text evidence = documents, gold labels =
labels. Every query runs over its whole tables; limits are top-k or samples.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, html as H, text as T, urls as U
from ..operators import accounts as A, claims as C, identity as I, lookup as L, metrics as M, observations as O, refresh as R, sampling as S, scoring as G, screen as Q
from ..sources.tables import accounts, observations, profiles, table
from ..streaming import changelog as Z

QUERIES: dict = {}
ORACLES: dict = {}

#: SQL of the role tables, put before the queries that use them.
PROFILES = """p AS (SELECT lpad(c_custkey::VARCHAR, 9, '0') AS organisation_number, c_custkey AS key, c_name AS name, upper(n_name) AS municipality,
 n_nationkey AS municipality_number, n_regionkey AS region, ['AS','ASA','ENK','NUF'][(c_custkey % 4 + 1)::INT] AS legal_form,
 CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 130)::INT END AS employees, c_mktsegment AS industry_label, c_acctbal AS balance, c_acctbal > 0 AS website
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
ACCOUNTS = """a AS (SELECT o_custkey AS key, o_orderkey AS record_id, o_orderdate AS period_end, year(o_orderdate)::INT AS year,
 CASE WHEN o_orderpriority <= '2-HIGH' THEN 'SELSKAP' ELSE 'KONSERN' END AS account_type, o_totalprice AS revenue, o_totalprice - 150000.0::DOUBLE AS annual_result FROM orders)"""
LATEST = "l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY key ORDER BY period_end DESC, record_id DESC) = 1)"
BEST = """b0 AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY key, year ORDER BY (account_type = 'SELSKAP')::INT DESC, record_id DESC) = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY period_end DESC, record_id DESC)::INT AS age FROM b0 QUALIFY age <= 5)"""
OBS = """o0 AS (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events),
o AS (SELECT event_id::VARCHAR AS id, event_id, user_id, lpad(user_id::VARCHAR, 9, '0') AS organisation_number,
 CASE event_type WHEN 'click' THEN 'company_site' WHEN 'view' THEN 'news' WHEN 'purchase' THEN 'google_places' WHEN 'signup' THEN 'youtube' WHEN 'error' THEN 'linkedin' END AS platform,
 CASE event_type WHEN 'click' THEN 'job_posting' WHEN 'view' THEN 'public_mention' WHEN 'purchase' THEN 'review' WHEN 'signup' THEN 'buzz_metrics' WHEN 'error' THEN 'registry_registration' END AS signal_type,
 CASE event_type WHEN 'click' THEN 'official_api' WHEN 'view' THEN 'licensed_api' WHEN 'purchase' THEN 'official_api' WHEN 'signup' THEN 'official_api' WHEN 'error' THEN 'unofficial_scraper' END AS acquisition_mode,
 CASE event_type WHEN 'click' THEN 'company_owned' WHEN 'view' THEN 'independent_news' WHEN 'purchase' THEN 'review_site' WHEN 'signup' THEN 'independent_news' WHEN 'error' THEN 'scraped' END AS source_class,
 'https://' || lower(event_type) || '.example.com/' || (event_id % 997) AS source_url, ts AS retrieved_at, sha256(event_id::VARCHAR) AS content_sha256,
 k % 5 <> 0 AS exact_entity, CASE WHEN k % 6 <> 0 THEN 'registry' END AS identity_proof, CASE WHEN k % 9 <> 0 THEN 'approved' ELSE 'pending' END AS rights_status,
 CASE WHEN k % 4 <> 0 THEN 'span' END AS evidence_span, k, CASE WHEN k % 3 = 0 THEN ['positive','neutral','negative','mixed'][k % 4 + 1] END AS sentiment_label,
 'v1' AS sentiment_model_version, (k % 12)::VARCHAR AS reviewer_id, value FROM o0),
r AS (SELECT *, list_filter([
 CASE WHEN trim(coalesce(id, '')) = '' THEN 'missing observation id' END,
 CASE WHEN NOT coalesce(regexp_matches(organisation_number, '^[0-9]+$'), false) THEN 'missing or invalid organisation number' END,
 CASE WHEN NOT coalesce(platform IN ('company_site','google_places','linkedin','youtube','news'), false) THEN 'unsupported platform' END,
 CASE WHEN NOT coalesce(signal_type IN ('job_posting','public_mention','review','buzz_metrics'), false) THEN 'unsupported signal type' END,
 CASE WHEN retrieved_at IS NULL THEN 'missing retrieval time' END,
 CASE WHEN coalesce(length(content_sha256), 0) <> 64 THEN 'missing content hash' END,
 CASE WHEN NOT coalesce(exact_entity, false) THEN 'exact legal entity is not verified' END,
 CASE WHEN trim(coalesce(identity_proof, '')) = '' THEN 'missing exact-entity proof' END,
 CASE WHEN NOT coalesce(acquisition_mode IN ('official_api','licensed_api'), false) THEN 'acquisition mode is not approved for publication' END,
 CASE WHEN NOT coalesce(rights_status = 'approved', false) THEN 'source rights are not approved' END,
 CASE WHEN signal_type IN ('review','public_post','public_mention') AND trim(coalesce(evidence_span, '')) = '' THEN 'missing evidence span' END,
 CASE WHEN sentiment_label IS NOT NULL AND sentiment_label NOT IN ('positive','neutral','negative','mixed') THEN 'unsupported sentiment label' END,
 CASE WHEN sentiment_label IS NOT NULL AND NOT coalesce(source_class IN ('customer_review','employee_review','licensed_news','public_news','public_mention','official_notice'), false) THEN 'sentiment source is not independent' END,
 CASE WHEN sentiment_label IS NOT NULL AND trim(coalesce(sentiment_model_version, '')) = '' THEN 'missing sentiment model version' END], lambda x: x IS NOT NULL) AS reasons FROM o)"""
HOST = r"regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.', '')"
PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
BAND = "CASE WHEN employees IS NULL THEN 'missing' WHEN employees = 0 THEN '0' WHEN employees < 5 THEN '1-4' WHEN employees < 20 THEN '5-19' WHEN employees < 100 THEN '20-99' ELSE '100+' END"
STRATUM = f"concat_ws('|', CASE WHEN legal_form IN ('AS','ASA','ENK') THEN legal_form ELSE 'OTHER' END, {BAND}, CASE WHEN website THEN 'web' ELSE 'no-web' END)"
FOLD = r"translate(replace(lower(coalesce(%s, '')), 'æ', 'ae'), 'øåéèêëáàâäãíìîïóòôöõúùûüçñý', 'oaeeeeaaaaaiiiiooooouuuucny')"
LEGAL = "('as','asa','sa','ba','da','ans','enk','nuf','sti')"


def sql_tokens(col: str, least: int = 2, legal: bool = False) -> str:
    drop = "" if legal else f" AND t NOT IN {LEGAL}"
    return f"list_filter(regexp_extract_all({FOLD % col}, '[a-z0-9]+'), lambda t: length(t) >= {least}{drop})"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _screen_rows(spark, d):
    last = A.latest(accounts(spark, d)).select("key", "revenue", "annual_result")
    p = profiles(spark, d).join(last, "key", "left")
    return p.withColumn("financials", F.col("revenue").isNotNull()).withColumn("industry", F.col("industry_label"))


@query("screen_topk", f"WITH {PROFILES}, {ACCOUNTS}, {LATEST} SELECT p.organisation_number, p.name, p.municipality, p.employees, l.revenue FROM p JOIN l USING (key) WHERE p.employees >= 5 AND l.revenue > 50000 AND p.region = p.region ORDER BY l.revenue DESC NULLS LAST, p.organisation_number LIMIT 10")
def screen_topk(spark, d):
    plan = Q.parse("companies with at least 5 employees and revenue over 50000 top 10 by revenue")
    return Q.screen(_screen_rows(spark, d), plan).select("organisation_number", "name", "municipality", "employees", "revenue")


@query("screen_municipality", f"WITH {PROFILES}, {ACCOUNTS}, {LATEST} SELECT p.organisation_number, p.legal_form, l.annual_result FROM p JOIN l USING (key) WHERE p.municipality = 'NATION_3' AND p.legal_form = 'AS' AND l.annual_result > 0")
def screen_municipality(spark, d):
    return Q.screen(_screen_rows(spark, d), "profitable companies in nation_3 with legal form AS").select("organisation_number", "legal_form", "annual_result")


@query("screen_contains", f"WITH {PROFILES} SELECT organisation_number, industry_label FROM p WHERE contains(lower(coalesce(industry_label, '')), 'build') AND website")
def screen_contains(spark, d):
    return Q.screen(_screen_rows(spark, d), 'companies with a website industry contains "BUILD"').select("organisation_number", "industry_label")


@query("screen_citations", f"WITH {PROFILES}, {ACCOUNTS}, {LATEST} SELECT p.organisation_number, 'financials,registry' AS citations FROM p JOIN l USING (key) ORDER BY p.employees DESC NULLS LAST, p.organisation_number LIMIT 20")
def screen_citations(spark, d):
    return Q.screen(_screen_rows(spark, d), "companies with accounts top 20 by employees").select("organisation_number", "citations")


@query("screen_abstain", f"WITH {PROFILES} SELECT organisation_number FROM p WHERE false")
def screen_abstain(spark, d):
    return Q.screen(_screen_rows(spark, d), "companies with good reviews and over 5 employees").select("organisation_number")


@query("latest_per_year", f"WITH {ACCOUNTS}, {BEST} SELECT key, year, record_id, account_type, revenue, age FROM b")
def latest_per_year(spark, d):
    return A.best_per_year(accounts(spark, d)).select("key", "year", "record_id", "account_type", "revenue", "age")


@query("latest_account", f"WITH {ACCOUNTS}, {LATEST} SELECT key, record_id, revenue FROM l")
def latest_account(spark, d):
    return A.latest(accounts(spark, d)).select("key", "record_id", "revenue")


@query("growth_cagr", f"""WITH {ACCOUNTS}, {BEST}, g AS (SELECT *, lag(revenue, 1) OVER w AS one, lag(revenue, 2) OVER w AS two, lag(year, 1) OVER w AS y1 FROM b WINDOW w AS (PARTITION BY key ORDER BY period_end, record_id))
SELECT key, year, CASE WHEN one > 0 THEN round((revenue - one) / one, 4) END AS yoy, CASE WHEN two > 0 AND revenue > 0 THEN round(pow(revenue / two, 0.5::DOUBLE) - 1, 4) END AS cagr, year - y1 = 1 AS consecutive FROM g""")
def growth_cagr(spark, d):
    return A.growth(A.best_per_year(accounts(spark, d))).select("key", "year", "yoy", "cagr", "consecutive")


@query("ratio_bands", """WITH x AS (SELECT o_orderkey, o_totalprice, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS debt, sum(l_extendedprice) AS assets FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
y AS (SELECT o_orderkey, CASE WHEN assets > 0 THEN round(o_totalprice / assets, 4) END AS equity_ratio, CASE WHEN debt > 0 AND assets <> 0 THEN round(assets / debt, 4) END AS liquidity FROM x)
SELECT o_orderkey, equity_ratio, liquidity, CASE WHEN equity_ratio >= 0.4 THEN 'Strong' WHEN equity_ratio >= 0.2 THEN 'Adequate' WHEN equity_ratio IS NOT NULL THEN 'Vulnerable' END AS solvency FROM y""")
def ratio_bands(spark, d):
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(0.0)).alias("debt"), F.sum("l_extendedprice").alias("assets"))
    x = table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(l, "o_orderkey")
    x = x.withColumns({"equity_ratio": A.guarded_ratio(F.col("o_totalprice"), F.col("assets")), "liquidity": A.guarded_ratio(F.col("assets"), F.col("debt"), zero_top=False)})
    return x.select("o_orderkey", "equity_ratio", "liquidity", A.solvency(F.col("equity_ratio")).alias("solvency"))


@query("obligation_class", f"""WITH {PROFILES}, h AS (SELECT p.*, (SELECT max(year(o_orderdate)) FROM orders WHERE o_custkey = p.key AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS latest FROM p)
SELECT organisation_number, CASE WHEN latest IS NOT NULL THEN 'filing_observed' WHEN legal_form IN ('AS','ASA') THEN 'required_by_legal_form' ELSE 'threshold_or_activity_dependent' END AS obligation FROM h""")
def obligation_class(spark, d):
    filed = table(spark, d, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("key")).agg(F.max(F.year("o_orderdate")).alias("latest"))
    p = profiles(spark, d).join(filed, "key", "left")
    return p.select("organisation_number", A.obligation(F.col("legal_form"), F.col("latest")).alias("obligation"))


MANIFEST = "m AS (SELECT lpad((o_orderkey % 2000)::VARCHAR, 9, '0') AS organisation_number, min(o_orderkey) AS position FROM orders GROUP BY 1)"


def _manifest(spark, d):
    return table(spark, d, "orders").groupBy(F.lpad((F.col("o_orderkey") % 2000).cast("string"), 9, "0").alias("organisation_number")).agg(F.min("o_orderkey").alias("position"))


@query("semi_join_manifest", f"WITH {PROFILES}, {MANIFEST} SELECT organisation_number, name FROM p WHERE organisation_number IN (SELECT organisation_number FROM m)")
def semi_join_manifest(spark, d):
    return profiles(spark, d).join(_manifest(spark, d), "organisation_number", "left_semi").select("organisation_number", "name")


@query("left_fill_missing", f"""WITH {PROFILES}, {MANIFEST}, s AS (SELECT lpad((s_suppkey + 1450)::VARCHAR, 9, '0') AS organisation_number, s_name AS name FROM supplier)
SELECT m.organisation_number, m.position, coalesce(p.name, s.name) AS name, CASE WHEN p.organisation_number IS NOT NULL THEN 'bulk' WHEN s.organisation_number IS NOT NULL THEN 'live' ELSE 'not_found' END AS origin
FROM m LEFT JOIN p USING (organisation_number) LEFT JOIN s USING (organisation_number)""")
def left_fill_missing(spark, d):
    live = table(spark, d, "supplier").select(F.lpad((F.col("s_suppkey") + 1450).cast("string"), 9, "0").alias("organisation_number"), F.col("s_name").alias("name"))
    return L.left_fill(_manifest(spark, d), profiles(spark, d), live, "organisation_number", ["name"])


@query("anti_join_seen", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join_seen(spark, d):
    seen = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(seen, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("hash_topk_sample", "SELECT c_custkey, sha256('20260825:' || c_custkey) AS rank_hash FROM customer ORDER BY rank_hash LIMIT 50")
def hash_topk_sample(spark, d):
    return S.hash_sample(table(spark, d, "customer").select("c_custkey"), "c_custkey", 50, 20260825)


@query("preserved_sample", "SELECT c_custkey, sha256('7:' || c_custkey) AS rank_hash, c_custkey % 97 = 0 AS preserved FROM customer ORDER BY c_custkey % 97 <> 0, rank_hash LIMIT 60")
def preserved_sample(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return S.preserved_sample(c, c.where("c_custkey % 97 = 0"), "c_custkey", 60, 7)


@query("stratified_sample", f"WITH {PROFILES}, s AS (SELECT key, {STRATUM} AS stratum, sha256('11:' || key) AS rank_hash FROM p) SELECT key, stratum, row_number() OVER (PARTITION BY stratum ORDER BY rank_hash)::INT AS place FROM s QUALIFY place <= 5")
def stratified_sample(spark, d):
    return S.stratified_sample(profiles(spark, d), "key", S.registry_stratum(), 5, 11).select("key", "stratum", "place")


@query("round_robin_sample", f"WITH {PROFILES}, s AS (SELECT key, {STRATUM} AS stratum, sha256('13:' || key) AS rank_hash FROM p), t AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY rank_hash)::INT AS place FROM s) SELECT key, stratum, place FROM t WHERE place <= 40 ORDER BY place, sha256('13:' || stratum) LIMIT 40")
def round_robin_sample(spark, d):
    return S.round_robin(profiles(spark, d), "key", S.registry_stratum(), 40, 13).select("key", "stratum", "place")


@query("split_assign", "WITH s AS (SELECT c_custkey, row_number() OVER (ORDER BY sha256('5:' || c_custkey)) - 1 AS place, count(*) OVER () AS n FROM customer) SELECT c_custkey, place, CASE WHEN place < round(n * 0.6) THEN 'development' WHEN place < round(n * 0.8) THEN 'validation' ELSE 'holdout' END AS split FROM s")
def split_assign(spark, d):
    return S.split_by_position(table(spark, d, "customer").select("c_custkey"), "c_custkey", 5)


@query("quota_fill_sample", "WITH s AS (SELECT c_custkey, c_mktsegment, sha256('3:' || c_custkey) AS rank_hash, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('3:' || c_custkey)) AS place FROM customer) SELECT c_custkey, c_mktsegment, place > 10 AS fill FROM s ORDER BY fill, rank_hash LIMIT 80")
def quota_fill_sample(spark, d):
    return S.quota_then_fill(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", "c_mktsegment", 10, 80, 3).select("c_custkey", "c_mktsegment", "fill")


@query("unique_host_sample", f"WITH h AS (SELECT page_id, {HOST} AS host, sha256('17:' || page_id) AS rank_hash FROM pages), f AS (SELECT * FROM h WHERE host <> '' QUALIFY row_number() OVER (PARTITION BY host ORDER BY rank_hash) = 1) SELECT host, page_id, rank_hash FROM f ORDER BY rank_hash LIMIT 20")
def unique_host_sample(spark, d):
    return S.first_per_host(table(spark, d, "pages").select("page_id", "url"), "page_id", U.host(F.col("url")), 20, 17)


@query("universe_chunks", "SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) // 250)::BIGINT AS chunk FROM customer")
def universe_chunks(spark, d):
    return S.chunks(table(spark, d, "customer").select("c_custkey"), "c_custkey", 250).select("c_custkey", "chunk")


@query("membership_digest", "WITH m AS (SELECT DISTINCT c_custkey::VARCHAR AS m FROM customer), g AS (SELECT substr(sha256(m), 1, 2) AS g, sha256(string_agg(m, chr(10) ORDER BY m)) AS h, count(*) AS k FROM m GROUP BY 1) SELECT sum(k)::BIGINT AS members, sha256(string_agg(h, chr(10) ORDER BY g)) AS digest FROM g")
def membership_digest(spark, d):
    return M.membership_digest(table(spark, d, "customer"), "c_custkey")


@query("stratum_counts", f"WITH {PROFILES} SELECT concat_ws('|', coalesce(legal_form, 'missing'), {BAND}, coalesce(industry_label, 'missing'), coalesce(municipality_number::VARCHAR, 'missing'), CASE WHEN website THEN 'web' ELSE 'no-web' END) AS stratum, count(*) AS n FROM p GROUP BY 1")
def stratum_counts(spark, d):
    return profiles(spark, d).withColumn("industry_code", F.col("industry_label")).groupBy(S.financial_stratum().alias("stratum")).agg(F.count("*").alias("n"))


@query("obs_reasons", f"WITH {OBS} SELECT event_id, array_to_string(reasons, '; ') AS reasons, len(reasons) = 0 AS publishable FROM r")
def obs_reasons(spark, d):
    x = observations(spark, d).select("event_id", O.reasons().alias("r"))
    return x.select("event_id", F.array_join("r", "; ").alias("reasons"), (F.size("r") == 0).alias("publishable"))


@query("obs_policy", f"""WITH {OBS}, q AS (SELECT event_id, CASE WHEN platform IN ('linkedin','facebook','instagram','glassdoor','indeed','tiktok','x') THEN 'restricted_platform:' || platform
 WHEN platform = 'google_places' THEN 'source_rights_registry_official_safe' WHEN platform = 'youtube' THEN 'registry_conditional:youtube'
 WHEN source_class IN ('company_site','company_owned','official','official_api') AND acquisition_mode NOT IN ('unofficial_scraper','guest_api','public_directory') THEN 'verified_company_or_official_source' ELSE 'undeclared_source_route' END AS reason FROM o)
SELECT event_id, reason, reason IN ('source_rights_registry_official_safe','verified_company_or_official_source') AS publishable FROM q""")
def obs_policy(spark, d):
    rights = spark.createDataFrame([("google_places", "official_safe"), ("youtube", "conditional")], "strategy string, publication string")
    x = observations(spark, d).withColumn("strategy", F.col("platform")).join(F.broadcast(rights), "strategy", "left")  # two literal rows
    x = x.withColumn("reason", O.policy_reason())
    return x.select("event_id", "reason", O.publishable_reason(F.col("reason")).alias("publishable"))


@query("footprint", f"""WITH {OBS}, e AS (SELECT *, len(reasons) = 0 AS ok FROM r) SELECT organisation_number, count(*) FILTER (ok) AS accepted, count(*) FILTER (NOT ok) AS rejected,
 count(*) FILTER (ok AND retrieved_at <= TIMESTAMP '2024-02-10' AND retrieved_at >= TIMESTAMP '2024-02-10' - INTERVAL 20 DAY) AS fresh, count(*) FILTER (ok AND signal_type = 'review') AS reviews,
 count(DISTINCT source_url) FILTER (ok AND signal_type = 'job_posting') AS jobs, count(DISTINCT source_url) FILTER (ok AND signal_type IN ('public_mention','buzz_metrics')) AS public_items,
 count(DISTINCT platform) FILTER (ok) AS platforms, count(*) FILTER (ok AND sentiment_label IS NOT NULL) AS sentiment_items FROM e GROUP BY 1""")
def footprint(spark, d):
    f = O.footprint(observations(spark, d), F.lit("2024-02-10").cast("timestamp"), 20)
    return f.select("organisation_number", "accepted", "rejected", "fresh", "reviews", "jobs", "public_items", "platforms", "sentiment_items")


@query("coverage_ratios", """WITH s AS (SELECT c_custkey, count(DISTINCT event_type) AS n, bool_or(event_type = 'click') AS jobs, bool_or(event_type IN ('purchase')) AS reviews, bool_or(event_type IN ('view','signup')) AS buzz FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1)
SELECT count(*) AS entities, round(avg((n > 0)::INT), 6) AS any_signal, round(avg((n >= 2)::INT), 6) AS two_signals, round(avg(coalesce(jobs, false)::INT), 6) AS jobs, round(avg(coalesce(reviews, false)::INT), 6) AS reviews, round(avg(coalesce(buzz, false)::INT), 6) AS buzz FROM s""")
def coverage_ratios(spark, d):
    e = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    s = table(spark, d, "events").select("user_id", F.col("event_type").alias("signal"))
    return M.coverage(e, s, "user_id", {"jobs": ("click",), "reviews": ("purchase",), "buzz": ("view", "signup")})


@query("two_platforms", f"WITH {OBS} SELECT organisation_number, count(DISTINCT platform) AS platforms FROM r WHERE len(reasons) = 0 GROUP BY 1 HAVING count(DISTINCT platform) >= 2")
def two_platforms(spark, d):
    x = observations(spark, d).where(F.size(O.reasons()) == 0)
    return x.groupBy("organisation_number").agg(F.countDistinct("platform").alias("platforms")).where("platforms >= 2")


@query("sentiment_rollup", """WITH j AS (SELECT lang, source, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'neutral' ELSE 'mixed' END AS label, doc_id % 20 AS company FROM documents JOIN labels USING (doc_id)),
g AS (SELECT company, count(DISTINCT source) AS sources, count(label) AS items, list_distinct(list(label) FILTER (label <> 'neutral')) AS l FROM j GROUP BY 1)
SELECT company, sources, items, CASE WHEN sources < 2 THEN 'abstain' WHEN coalesce(len(l), 0) = 0 THEN 'neutral' WHEN len(l) = 1 THEN l[1] ELSE 'mixed' END AS verdict FROM g""")
def sentiment_rollup(spark, d):
    j = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "neutral").otherwise("mixed")
    return M.sentiment_rollup(j.select((F.col("doc_id") % 20).alias("company"), "source", label.alias("label")), "company")


PREDICTED = "WITH c AS (SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS gold, CASE WHEN n_chars > 600 THEN 'good' WHEN n_chars > 200 THEN 'poor' END AS predicted FROM documents JOIN labels USING (doc_id)),\n l AS (SELECT unnest(['good','poor']) AS label), t AS (SELECT label, count(*) FILTER (gold = label AND coalesce(predicted = gold, false)) AS tp, count(*) FILTER (predicted = label AND NOT coalesce(predicted = gold, false)) AS fp, count(*) FILTER (gold = label AND NOT coalesce(predicted = gold, false)) AS fn FROM c, l GROUP BY 1),\n m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0::DOUBLE END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0::DOUBLE END AS r FROM t),\n f AS (SELECT label, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, CASE WHEN p + r > 0 THEN round(2 * p * r / (p + r), 6) ELSE 0.0::DOUBLE END AS f1 FROM m)"


def _predictions(spark, d):
    j = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return j.select(F.when(F.col("quality") == 1, "good").otherwise("poor").alias("gold"), F.when(F.col("n_chars") > 600, "good").when(F.col("n_chars") > 200, "poor").alias("predicted"))


@query("confusion_f1", PREDICTED + " SELECT * FROM f")
def confusion_f1(spark, d):
    return M.confusion(_predictions(spark, d))


@query("macro_f1", PREDICTED + " SELECT count(*) AS labels, round(avg(f1), 6) AS macro_f1 FROM f WHERE tp + fn > 0")
def macro_f1(spark, d):
    return M.macro_f1(M.confusion(_predictions(spark, d)))


@query("gold_eval", """WITH f AS (SELECT doc_id, CASE WHEN n_chars > 400 THEN 3 ELSE 2 END AS claims, CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS right_claims, CASE WHEN n_chars > 800 THEN 2 ELSE 1 END AS grounded FROM documents WHERE doc_id % 3 <> 0),
j AS (SELECT count(*) AS gold, count(claims) AS matched, coalesce(sum(claims), 0)::BIGINT AS claims, coalesce(sum(right_claims), 0)::BIGINT AS right_claims, coalesce(sum(grounded), 0)::BIGINT AS grounded FROM labels LEFT JOIN f USING (doc_id)),
k AS (SELECT *, round(right_claims / claims::DOUBLE, 6) AS precision, round(right_claims / (3 * gold)::DOUBLE, 6) AS recall, round(matched / gold::DOUBLE, 6) AS company_recall, round(grounded / claims::DOUBLE, 6) AS grounding FROM j)
SELECT *, round(0.7::DOUBLE * company_recall + 0.3::DOUBLE * recall, 6) AS coverage FROM k""")
def gold_eval(spark, d):
    x = table(spark, d, "documents").where("doc_id % 3 <> 0")
    found = x.select("doc_id", F.when(F.col("n_chars") > 400, 3).otherwise(2).alias("claims"), F.when(F.col("lang") == "en", 2).otherwise(1).alias("right_claims"), F.when(F.col("n_chars") > 800, 2).otherwise(1).alias("grounded"))
    return M.gold_evaluation(table(spark, d, "labels"), found, "doc_id")


@query("latency_percentiles", "SELECT event_type, count(value) AS n, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, max(value) AS max FROM events GROUP BY 1")
def latency_percentiles(spark, d):
    return M.latency(table(spark, d, "events"), "value", "event_type")


@query("domain_percentiles", f"WITH c AS (SELECT {HOST} AS host, count(*) AS requests FROM pages GROUP BY 1) SELECT count(*) AS n, quantile_disc(requests, 0.5)::DOUBLE AS p50, quantile_disc(requests, 0.95)::DOUBLE AS p95, max(requests) AS max FROM c")
def domain_percentiles(spark, d):
    return M.count_percentiles(table(spark, d, "pages").select(U.host(F.col("url")).alias("host")), "host")


@query("budget_admission", """WITH RECURSIVE s AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
a AS (SELECT user_id, n, event_id, CASE WHEN value <= 475.0 THEN value ELSE 0 END::DOUBLE AS spent, value <= 475.0 AS admitted FROM s WHERE n = 1
 UNION ALL SELECT s.user_id, s.n, s.event_id, CASE WHEN a.spent + s.value <= 475.0 THEN a.spent + s.value ELSE a.spent END, a.spent + s.value <= 475.0 FROM a JOIN s ON s.user_id = a.user_id AND s.n = a.n + 1)
SELECT event_id, round(spent, 2) AS spent, admitted FROM a""")
def budget_admission(spark, d):
    return M.admit_in_order(table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", 500.0, 25.0).select("event_id", "spent", "admitted")


@query("ucb_order", "WITH g AS (SELECT event_type, count(*) AS runs, avg(value) AS mean, count(*) FILTER (value > 0) AS successes FROM events GROUP BY 1), h AS (SELECT *, mean + 0.35::DOUBLE * sqrt(ln(sum(runs) OVER () + 1) / (runs + 1)) AS priority FROM g) SELECT event_type, runs, successes, round(priority, 6) AS priority, row_number() OVER (ORDER BY priority DESC, event_type)::INT AS place FROM h")
def ucb_order(spark, d):
    g = M.explore_order(table(spark, d, "events"), "event_type", "value")
    return g.select("event_type", "runs", "successes", F.round("priority", 6).alias("priority"), "place")


@query("changelog_compact", "WITH l AS (SELECT user_id * 1000 + json_extract_string(props, '$.k')::INT AS uuid, ts, event_id, CASE WHEN event_type = 'error' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status FROM events) SELECT uuid, event_id, status FROM l QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY ts DESC, event_id DESC) = 1 AND status = 'ACTIVE'")
def changelog_compact(spark, d):
    e = table(spark, d, "events")
    log = e.select((F.col("user_id") * 1000 + F.get_json_object("props", "$.k").cast("int")).alias("uuid"), "ts", "event_id", F.when(F.col("event_type") == "error", "INACTIVE").otherwise("ACTIVE").alias("status"))
    return Z.compact(log, "uuid", ["ts", "event_id"], "status").select("uuid", "event_id", "status")


@query("crawl_merge", "WITH e AS (SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) SELECT c_custkey AS user_id, event_id, event_type, CASE WHEN event_id IS NULL THEN 'source_error' ELSE 'captured' END AS state FROM customer FULL JOIN e ON user_id = c_custkey WHERE c_custkey IS NOT NULL")
def crawl_merge(spark, d):
    seeds = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts").join(seeds, "user_id", "left_semi")
    return Z.merge_events(seeds, e, "user_id", "ts").select("user_id", "event_id", "event_type", "state")


SNAPSHOTS = "s AS (SELECT o_custkey AS key, year(o_orderdate) AS y, count(*)::VARCHAR AS orders, max(o_orderstatus) AS status, max(o_orderpriority) AS priority FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1, 2), o AS (SELECT * FROM s WHERE y = 1997), n AS (SELECT * FROM s WHERE y = 1998)"
DIFF = f"""{SNAPSHOTS}, j AS (SELECT coalesce(o.key, n.key) AS key, o.key IS NOT NULL AND n.key IS NOT NULL AS whole, o.key AS ok, n.key AS nk, o.orders AS o1, n.orders AS n1, o.status AS o2, n.status AS n2, o.priority AS o3, n.priority AS n3 FROM o FULL JOIN n ON o.key = n.key),
x AS (SELECT key, 'membership' AS field, CASE WHEN ok IS NULL THEN 'absent' ELSE 'present' END AS old_value, CASE WHEN nk IS NULL THEN 'absent' ELSE 'present' END AS new_value FROM j WHERE NOT whole
UNION ALL SELECT key, 'orders', o1, n1 FROM j WHERE whole AND o1 <> n1 UNION ALL SELECT key, 'status', o2, n2 FROM j WHERE whole AND o2 <> n2 UNION ALL SELECT key, 'priority', o3, n3 FROM j WHERE whole AND o3 <> n3)"""


def _changes(spark, d):
    o = table(spark, d, "orders").where(F.year("o_orderdate").isin(1997, 1998)).groupBy(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("y"))
    s = o.agg(F.count("*").alias("orders"), F.max("o_orderstatus").alias("status"), F.max("o_orderpriority").alias("priority"))
    return R.snapshot_diff(s.where("y = 1997"), s.where("y = 1998"), "key", ["orders", "status", "priority"])


@query("snapshot_diff", f"WITH {DIFF} SELECT * FROM x")
def snapshot_diff(spark, d):
    return _changes(spark, d)


@query("replay_eval", f"""WITH {DIFF}, e AS (SELECT DISTINCT key, field FROM x WHERE key % 10 <> 0 UNION SELECT c_custkey, 'orders' FROM customer WHERE c_custkey % 40 = 1), ob AS (SELECT DISTINCT key, field FROM x),
c AS (SELECT count(*) FILTER (e.key IS NOT NULL AND ob.key IS NOT NULL) AS tp, count(*) FILTER (e.key IS NULL) AS fp, count(*) FILTER (ob.key IS NULL) AS fn FROM e FULL JOIN ob ON e.key = ob.key AND e.field = ob.field),
q AS (SELECT *, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 1.0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 1.0), 6) AS recall FROM c) SELECT *, precision >= 0.95 AND recall >= 0.95 AS qualified FROM q""")
def replay_eval(spark, d):
    seen = _changes(spark, d)
    extra = table(spark, d, "customer").where("c_custkey % 40 = 1").select(F.col("c_custkey").alias("key"), F.lit("orders").alias("field"))
    return R.replay_evaluation(seen.where("key % 10 <> 0").select("key", "field").union(extra), seen, ["key", "field"])


@query("dedup_first_wins", "WITH u AS (SELECT o_orderkey AS url_key, 0 AS priority, o_orderkey AS seq, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT l_orderkey, 1, l_linenumber, l_extendedprice FROM lineitem) SELECT url_key, priority, seq, amount FROM u QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY priority, seq, amount) = 1")
def dedup_first_wins(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("url_key"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("amount"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("url_key"), F.col("l_linenumber").cast("long").alias("seq"), F.col("l_extendedprice").alias("amount"))
    return L.union_first_wins([o, l], ["url_key"], ["seq", "amount"]).select("url_key", "priority", "seq", "amount")


CLAIMS = """c AS (SELECT o_custkey AS key, o_orderpriority AS field, CASE WHEN min(o_orderkey) % 5 = 0 THEN 'not_available' ELSE 'available' END AS availability, list(DISTINCT o_orderkey) AS ids0 FROM orders GROUP BY 1, 2),
e AS (SELECT DISTINCT o_custkey AS key, o_orderkey AS evidence_id FROM orders WHERE o_orderstatus = 'F'),
x AS (SELECT key, field, availability, unnest(ids0) AS id FROM c), y AS (SELECT x.key, field, availability, count(*) AS given, count(e.evidence_id) AS linked FROM x LEFT JOIN e ON e.key = x.key AND e.evidence_id = x.id GROUP BY ALL),
z AS (SELECT key, field, CASE WHEN availability = 'available' AND linked = 0 THEN 'ambiguous' ELSE availability END AS availability, linked, given - linked AS dropped FROM y)"""


def _claims(spark, d):
    o = table(spark, d, "orders")
    c = o.groupBy(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("field")).agg(F.when(F.min("o_orderkey") % 5 == 0, "not_available").otherwise("available").alias("availability"), F.collect_set("o_orderkey").alias("evidence_ids"))
    e = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("evidence_id"))
    return C.repair_linkage(c, e)


@query("evidence_linkage", f"WITH {CLAIMS} SELECT * FROM z")
def evidence_linkage(spark, d):
    return _claims(spark, d).select("key", "field", "availability", F.size("ids").cast("long").alias("linked"), F.col("dropped").cast("long").alias("dropped"))


@query("claims_by_field", f"WITH {CLAIMS} SELECT field, count(*) AS claims, count(*) FILTER (availability = 'available') AS available, count(*) FILTER (availability = 'not_available') AS not_available, count(*) FILTER (availability = 'ambiguous') AS abstained, round(count(*) FILTER (availability = 'available') / count(*), 6) AS coverage FROM z GROUP BY 1")
def claims_by_field(spark, d):
    return C.by_field(_claims(spark, d))


@query("envelopes", f"WITH {CLAIMS} SELECT key, string_agg(field || '=' || availability, ',' ORDER BY field) AS claims, count(*) FILTER (availability = 'available') AS available, count(*) AS fields FROM z GROUP BY 1")
def envelopes(spark, d):
    e = C.envelopes(_claims(spark, d).withColumn("value", F.lit("")))
    return e.select("key", F.array_join(F.transform("claims", lambda x: F.concat(x["field"], F.lit("="), x["availability"])), ",").alias("claims"), "available", "fields")


@query("validate_batch", f"WITH {CLAIMS} SELECT count(*) AS n, count(DISTINCT key * 10 + substr(field, 1, 1)::INT) AS distinct_keys, 0::BIGINT AS bad_states, count(*) = count(DISTINCT key * 10 + substr(field, 1, 1)::INT) AS valid FROM z")
def validate_batch(spark, d):
    c = _claims(spark, d).withColumn("id", F.col("key") * 10 + F.substring("field", 1, 1).cast("int"))
    return C.validate(c, "id", "availability")


@query("token_overlap", f"WITH t AS (SELECT doc_id, {sql_tokens('text')} AS a, {sql_tokens('substr(text, 1 + length(text) // 2)')} AS b FROM documents) SELECT doc_id, len(a) AS tokens, round(CASE WHEN len(b) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct(b), list_slice(a, 1, 50))) / len(list_distinct(b)) END, 6) AS overlap FROM t")
def token_overlap(spark, d):
    half = F.expr("substr(text, 1 + cast(length(text) div 2 as int))")
    x = table(spark, d, "documents").select("doc_id", T.tokens(F.col("text")).alias("a"), T.tokens(half).alias("b"))
    return x.select("doc_id", F.size("a").cast("long").alias("tokens"), F.round(T.overlap_ratio(F.col("b"), F.slice("a", 1, 50)), 6).alias("overlap"))


@query("name_in_text", f"WITH b AS (SELECT item_id, {sql_tokens('text')} AS w FROM benchmark), n AS (SELECT item_id, list_slice(w, 1, 3) AS name, w FROM b) SELECT item_id, len(name) > 0 AND contains(' ' || array_to_string(w, ' ') || ' ', ' ' || array_to_string(name, ' ') || ' ') AS hit, round(CASE WHEN len(list_distinct(name)) = 0 THEN 0.0 ELSE len(list_intersect(name, list_slice(w, 3, 10))) / len(list_distinct(name)) END, 6) AS overlap FROM n")
def name_in_text(spark, d):
    w = T.tokens(F.col("text"))
    n = table(spark, d, "benchmark").select("item_id", w.alias("w")).withColumn("name", F.slice("w", 1, 3))
    return n.select("item_id", T.contains_sequence(F.col("w"), F.col("name")).alias("hit"), F.round(T.overlap_ratio(F.col("name"), F.slice("w", 3, 8)), 6).alias("overlap"))


@query("url_parts", f"""WITH h AS (SELECT page_id, url, {HOST} AS host, {PATH} AS path FROM pages), l AS (SELECT *, string_split(host, '.') AS p FROM h)
SELECT page_id, host, CASE WHEN len(p) <= 2 THEN host WHEN p[-2] IN ('co','com','org','gov','ac') THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS registrable, path FROM l""")
def url_parts(spark, d):
    return table(spark, d, "pages").select("page_id", U.url_parts(F.col("url")).alias("u")).select("page_id", "u.host", "u.registrable", "u.path")


@query("url_hub", f"WITH h AS (SELECT page_id, list_filter(string_split({PATH}, '/'), lambda s: s <> '') AS p FROM pages) SELECT page_id, len(p) = 0 OR (len(p) = 1 AND NOT regexp_matches(p[1], '[0-9]')) AS hub FROM h")
def url_hub(spark, d):
    return table(spark, d, "pages").select("page_id", U.is_hub(F.col("url")).alias("hub"))


@query("url_redact", r"SELECT page_id, regexp_replace(url || '&token=abc' || page_id, '([?&](?:key|api_key|apikey|secret|token|access_token|auth)=)[^&#]*', '\1REDACTED', 'gi') AS url FROM pages")
def url_redact(spark, d):
    return table(spark, d, "pages").select("page_id", U.redacted(F.concat("url", F.lit("&token=abc"), "page_id")).alias("url"))


@query("html_title_links", r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)) AS title, len(regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1)) AS links FROM pages""")
def html_title_links(spark, d):
    return table(spark, d, "pages").select("page_id", H.title(F.col("html")).alias("title"), F.size(H.links(F.col("html"))).cast("long").alias("links"))


VISIBLE = r"trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"


@query("html_shell", rf"""SELECT page_id, length({VISIBLE}) < 100 AND len(regexp_extract_all(coalesce(html, ''), '(?i)<script[^>]+src')) >= 2 AS shell, concat_ws(',', CASE WHEN contains(lower(html), 'wp-content') THEN 'wordpress' END, CASE WHEN contains(lower(html), 'cdn.shopify.com') THEN 'shopify' END,
 CASE WHEN contains(lower(html), 'static.wixstatic.com') THEN 'wix' END, CASE WHEN contains(lower(html), 'data-reactroot') THEN 'react' END, CASE WHEN contains(lower(html), 'google-analytics.com') THEN 'google_analytics' END, CASE WHEN contains(lower(html), 'googletagmanager.com') THEN 'gtm' END) AS technologies FROM pages""")
def html_shell(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", H.is_shell(F.col("html")).alias("shell"), F.array_join(H.technologies(F.col("html")), ",").alias("technologies"))


@query("json_ld_organisations", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || '|Child ' || c_custkey WHEN 1 THEN 'Shop ' || c_custkey ELSE '' END AS names FROM customer")
def json_ld_organisations(spark, d):
    html = """CASE c_custkey % 3 WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"Organization","name":"', c_name, '","subOrganization":{"@type":["NGO","Thing"],"name":"Child ', c_custkey, '"}}</script>')
        WHEN 1 THEN concat('<script type="application/ld+json">not json</script><script type="application/ld+json">[{"@graph":[{"@type":"LocalBusiness","name":"Shop ', c_custkey, '"},{"@type":"Person","name":"x"}]}]</script>') ELSE '<p>none</p>' END"""
    c = table(spark, d, "customer").select("c_custkey", F.expr(html).alias("html"))
    return H.json_ld_organisations(c, "c_custkey").select("c_custkey", F.array_join("names", "|").alias("names"))


@query("headline_flags", r"""WITH t AS (SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)) AS t FROM pages)
SELECT page_id, CASE WHEN t = '' THEN 'empty_title' ELSE concat_ws(',', CASE WHEN length(t) - length(replace(t, '!', '')) >= 2 THEN 'excessive_exclamation' END, CASE WHEN length(t) - length(replace(t, '?', '')) >= 2 THEN 'excessive_questions' END,
 CASE WHEN length(regexp_replace(t, '[^\p{L}]', '', 'g')) >= 12 AND regexp_replace(t, '[^\p{L}]', '', 'g') = upper(regexp_replace(t, '[^\p{L}]', '', 'g')) THEN 'all_caps_title' END, CASE WHEN length(t) < 15 THEN 'suspiciously_short' END) END AS flags FROM t""")
def headline_flags(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_join(T.headline_flags(H.title(F.col("html"))), ",").alias("flags"))


@query("identity_ladder")
def identity_ladder(spark, d):
    p = table(spark, d, "pages")
    rows = p.select("page_id", F.lpad(F.col("page_id").cast("string"), 9, "0").alias("organisation_number"), F.array_join(F.slice(F.split(H.title(F.col("html")), " "), 1, 2), " ").alias("name"), "url", H.title(F.col("html")).alias("title"), H.visible_text(F.col("html")).alias("text"), F.when(F.col("page_id") % 2 == 0, U.host(F.col("url"))).otherwise("").alias("declared_host"))
    return I.website_ladder(rows).select("page_id", "matched", F.round("ratio", 6).alias("ratio"), "score", "status", "publishable")


@query("candidate_argmax_tie", "WITH s AS (SELECT s_nationkey AS key, round(s_acctbal / 1000) AS score, s_suppkey AS candidate FROM supplier), b AS (SELECT key, max(score) AS score FROM s GROUP BY 1) SELECT s.key, min(candidate) AS candidate, s.score FROM s JOIN b ON s.key = b.key AND s.score = b.score GROUP BY s.key, s.score HAVING count(*) = 1")
def candidate_argmax_tie(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("key"), F.round(F.col("s_acctbal") / 1000).alias("score"), F.col("s_suppkey").alias("candidate"))
    return L.unique_best(s, "key", "score", "candidate").select("key", "candidate", "score")


@query("waterfall_first", "WITH c AS (SELECT l_orderkey AS key, l_linenumber AS level, l_suppkey AS candidate FROM lineitem WHERE l_quantity >= 20) SELECT key, level, candidate FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY level, candidate) = 1")
def waterfall_first(spark, d):
    c = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("level"), F.col("l_suppkey").alias("candidate"), "l_quantity")
    return L.first_accepted(c, "key", "level", F.col("l_quantity") >= 20, ["candidate"]).select("key", "level", "candidate")


@query("entity_decision", """WITH f AS (SELECT c_custkey AS key, (c_custkey % 3 = 0)::INT::DOUBLE AS o, (c_custkey % 5) / 4.0::DOUBLE AS n, CASE WHEN c_custkey % 2 = 0 THEN 0.95::DOUBLE ELSE 0.0::DOUBLE END AS d, CASE WHEN c_custkey % 7 = 0 THEN 0.85::DOUBLE ELSE 0.0::DOUBLE END AS a FROM customer),
g AS (SELECT *, o * 0.4::DOUBLE + n * 0.3::DOUBLE + d * 0.2::DOUBLE + a * 0.1::DOUBLE AS s FROM f) SELECT key, round(s, 3) AS score, CASE WHEN key % 11 = 0 THEN 'rejected' WHEN (o >= 1 AND (n >= 0.9 OR d >= 0.9)) OR (n >= 0.95 AND d >= 0.9 AND s >= 0.95) THEN 'exact' ELSE 'review' END AS status FROM g""")
def entity_decision(spark, d):
    k = F.col("c_custkey")
    veto = F.when(k % 11 == 0, F.array(F.lit("parked_or_for_sale_domain"))).otherwise(F.array().cast("array<string>"))
    e = I.entity_decision((k % 3 == 0).cast("double"), (k % 5) / F.lit(4.0), F.when(k % 2 == 0, 0.95).otherwise(0.0), F.when(k % 7 == 0, 0.85).otherwise(0.0), veto)
    return table(spark, d, "customer").select(k.alias("key"), e.alias("e")).select("key", "e.score", "e.status")


METRICS = "WITH m AS (SELECT count(*) FILTER (o_orderstatus = 'P') AS base_wrong, count(*) FILTER (o_orderstatus = 'P') - 1 AS new_wrong, avg((o_orderpriority <= '2-HIGH')::INT) AS base_precision, avg((o_orderpriority <= '3-MEDIUM')::INT) AS new_precision, 0.9::DOUBLE AS base_grounding, 0.8::DOUBLE AS new_grounding, 0.5::DOUBLE AS base_recall, 0.6::DOUBLE AS new_recall FROM orders), g AS (SELECT unnest([1,2,3,4,5,6]) AS gate, unnest(['zero_wrong_company','claim_precision','evidence_grounding','recall_or_coverage','refresh','budget']) AS name, unnest([new_wrong <= base_wrong, new_precision >= base_precision, new_grounding >= base_grounding, new_recall > base_recall, true, true]) AS passed, unnest([true, true, true, true, false, true]) AS evaluated FROM m)"


def _gates(spark, d):
    o = table(spark, d, "orders")
    wrong = F.count_if(F.col("o_orderstatus") == "P")
    share = lambda p: F.avg((F.col("o_orderpriority") <= p).cast("int"))
    none = F.lit(None).cast("double")
    m = o.agg(wrong.alias("base_wrong"), (wrong - 1).alias("new_wrong"), share("2-HIGH").alias("base_precision"), share("3-MEDIUM").alias("new_precision"))
    m = m.withColumns({"base_grounding": F.lit(0.9), "new_grounding": F.lit(0.8), "base_recall": F.lit(0.5), "new_recall": F.lit(0.6), "base_refresh": none, "new_refresh": none, "base_within_budget": F.lit(1), "new_within_budget": F.lit(1)})
    return G.gate_rows(m)


@query("gate_rows", METRICS + " SELECT * FROM g")
def gate_rows(spark, d):
    return _gates(spark, d)


@query("gate_verdict", METRICS + " SELECT count(*) FILTER (passed) AS gates_passed, bool_and(passed) AS promoted FROM g")
def gate_verdict(spark, d):
    return G.verdict(_gates(spark, d))


@query("completeness_score", f"""WITH {PROFILES}, a AS (SELECT o_custkey AS key, count(*) AS accounts FROM orders GROUP BY 1), e AS (SELECT user_id AS key, count(DISTINCT event_type) AS signals FROM events GROUP BY 1),
c AS (SELECT key, least(coalesce(accounts, 0) / 5.0::DOUBLE, 1.0::DOUBLE) * 40.0::DOUBLE AS x, least(coalesce(signals, 0) / 4.0::DOUBLE, 1.0::DOUBLE) * 40.0::DOUBLE AS y, CASE WHEN website THEN 20.0::DOUBLE ELSE 0.0::DOUBLE END AS z FROM p LEFT JOIN a USING (key) LEFT JOIN e USING (key))
SELECT key, round(0.0::DOUBLE + x + y + z, 3) AS score FROM c""")
def completeness_score(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("accounts"))
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("key")).agg(F.countDistinct("event_type").alias("signals"))
    j = profiles(spark, d).join(a, "key", "left").join(e, "key", "left")
    parts = {"accounts": G.capped(F.col("accounts"), 5.0, 40.0), "signals": G.capped(F.col("signals"), 4.0, 40.0), "site": F.when(F.col("website"), 20.0).otherwise(0.0)}
    return j.select("key", G.weighted(parts).alias("score"))


@query("development_score", f"""WITH {OBS}, q AS (SELECT organisation_number, bool_or(signal_type = 'review') AS rv, bool_or(signal_type = 'job_posting') AS jb, bool_or(signal_type IN ('public_mention','buzz_metrics')) AS bz, count(*) AS accepted FROM r WHERE len(reasons) = 0 GROUP BY 1)
SELECT organisation_number, accepted, 25.0::DOUBLE + 10.0::DOUBLE * (rv::INT + jb::INT + bz::INT) AS score FROM q""")
def development_score(spark, d):
    x = observations(spark, d).where(F.size(O.reasons()) == 0)
    return G.development_score(x, "organisation_number").select("organisation_number", "accepted", "score")


@query("contract_score", """WITH m AS (SELECT event_type, avg((value > 10)::INT) AS accuracy, avg((value > 5)::INT) AS coverage, avg((value > 2)::INT) AS freshness, 1.5::DOUBLE AS operations FROM events GROUP BY 1)
SELECT event_type, round(0.0::DOUBLE + least(accuracy, 1.0) * 50.0::DOUBLE + least(coverage, 1.0) * 30.0::DOUBLE + least(freshness, 1.0) * 12.0::DOUBLE + least(operations, 1.0) * 8.0::DOUBLE, 3) AS score FROM m""")
def contract_score(spark, d):
    share = lambda x: F.avg((F.col("value") > x).cast("int"))
    m = table(spark, d, "events").groupBy("event_type").agg(share(10).alias("accuracy"), share(5).alias("coverage"), share(2).alias("freshness"), F.lit(1.5).alias("operations"))
    return G.contract_score(m).select("event_type", "score")


@query("windowed_counts", "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    w = Z.windowed_counts(table(spark, d, "events"), "ts", "1 day", "event_type")
    return w.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("session_counts", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, s.s""")
def session_counts(spark, d):
    s = Z.session_counts(table(spark, d, "events"), "ts", "12 hours", "user_id")
    return s.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


@query("live_over_bulk", "SELECT c_custkey AS key, coalesce(CASE WHEN s_name <> '' THEN s_name END, c_name) AS name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey * 3")
def live_over_bulk(spark, d):
    s = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("c_custkey"), "s_name")
    return table(spark, d, "customer").join(s, "c_custkey", "left").select(F.col("c_custkey").alias("key"), L.live_over_bulk(F.col("c_name"), F.col("s_name")).alias("name"))


@query("domain_suffix_match", f"WITH h AS (SELECT page_id, {HOST} AS host FROM pages), b AS (SELECT unnest(['example.org', 'blog.tionsh.example.net', 'nosuch.no']) AS blocked) SELECT page_id, blocked FROM h, b WHERE host = blocked OR ends_with(host, '.' || blocked)")
def domain_suffix_match(spark, d):
    blocked = spark.createDataFrame([("example.org",), ("blog.tionsh.example.net",), ("nosuch.no",)], "blocked string")
    x = table(spark, d, "pages").select("page_id", F.explode(U.host_suffixes(U.host(F.col("url")))).alias("blocked"))
    return x.join(F.broadcast(blocked), "blocked").select("page_id", "blocked")  # three literal rows


@query("date_parse", "SELECT o_orderkey, o_orderdate::DATE AS iso, o_orderdate::DATE AS dotted FROM orders")
def date_parse(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", dates.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso"), dates.parse_date(F.date_format("o_orderdate", "d.M.yyyy")).alias("dotted"))


@query("role_chain", "SELECT conv_id, count(*) AS turns, min_by(text, turn) AS opener, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY 1")
def role_chain(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.min_by("text", "turn").alias("opener"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))
    return c


# --- validators, hiring, runs, names, connectors -----------------------------------------------

from ..functions import names as N  # noqa: E402
from ..operators import hiring as J, runs as X, validators as V  # noqa: E402
from ..sources import connectors as K  # noqa: E402


@query("news_validation", f"""WITH n AS (SELECT page_id, url, trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)) AS title, page_id % 1300 AS age, page_id % 3 <> 0 AS fetched FROM pages),
p AS (SELECT *, list_filter(string_split({PATH}, '/'), lambda s: s <> '') AS steps FROM n)
SELECT page_id, CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'no_url' WHEN list_has_any(list_transform(steps, lambda s: lower(s)), ['karriere','career','careers','job','jobs','jobb','stillinger','ledige-stillinger','vacancies','work-with-us']) THEN 'recruitment_page_not_news'
 WHEN list_has_any(list_transform(steps, lambda s: lower(s)), ['privacy','personvern','cookies','terms','vilkar']) THEN 'website_policy_page_not_news' WHEN length(title) < 8 OR lower(title) IN ('nyheter','aktuelt','news','les mer','read more') THEN 'generic_title'
 WHEN age > 1126 THEN 'too_old' WHEN len(steps) = 0 OR (len(steps) = 1 AND NOT regexp_matches(steps[1], '[0-9]')) THEN 'hub_or_listing_url' WHEN NOT fetched THEN 'article_not_refetched' ELSE 'passed_so_far' END AS reason FROM p""")
def news_validation(spark, d):
    p = table(spark, d, "pages")
    x = p.select("page_id", "url", H.title(F.col("html")).alias("title"), F.sha2("html", 256).alias("content_sha256"), F.date_sub(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 1300).cast("int")).alias("published_at"), F.lit("").alias("site_url"), F.when(F.col("page_id") % 3 != 0, "article_fetched").alias("verification"), F.lit("Nobody Anywhere").alias("company_name"), H.title(F.col("html")).alias("article_text"))
    r = V.news_reason(F.lit("2024-01-01").cast("date"))
    return x.select("page_id", F.when(r.isin("article_verified", "company_not_named_in_article"), "passed_so_far").otherwise(r).alias("reason"))


@query("attempt_validation", """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderstatus = 'P' THEN 'Missing required field: ''route_name''' END, CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderkey % 7 = 0 THEN 'Active attempt record lacks required ''snapshot_hash''' END,
 CASE WHEN o_orderkey % 11 = 0 THEN 'Accepted claim lacks a span of 5 characters' END, CASE WHEN o_orderkey % 13 = 0 THEN 'cost_usd cannot be negative' END], lambda x: x IS NOT NULL), '; ') AS errors FROM orders""")
def attempt_validation(spark, d):
    k = F.col("o_orderkey")
    claim = F.array(F.struct(F.lit("f").alias("field"), F.when(k % 11 == 0, "abc").otherwise("a long span").alias("evidence_span"), F.lit("u").alias("source_url")))
    x = table(spark, d, "orders").select("o_orderkey", k.cast("string").alias("attempt_id"), F.lit("r").alias("run_id"), F.lit("1").alias("organisation_number"), F.when(F.col("o_orderstatus") != "P", "route").alias("route_name"), F.when(F.col("o_orderpriority") == "1-URGENT", "failed").otherwise("success").alias("status"), F.when(k % 7 != 0, F.sha2(k.cast("string"), 256)).alias("snapshot_hash"), F.lit(1.0).alias("runtime_seconds"), F.lit(1).alias("request_count"), F.when(k % 13 == 0, -1.0).otherwise(0.5).alias("cost_usd"), claim.alias("accepted_claims"))
    return x.select("o_orderkey", F.array_join(V.attempt_errors(), "; ").alias("errors"))


@query("attempt_summary", """SELECT count(*) AS attempts, count(*) FILTER (o_orderstatus = 'F') AS successful, count(*) FILTER (o_orderkey % 10 = 0) AS quarantined, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*)::BIGINT AS claims, count(*) FILTER (o_orderkey % 11 <> 0) AS grounded,
 sum(o_orderkey % 5)::BIGINT AS requests, round(count(*) * 0.25::DOUBLE, 5) AS cost_usd, round(count(*) * 0.5::DOUBLE, 3) AS runtime_seconds, round(count(*) FILTER (o_orderkey % 11 <> 0) / count(*), 4) AS grounded_rate FROM orders""")
def attempt_summary(spark, d):
    k = F.col("o_orderkey")
    claim = F.array(F.struct(F.when(k % 11 == 0, "abc").otherwise("a long span").alias("evidence_span"), F.lit("u").alias("source_url")))
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "failed").otherwise("abstained")
    x = table(spark, d, "orders").select(status.alias("status"), (k % 10 == 0).alias("quarantined"), (k % 5).alias("request_count"), F.lit(0.25).alias("cost_usd"), F.lit(0.5).alias("runtime_seconds"), claim.alias("accepted_claims"))
    return X.attempt_summary(x)


@query("run_delta", "WITH a AS (SELECT o_orderpriority AS field, count(*) AS v FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1), b AS (SELECT o_orderpriority AS field, count(*) AS v FROM orders WHERE year(o_orderdate) = 1998 AND o_orderpriority <> '5-LOW' GROUP BY 1) SELECT coalesce(a.field, b.field) AS field, coalesce(a.v, 0) AS old, coalesce(b.v, 0) AS new, coalesce(b.v, 0) - coalesce(a.v, 0) AS delta FROM a FULL JOIN b ON a.field = b.field")
def run_delta(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("field"), F.year("o_orderdate").alias("y"))
    runs = lambda y: o.where(F.col("y") == y).groupBy("field").agg(F.count("*").alias("v"))
    return X.run_delta(runs(1997), runs(1998).where("field <> '5-LOW'"), "field", "v")


@query("history_last", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 20")
def history_last(spark, d):
    return X.last_entries(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", [F.desc("ts"), "event_id"], 20).select("user_id", "event_id")


@query("cumulative_signals", "WITH e AS (SELECT user_id, event_type, day(ts)::INT AS step FROM events), f AS (SELECT user_id, event_type, min(step) AS step FROM e GROUP BY ALL), s AS (SELECT DISTINCT user_id, step FROM e), g AS (SELECT s.user_id, s.step, count(f.event_type) AS fresh FROM s LEFT JOIN f ON f.user_id = s.user_id AND f.step = s.step GROUP BY ALL) SELECT user_id, step, fresh, sum(fresh) OVER (PARTITION BY user_id ORDER BY step)::BIGINT AS seen FROM g")
def cumulative_signals(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", F.dayofmonth("ts").alias("step"))
    return X.cumulative_signals(e, "user_id", "step", "event_type").select("user_id", "step", "fresh", "seen")


@query("promotion_report", """WITH g AS (SELECT event_type AS strategy, count(*) FILTER (user_id % 2 = 0) AS reviewed, count(*) FILTER (value > 60) AS wrong, count(*) FILTER (value < 0) AS unsupported, count(DISTINCT user_id) FILTER (value > 30) AS gain FROM events GROUP BY 1)
SELECT strategy, reviewed, wrong, unsupported, gain, concat_ws(',', CASE WHEN reviewed = 0 THEN 'not reviewed' END, CASE WHEN wrong > 0 THEN 'wrong entity' END, CASE WHEN unsupported > 0 THEN 'unsupported claim' END, CASE WHEN gain = 0 THEN 'no gain' END) AS reasons, reviewed > 0 AND wrong = 0 AND unsupported = 0 AND gain > 0 AS promoted FROM g""")
def promotion_report(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("strategy"), "user_id", (F.col("user_id") % 2 == 0).alias("reviewed"), (F.col("value") > 60).alias("wrong"), (F.col("value") < 0).alias("unsupported"), (F.col("value") > 30).alias("gain"))
    return X.promotion(e, "user_id")


@query("audit_gates", "SELECT unnest(['price','status']) AS gate, unnest([count(*) FILTER (NOT coalesce(o_totalprice > 1000, false)), count(*) FILTER (o_orderstatus = 'P')]) AS failures, unnest([count(*) FILTER (NOT coalesce(o_totalprice > 1000, false)) = 0, count(*) FILTER (o_orderstatus = 'P') = 0]) AS passed FROM orders")
def audit_gates(spark, d):
    return X.audit_gates(table(spark, d, "orders"), {"price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus") != "P"})


@query("suite_score", "WITH t AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS p2 FROM orders), g AS (SELECT o_custkey, list(o_orderkey ORDER BY place) FILTER (place <= 2) AS w, list(o_orderkey ORDER BY p2) FILTER (p2 <= 2) AS g FROM t GROUP BY 1) SELECT o_custkey, w = g AS passed FROM g")
def suite_score(spark, d):
    from pyspark.sql import Window as W

    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    ranked = lambda *by: o.withColumn("place", F.row_number().over(W.partitionBy("o_custkey").orderBy(*by))).where("place <= 2").select("o_custkey", "o_orderkey", "place")
    return X.suite_score(ranked(F.desc("o_orderdate"), "o_orderkey"), ranked(F.desc("o_totalprice"), "o_orderkey"), "o_custkey", "o_orderkey", "place")


@query("sequence_digest", "WITH b AS (SELECT o_orderkey // 1000 AS b, sha256(string_agg(o_custkey::VARCHAR, chr(10) ORDER BY o_orderkey)) AS h FROM orders GROUP BY 1) SELECT sha256(string_agg(h, chr(10) ORDER BY b)) AS digest FROM b")
def sequence_digest(spark, d):
    return X.sequence_digest(table(spark, d, "orders"), "o_custkey", "o_orderkey")


@query("value_formats", """WITH c AS (SELECT page_id, ['website','legal_identity','roles','hiring_signal'][(page_id % 4 + 1)::INT] AS field, CASE WHEN page_id % 5 = 0 THEN url WHEN page_id % 5 = 1 THEN '{"name": "x", "organisation_number": "1"}' WHEN page_id % 5 = 2 THEN '[]' WHEN page_id % 5 = 3 THEN '""' END AS v FROM pages)
SELECT page_id, CASE WHEN v IS NULL THEN 'Value cannot be None' WHEN field = 'website' AND NOT regexp_matches(v, '^"?https?://') THEN 'Expected HTTP(S) URL string' WHEN field = 'roles' AND NOT starts_with(v, '[') THEN 'Expected list' WHEN field = 'legal_identity' AND NOT starts_with(v, '{') THEN 'Expected dict' WHEN field = 'hiring_signal' AND v IN ('', '""') THEN 'Expected non-empty string' END AS error FROM c""")
def value_formats(spark, d):
    k = F.col("page_id")
    field = F.element_at(F.array(*(F.lit(x) for x in ("website", "legal_identity", "roles", "hiring_signal"))), (k % 4 + 1).cast("int"))
    value = F.when(k % 5 == 0, F.col("url")).when(k % 5 == 1, '{"name": "x", "organisation_number": "1"}').when(k % 5 == 2, "[]").when(k % 5 == 3, '""')
    return table(spark, d, "pages").select("page_id", V.value_format_error(field, value).alias("error"))


@query("leak_scan", r"SELECT doc_id, concat_ws(' ', CASE WHEN regexp_matches(text, 'sk-[A-Za-z0-9]{20,}') THEN 'sk-[A-Za-z0-9]{20,}' END, CASE WHEN regexp_matches(text, 'AKIA[0-9A-Z]{16}') THEN 'AKIA[0-9A-Z]{16}' END, CASE WHEN regexp_matches(text, 'ghp_[A-Za-z0-9]{36}') THEN 'ghp_[A-Za-z0-9]{36}' END, CASE WHEN regexp_matches(text, 'AIza[0-9A-Za-z_-]{35}') THEN 'AIza[0-9A-Za-z_-]{35}' END, CASE WHEN regexp_matches(text, '-----BEGIN [A-Z ]*PRIVATE KEY-----') THEN '-----BEGIN [A-Z ]*PRIVATE KEY-----' END) AS leaks FROM documents")
def leak_scan(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(V.leaks(F.col("text")), " ").alias("leaks"))


@query("confuser_containment", "WITH t AS (SELECT c_custkey AS key, c_name, c_mktsegment FROM customer), f AS (SELECT c_custkey AS key, ['build', 'machin', 'zzz'][(c_custkey % 3 + 1)::INT] AS confuser FROM customer) SELECT key, confuser FROM f JOIN t USING (key) WHERE contains(lower('{\"key\":' || key || ',\"c_name\":\"' || c_name || '\",\"c_mktsegment\":\"' || c_mktsegment || '\"}'), confuser)")
def confuser_containment(spark, d):
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment")
    f = t.select("key", F.element_at(F.array(F.lit("build"), F.lit("machin"), F.lit("zzz")), (F.col("key") % 3 + 1).cast("int")).alias("confuser"))
    return V.confusers_in(t, f, "key")


@query("sequence_ratio", "SELECT s_suppkey, round(2.0::DOUBLE * (8 + length(s_suppkey::VARCHAR)) / (length(s_name) + 9 + length(s_suppkey::VARCHAR)), 6) AS ratio FROM supplier")
def sequence_ratio(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", F.round(N.sequence_ratio("s_name", F.concat(F.lit("Supplier "), F.col("s_suppkey"))), 6).alias("ratio"))


@query("map_candidates", """WITH s AS (SELECT s_suppkey, (s_suppkey % 4) / 3.0::DOUBLE AS name, s_suppkey % 2 = 0 AS a, s_suppkey % 3 = 0 AS p, s_suppkey % 5 = 0 AS w, s_suppkey % 7 = 0 AS z, s_suppkey * 10 AS reviews FROM supplier)
SELECT s_suppkey, round(name * 4 + a::INT * 3 + p::INT * 2 + w::INT * 3 + z::INT * 2 + least(1.0::DOUBLE, log10(greatest(1, reviews)) / 5), 4) AS score, (name >= 0.99 AND a::INT + p::INT + w::INT >= 1) OR (name >= 0.66 AND a::INT + p::INT + w::INT >= 2) AS accepted FROM s""")
def map_candidates(spark, d):
    k = F.col("s_suppkey")
    name, a, p, w, z = (k % 4) / F.lit(3.0), k % 2 == 0, k % 3 == 0, k % 5 == 0, k % 7 == 0
    return table(spark, d, "supplier").select("s_suppkey", N.map_score(name, a, p, w, z, k * 10).alias("score"), N.map_accepted(name, a, p, w, F.lit(0.0)).alias("accepted"))


@query("vacancy_match", """WITH a AS (SELECT l_orderkey AS ad_id, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS org, 'Supplier#' || lpad((l_suppkey)::VARCHAR, 9, '0') AS employer, l_shipdate::DATE AS expires FROM lineitem),
l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY coalesce(expires, DATE '9999-01-01') DESC, employer DESC) = 1), v AS (SELECT * FROM l WHERE expires IS NULL OR expires >= DATE '1998-06-01'),
m AS (SELECT v.*, c.s_suppkey AS by_org, u.s_suppkey AS by_unit, n.s_suppkey AS by_name FROM v LEFT JOIN supplier c ON c.s_suppkey = v.org LEFT JOIN supplier u ON u.s_suppkey + 1000 = v.org LEFT JOIN supplier n ON v.org IS NULL AND n.s_name = v.employer)
SELECT ad_id, CASE WHEN by_org IS NOT NULL THEN 'organisation' WHEN by_unit IS NOT NULL THEN 'subunit' WHEN by_name IS NOT NULL THEN 'name' ELSE 'rejected' END AS match_type, coalesce(by_org, by_unit, by_name) AS company FROM m""")
def vacancy_match(spark, d):
    # lines of one order with equal ship date and employer may differ in org; the oracle and the query break such ties alike only through max_by's first maximum, so ties are cut out by org
    ads = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ad_id"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey")).alias("org"), F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("employer"), F.col("l_shipdate").cast("date").alias("expires"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("org"), F.col("s_name").alias("name"))
    return J.match_vacancies(ads, s, s.select((F.col("org") + 1000).alias("subunit"), "org"), F.lit("1998-06-01").cast("date"))


@query("workforce_phrases", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 50 ELSE c_custkey % 90 END::DOUBLE AS workforce FROM customer")
def workforce_phrases(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    text = F.concat(F.lit("Selskapet har "), (k % 90).cast("string"), F.lit(" ansatte\nkonsern 999 ansatte\n"), F.when(k % 4 == 0, F.concat(F.lit("Antall årsverk: "), (k % 50).cast("string"))).otherwise(F.lit("")))
    return J.workforce(c.select("c_custkey", text.alias("text")), "c_custkey")


@query("hiring_signals", rf"""WITH t AS (SELECT page_id, url || '/careers/' AS url, trim(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>([^<]*)</title>', 1)) || chr(10) || {VISIBLE} || ' We are hiring now' AS s FROM pages WHERE page_id % 3 = 0 AND NOT regexp_matches(url, '[?#]')), a AS (SELECT *, strpos(s, 'We are hiring') AS p FROM t)
SELECT page_id, url, trim(substr(s, greatest(1, p - 35), p - greatest(1, p - 35) + 13 + 65)) AS claim_span FROM a""")
def hiring_signals(spark, d):
    p = table(spark, d, "pages").select("page_id", F.concat("url", F.lit("/careers/")).alias("url"), H.title(F.col("html")).alias("title"), F.concat(H.visible_text(F.col("html")), F.when(F.col("page_id") % 3 == 0, F.lit(" We are hiring now")).otherwise(F.lit(""))).alias("text"))
    return J.signals(p, "page_id")


@query("connector_rows", """SELECT 'vacancy_feed-' || lpad(c_custkey::VARCHAR, 9, '0') || '-' || substr(sha256('{"url":"https://x.no/' || c_custkey || '","text":"' || c_mktsegment || '"}'), 1, 16) AS id, 'https://x.no/' || c_custkey AS source_url, c_mktsegment AS evidence_span FROM customer WHERE c_custkey % 3 <> 0""")
def connector_rows(spark, d):
    k = F.col("c_custkey")
    item = F.to_json(F.struct(F.concat(F.lit("https://x.no/"), k).alias("url"), F.col("c_mktsegment").alias("text")))
    r = table(spark, d, "customer").select(F.lpad(k.cast("string"), 9, "0").alias("organisation_number"), F.lit("https://api").alias("url"), F.when(k % 3 == 0, 404).otherwise(200).alias("status"), F.concat(F.lit('{"items":['), item, F.lit("]}")).alias("body"), F.lit("2024-01-01").alias("retrieved_at"))
    return K.observations_from(r, "vacancy_feed").select("id", "source_url", "evidence_span")


# --- evidence, security, ownership, answers ----------------------------------------------------

from ..operators import evidence as E  # noqa: E402


@query("module_states", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'available' WHEN '2-HIGH' THEN 'not_available' WHEN '3-MEDIUM' THEN 'blocked' WHEN '5-LOW' THEN 'failed' ELSE 'failed' END AS terminal, CASE o_orderpriority WHEN '1-URGENT' THEN 'available' WHEN '2-HIGH' THEN 'failed' WHEN '3-MEDIUM' THEN 'blocked' WHEN '5-LOW' THEN 'ambiguous' ELSE 'failed' END AS availability FROM orders""")
def module_states(spark, d):
    names = {"1-URGENT": "available", "2-HIGH": "not_available", "3-MEDIUM": "blocked", "5-LOW": "ambiguous"}
    status = F.coalesce(*(F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in names.items()))
    return table(spark, d, "orders").select("o_orderkey", E.terminal_state(status).alias("terminal"), E.availability_state(status).alias("availability"))


@query("social_security", "WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Bitcoin giveaway' WHEN doc_id % 3 = 1 THEN 'official customer contact example.no' ELSE repeat('lorem ', 40) END AS s FROM documents) SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'quarantined_threat' WHEN 1 THEN 'verified_safe_and_authentic' ELSE 'quarantined_uncertain' END AS tier, CASE doc_id % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'low' ELSE 'medium' END AS risk FROM t")
def social_security(spark, d):
    k = F.col("doc_id")
    text = F.when(k % 3 == 0, "Bitcoin giveaway").when(k % 3 == 1, "official customer contact example.no").otherwise(F.repeat(F.lit("lorem "), 40))
    v = E.channel_verdict(text, F.lit("Firma"), F.lit("www.example.no"))
    return table(spark, d, "documents").select("doc_id", v.alias("v")).select("doc_id", "v.tier", "v.risk")


@query("domain_ownership", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'org_number_match' WHEN s_suppkey % 3 = 1 THEN 'registrant_name_match' ELSE 'registrant_unverified' END AS state FROM supplier")
def domain_ownership(spark, d):
    k = F.col("s_suppkey")
    ids = F.array(F.when(k % 3 == 0, k.cast("string")).otherwise("x"))
    return table(spark, d, "supplier").select("s_suppkey", E.ownership(k.cast("string"), F.col("s_name"), ids, F.when(k % 3 == 1, F.upper("s_name"))).alias("state"))


@query("profile_facts", f"""WITH {PROFILES}, {ACCOUNTS}, {LATEST}, j AS (SELECT p.*, l.revenue FROM p LEFT JOIN l USING (key)), u AS (SELECT organisation_number, unnest(['Registered name','Legal form','Municipality','Registry employee count','Revenue']) AS label, unnest([name, legal_form, municipality, employees::VARCHAR, CASE WHEN revenue IS NULL THEN NULL ELSE round(revenue)::BIGINT::VARCHAR END]) AS value FROM j) SELECT * FROM u WHERE value IS NOT NULL AND value <> ''""")
def profile_facts(spark, d):
    p = _screen_rows(spark, d).withColumn("revenue", F.round("revenue").cast("long"))
    return E.facts(p, "organisation_number", {"Registered name": "name", "Legal form": "legal_form", "Municipality": "municipality", "Registry employee count": "employees", "Revenue": "revenue"})


@query("narrative", f"""WITH {PROFILES}, {ACCOUNTS}, {LATEST} SELECT p.organisation_number, concat_ws(' ', p.name || ' is registered in ' || upper(left(municipality, 1)) || lower(substr(municipality, 2)) || '.', 'It has ' || employees || ' registered employees.',
 'Its latest revenue is ' || format('{{:,}}', round_even(l.revenue, 0)::BIGINT) || '.', CASE WHEN l.annual_result < 0 THEN 'The latest result is a loss.' WHEN l.annual_result > 0 THEN 'The latest result is a profit.' END) AS summary FROM p LEFT JOIN l USING (key)""")
def narrative(spark, d):
    return E.narrative(_screen_rows(spark, d)).select("organisation_number", "summary")


from . import activity, extended, functions, identities, matching, pages, profiles as companies, registers, states  # noqa: E402,F401  add their queries
