"""Queries of claim selection, retries and route order over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity as V
from ..sources.tables import table
from .catalogue import query

TITLE = "CASE event_id % 9 WHEN 0 THEN 'Nyheter' WHEN 1 THEN 'News from us ' || event_id WHEN 2 THEN 'Kunngjøring ' || event_id ELSE 'Long headline ' || event_id END"
URL = "CASE WHEN event_id % 7 = 0 THEN 'https://site' || user_id || '.no/karriere/' || event_id WHEN event_id % 2 = 0 THEN 'https://www.site' || user_id || '.no/a/' || (event_id % 30) || '/' ELSE 'https://avis.no/' || user_id || '/' || (event_id % 30) END"
DAY = "CASE WHEN event_id % 5 <> 0 THEN '2024-03-' || lpad((1 + event_id % 28)::VARCHAR, 2, '0') END"


def _spark(sql: str) -> str:
    """The same expression for Spark: || and casts written out."""
    return sql.replace("(1 + event_id % 28)::VARCHAR", "cast(1 + event_id % 28 as string)")


@query("news_items", f"""WITH c AS (SELECT event_id, user_id, event_id % 3 AS list, {TITLE} AS title, {URL} AS url, {DAY} AS day, event_type FROM events),
k AS (SELECT * FROM c WHERE title <> 'Nyheter' AND NOT contains(url, '/karriere') AND day IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, rtrim(url, '/') ORDER BY list, event_id) = 1),
s AS (SELECT *, contains(url, '//www.site') AND user_id % 4 <> 0 AS is_site FROM k), p AS (SELECT *, CASE WHEN is_site AND event_id % 2 = 0 AND event_type <> 'error' THEN sha256('page' || user_id) END AS page FROM s),
f AS (SELECT *, CASE WHEN is_site THEN coalesce(page, sha256(event_id::VARCHAR)) ELSE sha256(event_id::VARCHAR) END AS sha FROM p WHERE NOT (is_site AND page IS NULL AND event_type = 'view') AND title NOT LIKE 'Kunngjøring%')
SELECT user_id, title, url, day AS published_at, sha AS content_sha256, is_site, row_number() OVER (PARTITION BY user_id ORDER BY is_site DESC, NOT starts_with(title, 'News ') DESC, day DESC, list, event_id)::INT AS rank FROM f""")
def news_items(spark, d):
    e = table(spark, d, "events")
    c = e.select(
        "user_id", (F.col("event_id") % 3).alias("list"), F.col("event_id").alias("place"), F.expr(_spark(TITLE)).alias("title"), F.expr(_spark(URL)).alias("url"), F.lit("").alias("source"), F.expr(_spark(DAY)).alias("published_at"),
        F.lit(None).cast("string").alias("excerpt"), F.when(F.col("event_type") == "error", "https://elsewhere.no/").otherwise(F.concat(F.lit("https://www.site"), "user_id", F.lit(".no/news"))).alias("source_url"),
        F.when(F.col("event_type") == "view", "article_fetched").alias("verification"), F.sha2(F.col("event_id").cast("string"), 256).alias("content_sha256"),
    )
    c = c.withColumn("source_url", F.when((F.col("place") % 2 == 0), F.col("source_url")).otherwise(F.concat("source_url", F.lit("x"))))
    users = e.select("user_id").distinct()
    sites = users.select("user_id", F.concat(F.lit("https://www.site"), "user_id", F.lit(".no")).alias("site"), (F.col("user_id") % 4 != 0).alias("valid"))
    pages = users.select("user_id", F.concat(F.lit("https://www.site"), "user_id", F.lit(".no/news/")).alias("url"), F.sha2(F.concat(F.lit("page"), "user_id"), 256).alias("sha"))
    return V.news_items(c, sites, pages, "user_id").select("user_id", "title", "url", "published_at", "content_sha256", "is_site", "rank")


JOB_URL = "CASE event_id % 4 WHEN 0 THEN 'https://arbeidsplassen.nav.no/stillinger/stilling/' || (event_id % 40) WHEN 1 THEN 'https://www.linkedin.com/jobs/view/' || (event_id % 40) WHEN 2 THEN 'https://firma.no/kontakt/' || event_id ELSE 'https://firma.no/jobs/' || (event_id % 40) || '/' END"
JOB_SHA = "CASE WHEN event_id % 6 = 1 THEN '' WHEN event_id % 6 < 4 THEN sha256('p' || user_id) ELSE sha256(event_id::VARCHAR) END"
JOBS = f"""c AS (SELECT event_id, user_id, event_id % 2 AS list, CASE WHEN event_id % 8 = 5 THEN 'Karriere' ELSE 'Utvikler ' || event_id END AS title, {JOB_URL} AS url, {DAY} AS day, {JOB_SHA} AS sha, event_type = 'click' AS unverified FROM events),
k AS (SELECT * FROM c WHERE NOT unverified AND title <> 'Karriere' AND NOT contains(url, '/kontakt') QUALIFY row_number() OVER (PARTITION BY user_id, rtrim(url, '/') ORDER BY list, event_id) = 1),
j AS (SELECT *, CASE WHEN contains(url, 'nav.no') THEN 2 WHEN contains(url, 'linkedin') THEN 1 ELSE 0 END AS priority FROM k WHERE sha <> '' AND (contains(url, 'nav.no') OR contains(url, 'linkedin') OR sha = sha256('p' || user_id)))"""


def _jobs(spark, d):
    e = table(spark, d, "events")
    sha = F.when(F.col("event_id") % 6 == 1, "").when(F.col("event_id") % 6 < 4, F.sha2(F.concat(F.lit("p"), "user_id"), 256)).otherwise(F.sha2(F.col("event_id").cast("string"), 256))
    c = e.select("user_id", (F.col("event_id") % 2).alias("list"), F.col("event_id").alias("place"), F.expr("CASE WHEN event_id % 8 = 5 THEN 'Karriere' ELSE 'Utvikler ' || event_id END").alias("title"), F.expr(JOB_URL).alias("url"), F.expr(_spark(DAY)).alias("published_at"), F.lit("").alias("kind"), sha.alias("content_sha256"), (F.col("event_type") == "click").alias("unverified"))
    return V.job_items(c, e.select("user_id", F.sha2(F.concat(F.lit("p"), "user_id"), 256).alias("sha")), "user_id")


@query("job_items", f"WITH {JOBS} SELECT user_id, title, url, day AS published_at, priority, row_number() OVER (PARTITION BY user_id ORDER BY priority DESC, day DESC NULLS LAST, list, event_id)::INT AS rank FROM j")
def job_items(spark, d):
    return _jobs(spark, d).select("user_id", "title", "url", "published_at", "priority", "rank")


@query("hiring_reconciled", f"""WITH {JOBS}, n AS (SELECT user_id, count(*) AS open_jobs FROM j GROUP BY 1) SELECT c_custkey AS user_id, coalesce(open_jobs, 0)::BIGINT AS open_jobs, CASE WHEN coalesce(open_jobs, 0) > 0 THEN 'actively_recruiting' WHEN c_custkey % 3 = 2 THEN 'unknown'
WHEN c_custkey % 2 = 0 THEN 'recruitment_page_present' ELSE 'unknown' END AS status FROM customer LEFT JOIN n ON user_id = c_custkey""")
def hiring_reconciled(spark, d):
    v = table(spark, d, "customer").selectExpr("c_custkey AS user_id", "CASE WHEN c_custkey % 3 = 2 THEN 'unknown' ELSE 'actively_recruiting' END AS status", "CASE WHEN c_custkey % 2 = 0 THEN 'https://x.no/karriere' END AS career_url")
    return V.hiring_status(v, _jobs(spark, d), "user_id").select("user_id", "open_jobs", "status")


@query("spaced_starts", "WITH RECURSIVE a AS (SELECT event_id, event_type, epoch(ts) / 3600.0::DOUBLE AS t, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events), m AS (SELECT *, max(t - i * 2.1::DOUBLE) OVER (PARTITION BY event_type ORDER BY i) AS lead FROM a) SELECT event_id, round(lead + i * 2.1::DOUBLE, 4) AS start FROM m")
def spaced_starts(spark, d):
    e = table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3.6e9))
    return V.spaced_starts(e, "event_type", ["ts", "event_id"], "t").select("event_id", F.round("start", 4).alias("start"))


@query("fetch_outcomes", """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 200 WHEN 6 THEN 200 ELSE 0 END::INT AS status, CASE c_custkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 4 THEN 3 WHEN 5 THEN 1 ELSE 2 END::BIGINT AS requests,
CASE c_custkey % 7 WHEN 2 THEN 15 + 4 WHEN 4 THEN 0.4 + 0.8 WHEN 6 THEN 1 ELSE 0 END::DOUBLE AS waited FROM customer""")
def fetch_outcomes(spark, d):
    t = table(spark, d, "customer").select("c_custkey", F.explode(F.array(*(F.lit(i) for i in range(4)))).alias("attempt"))
    k, n = F.col("c_custkey") % 7, F.col("attempt")
    status = F.when(k == 0, 200).when(k == 1, 404).when(k == 2, F.when(n < 2, 429).otherwise(200)).when(k == 3, 403).when(k == 4, 503).when(k == 5, 0).otherwise(F.when(n == 0, 429).otherwise(200))
    told = F.when((k == 2) & (n == 0), 99.0).when(k == 6, 0.2)
    return V.fetch_outcomes(t.withColumns({"status": status, "retry_after": told, "fatal": k == 5}), "c_custkey")


@query("site_cache", "SELECT c_custkey, 'https://site' || c_custkey || '.no' AS cached_url, CASE c_custkey % 4 WHEN 0 THEN 'to_revalidate' WHEN 1 THEN 'moved' WHEN 2 THEN 'unchanged' ELSE 'changed' END AS state FROM customer")
def site_cache(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("https://site"), "c_custkey", F.lit(".no")).alias("url"), F.lit("a").alias("sha"))
    now = c.where("c_custkey % 4 <> 0").withColumns({"url": F.when(F.col("c_custkey") % 4 == 1, "https://new.no/").otherwise(F.concat(F.lit("http://www."), F.substr("url", F.lit(9)))), "sha": F.when(F.col("c_custkey") % 4 == 3, "b").otherwise("a")})
    return V.site_cache(c, now, "c_custkey")


@query("seed_faults", "SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'unknown_organisation' WHEN o_orderkey % 3 = 0 THEN 'bad_hash' WHEN o_orderkey % 3 = 1 THEN 'no_source' END AS fault FROM orders")
def seed_faults(spark, d):
    seeds = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.sha2(F.col("o_orderkey").cast("string"), 256)).otherwise("xyz").alias("content_sha256"), F.when(F.col("o_orderkey") % 3 != 1, "https://x.no").alias("source_url"))
    return V.verify_seeds(seeds, table(spark, d, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("k")), "k").select("o_orderkey", "fault")


@query("repeated_keys", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, d):
    return V.repeated_keys(table(spark, d, "orders"), "o_custkey")


@query("social_corroboration", "SELECT c_custkey, c_custkey % 5 IN (0, 1, 3) AS corroborated FROM customer")
def social_corroboration(spark, d):
    k = F.col("c_custkey")
    name = F.concat(F.lit("Nordlys"), k, F.lit(" Bakeri AS"))
    text = F.when(k % 5 == 0, F.concat(F.lit("Vi er Nordlys"), k, F.lit(" Bakeri, se www.nordlys.no"))).when(k % 5 == 1, F.concat(F.lit("Velkommen til Kafe"), k, F.lit(" - NORDLYS.no"))).when(k % 5 == 2, F.concat(F.lit("Nordlys"), k, F.lit(" Bakeri i byen"))).when(k % 5 == 3, F.concat(F.lit("NORDLYS"), k, F.lit(" bakeri as, Tromsø sentrum"))).otherwise("nordlys.no")
    return table(spark, d, "customer").select("c_custkey", V.corroborated(F.lit("@x"), name, F.concat(F.lit("Kafe"), k), text, F.lit("nordlys.no"), F.lit("Tromsø")).alias("corroborated"))


ROUTES = ["click", "view", "purchase", "signup", "error"]
OUTCOME = "CASE WHEN event_id % 4 = 0 THEN 'accepted' WHEN event_id % 4 = 1 THEN 'abstained' WHEN event_id % 4 = 2 THEN 'blocked' ELSE 'failed' END"
ROUTE_ROWS = f"r AS (SELECT user_id, event_type AS route, list_position(['click','view','purchase','signup','error'], event_type) AS pos, min(event_id) AS event_id FROM events GROUP BY ALL), o AS (SELECT *, {OUTCOME} AS status FROM r), h AS (SELECT user_id, min(pos) FILTER (status = 'accepted') AS first FROM o GROUP BY 1)"


@query("route_waterfall", f"""WITH {ROUTE_ROWS} SELECT h.user_id, max(route) FILTER (pos = first) AS route, max(event_id) FILTER (pos = first) AS value, count(*) FILTER (status = 'abstained' AND (first IS NULL OR pos < first))::INT AS abstained,
count(*) FILTER (status = 'blocked' AND (first IS NULL OR pos < first))::INT AS blocked, count(*) FILTER (status = 'failed' AND (first IS NULL OR pos < first))::INT AS failed FROM h JOIN o ON h.user_id = o.user_id GROUP BY 1""")
def route_waterfall(spark, d):
    r = table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("route")).agg(F.min("event_id").alias("event_id"))
    return V.route_waterfall(r.withColumn("status", F.expr(OUTCOME)).withColumn("value", F.col("event_id")), "user_id", ROUTES)
