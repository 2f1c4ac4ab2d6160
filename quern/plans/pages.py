"""Queries of page trees over the pages table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pages as G
from ..sources.tables import table
from .catalogue import query

#: DuckDB: text of a piece of html without tags, entities decoded, blanks single.
PLAIN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g'))"
#: A page's answer: the table has no failed fetches, so that some ids get one.
CODES = "CASE WHEN page_id % 11 = 3 THEN 404 WHEN page_id % 13 = 5 THEN 503 ELSE 200 END"


@query("page_events", f"""SELECT page_id, url, CASE WHEN page_id % 11 = 3 THEN 'not_found' WHEN page_id % 13 = 5 OR page_id % 17 = 9 THEN 'source_error' ELSE 'available' END AS status,
 {PLAIN.format("regexp_extract(h, '<title>(.*?)</title>', 1)")} AS title, '' AS description,
 md5({PLAIN.format("regexp_extract(h, '(?s)<article>(.*)</article>', 1)")}) AS main_md5, {PLAIN.format("regexp_extract(h, '(?s)<footer>(.*)</footer>', 1)")} AS identity_text,
 CASE WHEN page_id % 11 <> 3 AND page_id % 13 <> 5 AND page_id % 17 <> 9 THEN 'static_complete' END AS extraction_state
FROM (SELECT *, CASE WHEN page_id % 11 = 3 OR page_id % 13 = 5 OR page_id % 17 = 9 THEN '' ELSE html END AS h FROM pages)""")
def page_events(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url", "html", F.expr(CODES).alias("status_code"), F.expr("CASE WHEN page_id % 17 = 9 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END").alias("content_type"))
    return G.page_events(pages, "page_id").withColumn("main_md5", F.md5(F.trim(F.regexp_replace("main_text", r"\s+", " ")))).drop("main_text")


#: News pages made of the titles of ten pages each, with dates of four kinds; the last has none.
HUB = """concat('<article class="post"><h2>', title, '</h2><p>Sak ', page_id, ' <a href="', CASE page_id % 5 WHEN 2 THEN concat('/2024/0', 1 + page_id % 9, '/sak-', page_id) WHEN 3 THEN concat('https://elsewhere.org/', page_id) ELSE concat('sak/../sak-', page_id) END, '">Mer</a>',
 CASE page_id % 5 WHEN 0 THEN concat('<time datetime="2024-03-0', 1 + page_id % 9, '">i dag</time>') WHEN 1 THEN concat('publisert ', 10 + page_id % 9, '. mars 2023') WHEN 3 THEN '1.1.2024' ELSE '' END, '</article>')"""
CARD = """concat('<div class="job-card"><h3>', CASE WHEN page_id % 4 = 0 THEN 'Ledige stillinger' ELSE title END, '</h3><a href="', CASE WHEN page_id % 4 = 1 THEN '/kontakt' ELSE concat('/ad/', page_id % 3) END, '#x">Apply</a><p>Frist ', 1 + page_id % 9, '.5.2024</div>')"""
MADE = "regexp_extract(html, '<title>(.*?)</title>', 1)"
HUBS = f"""t AS (SELECT page_id, page_id // 10 AS hub, {PLAIN.format(MADE)} AS title FROM pages)"""


def _hubs(spark, d, item: str, folder: str):
    pages = table(spark, d, "pages").select("page_id", F.expr("page_id div 10").alias("hub"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", F.expr(item).alias("item")))), lambda x: x["item"]), "\n")
    return pages.groupBy("hub").agg(body.alias("body")).select("hub", F.expr(f"concat('https://www.firma', hub, '.no/{folder}/')").alias("url"), F.concat(F.lit("<html><body><nav><a href='/x'>Meny</a></nav><main>"), "body", F.lit("</main>")).alias("html"))


@query("listed_news", f"""WITH {HUBS}, i AS (SELECT hub, page_id, title, 'https://www.firma' || hub || '.no/' || CASE page_id % 5 WHEN 2 THEN '2024/0' || (1 + page_id % 9) || '/sak-' || page_id ELSE 'aktuelt/sak-' || page_id END AS url,
 CASE page_id % 5 WHEN 0 THEN '2024-03-0' || (1 + page_id % 9) WHEN 1 THEN '2023-03-' || (10 + page_id % 9) WHEN 2 THEN '2024-0' || (1 + page_id % 9) || '-01' END AS published_at FROM t WHERE page_id % 5 < 3 AND length(title) BETWEEN 8 AND 200 AND NOT regexp_matches(lower(title), '{"|".join(G.NOT_NEWS)}')),
 f AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY hub, lower(title) ORDER BY page_id) = 1)
 SELECT hub, (row_number() OVER (PARTITION BY hub ORDER BY page_id) - 1)::INT AS place, title, url, published_at FROM f""")
def listed_news(spark, d):
    return G.listed_news(_hubs(spark, d, HUB, "aktuelt"), "hub").drop("excerpt")


@query("listed_jobs", f"""WITH {HUBS}, i AS (SELECT hub, page_id, title, 'https://www.firma' || hub || '.no/ad/' || page_id % 3 || '#x' AS url, '2024-05-0' || (1 + page_id % 9) AS published_at FROM t
 WHERE page_id % 4 > 1 AND length(title) BETWEEN 5 AND 150 AND NOT regexp_matches(lower(title), '{"|".join(G.NOT_JOBS)}')), f AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY hub, url ORDER BY page_id) = 1)
 SELECT hub, (row_number() OVER (PARTITION BY hub ORDER BY page_id) - 1)::INT AS place, title, url, published_at FROM f""")
def listed_jobs(spark, d):
    return G.listed_jobs(_hubs(spark, d, CARD, "karriere"), "hub").drop("excerpt")


@query("linked_pages", """SELECT page_id, count(*) AS n_links, sum(length(regexp_replace(x, '<[^>]*>', '', 'g')))::BIGINT AS linked_chars FROM (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href="[^"]*">[^<]*</a>')) AS x FROM pages) GROUP BY page_id""")
def linked_pages(spark, d):
    """Navigation of every page by its tree: links and their text, entities as one character where they occur."""
    tree = F.col("tree")
    rows = G.trees(table(spark, d, "pages").select("page_id", "html")).select("page_id", F.explode(F.filter(tree, lambda x: (x["tag"] == "#text") & x["aside"] & x["link"].isNotNull())).alias("x"))
    return rows.groupBy("page_id").agg(F.countDistinct("x.link").alias("n_links"), F.sum(F.length("x.text")).alias("linked_chars"))
