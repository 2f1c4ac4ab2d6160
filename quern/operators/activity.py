"""Which news and job candidates of a company become claims, and how requests were spaced and retried."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import urls as U
from .extraction import text_date

#: Fixed address parts and titles that are no news, and prefixes of listing titles.
NEWS_SKIP = ("/career", "/karriere", "/jobb", "/stilling", "/vacanc", "/work-with-us", "/about-us", "/om-oss")
NEWS_TITLES = (
    "nyheter", "aktuelt", "news", "presse", "pressemeldinger", "press releases", "siste nytt", "blogg", "artikler", "our purpose", "about us", "our brand", "our history", "contacting equinor", "ethics helpline",
    "careers in equinor", "contact us about careers", "meet the summer interns", "our summer internship programme",
)
NEWS_PARTS = ("summer internship", "contact us about careers", "ethics helpline", "owner relations", "discover the stories")
NEWS_PREFIXES = ("nyheter ", "aktuelt ", "news ", "presse ")
#: Fixed titles, title parts and address parts that are no single advert.
JOB_TITLES = (
    "vacancies", "offene stellen", "jobb hos oss", "jobbe hos oss", "ledige stillinger", "karriere", "careers", "careers in", "careers in equinor", "work with us", "join our team", "our purpose",
    "contact us about careers", "meet the summer interns", "discover the stories behind the headlines in our magazine", "åpen søknad", "open application",
)
JOB_PARTS = ("our purpose", "discover the stories", "contact us about careers", "meet the summer interns", "ledige stillinger på ", "we are now accepting applications")
JOB_SKIP = ("/about-us", "/magazine", "/careers/contact", "/kontakt", "/om-oss/jobb-hos-oss")
#: Fixed addresses of verified boards, by priority.
BOARDS = {"arbeidsplassen.nav.no/stillinger/stilling/": 2, "linkedin.com/jobs/view/": 1}


def _has(text: Column, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out


def _bare(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), "/+$", "")


def _first(rows: DataFrame, org: str, key: Column) -> DataFrame:
    """The first row of each address: earlier lists before later ones, then by place (partial aggregation)."""
    rest = [c for c in rows.columns if c != org]
    first = F.min_by(F.struct(*rest), F.struct("list", "place")).alias("_r")
    return rows.withColumn("_key", key).groupBy(org, "_key").agg(first).select(org, "_r.*")


def news_items(candidates: DataFrame, sites: DataFrame, pages: DataFrame, org: str) -> DataFrame:
    """candidates: org, list, place, title, url, source, published_at, excerpt, source_url, verification,
    content_sha256; sites: org, site (address), valid; pages: org, url, sha. One row per news item with its
    rank: own site before others, plain titles before listing titles, then newest.

    Undated, career, about and generic entries go, of an address the first stays; an item of the own site takes
    the hash of the crawled page it came from, and goes if it claims a fetched article that no page backs;
    official notices are no news."""
    c = candidates.withColumns({"title": F.trim(F.coalesce("title", F.lit(""))), "url": F.trim(F.coalesce("url", F.lit("")))})
    low, address = F.lower("title"), F.lower("url")
    day = F.coalesce(text_date(F.col("published_at")), text_date(F.col("excerpt")), text_date(F.col("url")))
    c = c.where((F.col("title") != "") & F.col("url").rlike("^https?://") & ~_has(address, NEWS_SKIP) & ~low.isin(*NEWS_TITLES) & ~_has(low, NEWS_PARTS)).withColumn("published_at", day).where("published_at is not null")
    c = _first(c, org, F.lower(_bare(F.col("url")))).join(sites.select(org, "site", "valid"), org, "left")
    dom = lambda x: U.registrable(U.host(x))
    own = F.coalesce(F.col("valid") & (dom(F.col("site")) != "") & (dom(F.col("url")) == dom(F.col("site"))), F.lit(False))
    c = c.withColumn("is_site", own).withColumn("source_url", F.when(F.col("is_site"), F.coalesce("source_url", "site")).otherwise(F.coalesce("source_url", "url")))
    crawled = pages.select(F.col(org), _bare(F.col("url")).alias("_page"), F.col("sha").alias("_sha")).dropDuplicates([org, "_page"])
    c = c.withColumn("_page", _bare(F.col("source_url"))).join(crawled, [org, "_page"], "left")
    backed = ~(F.col("is_site") & F.col("_sha").isNull() & F.coalesce(F.col("verification").isin("article_fetched", "inline_newsroom"), F.lit(False)))
    sha = F.when(F.col("is_site"), F.coalesce("_sha", "content_sha256")).otherwise(F.col("content_sha256"))
    low, address = F.lower("title"), F.lower("url")
    official = F.contains(F.lower(F.coalesce("source", F.lit(""))), F.lit("brreg")) | F.contains(address, F.lit("brreg.no")) | _has(low, ("offisiell registrering", "kunngjøring"))
    c = c.where(backed & ~official).withColumn("content_sha256", sha).where(F.coalesce("content_sha256", F.lit("")) != "")
    plain = F.lit(True)
    for p in NEWS_PREFIXES:
        plain = plain & ~F.startswith(F.lower("title"), F.lit(p))
    w = W.partitionBy(org).orderBy(F.desc("is_site"), F.desc(plain), F.desc("published_at"), "list", "place")
    return c.select(org, "title", "url", "source_url", "published_at", "content_sha256", "is_site", F.row_number().over(w).alias("rank"))


def job_items(candidates: DataFrame, pages: DataFrame, org: str) -> DataFrame:
    """candidates: org, list, place, title, url, published_at, kind, content_sha256, unverified; pages: org, sha.
    One row per advert with its rank: national board, then the other board, then newest. Listing pages and
    unverified leads go, of an address the first stays; what is no verified board's must come from a crawled page."""
    title, url = F.trim(F.replace(F.coalesce("title", F.lit("")), F.lit("\\&"), F.lit("&"))), F.trim(F.coalesce("url", F.lit("")))
    c = candidates.where(~F.coalesce("unverified", F.lit(False))).withColumns({"title": title, "url": url})
    low, address = F.lower("title"), F.lower("url")
    c = c.where((F.col("title") != "") & F.col("url").rlike("^https?://") & ~low.isin(*JOB_TITLES) & ~_has(low, JOB_PARTS) & ~_has(address, JOB_SKIP))
    c = _first(c, org, F.lower(_bare(F.col("url"))))
    priority = F.lit(0)
    for part, p in BOARDS.items():
        priority = F.greatest(priority, F.when(F.contains(F.lower("url"), F.lit(part)), p).otherwise(0))
    c = c.withColumn("priority", priority).withColumn("_board", (F.col("priority") > 0) | F.coalesce(F.col("kind") == "verified_career_ad", F.lit(False)))
    crawled = pages.select(org, F.col("sha").alias("content_sha256"), F.lit(True).alias("_page")).distinct()
    c = c.join(crawled, [org, "content_sha256"], "left").where((F.coalesce("content_sha256", F.lit("")) != "") & (F.col("_board") | F.col("_page")))
    day = F.coalesce(text_date(F.col("published_at")), F.col("published_at"))
    c = c.withColumn("published_at", day)
    w = W.partitionBy(org).orderBy(F.desc("priority"), F.desc_nulls_last("published_at"), "list", "place")
    return c.select(org, "title", "url", "published_at", "content_sha256", "priority", F.row_number().over(w).alias("rank"))


def hiring_status(verdicts: DataFrame, jobs: DataFrame, org: str, career: str = "career_url") -> DataFrame:
    """verdicts: org, status, career_url; the status follows the number of verified adverts."""
    n = jobs.groupBy(org).agg(F.count("*").alias("open_jobs"))
    d = verdicts.join(n, org, "left").fillna(0, ["open_jobs"])
    calm = F.when(F.col(career).isNotNull(), "recruitment_page_present").otherwise("unknown")
    status = F.when(F.col("open_jobs") > 0, "actively_recruiting").when(F.col("status") == "actively_recruiting", calm).otherwise(F.col("status"))
    return d.withColumn("status", status)


def spaced_starts(requests: DataFrame, lane: str, order: list[str], at: str, gap: float = 2.1) -> DataFrame:
    """Earliest start of each request of a lane, `gap` seconds after the one before. The i-th start is the
    greatest over earlier requests j of arrival j plus (i - j) gaps, so one running maximum gives it."""
    w = W.partitionBy(lane).orderBy(*order)
    d = requests.withColumn("_i", F.row_number().over(w))
    lead = F.max(F.col(at) - F.col("_i") * F.lit(gap)).over(w.rowsBetween(W.unboundedPreceding, 0))
    return d.withColumn("start", lead + F.col("_i") * F.lit(gap)).drop("_i")


#: Fixed limits of retries: tries, seconds before the next one, bounds of a stated wait.
TRIES, PAUSE, LEAST_WAIT, MOST_WAIT = 3, 0.4, 1.0, 15.0


def fetch_outcomes(tries: DataFrame, url: str) -> DataFrame:
    """tries: url, attempt (from 0), status (0: network error), retry_after, fatal (name or certificate error).
    One row a url: the try that ends it, requests made and seconds waited. 200, 404 and 410 end it; 429 waits as
    told; 5xx and network errors wait a little; anything else, or the last try, ends it as failed."""
    s, n = F.col("status"), F.col("attempt")
    again = (n + 1 < TRIES) & ((s == 429) | ((s >= 500) & (s < 600)) | ((s == 0) & ~F.coalesce("fatal", F.lit(False))))
    told = F.when(F.col("retry_after").isNotNull(), F.least(F.greatest(F.col("retry_after"), F.lit(LEAST_WAIT)), F.lit(MOST_WAIT)))
    wait = F.when(~again, 0.0).when(s == 429, F.coalesce(told, F.least(F.lit(2.0) * F.pow(F.lit(2.0), n), F.lit(MOST_WAIT)))).otherwise(F.lit(PAUSE) * F.pow(F.lit(2.0), n))
    w = W.partitionBy(url).orderBy("attempt").rowsBetween(W.unboundedPreceding, -1)  # TRIES rows at most count
    d = tries.where(n < TRIES).withColumns({"_again": again, "_wait": wait}).withColumn("_live", F.coalesce(F.min(F.col("_again").cast("int")).over(w), F.lit(1)) == 1).where("_live")
    g = d.groupBy(url).agg(F.max_by("status", "attempt").alias("last"), F.count("*").alias("requests"), F.round(F.sum("_wait"), 3).alias("waited"))
    return g.select(url, F.when(F.col("last").isin(200, 404, 410), F.col("last")).otherwise(0).alias("status"), "requests", "waited")


def site_cache(verified: DataFrame, current: DataFrame, org: str) -> DataFrame:
    """verified: org, url, sha of sites proven before; current: org, url, sha as fetched now. A cached site is
    only taken up again after it was fetched and proven anew; it never stands on its own."""
    j = verified.select(org, F.col("url").alias("cached_url"), F.col("sha").alias("cached_sha")).join(current.select(org, "url", "sha"), org, "left")
    state = F.when(F.col("url").isNull(), "to_revalidate").when(U.host(F.col("url")) != U.host(F.col("cached_url")), "moved").when(F.col("sha") == F.col("cached_sha"), "unchanged").otherwise("changed")
    return j.select(org, "cached_url", state.alias("state"))


def verify_seeds(seeds: DataFrame, registry: DataFrame, org: str) -> DataFrame:
    """Manual seeds with the first fault of each: an organisation that the registry doesn't have, a hash that is none, no source."""
    known = registry.select(org).distinct().withColumn("_known", F.lit(True))
    fault = F.when(F.col("_known").isNull(), "unknown_organisation").when(~F.coalesce(F.col("content_sha256").rlike("^[0-9a-fA-F]{64}$"), F.lit(False)), "bad_hash").when(~F.coalesce(F.col("source_url").rlike("^https?://"), F.lit(False)), "no_source")
    return seeds.join(known, org, "left").withColumn("fault", fault).drop("_known")


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n): keys that more than one row has."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def corroborated(handle: Column, name: Column, alias: Column, text: Column, domain: Column, town: Column) -> Column:
    """True for a profile whose text has the core name or alias with the company's domain, or the whole name with its town."""
    from ..functions import text as T

    t = T.tokens(text, keep_legal=True, min_length=1)
    has = lambda n, **k: (F.size(T.tokens(n, **k)) > 0) & T.contains_sequence(t, T.tokens(n, **k))
    core = has(name, min_length=1) | F.coalesce(has(alias, min_length=1), F.lit(False))
    shown = F.coalesce((domain != "") & F.contains(F.lower(F.concat_ws(" ", text, handle)), F.lower(domain)), F.lit(False))
    return (core & shown) | (has(name, keep_legal=True, min_length=1) & F.coalesce(has(town, keep_legal=True, min_length=1), F.lit(False)))


#: Fixed canonical order of the strategy routes' outcomes: an earlier one that is accepted ends the search.
def route_waterfall(outcomes: DataFrame, org: str, routes: list[str]) -> DataFrame:
    """outcomes: org, route, status (accepted, abstained, blocked, failed), value. Routes run in canonical order;
    a blocked or failed one does not stop the next. One row per org: the first accepted route with its value, and how the
    routes before it ended."""
    order = F.array_position(F.array(*(F.lit(r) for r in routes)), F.col("route"))
    d = outcomes.withColumn("_at", order).where("_at > 0")
    hit = F.min(F.when(F.col("status") == "accepted", F.struct("_at", "route", "value")))
    g = d.groupBy(org).agg(hit.alias("h"), F.array_sort(F.collect_list(F.struct("_at", "status"))).alias("s"))  # a row a route at most
    before = F.filter("s", lambda x: F.col("h").isNull() | (x["_at"] < F.col("h._at")))
    count = lambda status: F.size(F.filter(before, lambda x: x["status"] == status))
    return g.select(org, "h.route", "h.value", *(count(x).alias(x) for x in ("abstained", "blocked", "failed")))
