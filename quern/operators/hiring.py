"""Recruitment signals, vacancy matching, workforce phrases, roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T, urls as U

#: Fixed recruitment phrases.
PHRASES = (
    r"\bledige?\s+stilling(?:er)?\b", r"\bbli\s+med\s+p[åa]\s+(?:v[åa]rt\s+)?(?:team|laget)\b", r"\bkarriere\s+hos\s+oss\b", r"\bwe(?:'re|\s+are)\s+hiring\b", r"\bopen\s+positions?\b",
    r"\bjoin\s+our\s+team\b", r"\bjobb\s+hos\s+oss\b", r"\bjobbe\s+hos\s+oss\b", r"\bny(?:e)?\s+medarbeidere?\b",
)
CAREER = r"(?i)(?:^|/)(?:karriere|careers?|jobs?|jobb|jobber|jobbe?-hos-oss|vacancies|stillinger?|ledige?-stillinger?|work-with-us)(?:/|$)"
BEFORE, AFTER = 35, 65
#: Fixed workforce phrases by priority; the number is the first group.
WORKFORCE = (r"(?i)antall årsverk[^0-9]{0,40}([0-9][0-9 .,]*)", r"(?i)([0-9][0-9 .,]*) årsverk", r"(?i)([0-9][0-9 .,]*) (?:ansatte|employees)")
#: Fixed role codes.
CHAIR, CEO, BOARD = ("LEDE",), ("DAGL",), ("MEDL", "NEST")


def signals(pages: DataFrame, key: str) -> DataFrame:
    """rows: key, url, title, text. Career pages with the phrase and its span;
    the text counts on career paths only, titles count everywhere."""
    d = pages.withColumn("_s", F.concat_ws("\n", "title", F.when(U.path(F.col("url")).rlike(CAREER), F.col("text"))))
    at = F.coalesce(*(F.nullif(F.regexp_instr("_s", F.lit("(?i)" + p)), F.lit(0)) for p in PHRASES))
    hit = F.coalesce(*(F.nullif(F.regexp_extract("_s", "(?i)" + p, 0), F.lit("")) for p in PHRASES))
    d = d.withColumns({"_at": at, "_hit": hit}).where(F.col("_at").isNotNull() & F.col("url").rlike("^https?://"))
    begin = F.greatest(F.lit(1), F.col("_at") - BEFORE)
    span = F.trim(F.substr("_s", begin, F.col("_at") - begin + F.length("_hit") + AFTER))
    return d.select(key, "url", span.alias("claim_span"))


def assessment(entities: DataFrame, signal_rows: DataFrame, jobs: DataFrame, key: str) -> DataFrame:
    """actively_recruiting, recruitment_page_present or unknown per entity."""
    s = signal_rows.groupBy(key).agg(F.count("*").alias("pages"))
    j = jobs.groupBy(key).agg(F.count("*").alias("open_jobs"))
    out = entities.select(key).join(s, key, "left").join(j, key, "left").fillna(0, ["pages", "open_jobs"])
    return out.withColumn("status", F.when(F.col("open_jobs") > 0, "actively_recruiting").when(F.col("pages") > 0, "recruitment_page_present").otherwise("unknown"))


def core_name(name: Column) -> Column:
    return F.array_join(T.tokens(name, min_length=1), " ")


def match_vacancies(ads: DataFrame, companies: DataFrame, subunits: DataFrame, today: Column) -> DataFrame:
    """ads: ad_id, org, employer, expires. Organisation number first, then a
    registered subunit's number, then the strict core name, and that only if
    the ad has no number and the name is one company's alone. Last ad per id."""
    last = ads.groupBy("ad_id").agg(F.max_by(F.struct("org", "employer", "expires"), F.struct(F.coalesce("expires", F.lit("9999").cast("date")), "employer")).alias("r")).select("ad_id", "r.*")
    last = last.where(F.col("expires").isNull() | (F.col("expires") >= today)).withColumn("_core", F.when(F.col("org").isNull(), core_name(F.col("employer"))))
    names = companies.select(core_name(F.col("name")).alias("_core"), F.col("org").alias("by_name")).groupBy("_core").agg(F.min("by_name").alias("by_name"), F.count("*").alias("_n")).where("_n = 1 AND _core <> ''").drop("_n")
    j = last.join(companies.select("org", F.col("org").alias("by_org")), "org", "left").join(subunits.select(F.col("subunit").alias("org"), F.col("org").alias("by_unit")), "org", "left").join(names, "_core", "left")
    kind = F.when(F.col("by_org").isNotNull(), "organisation").when(F.col("by_unit").isNotNull(), "subunit").when(F.col("by_name").isNotNull(), "name").otherwise("rejected")
    return j.select("ad_id", kind.alias("match_type"), F.coalesce("by_org", "by_unit", "by_name").alias("company"))


def workforce(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One number per key by the first phrase that any line has; lines about the
    group are passed over, two different numbers give none."""
    lines = texts.select(key, F.explode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("l")).where(~F.lower("l").rlike("konsern|group"))
    found = F.array(*(F.struct(F.lit(i).alias("p"), F.regexp_extract_all("l", F.lit(p), F.lit(1)).alias("v")) for i, p in enumerate(WORKFORCE)))
    rows = lines.select(key, F.explode(found).alias("f")).select(key, "f.p", F.explode("f.v").alias("v")).withColumn("n", T.number_nb(F.regexp_replace("v", r"[ .,]+$", ""))).where("n is not null")
    per = rows.groupBy(key, "p").agg(F.countDistinct("n").alias("_k"), F.min("n").alias("_n"))
    best = per.groupBy(key).agg(F.min_by(F.struct("_k", "_n"), "p").alias("b"))
    return best.select(key, F.when(F.col("b._k") == 1, F.col("b._n")).alias("workforce"))


def roles(groups: Column) -> Column:
    """groups: array<struct<group, changed, roles: array<struct<code, name,
    inactive>>>>. First active chair and chief, sorted distinct board."""
    every = F.filter(F.flatten(F.transform(groups, lambda g: g["roles"])), lambda r: ~F.coalesce(r["inactive"], F.lit(False)) & (F.coalesce(r["name"], F.lit("")) != ""))
    of = lambda codes: F.transform(F.filter(every, lambda r: F.upper(r["code"]).isin(*codes)), lambda r: r["name"])
    return F.struct(F.try_element_at(of(CHAIR), F.lit(1)).alias("chair"), F.try_element_at(of(CEO), F.lit(1)).alias("ceo"), F.array_sort(F.array_distinct(of(BOARD))).alias("board"))


def link_priority(links: DataFrame, page: str, url: str, score: Column, kind: Column, top: int = 4) -> DataFrame:
    """Least score per url and class, then the first few of each class."""
    from pyspark.sql import Window as W

    d = links.withColumns({"score": score, "kind": kind}).where("kind is not null").groupBy(page, "kind", url).agg(F.min("score").alias("score"))
    w = W.partitionBy(page, "kind").orderBy("score", url)
    return d.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)
