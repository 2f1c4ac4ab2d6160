"""Identity ladders, vetoes, search and news credibility as Column rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..functions.urls import host, path

#: Fixed marks of parked or placeholder pages (folded, like the text, before they are compared).
PARKED = (
    "domain is for sale", "domain for sale", "hugedomains", "parked at", "miss hosting", "her flytter snart en ny gjest", "has been informing visitors",
    "find the best information and most relevant links on all topics related to", "buy this domain", "kjøp dette domenet", "domenet er til salgs", "this domain is parked",
    "under construction / sedo", "sedo domain parking", "domeneshop parkering", "parkert hos domeneshop", "dan.com", "the sponsored listings displayed above", "related searches",
    "is parked free", "velkommen til vårt nye nettsted", "siden er under konstruksjon",
)
LOGIN = ("error=true", "login_required", "/login", "/logg-inn")
#: Fixed words that names are compared without, geographic words, words of an industry.
LEGAL_AND_GENERIC = ("as", "asa", "ans", "da", "enk", "iks", "sa", "sam", "sti", "stiftelsen", "nuf", "ab", "b", "v", "limited", "ltd", "inc", "plc", "the", "og", "and")
GEOGRAPHIC = ("norway", "norge", "nordic", "scandinavia", "norden")
INDUSTRY = ("forsikring", "holding", "invest", "eiendom", "gruppen", "consulting", "drift", "bygg", "service", "regnskap", "advokat", "revisjon", "transport", "teknologi", "utvikling", "partner", "handel", "salg", "industri")
#: Fixed housing managers and the forms of co-operatives they serve.
HOUSING, CO_OPERATIVES = ("bori", "obos", "usbl", "tobb", "vestbo", "bonord", "nobl", "kobbl", "gbl", "sobo", "bbl"), ("SAM", "BRL", "BOL", "BA", "SA", "ESEK")
#: Fixed words of a group of companies, and phrases that say so.
GROUP_WORDS, GROUP_PHRASES = ("holding", "group", "gruppen", "konsern", "morforetak"), ("del av konsernet", "konsernselskap", "et selskap i", "a subsidiary of")
#: Fixed publisher lists (domains).
TRUSTED = (
    "nrk.no", "tv2.no", "vg.no", "dagbladet.no", "aftenposten.no", "dagsavisen.no", "klassekampen.no", "morgenbladet.no", "nettavisen.no",
    "dn.no", "e24.no", "finansavisen.no", "kapital.no", "borsen.no",
    "shifter.no", "tek.no", "digi.no", "tu.no", "computerworld.no", "kyst.no", "intrafish.no", "bygg.no", "at.no",
    "bt.no", "adressa.no", "aftenbladet.no", "fvn.no", "nordlys.no", "an.no", "itromso.no", "ba.no", "ta.no", "sb.no", "rbnett.no", "romsdals-budstikke.no", "smp.no", "firda.no", "firdaposten.no",
    "fjordingen.no", "fjt.no", "h-avis.no", "ha-halden.no", "moss-avis.no", "op.no", "oa.no", "gd.no", "dt.no", "tb.no", "varden.no", "pd.no", "nyss.no", "telemarkavisa.no", "lofotposten.no", "vol.no", "fremo.no",
    "sunnmoringen.no", "morenytt.no", "driva.no", "auraavis.no",
    "ntb.no", "kommunikasjon.ntb.no", "mynewsdesk.com", "cision.com", "cision.no", "reuters.com", "bloomberg.com", "apnews.com", "regjeringen.no", "ssb.no", "brreg.no", "toll.no", "skatteetaten.no",
)
BLACKLIST = (
    "medium.com", "blogspot.com", "wordpress.com", "tumblr.com", "substack.com", "wixsite.com", "weebly.com", "squarespace.com", "hubpages.com", "buzzfeed.com",
    "dailymail.co.uk", "thesun.co.uk", "nationalenquirer.com",
    "rt.com", "sputniknews.com", "globalresearch.ca", "infowars.com", "naturalnews.com", "breitbart.com", "beforeitsnews.com", "newspunch.com", "thegatewaypundit.com", "zerohedge.com",
)
#: Fixed media brands that a publisher's name may contain.
BRANDS = ("nrk", "tv2", "vg", "dn", "e24", "aftenposten")
#: Fixed weights of the entity factors.
WEIGHTS = {"orgnr": 0.40, "name": 0.30, "domain": 0.20, "address": 0.10}
#: Fixed first path steps of a social platform's own pages.
PLATFORM_PAGES = ("share", "sharer", "sharer.php", "intent", "tweet", "login", "home", "policies", "privacy", "terms", "help", "about", "search", "explore", "watch", "feed", "groups", "hashtag", "pages", "events", "jobs")


def any_in(text: Column, marks) -> Column:
    """True if the text has any of the marks (one pass of one pattern)."""
    return text.rlike("|".join(re.escape(m) for m in marks))


def _words(col: Column) -> Column:
    return T.tokens(col, drop=LEGAL_AND_GENERIC)


def _subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once: a generator stands between them and
    what uses them, over which the optimiser does not write them out again."""
    return df.select("*", F.explode(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))).alias("_o")).select(*(F.col(f"`{c}`") for c in df.columns), *(F.col(f"_o.{k}").alias(k) for k in columns))


OPTIONAL = ("description", "identity_text", "legal_form", "email", "careof")


def website_ladder(rows: DataFrame) -> DataFrame:
    """rows: name, organisation_number, url (where the page was found), title, text and
    declared_host (of the registry's homepage); optionally description, identity_text
    (footers), legal_form and trademarks (array). Adds matched, ratio, score, status,
    publishable, relationship and other_entities: the score of the first rule that holds; a page that shows other
    nine-digit numbers and not the company's own scores 0."""
    given = rows.columns
    for c in OPTIONAL:
        if c not in given:
            rows = rows.withColumn(c, F.lit(""))
    if "trademarks" not in given:
        rows = rows.withColumn("trademarks", F.array().cast("array<string>"))
    # a rule's row costs far more time than its bytes suggest: files are too few tasks
    rows = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism * 4, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    site = F.regexp_replace(host(F.col("url")), r"^www\.", "")
    home = F.concat_ws(" ", "title", "description", "identity_text", site)
    page = F.concat_ws(" ", home, "text")
    d = _once(rows, {"_site": site, "_home": F.concat_ws(" ", home, "text"), "_page": page})
    d = _once(d, {
        "_core": F.array_distinct(_words(F.col("name"))), "_seen": F.array_distinct(_words(F.col("_page"))), "_low": T.folded(F.col("_page")),
        "_parts": F.array(*(F.array_distinct(_words(F.col(c))) for c in ("title", "description", "identity_text", "_site"))),
        "_digits": F.regexp_replace("_page", "[^0-9]", ""), "_numbers": T.org_numbers(F.col("_page")),
        "_sld": F.regexp_replace(F.element_at(F.split("_site", r"\."), 1), "[^a-z0-9]", ""), "_entities": T.legal_mentions(F.col("_page")),
        "_marks": F.transform("trademarks", lambda t: _words(t)),
    })
    core, seen, parts, sld = F.col("_core"), F.col("_seen"), F.col("_parts"), F.col("_sld")
    brand = F.filter(core, lambda w: ~w.isin(*INDUSTRY, *GEOGRAPHIC))
    together = F.array_distinct(F.flatten(parts))
    whole = lambda words: F.exists(parts, lambda p: _subset(words, p))
    compact = F.array_join(core, "")
    n = F.size(core)
    exact_name = (n > 0) & (whole(core) | ((n >= 2) & _subset(core, together)))
    entity = F.array_join(_words(F.col("name")), " ")
    trademark = F.exists("_marks", lambda m: (F.size(m) > 0) & (((sld == F.array_join(m, "")) & whole(m)) | ((F.length(F.array_join(m, "")) >= 4) & F.contains(sld, F.array_join(m, "")) & (_subset(m, together) | F.contains(F.col("_digits"), F.col("organisation_number"))))))
    d = _once(d, {
        "matched": F.size(F.array_intersect(core, seen)), "_n": n, "_compact": compact, "_brand": brand, "_exact": exact_name, "_trademark": trademark, "other_entities": F.array_remove("_entities", entity),
        "_substantive": (F.length(F.trim(F.coalesce("text", F.lit("")))) >= 50) | (F.length(F.trim(F.coalesce("title", F.lit("")))) >= 15), "_declared": (F.coalesce("declared_host", F.lit("")) != "") & (F.col("declared_host") == F.col("_site")),
        "_club": F.col("name").rlike(r"(?i)(?:^|\s)B\.?\s*I\.?\s*L\.?(?:\s|$)") & ~F.contains("_low", F.lit("bedriftsidrett")) & ~F.contains(F.array_join(seen, " "), F.lit("b i l")),
        "_housing": any_in(F.col("_site"), HOUSING) | any_in(F.coalesce("declared_host", F.lit("")), HOUSING), "_coop": F.upper(F.coalesce("legal_form", F.lit(""))).isin(*CO_OPERATIVES),
        "_own": F.contains(F.col("_digits"), F.col("organisation_number")) & (F.col("organisation_number") != ""), "_parked": any_in(F.col("_low"), [m.replace("ø", "o").replace("å", "a") for m in PARKED]), "_login": any_in(F.lower("url"), LOGIN),
        "_acronym": F.when(n >= 3, F.array_join(F.transform(core, lambda w: F.substring(w, 1, 1)), "")).otherwise(""), "_brand_site": (F.size(brand) > 0) & (F.size(brand) < n) & (sld == F.array_join(brand, "")) & whole(brand),
        "_acronym_site": _subset(core, seen),
    })
    c = F.col
    ratio = F.when(c("_n") > 0, c("matched") / c("_n")).otherwise(0.0)
    same = (c("_sld") == c("_compact")) & (c("_compact") != "")
    alone = F.size("other_entities") == 0
    foreign = (F.size("_numbers") > 0) & ~F.array_contains("_numbers", c("organisation_number")) & c("organisation_number").rlike("^[0-9]{9}$")
    ladder = [
        (c("_parked"), 0.1), (c("_login"), 0.2), (c("_club"), 0.3), (c("_own"), 1.0), (c("_trademark") & c("_substantive"), 0.95), ((c("_n") >= 2) & c("_exact"), 0.95),
        (c("_declared") & c("_substantive") & (c("_n") >= 2) & (ratio >= 0.99), 0.95), (c("_declared") & (c("_n") == 1) & same & c("_substantive"), 0.94),
        ((c("_n") == 1) & c("_exact") & c("_substantive") & alone, 0.95), ((c("_n") == 1) & c("_exact") & c("_substantive") & ~alone, 0.75), (c("_declared") & (c("_n") >= 2) & same, 0.94),
        (c("_declared") & c("_substantive") & c("_brand_site"), 0.93), (c("_declared") & c("_substantive") & (c("_n") >= 3) & (c("_sld") == c("_acronym")) & c("_acronym_site"), 0.93),
        (c("_coop") & c("_housing") & c("_declared") & c("_substantive") & ~F.contains("_site", F.lit("minside.")), 0.91),
        ((ratio >= 0.75) & (c("matched") >= 2), 0.85), ((ratio >= 0.5) & (c("matched") >= 2), 0.65),
    ]
    score = F.when(foreign, 0.0)
    for rule, value in ladder:
        score = score.when(rule, value)
    d = d.withColumn("ratio", ratio).withColumn("score", score.otherwise(0.3))
    group = any_in(c("_low"), GROUP_PHRASES) | (any_in(c("_low"), GROUP_WORDS) & F.arrays_overlap(F.flatten(F.transform("other_entities", lambda e: F.split(e, " "))), F.when(F.size("_brand") > 0, c("_brand")).otherwise(c("_core"))))
    housing = c("_coop") & c("_housing")
    relationship = (
        F.when(c("score") == 0.0, "unrelated_or_confuser").when((c("score") >= 0.9) & housing, "housing_management_portal").when(c("score") >= 0.9, "exact_legal_entity").when(group, "corporate_group_parent").when(housing, "housing_management_portal")
        .when(c("_exact") & ~alone, "public_brand_or_related_entity").when(~alone & (c("score") < 0.5), "unrelated_or_confuser").otherwise("ambiguous_or_unproven")
    )
    d = d.withColumn("status", F.when(c("score") >= 0.9, "exact").when(c("score") >= 0.8, "review").otherwise("related_or_uncertain"))
    return d.select(*given, "matched", "ratio", "score", "status", (c("status") == "exact").alias("publishable"), relationship.alias("relationship"), "other_entities")


def website_gate(assessed: DataFrame) -> DataFrame:
    """The ladder's verdict with the veto of a relationship that is another company's."""
    veto = F.col("relationship").isin("corporate_group_parent", "public_brand_or_related_entity", "unrelated_or_confuser")
    return assessed.withColumn("publishable", F.col("publishable") & ~veto)


def social_handle(rows: DataFrame) -> DataFrame:
    """rows: name, url (a social profile), website, optionally trademarks. Adds handle_score and handle_publishable."""
    given = rows.columns
    if "trademarks" not in given:
        rows = rows.withColumn("trademarks", F.array().cast("array<string>"))
    steps = F.filter(F.split(path(F.col("url")), "/"), lambda x: x != "")
    handle = F.array_join(_words(F.try_url_decode(F.array_join(steps, "/"))), "")
    web = F.when(F.contains(host(F.col("website")), F.lit(".")), F.element_at(F.split(host(F.col("website")), r"\."), 1)).otherwise(host(F.col("website")))
    d = _once(rows, {"_core": _words(F.col("name")), "_handle": F.coalesce(handle, F.lit("")), "_first": F.lower(F.coalesce(F.try_element_at(steps, F.lit(1)), F.lit(""))), "_web": F.coalesce(web, F.lit("")), "_tm": F.transform("trademarks", lambda t: F.array_join(_words(t), ""))})
    h, core = F.col("_handle"), F.col("_core")
    hit = F.filter(core, lambda w: F.contains(h, w))
    brand = F.filter(core, lambda w: ~w.isin(*INDUSTRY) & (F.length(w) >= 4))
    distinct, ratio = F.size(F.array_distinct(hit)), F.when(F.size(core) > 0, F.size(F.array_distinct(hit)) / F.size(F.array_distinct(core))).otherwise(0.0)
    domain = (F.length("_web") >= 3) & ~F.col("_web").isin(*INDUSTRY, *LEGAL_AND_GENERIC) & F.contains(h, F.col("_web"))
    score = (
        F.when(F.col("_first").isin(*PLATFORM_PAGES) | (h == ""), 0.1).when((F.size(core) > 0) & F.contains(h, F.array_join(core, "")), 0.98).when(F.exists("_tm", lambda t: (F.length(t) >= 4) & F.contains(h, t)), 0.96)
        .when((F.size(core) == 1) & (distinct > 0), 0.95).when(domain, 0.95).when(~F.exists(core, lambda w: w.isin(*GEOGRAPHIC)) & (F.size(brand) > 0) & F.forall(brand, lambda w: F.contains(h, w)), 0.94)
        .when((ratio >= 0.75) & (distinct >= 2), 0.9).otherwise(0.3)
    )
    return d.withColumn("handle_score", score).select(*given, "handle_score", (F.col("handle_score") >= 0.9).alias("handle_publishable"))


def social_gate(links: DataFrame, sites: DataFrame, key: str) -> DataFrame:
    """Social links of assessed sites: published only where both the site and the handle may be; the others are quarantined."""
    j = social_handle(links).join(sites.select(key, F.col("publishable").alias("_site")), key, "left")
    return j.withColumn("quarantined", ~(F.coalesce("_site", F.lit(False)) & F.col("handle_publishable"))).drop("_site")


def gate_counts(assessed: DataFrame) -> DataFrame:
    """How many stored profiles end in each status and relationship when gated again."""
    return website_gate(assessed).groupBy("status", "relationship").agg(F.count("*").alias("profiles"), F.count_if("publishable").alias("publishable"))


#: Fixed declaration of an operator on a legal page, and the paths of such pages.
OPERATOR = r"(?im)^[ \t-]*([^\W\d_][\w.'& -]{0,95}?\s+(?:AS|ASA|AB|LTD|LIMITED|INC\.?))\s*\([^\n)]{0,100}\b(?:we|our|us|vi|oss)\b[^\n)]{0,100}\)\s+(?:operates|provides|driver|drifter)\b[^\n.]*"
LEGAL_PAGE = r"(?i)(?:^|/)(?:privacy|personvern|terms|vilkår|vilkar|legal)(?:[-./]|$)"


def operator_conflict(pages: DataFrame, key: str) -> DataFrame:
    """pages: key, name, site (the homepage's address), url, text, content_sha256. (key, operator, source_url,
    claim_span) of another company that declares itself the operator on one of the site's own legal pages."""
    plain = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    own = pages.where((host(F.col("url")) == host(F.col("site"))) & (host(F.col("site")) != "") & path(F.col("url")).rlike(LEGAL_PAGE) & F.col("content_sha256").rlike("^[a-fA-F0-9]{64}$"))
    pattern = OPERATOR.replace(r"\w", r"[\p{L}\p{N}_]").replace("[^\\W\\d_]", r"\p{L}").replace(r"[[\p{L}\p{N}_].'& -]", r"[\p{L}\p{N}_.'& -]")
    spans = F.regexp_extract_all("text", F.lit("(" + pattern + ")"), F.lit(1))
    names = F.regexp_extract_all("text", F.lit(pattern), F.lit(1))
    rows = own.select(key, "name", "url", F.explode(F.arrays_zip(names.alias("operator"), spans.alias("span"))).alias("o")).select(key, "name", "url", F.trim("o.operator").alias("operator"), F.substring(F.trim("o.span"), 1, 300).alias("claim_span"))
    rows = rows.where(plain(F.col("operator")) != plain(F.col("name")))
    return rows.groupBy(key).agg(F.min_by(F.struct("operator", F.col("url").alias("source_url"), "claim_span"), F.struct("url", "operator")).alias("o")).select(key, "o.*")


#: Fixed labels before an organisation number in a footer.
NUMBER_LABEL = r"(?i)\b(?:org\.?\s*(?:nr\.?|nummer|no\.?)|organisasjonsnummer|foretaks\s*(?:nr\.?|nummer)|organi[sz]ation\s+number|reg(?:istration)?\.?\s*(?:no\.?|number)|VAT\s*(?:no\.?|number)|MVA|EHF[ -]faktura\s*:\s*ELMA)\s*[:.]?\s*(?:NO\s*)?((?:[0-9][\s.\u00a0-]*){8}[0-9])(?![0-9])"


def operator_proof(number: Column, name: Column, title: Column, identity_text: Column, url: Column) -> Column:
    """True if labelled numbers of the page are the company's own and no other's or, where there are none, its
    whole legal name stands in the footer, or in the title of a front page."""
    plain = lambda c: F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), " "), F.lit(" "))
    stated = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(identity_text, F.lit("")), F.lit(NUMBER_LABEL), F.lit(1)), lambda x: F.regexp_replace(x, "[^0-9]", "")))
    front = F.lower(F.trim(F.replace(path(url), F.lit("/"), F.lit(" ")))).isin("", "no", "nb", "nn", "en", "en-us", "en-gb")
    named = F.contains(plain(identity_text), plain(name)) | (front & F.contains(plain(title), plain(name)))
    able = number.rlike("^[0-9]{9}$") & (F.size(F.regexp_extract_all(name, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))) >= 2)
    return able & F.when(F.size(stated) > 0, (F.size(stated) == 1) & (F.element_at(F.concat(stated, F.array(F.lit(""))), 1) == number)).otherwise(named)


def entity_decision(orgnr: Column, name: Column, domain: Column, address: Column, vetoes: Column) -> Column:
    """Struct(score, status): vetoes reject; number with name or domain, or a
    near-perfect whole, is exact."""
    total = orgnr * WEIGHTS["orgnr"] + name * WEIGHTS["name"] + domain * WEIGHTS["domain"] + address * WEIGHTS["address"]
    exact = ((orgnr >= 1) & ((name >= 0.9) | (domain >= 0.9))) | ((name >= 0.95) & (domain >= 0.9) & (total >= 0.95))
    return F.struct(F.round(total, 3).alias("score"), F.when(F.size(vetoes) > 0, "rejected").when(exact, "exact").otherwise("review").alias("status"))


def search_score(org: Column, title_names: Column, all_names: Column, in_host: Column, municipality: Column) -> Column:
    total = org.cast("int") * 0.75 + F.when(title_names, 0.45).when(all_names, 0.25).otherwise(0.0) + in_host.cast("int") * 0.3 + municipality.cast("int") * 0.1
    return F.least(F.lit(1.0), total)


def name_match(title: Column, name: Column) -> Column:
    """exact_legal_name, multi_token_base_name or none; letters æ, ø and å stay as they are."""
    words = lambda c: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z0-9æøå]+)"), F.lit(1))
    whole = words(name)
    base = F.filter(whole, lambda w: ~w.isin(*T.LEGAL_WORDS))
    head = words(F.regexp_replace(F.coalesce(title, F.lit("")), r"^(.*) - .*?$", "$1"))
    return F.when(T.contains_sequence(head, whole), "exact_legal_name").when((F.size(base) >= 2) & T.contains_sequence(head, base), "multi_token_base_name").otherwise("none")


def news_credibility(rows: DataFrame, as_of: Column) -> DataFrame:
    """rows: title, publisher, url, published_at, name. Five dimensions, a tier
    and the publication gate; the clock is a parameter."""
    last_two = lambda c: F.array_join(F.slice(F.split(host(c), r"\."), -2, 2), ".")
    d = rows.withColumn("domain", F.when(F.contains(host(F.col("url")), F.lit(".")), last_two(F.col("url"))).otherwise(host(F.col("url"))))
    age = F.datediff(as_of, F.col("published_at"))
    flags = T.headline_flags(F.col("title"))
    trusted, black = F.col("domain").isin(*TRUSTED), F.col("domain").isin(*BLACKLIST)
    publisher = F.when(trusted, 0.35).when(any_in(F.lower(F.trim("publisher")), BRANDS), 0.30).when(F.length(F.trim("publisher")) >= 3, 0.12).otherwise(0.0)
    domain = F.when(F.col("domain").endswith(".no") | trusted, 0.20).when(F.col("domain") != "", 0.05).otherwise(0.0)
    date = F.when(F.col("published_at").isNull(), 0.0).when(age < -1, -0.20).when((age >= 0) & (age <= 730), 0.15).otherwise(0.05)
    headline = F.when(F.size(flags) == 0, 0.15).otherwise(-F.least(F.lit(0.15), F.lit(0.06) * F.size(flags)))
    match = name_match(F.col("title"), F.col("name"))
    entity = F.when(match == "exact_legal_name", 0.15).when(match == "multi_token_base_name", 0.10).otherwise(0.02)
    total = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), publisher + domain + date + headline + entity)), 2)
    d = d.withColumns({"flags": F.array_join(flags, ","), "match": match, "score": F.when(black, 0.0).otherwise(total)})
    tier = F.when(F.col("score") >= 0.70, "high").when(F.col("score") >= 0.50, "medium").when(F.col("score") >= 0.25, "low").otherwise("rejected")
    fatal = black | F.coalesce(age < -1, F.lit(False))
    return d.withColumns({"tier": tier, "publishable": (F.col("score") >= 0.60) & (F.col("match") != "none") & ~fatal})
