"""Names, validators, hiring, runs and connectors on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from quern.functions import names as N
from quern.operators import hiring as J, runs as X, validators as V
from quern.sources import connectors as K


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_names(spark):
    r = one(
        spark, N.brand_tokens(F.lit("Blå Fjord AS"), F.lit("https://www.bfjord.no")).alias("b"), N.named(F.lit("Nordic Choice AS"), F.lit("besøk nordicchoice i dag")).alias("j"), N.named(F.lit("Flo AS"), F.lit("flo er her")).alias("s"),
        N.homepage(F.lit("Example.no")).alias("h"), N.homepage(F.lit("ftp://x")).alias("f"), N.homepage(F.lit(" ")).alias("e"), N.domain_slugs(F.lit("Blå Fjord AS")).alias("d"), N.idna(F.lit("blå")).alias("i"),
        N.sequence_ratio(F.lit("abcd"), F.lit("bcde")).alias("q"),
    )
    assert r.b == ["bfjord", "blafjord", "fjord"] and r.j and not r.s and r.h == "https://Example.no/" and r.e is None and r.d[0] == "blafjord.no" and r.i == "xn--bl-zia" and r.q == 0.75


def test_social(spark):
    urls = ["https://www.facebook.com/firma/", "https://facebook.com/sharer.php?u=1", "https://linkedin.com/in/x", "https://no.linkedin.com/company/firma/about", "https://youtu.be/x", "https://youtube.com/@firma/videos", "https://twitter.com/firma", "https://x.com/a/b", "https://example.no/x", None]
    got = [r.p.url if r.p else None for r in spark.createDataFrame([(u,) for u in urls], "u string").select(N.social_profile(F.col("u")).alias("p")).collect()]
    assert got == ["https://facebook.com/firma", None, None, "https://linkedin.com/company/firma", None, "https://youtube.com/@firma", "https://x.com/firma", None, None, None]


def test_news_and_jobs(spark):
    day = dt.date(2024, 1, 1)
    base = dict(url="https://avis.no/a/1", title="Firma vinner pris", content_sha256="h", published_at=day, site_url="", verification="article_fetched", company_name="Firma Stor AS", article_text="I dag vant Firma Stor prisen")
    rows = [base, base | {"url": "x"}, base | {"url": "https://x.no/careers/1"}, base | {"title": "News"}, base | {"published_at": None}, base | {"published_at": dt.date(2025, 1, 1)}, base | {"published_at": dt.date(2015, 1, 1)}, base | {"verification": None}, base | {"article_text": "en annen"}]
    schema = "url string, title string, content_sha256 string, published_at date, site_url string, verification string, company_name string, article_text string"
    got = [r[0] for r in spark.createDataFrame([tuple(r.values()) for r in rows], schema).select(V.news_reason(F.lit(day))).collect()]
    assert got == ["article_verified", "no_url", "recruitment_page_not_news", "generic_title", "no_publication_date", "future_date", "too_old", "article_not_refetched", "company_not_named_in_article"]
    job = spark.createDataFrame([("https://x.no/1", "Kokk", "h", day, "Firma Stor AS", "Firma Stor AS"), ("https://x.no/1", "Jobs", "h", day, "Firma Stor AS", "Firma Stor AS"), ("https://x.no/1", "Kokk", "h", dt.date(2023, 1, 1), "Firma Stor AS", "Firma Stor AS"), ("https://x.no/1", "Kokk", "h", None, "Annen AS", "Firma Stor AS")], "url string, title string, content_sha256 string, deadline date, employer string, company_name string")
    assert [r[0] for r in job.select(V.job_reason(F.lit(day))).collect()] == ["job_verified", "generic_title", "expired", "other_employer"]


def test_hiring(spark):
    pages = spark.createDataFrame([(1, "https://x.no/karriere/", "Om oss", "Vi søker. Ledig stilling som kokk nå"), (2, "https://x.no/om", "Om oss", "Ledig stilling"), (3, "https://x.no/", "Join our team", None)], "k int, url string, title string, text string")
    got = {r.k: r.claim_span for r in J.signals(pages, "k").collect()}
    assert set(got) == {1, 3} and "Ledig stilling" in got[1] and got[3] == "Join our team"
    who = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    jobs = spark.createDataFrame([(2, "a")], "k int, ad string")
    assert {r.k: r.status for r in J.assessment(who, J.signals(pages, "k"), jobs, "k").collect()} == {1: "recruitment_page_present", 2: "actively_recruiting", 3: "recruitment_page_present"}
    text = spark.createDataFrame([(1, "Antall årsverk: 12,5\n40 ansatte"), (2, "40 ansatte og 41 ansatte"), (3, "Konsernet har 900 ansatte"), (4, None)], "k int, text string")
    assert {r.k: r.workforce for r in J.workforce(text, "k").collect()} == {1: 12.5, 2: None}


def test_vacancies(spark):
    c = spark.createDataFrame([(1, "Stor Firma AS"), (2, "Lik AS"), (3, "Lik ASA")], "org int, name string")
    u = spark.createDataFrame([(10, 1)], "subunit int, org int")
    d = dt.date
    ads = spark.createDataFrame([("a", 1, "x", d(2024, 5, 1)), ("b", 10, "x", None), ("c", None, "STOR FIRMA", d(2024, 5, 1)), ("d", None, "Lik", d(2024, 5, 1)), ("e", 99, "Stor Firma", d(2024, 5, 1)), ("f", 1, "x", d(2020, 1, 1))], "ad_id string, org int, employer string, expires date")
    got = {r.ad_id: (r.match_type, r.company) for r in J.match_vacancies(ads, c, u, F.lit(d(2024, 1, 1))).collect()}
    assert got == {"a": ("organisation", 1), "b": ("subunit", 1), "c": ("name", 1), "d": ("rejected", None), "e": ("rejected", None)}


def test_roles(spark):
    t = "array<struct<group:string,changed:string,roles:array<struct<code:string,name:string,inactive:boolean>>>>"
    df = spark.createDataFrame([([("g", None, [("LEDE", "Gammel", True), ("LEDE", "Anne", False), ("MEDL", "Ola", None)]), ("h", None, [("DAGL", "Kari", False), ("NEST", "Ola", False), ("MEDL", None, False)])],)], f"g {t}")
    r = df.select(J.roles(F.col("g")).alias("r")).first().r
    assert (r.chair, r.ceo, r.board) == ("Anne", "Kari", ["Ola"])


def test_runs(spark):
    rows = spark.createDataFrame([("1", 1), ("2", 2), ("3", 1500)], "k string, o long")
    assert X.sequence_digest(rows, "k", "o").first() == X.sequence_digest(rows.repartition(3), "k", "o").first()
    a, b = spark.createDataFrame([("x", 1), ("y", 2)], "f string, v int"), spark.createDataFrame([("y", 5), ("z", 1)], "f string, v int")
    assert {r.f: r.delta for r in X.run_delta(a, b, "f", "v").collect()} == {"x": -1, "y": 3, "z": 1}


def test_connectors(spark):
    body = '{"items": [{"url": "https://a", "text": "one"}, {"url": "https://a", "text": "one"}, {"text": "two"}]}'
    r = spark.createDataFrame([("987654321", "https://api", 200, body, "t"), ("111222333", "https://api", 404, body, "t"), ("111222333", "https://api", 200, "{bad", "t")], "organisation_number string, url string, status int, body string, retrieved_at string")
    for name in ("vacancy_feed", "lei"):
        got = K.observations_from(r, name).collect()
        assert sorted((x.source_url, x.evidence_span) for x in got) == [("https://a", "one"), ("https://api", "two")]
        assert all(x.strategy == name and x.publication == K.CONNECTORS[name].publication for x in got)
    assert K.rights(spark).count() == len(K.CONNECTORS)


def test_evidence(spark):
    from quern.operators import evidence as E

    r = one(spark, E.same_address(F.lit("Storgata 1B"), F.lit("0150"), F.lit("0301"), F.lit("storgata 1 B"), F.lit("0150"), F.lit("0301")).alias("a"), E.same_address(F.lit("Storgata 1"), F.lit("150"), F.lit(""), F.lit("Storgata 1"), F.lit("150"), F.lit("")).alias("b"))
    assert r.a and not r.b
    order = E.adaptive_loop(["a", "b", "c"], {"a": 0.0, "b": 5.0, "c": 1.0}.get, {"c": [3.0]})
    assert [s for s, _ in order] == ["c", "a", "b"]


def test_answers(spark):
    from quern.operators import screen as Q

    claims = spark.createDataFrame([("1", "financials", f"f{i:02}", "available") for i in range(15)] + [("1", "roles", "chair", "available"), ("1", "registry", "x", "failed"), ("2", "roles", "y", "available")], "organisation_number string, module string, field string, availability string")
    assert Q.answer(claims, "1", "What is the revenue?").count() == 12
    assert Q.answer(claims, "1", "Who leads it?").count() == 1
    assert Q.answer(claims, "1", "Tell me more").count() == 13
