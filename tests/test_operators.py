"""Hand-made rows: nulls, ties, abstention and the traps of the survey."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quern.functions import dates, html as H, text as T, urls as U
from quern.operators import accounts as A, claims as C, identity as I, lookup as L, metrics as M, refresh as R, sampling as S, scoring as G, screen as Q
from quern.sources import files
from quern.streaming import changelog as Z


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_screen_parser():
    p = Q.parse("Companies in Oslo with more than 50 employees and revenue over NOK 10 million")
    assert [(f.field, f.operator, f.value) for f in p.filters] == [("municipality", "eq", "OSLO"), ("employees", ">", 50), ("revenue", ">", 1e7)]
    assert Q.parse("companies in Oslo top 10 by revenue", compat=True).filters == []
    assert Q.parse("companies in Oslo top 10 by revenue").filters[0].value == "OSLO"
    assert Q.parse("revenue over 1,000,000").unsupported == ["the amount 1,000,000 can't be read"]
    assert Q.parse("top 500 by employees").sort == ("employees", 100)
    assert Q.parse("unprofitable companies").filters[0].operator == "<"
    assert not Q.parse("companies with good reviews in Oslo").executable
    assert Q.parse("hello").reason == "No supported criterion was recognized."


def test_screen_nulls(spark):
    rows = spark.createDataFrame([("1", None, 5.0), ("2", 10, None), ("3", 20, 7.0), ("4", 20, 9.0)], "organisation_number string, employees int, revenue double")
    assert [r[0] for r in Q.screen(rows, "employees > 5").orderBy("organisation_number").collect()] == ["2", "3", "4"]
    assert [r[0] for r in Q.screen(rows, "top 3 by revenue").collect()] == ["4", "3", "1"]
    assert [r[0] for r in Q.screen(rows, "top 2 by employees").collect()] == ["3", "4"]
    assert Q.screen(rows, "companies with traffic").count() == 0


def test_accounts(spark):
    d = lambda y: dt.datetime(y, 12, 31)
    rows = [(1, 1, d(2020), 2020, "KONSERN", 100.0), (1, 2, d(2020), 2020, "SELSKAP", 50.0), (1, 3, d(2021), 2021, "SELSKAP", 75.0), (1, 5, d(2023), 2023, "SELSKAP", 0.0), (1, 6, None, None, "SELSKAP", 1.0)]
    df = spark.createDataFrame(rows, "key long, record_id long, period_end timestamp, year int, account_type string, revenue double")
    best = A.best_per_year(df)
    assert sorted((r.year, r.record_id) for r in best.collect()) == [(2020, 2), (2021, 3), (2023, 5)]
    g = {r.year: r for r in A.growth(best).collect()}
    assert g[2021].yoy == 0.5 and g[2021].growth_label == "+50.0%" and g[2021].consecutive
    assert g[2023].yoy == -1.0 and g[2023].cagr is None and not g[2023].consecutive
    r = one(spark, A.guarded_ratio(F.lit(0.0), F.lit(2.0), zero_top=False).alias("a"), A.guarded_ratio(F.lit(0.0), F.lit(2.0)).alias("b"), A.guarded_ratio(F.lit(1.0), F.lit(0.0)).alias("c"))
    assert (r.a, r.b, r.c) == (None, 0.0, None)


def test_lookup(spark):
    m = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    reg, live = spark.createDataFrame([("a", "x")], "k string, v string"), spark.createDataFrame([("b", "y"), ("a", "z")], "k string, v string")
    assert sorted(tuple(r) for r in L.left_fill(m, reg, live, "k", ["v"]).collect()) == [("a", "x", "bulk"), ("b", "y", "live"), ("c", None, "not_found")]
    with pytest.raises(PySparkException):
        L.join_or_raise(m, reg, "k", "registry").collect()
    assert not L.same_members(m, reg, "k") and L.same_members(m, m, "k")
    tied = spark.createDataFrame([(1, 5.0, 1), (1, 5.0, 2), (2, 3.0, 9), (2, 1.0, 1)], "k int, s double, c int")
    assert [tuple(r) for r in L.unique_best(tied, "k", "s", "c").collect()] == [(2, 9, 3.0)]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = S.split_by_position(df, "k", 1).collect()
    b = S.split_by_position(df.repartition(7), "k", 1).collect()
    assert sorted(a) == sorted(b)
    assert {x: sum(r.split == x for r in a) for x in ("development", "validation", "holdout")} == {"development": 300, "validation": 100, "holdout": 100}
    assert sorted(r.place for r in a) == list(range(500))


def test_text(spark):
    r = one(spark, T.tokens(F.lit("Blåbær & Sønn AS")).alias("t"), T.tokens(F.lit(None).cast("string")).alias("n"), T.phone(F.lit("+47 22 33 44 55")).alias("p"), T.email_domain(F.lit("a@gmail.com")).alias("g"), T.email_domain(F.lit("a@Firma.no")).alias("e"), T.number_nb(F.lit("1 2O0,5")).alias("x"), T.org_numbers(F.lit("NO 987 654 321 MVA, 987654321, 12345678901")).alias("o"))
    assert r.t == ["blabaer", "sonn"] and r.n == [] and r.p == "22334455" and r.g is None and r.e == "firma.no" and r.x == 1200.5 and r.o == ["987654321"]
    r = one(spark, T.headline_flags(F.lit("SHOCKING NEWS!!")).alias("f"), I.name_match(F.lit("Byggmester Flo vinner - Avisen"), F.lit("Byggmester Flo AS")).alias("m"))
    assert r.f == ["clickbait_phrase:shocking", "excessive_exclamation", "all_caps_title"] and r.m == "multi_token_base_name"


def test_urls_and_dates(spark):
    r = one(spark, U.host(F.lit("HTTPS://user@www.Example.co.uk:8080/a?b")).alias("h"), U.registrable(F.lit("a.example.co.uk")).alias("r"), U.redacted(F.lit("http://x/?a=1&API_KEY=s3&b=2")).alias("k"), U.is_hub(F.lit("https://x.no/nyheter/")).alias("u"), U.is_hub(F.lit("https://x.no/a/b")).alias("v"), U.host_suffixes(F.lit("a.b.c")).alias("s"))
    assert r.h == "example.co.uk" and r.r == "example.co.uk" and r.k == "http://x/?a=1&API_KEY=REDACTED&b=2" and r.u and not r.v and r.s == ["a.b.c", "b.c", "c"]
    r = one(spark, *(dates.parse_date(F.lit(x)).alias(f"d{i}") for i, x in enumerate(("2024-03-05T10:00", "5.3.2024", "5. mars 2024", "never"))))
    assert list(r) == [dt.date(2024, 3, 5)] * 3 + [None]


def test_html(spark):
    page = '<html><title> A </title><script src="a"></script><script src="b"></script><script type="application/ld+json">{"@graph":[{"@type":["Organization"],"name":"Firma"},{"x":{"@type":"NGO","name":"Vern"}}]}</script><a href="/x">x</a></html>'
    df = spark.createDataFrame([(1, page), (2, None), (3, '<script type="application/ld+json">{bad</script>')], "page_id long, html string")
    r = df.select(H.title(F.col("html")).alias("t"), H.links(F.col("html")).alias("l"), H.is_shell(F.col("html")).alias("s")).collect()
    assert (r[0].t, r[0].l, r[0].s) == ("A", ["/x"], True) and (r[1].t, r[1].s) == ("", False)
    assert {x.page_id: x.names for x in H.json_ld_organisations(df, "page_id").collect()} == {1: ["Firma", "Vern"], 2: [], 3: []}


def test_identity(spark):
    rows = spark.createDataFrame([
        ("Nordlys Bakeri AS", "987654321", "https://nordlysbakeri.no", "Nordlys Bakeri", "Velkommen til oss, brød og kaker hver dag i uken hele året.", ""),
        ("Nordlys Bakeri AS", "987654321", "https://x.no", "Kontakt", "Org 111 222 333", ""), ("Nordlys Bakeri AS", "987654321", "https://x.no", "Kontakt", "Org 987 654 321 og 111222333", ""),
        ("Nordlys Bakeri AS", "987654321", "https://x.no", "Kjøp dette domenet", "", ""), (None, "987654321", "https://x.no", None, None, None),
    ], "name string, organisation_number string, url string, title string, text string, declared_host string")
    assert [r.score for r in I.website_ladder(rows).collect()] == [0.95, 0.0, 1.0, 0.1, 0.3]


def test_metrics(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", None)], "gold string, predicted string")
    c = {r.label: (r.tp, r.fp, r.fn) for r in M.confusion(rows).collect()}
    assert c == {"a": (1, 0, 1), "b": (1, 1, 1)}
    s = spark.createDataFrame([(1, "x", "neutral"), (1, "y", "positive"), (2, "x", "negative"), (3, "x", "positive"), (3, "y", "negative")], "k int, source string, label string")
    assert {r.k: r.verdict for r in M.sentiment_rollup(s, "k").collect()} == {1: "positive", 2: "abstain", 3: "mixed"}
    n = spark.range(1, 5).select(F.col("id").cast("double").alias("v"))
    assert tuple(M.latency(n, "v").first()) == (4, 2.0, 4.0, 4.0)
    assert M.membership_digest(spark.range(9), "id").first() == M.membership_digest(spark.range(9).repartition(5), "id").first()


def test_refresh(spark):
    a = spark.createDataFrame([(1, 5, "x"), (2, None, "y")], "k int, n int, s string")
    b = spark.createDataFrame([(1, 6, "x"), (2, None, "y"), (3, 1, "z")], "k int, n int, s string")
    assert R.snapshot_diff(a, a, "k", ["n", "s"]).count() == 0
    got = sorted(tuple(r) for r in R.snapshot_diff(a, b, "k", ["n", "s"]).collect())
    assert got == [(1, "n", "5", "6"), (3, "membership", "absent", "present")]
    with pytest.raises(PySparkException):
        R.snapshot_diff(a, b, "k", ["n"], strict=True).collect()
    e = spark.createDataFrame([], "k int, field string")
    assert R.replay_evaluation(e, e, ["k", "field"]).first().qualified


def test_claims_and_gates(spark):
    c = spark.createDataFrame([(1, "f", "available", ["x", "y"]), (1, "g", "available", ["z"]), (1, "h", "not_available", [])], "key int, field string, availability string, evidence_ids array<string>")
    e = spark.createDataFrame([(1, "x")], "key int, evidence_id string")
    got = {r.field: (r.availability, r.ids, r.dropped) for r in C.repair_linkage(c, e).collect()}
    assert got == {"f": ("available", ["x"], 1), "g": ("ambiguous", [], 1), "h": ("not_available", [], 0)}
    cols = [f"{s}_{m}" for m in ("wrong", "precision", "grounding", "recall", "refresh", "within_budget") for s in ("base", "new")]
    pair = lambda *v: spark.createDataFrame([v], ", ".join(f"{x} double" for x in cols))
    ok = G.gate_rows(pair(2.0, 2.0, 0.9, 0.9, 0.9, 0.9, 0.5, 0.6, None, None, 1.0, 1.0))
    assert tuple(G.verdict(ok).first()) == (6, True) and [r.evaluated for r in ok.collect()] == [True] * 4 + [False, True]
    assert tuple(G.verdict(G.gate_rows(pair(0.0, 1.0, *[1.0] * 10))).first()) == (0, False)


def test_registry_files(spark, tmp_path):
    text = "﻿organisasjonsnummer;navn;antallAnsatte;konkurs\n987654321;Ett;12;true\n123;Kort;1;false\n111222333;To;;false\n"
    plain, packed = tmp_path / "r.csv", tmp_path / "misnamed.csv"
    plain.write_bytes(text.encode())
    packed.write_bytes(gzip.compress(text.encode()))
    for p in (plain, packed):
        got = sorted((r.organisation_number, r.name, r.employees, r.bankrupt) for r in files.normalise_registry(files.read_registry(spark, str(p))).collect())
        assert got == [("111222333", "To", None, False), ("987654321", "Ett", 12, True)]
    lines = tmp_path / "r.jsonl"
    lines.write_text(json.dumps({"Organisasjonsnummer": "987654321", "Navn": "Ett"}) + "\n")
    assert files.normalise_registry(files.read_registry(spark, str(lines))).first().name == "Ett"


def test_manifest(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"orgnr": "987 654 321"}\n{"organisation_number": ""}\n')
    got = [r.organisation_number for r in files.read_manifest(spark, str(tmp_path / "m.jsonl")).orderBy("position").collect()]
    assert got == ["987654321", "input_2"]
    (tmp_path / "m.json").write_text('{"organisation_numbers": ["111222333", "111 222 333"]}')
    with pytest.raises(PySparkException):
        files.read_manifest(spark, str(tmp_path / "m.json")).collect()


def test_attempt_log_and_snapshot(spark, tmp_path):
    path = str(tmp_path / "log")
    for run in ("r1", "r2"):
        files.append_attempts(spark.createDataFrame([("987654321", run, "site"), ("111222333", run, "news")], "organisation_number string, run_id string, route string"), path)
    assert files.read_attempts(spark, path, organisation="987654321", run="r2").count() == 1
    req = spark.createDataFrame([("u1",), ("u2",)], "url string")
    res = spark.createDataFrame([("u1", 200, "body", "t")], "url string, status int, body string, retrieved_at string")
    assert sorted(r.status for r in files.serve_snapshot(req, res).collect()) == [0, 200]


def test_stream_equals_batch(spark, tmp_path):
    log = [(1, 1, "ACTIVE"), (1, 2, "INACTIVE"), (2, 1, "ACTIVE"), (2, 3, "ACTIVE"), (3, 9, "ACTIVE")]
    for i in range(len(log)):
        spark.createDataFrame(log[i : i + 1], "uuid int, seq int, status string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("uuid int, seq int, status string").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = Z.compact_stream(stream, "uuid", ["seq"], "status", str(tmp_path / "out"), str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(tuple(r) for r in Z.read_compacted(spark, str(tmp_path / "out"), "status").select("uuid", "seq", "status").collect())
    assert all(len(v) <= 2 for v in Z._versions(spark, str(tmp_path / "out")).values())
    want = sorted(tuple(r) for r in Z.compact(spark.createDataFrame(log, "uuid int, seq int, status string"), "uuid", ["seq"], "status").collect())
    assert got == want


def test_entity_mentions_equal_the_pattern():
    import random
    import re

    from quern.functions import text as T

    pattern, r = re.compile(T.LEGAL_ENTITY), random.Random(1)
    for _ in range(5000):
        t = "".join(r.choice(["a", "B", "ø", " ", "  ", "\n", "1", ",", " AS", " as ", " DA", " nuf", "x" * 40, " hei ", " ASA", "Nord", ".", "-"]) for _ in range(r.randrange(1, 30)))
        assert T.entities_in(t) == [m[0].replace("\n", " ") for m in pattern.finditer(t)], t


def test_folding_covers_latin_letters(spark):
    from quern.functions import text as T

    r = one(spark, T.folded(F.lit("ÆØÅ ŁŚŻ Ěřů ñç Ạễ")).alias("f"))
    assert r.f == "aeoa łsz eru nc ae"
