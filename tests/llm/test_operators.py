"""The ten operators against plain versions; nulls, ties, empty tables, clashing columns."""

import random
import string

import numpy as np
import pytest

from quern.llm import decontaminate, mixing, paragraphs, personal, quality, scoring, secrets, setjoin, suffixes, warc
from quern.llm.boosting import BoostedTrees

from . import brute

EDGES = [(9000, None), (9001, ""), (9002, "a"), (9003, "A"), (9004, " \t\n"), (9005, "\n\n"), (9006, "é ü\nÆ"), (9007, "a b"), (9008, " a  b "), (9009, "word " * 3000), (9010, "x" * 50_000)]


def corpus(n=160, seed=3):
    """Texts with copies, near copies, shared passages, repeated lines, secrets and personal data."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randrange(2, 8))) for _ in range(400)]
    sentence = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passages = [sentence(60) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = r.random()
        if kind < 0.15 and rows:
            text = rows[r.randrange(len(rows))][1]
        elif kind < 0.4 and rows:
            w = rows[r.randrange(len(rows))][1].split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            text = " ".join(w)
        else:
            text = "\n".join(sentence(r.randrange(3, 90)) for _ in range(r.randrange(1, 6)))
            if kind > 0.8:
                text += "\n" + r.choice(passages) + "\n" + sentence(5)
            if kind > 0.9:
                text += ' token = "' + "".join(r.choice("0123456789abcdef") for _ in range(40)) + '" +1 (415) 555-2671 a.b@mail.example.com 4111 1111 1111 1111 10.0.0.300 10.1.2.3'
        rows.append((i * 7, text))
    return rows + EDGES


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    full = [(i, t, "en", f"s{i % 3}", "x", 1, 2) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, batch string, key int, size int").repartition(5)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_paragraphs(spark, rows, docs):
    got, want = {i: r.removed_spans for i, r in by_id(paragraphs.repeated_paragraphs(docs)).items()}, brute.paragraphs(rows)
    pairs = lambda x: {(i, s) for i, v in x.items() for s in v.split(",") if s}
    assert set(got) == set(want) and pairs(got) <= pairs(want)
    assert len(pairs(got)) >= 0.97 * len(pairs(want)) > 10
    assert paragraphs.repeated_paragraphs(empty(spark)).count() == 0


def test_suffixes(spark, rows, docs):
    got = {i: tuple(r)[1:] for i, r in by_id(suffixes.remove_repeats(docs)).items()}
    assert got == brute.suffixes(rows)
    assert suffixes.remove_repeats(empty(spark)).count() == 0
    twice = spark.createDataFrame([(1, "z" * 100), (1, "z" * 100), (None, "z" * 150)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffixes.remove_repeats(twice).collect()) == [(0, 150), (1, 0), (1, 100)]


def test_suffixes_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 256)
    import pyarrow as pa

    r = random.Random(1)
    part = "".join(r.choice("abcd") for _ in range(700))
    t = pa.table({"doc_id": [1, 2], "text": [part + "x" * 300, "y" * 77 + part[50:650]]})
    b = suffixes.Batch(t)
    assert int(b.count.sum()) == (1000 - 99) + (677 - 99)
    assert len(set(b.hashes(b.windows(__import__("numpy").arange(len(b.first)))[0]).tolist())) > 700


def test_quality(spark, rows, docs):
    got = by_id(quality.quality_verdicts(docs))
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t)
        assert not (r.kept and r.base_failed)
    assert quality.quality_verdicts(empty(spark)).count() == 0
    junk = [(i, " ".join([("word%d" if i else "wo%d") % ((i + 1) * k) for k in range(30)]) + ("#|" * 60 if i == 7 else ""), None, None) for i in range(300)]
    got = by_id(quality.quality_verdicts(spark.createDataFrame(junk, "doc_id long, text string, lang string, source string")))
    # fences lie on both sides: text 0 (wo0 to wo29) has by far the shortest words, 15 scales below the median
    assert {i: r.outlier_in.split(",")[0] for i, r in got.items() if not r.kept} == {0: "word_length", 7: "symbol_ratio"}


def test_quality_fences_against_exact_quantiles(spark):
    """kept by the method, with exact quantiles in place of sketches (which are exact up to 200 values)."""
    r = random.Random(12)
    rows = []
    for i in range(400):
        lang, source = r.choice([None, "en", "de"]), r.choice(["a", "b", None])
        words = ["".join(r.choice(string.ascii_lowercase) for _ in range(max(1, round(r.gauss(5 + (lang == "de"), 1.5))))) for _ in range(r.choice([25, 60, 200, 400]))]
        if i % 13 == 0:
            words = [w * r.choice([1, 3]) for w in words]
        if i % 17 == 0:
            words = [w + r.choice(["", "#$", "|"]) for w in words]
        if i % 19 == 0:
            words = [w[:1] for w in words]
        text = "\n".join(" ".join(words[k : k + 10]) for k in range(0, len(words), 10))
        rows.append((i, text + ("\nsame line here" * 12 if i % 23 == 0 else ""), lang, source))
    want = brute.fenced(rows, quality.SPREAD, quality.CORE, quality.LEAN, quality.TAILS, quality.TAIL_LEAN)
    got = by_id(quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    assert {i: x.outlier_in for i, x in got.items()} == want
    # one row in 17 has symbols and one in 23 repeated lines: more than the tail beyond the fence, so these are usual here
    assert {f for x in want.values() for f in x.split(",")} >= {"repeat_ratio", "word_length"}


def test_quality_tails_follow_their_group(spark):
    """The same symbols are usual in one source and junk in another; rare repeated lines go, one repeat doesn't."""
    r = random.Random(31)
    rows, junk = [], {"symbol_ratio": set(), "dup_line_ratio": set()}
    for i in range(6000):
        source = "code" if i % 2 else "news"
        words = ["".join(r.choice(string.ascii_lowercase) for _ in range(r.choice([4, 5, 5, 6]))) for _ in range(r.choice([80, 120, 200]))]
        if source == "code" or i % 400 == 0:
            for k in range(0, len(words), 4):
                words[k] = words[k][:-1] + r.choice("#$|&")
            junk["symbol_ratio"] |= {i} if source == "news" else set()
        lines = [" ".join(words[k : k + 10]) for k in range(0, len(words), 10)]
        if i % 500 == 2:
            lines += ["again"] * 24
            junk["dup_line_ratio"].add(i)
        elif i % 10 == 4:
            lines += ["again", "again"]
        rows.append((i, "\n".join(lines), "en", source))
    got = by_id(quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    for f, planted in junk.items():
        assert {i for i, x in got.items() if f in x.outlier_in.split(",")} == planted
    assert sum(not x.kept for x in got.values()) <= 40


def test_quality_without_core_or_text(spark):
    """No document passes the base, only nulls and blanks, one group without core documents; clashing names beside."""
    schema = "doc_id long, text string, lang string, source string, q_lang string, n_own int, cell int"
    few, none, plain = (1, "few words", None, None, "x", 1, 2), (None,) * 7, (2, " ".join(f"word{k}" for k in range(40)), "b", "c", "x", 1, 2)
    for rows, want in (([few] * 3, [(1, False, "")] * 3), ([none, (1, "", "a", "b", "x", 1, 2)], [(1, False, ""), (None, False, "")]), ([(1, "#$ " * 4, "a", None, "x", 1, 2), plain], [(1, False, "symbol_ratio"), (2, True, "")])):
        df = spark.createDataFrame(rows, schema)
        assert sorted(((r.doc_id, r.kept, r.outlier_in) for r in quality.quality_verdicts(df).collect()), key=str) == want
        assert [r.spans for r in secrets.secret_spans(df).collect()] == [""] * len(rows) and secrets.redact_documents(df).count() == len(rows)


def test_warc(spark):
    r = random.Random(2)
    big = "".join(r.choice(string.printable) for _ in range(40_000))
    pages = [(1, "u", big), (2, "u", big), (3, None, None), (4, "u", ""), (5, "u", "a\r\n\r\nWARC/1.1\r\n\r\n"), (6, "ü\n", "é" * 9000), (-7, "u", big), (8, "u", "x" * 16_384)]
    df = spark.createDataFrame([(*p, "k", "r") for p in pages], "page_id long, url string, html string, key string, response string")
    assert {x.page_id: tuple(x)[1:] for x in warc.warc_round_trip(df).collect()} == brute.warc([(i, h) for i, _, h in pages])
    assert warc.warc_round_trip(df.limit(0)).count() == 0


def test_warc_repeated_and_missing_ids(spark):
    """Every row has records of its own: two of one id, whole and segmented, and rows without an id."""
    big = "y" * 50_000
    pages = [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (3, big), (3, big), (3, big + "z"), (None, "c"), (None, "c"), (None, "a"), (None, None)]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.warc_round_trip(df).collect()), key=str)
    want = [(1, 1, "response", None), (1, 1, "revisit", 1), (1, 1, "revisit", 2), (2, 1, "response", None), (3, 50_000, "response", None), (3, 50_000, "revisit", 3), (3, 50_001, "response", None), (None, 1, "response", None), (None, 1, "revisit", None), (None, 1, "revisit", 1), (None, 0, "response", None)]
    assert got == sorted(want, key=str)


def test_warc_payloads_and_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc" * 9000), (2, "u", "def")], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "w"), segment_bytes=1000)
    got = {r.page: bytes(r.payload).decode() for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got == {1: "abc" * 9000, 2: "def"}
    records = warc.records_of("1", "u", b"abc" * 9000, None, 1000)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in [*records[:3], *records[4:]]))
    with pytest.raises(Exception, match="not whole"):
        warc.read_archives(spark, str(tmp_path / "d")).collect()
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"


def test_jaccard(spark, rows, docs):
    got = {i: tuple(r)[1:] for i, r in by_id(setjoin.document_components(docs)).items()}
    want = brute.jaccard(rows)
    assert got == want and len({c for _, c in want.values()}) < len(want) - 10
    assert setjoin.document_components(empty(spark)).count() == 0


def test_jaccard_of_a_large_group(spark):
    r = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(r.choice([0, 1, 3, 5, 6, 7, 9])):
            w[r.randrange(300)] = f"x{r.randrange(10**6)}"
        rows.append((i * 3, " ".join(w[: r.choice([300, 295, 280])])))
    got = by_id(setjoin.document_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: tuple(x)[1:] for i, x in got.items()} == brute.jaccard(rows)


def test_prefix_filter_bounds():
    """The opening of every set is long enough for every partner it can link with."""
    for n in range(1, 400):
        for m in range(setjoin.least_overlap(n), n + n // 9 + 2):
            o = setjoin.needed(n, m)
            if o <= min(n, m):
                assert len(setjoin.opening(range(m), 90)) >= min(m, m - o + setjoin.ell(n))
                assert n - setjoin.least_overlap(n) + 1 >= n - o + 1


def test_secrets(spark, rows, docs):
    more = [(5000, "x AKIA" + "A" * 14 + " AKIAshort PassWord: 'abcDEF123456-._' api_key=short TOKEN:0123456789abcdef é deadbeefdeadbeef deadbeefdeadbee")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = by_id(secrets.secret_spans(df))
    for i, t in [*rows, *more]:
        base = brute.secrets(t)
        r = got[i]
        assert r.base_sha256 == brute.sha(brute.line(base)), i
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
        assert {x for x in brute.line(base).split(",") if x} <= set(r.spans.split(","))
    assert secrets.secret_spans(empty(spark)).count() == 0


def test_randomness_battery_adds_keys(spark):
    r = random.Random(4)
    words = ["".join(r.choice("etaoinshr") for _ in range(20)) for _ in range(60)]
    plain = [(i, " ".join(["straightforwardnesses", "internationalization", words[i % 60]] * 5)) for i in range(200)]
    keys = [(1000 + i, "see " + "".join(r.choice(string.ascii_letters + string.digits) for _ in range(44)) + " end") for i in range(20)]
    ids = [(2000 + i, "see aaaaaaaaaaaaaaaaaaaa1111111111111111 end") for i in range(20)]
    got = by_id(secrets.secret_spans(spark.createDataFrame(plain + keys + ids, "doc_id long, text string")))
    found = {i for i, x in got.items() if "random" in x.spans}
    assert len(found & {i for i, _ in keys}) >= 15 and not found - {i for i, _ in keys}


def test_randomness_battery_by_alphabet_and_length(spark):
    """Recall on planted keys that the base doesn't match: mixed case, letters only, upper case, by length."""
    r = random.Random(15)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(16, 70))) for _ in range(6000)]
    rows = [(i, " ".join(words[i % 6000 :: 1500])) for i in range(1500)]
    planted = []
    for alphabet in (string.ascii_letters + string.digits, string.ascii_letters, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        for n in (24, 40, 64):
            planted += [(alphabet, n, "".join(r.choice(alphabet) for _ in range(n))) for _ in range(20)]
    rows += [(10_000 + k, f"see {key} end") for k, (*_, key) in enumerate(planted)]
    got = by_id(secrets.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")))
    hits = [("random" in got[10_000 + k].spans) for k in range(len(planted))]
    by = {}
    for (a, n, _), h in zip(planted, hits, strict=True):
        by.setdefault((len(a), n), []).append(h)
    assert all(sum(h) >= 0.8 * len(h) for (_, n), h in by.items() if n >= 40), by
    assert sum("random" in got[i].spans for i in range(1500)) <= 15


@pytest.mark.parametrize("letter_keys", [0, 300])
def test_randomness_battery_recall(spark, letter_keys):
    """At least 0.9 for each alphabet and length from 20 characters among pronounceable long words, also where
    one long run in twenty is a key of letters of one case; at most FDR of the added spans (twice, for chance) are words."""
    r = random.Random(18)
    syllables = [a + b + c for a in "bdfglmnprst" for b in "aeiou" for c in ("", "n", "r", "s")]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 16)))
    rows = [(i, " ".join(word() for _ in range(20))) for i in range(1200)]
    planted = []
    alphabets = {"base64": string.ascii_letters + string.digits + "+/", "upper hex": "0123456789ABCDEF", "base36": string.ascii_lowercase + string.digits, "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "mixed": string.ascii_letters, "lower": string.ascii_lowercase, "upper": string.ascii_uppercase}
    for name, alphabet in alphabets.items():
        for n in (20, 32, 40, 64):
            planted += [((name, n), "".join(r.choice(alphabet) for _ in range(n))) for _ in range(20)]
    planted += [(("lower", "more"), "".join(r.choice(string.ascii_lowercase) for _ in range(r.randrange(20, 50)))) for _ in range(letter_keys)]
    rows += [(10_000 + k, f"see {key} end") for k, (_, key) in enumerate(planted)]
    got = by_id(secrets.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")))
    by = {}
    for k, (cell, key) in enumerate(planted):
        by.setdefault(cell, []).append(f"random:4:{4 + len(key)}" in got[10_000 + k].spans)
    assert all(sum(h) >= 0.9 * len(h) for h in by.values()), by
    false = sum(got[i].spans.count("random") for i in range(1200))
    assert false <= 2 * secrets.FDR * len(planted)


def test_redact():
    assert secrets.redact("ab token=x cd", "assign:3:10") == "ab [ASSIGN] cd"
    assert secrets.redact("abcdef", "assign:0:4,hex:2:6") == "[ASSIGN]" and secrets.redact(None, "") is None


def test_personal(spark, rows, docs):
    got = by_id(personal.personal_spans(docs))
    for i, t in rows:
        base, r = brute.personal(t), got[i]
        assert r.base_sha256 == brute.sha(brute.line(base)), i
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in ("email", "ip", "card", "phone"))
        assert {x for x in brute.line(base).split(",") if x} <= set(r.spans.split(","))
    assert personal.personal_spans(empty(spark)).count() == 0


def test_personal_patterns_on_random_and_long_texts():
    r = random.Random(9)
    for _ in range(3000):
        t = "".join(r.choice("a1.@-+ %9") for _ in range(r.randrange(1, 40)))
        assert personal.base_spans(t) == brute.personal(t), t
    assert personal.base_spans("x" * 300_000 + " a@b.c " + "1" * 300_000 + "." + "@" * 1000) == [("email", 300_001, 300_006)]


def test_personal_method_finds_other_forms(spark):
    """Recall of planted forms that no base pattern matches, and look-alikes left alone."""
    r = random.Random(14)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: "".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randrange(4, 9)))

    def card():
        d = digits(15)
        return next(d + c for c in "0123456789" if brute.luhn(d + c))

    rows = []
    for i in range(1200):
        kind = i % 4
        ip = ".".join(str(r.randrange(256)) for _ in range(4))
        value = [f"{name()}.{name()}@{name()}.com", f"+1 ({r.randrange(200, 999)}) {digits(3)}-{digits(4)}", card(), ip][kind]
        rows.append((i, f"{name()} {name()} {['mail', 'call', 'pay', 'from'][kind]} {value} {name()} {name()}"))
    planted = []
    for i in range(160):
        c = card()
        planted.append([f"{name()}.{name()} (at) {name()}.com", f"({r.randrange(200, 999)}) {digits(3)}-{digits(4)}", ".".join(c[k : k + 4] for k in range(0, 16, 4)), f"2001:db8:{digits(4)}:{digits(4)}:{digits(3)}:{digits(3)}"][i % 4])
    plain = [f"19{i:02d}-{1 + i % 12:02d}-{1 + i % 28:02d}" for i in range(50)] + [f"{i % 24:02d}:{i % 60:02d}:{i % 50:02d}:{i % 40:02d}" for i in range(50)]
    rows += [(10_000 + i, f"{name()} {['mail', 'call', 'pay', 'from'][i % 4]} {x} {name()}") for i, x in enumerate(planted)]
    rows += [(20_000 + i, f"{name()} on {x} {name()}") for i, x in enumerate(plain)]
    got = by_id(personal.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")))
    found = sum(got[10_000 + i].n_other > 0 for i in range(len(planted)))
    wrong = sum(got[20_000 + i].n_other > 0 for i in range(len(plain)))
    assert found >= 0.9 * len(planted) and wrong <= 2, (found, wrong)


def test_personal_proposals_overlap_and_have_any_length(spark):
    found = lambda t: {t[p["s"] : p["e"]] for p in personal.proposals(t, personal.base_spans(t))}
    assert found("call 12 (555) 123-4567 now") >= {"12 (555) 123-4567", "(555) 123-4567", "123-4567"}
    assert found("1.2.3.4 555-123-4567") == {"555-123-4567"}  # the run begins with a base span
    assert found("paid 4981.0215.2537.5367 12/26") >= {"4981.0215.2537.5367", "4981.0215.2537.5367 12/26"}
    assert found("call 555 1234 at mail.com now") == {"555 1234", "1234 at mail.com"}
    assert found("john dot s (at) foo [dot] com") == {"john dot s (at) foo [dot] com", "s (at) foo [dot] com"}
    assert found("a at at b.com") == {"at at b.com"}
    long = ["x" * 70 + " (at) b.com", " dot ".join("abcdefg") + " at " + " dot ".join("hijklmnop"), "5" + " " * 80 + "(55) 12345", ".".join(["999"] * 40)]
    assert all(t in found(f"see {t} end") for t in long)
    rows = [(1, "write to john AT example DOT com"), (2, "y" * 120 + "@b.com"), (3, None)]
    got = by_id(spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(personal._scan, personal.SCAN))
    assert [(p.s, p.e) for p in got[1].proposed] == [(9, 32)] and [c.value for c in got[2].cases] == [rows[1][1]]
    assert personal.chosen([(0.5, 0, 9), (0.9, 3, 6), (0.4, 6, 9), (0.9, 3, 5)]) == [(3, 6), (6, 9)]
    assert personal.rewritten("ip", "0" * 5000 + "1.2.3.4", 1)[0] == ("2001:db8:0102:0304:7:2c", 1)


def test_personal_learns_from_all_spans(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('mail user', id, '@host', id % 50, '.com now') AS text")
    found = docs.select("doc_id", "text").mapInArrow(personal._scan, personal.SCAN)
    cases = personal.examples(found).cache()
    assert cases.where("y = 1").count() == 6000  # one form of each span
    model, limits = personal.fit(cases)
    again, same = personal.fit(cases.repartition(7))
    assert model.trees == again.trees and limits == same and limits[0] <= 1


def test_personal_learns_in_tasks_by_cases(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('mail user', id, '@host', id % 50, '.com now') AS text")
    cases = personal.examples(docs.mapInArrow(personal._scan, personal.SCAN)).repartition(60).cache()
    group, jobs = "personal-fit", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        model, limits = personal.fit(cases)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    stages = [jobs.getStageInfo(s) for j in jobs.getJobIdsForGroup(group) for s in jobs.getJobInfo(j).stageIds]
    wide = [s for s in stages if s and s.numCompletedTasks > 8]
    assert len(model.trees) == 40 and limits[0] <= 1 and len(stages) > 40 > len(wide)  # not all levels of all trees in all partitions
    assert personal.fit(cases.repartition(3))[0].trees == model.trees


def test_spread_trees_equal_whole_ones(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 60, (900, 4)).astype(float)
    y = ((x[:, 0] > 30) ^ (x[:, 2] < 12) ^ (rng.random(900) < 0.05)).astype(float)
    parts = spark.sparkContext.parallelize([(x[i::5], y[i::5]) for i in range(5)], 5)
    whole, spread = BoostedTrees(rounds=6).fit(x, y), BoostedTrees(rounds=6).fit_spread(parts)
    assert all(np.allclose(a, b) for a, b in zip(whole.edges, spread.edges, strict=True))
    assert np.allclose(whole.predict(x), spread.predict(x), atol=1e-4)


def test_boosted_trees_hold_out():
    import numpy as np

    g = np.random.default_rng(0)
    x = g.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = BoostedTrees().fit(x[:1500], y[:1500])
    assert ((m.predict(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_scores(spark, rows, docs):
    got, want = by_id(scoring.score_documents(docs)), brute.scores(rows)
    gain = 0.0
    for i, (held, n, known, total, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        gain += (r.score - r.base_score) if held else 0
        assert r.score_per_token == pytest.approx(r.score / n) and r.gain_per_token == pytest.approx((r.score - r.base_score) / n)
    assert gain > 0  # the mixture predicts held-out texts better than its base
    assert scoring.score_documents(empty(spark)).count() == 0


def test_scores_equal_the_exact_mixture(spark, rows, docs, monkeypatch):
    """score against a plain model that has the same mixture weights, within the stored ratios' steps."""
    seen, em = [], scoring.weights_by_em
    monkeypatch.setattr(scoring, "weights_by_em", lambda hist: seen.append(em(hist)) or seen[-1])
    got = by_id(scoring.score_documents(docs))
    want = brute.mixture_scores(rows, seen[-1])
    assert all(abs(got[i].score - x) <= 2.3e-4 * got[i].n_tokens for i, x in want.items())
    weights = brute.mixture_weights(rows)  # EM on the deleted ratios themselves, not on a histogram
    assert all(abs(seen[-1][b] - w) < 0.03 for b, w in weights.items()) and len(weights) > 3


def test_em_finds_the_mixture():
    import numpy as np

    hist = np.zeros((scoring.BUCKETS, 1 + scoring.CELLS))
    hist[3, 0], hist[3, 1 + int((4 - scoring.LOW) / scoring.STEP)] = 600, 400
    hist[5, 1 + int((4 - scoring.LOW) / scoring.STEP)] = 10
    lam = scoring.weights_by_em(hist)
    assert 0.3 < lam[3] < 0.4 and lam[5] > 0.99 and lam[7] == 0.5


def test_contamination(spark, rows, docs):
    long = rows[20][1].split()
    items = [(1, " ".join(long[:20]).upper()), (2, "a b"), (3, None), (4, ""), (5, "never-seen words only here in this item that is long enough to make windows of it"), (6, rows[30][1])]
    bench = spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, n_hit string")
    want = brute.contamination(rows, items)
    for blocks in (16_000_000, 300):
        got = by_id(decontaminate.contamination(docs, bench, block_bytes=blocks))
        assert {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in got.items()} == want
        assert {i: r.longest_match for i, r in got.items()} == brute.longest_matches(rows, items)
    assert any(x[4] for x in want.values())
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def test_contamination_without_or_with_the_same_ids(spark):
    """One block and many give the same rows, one a document, for missing and repeated ids."""
    words = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    items = [(None, words("p", 20)), (1, words("p", 20) + " more"), (1, words("q", 15)), (2, words("r", 30)), (3, "short item")]
    rows = [(None, "x " + words("p", 20)), (None, "clean"), (7, words("q", 15) + " y " + words("r", 14)), (7, "a short item"), (7, None), (8, words("p", 19) + " " + words("p", 14))]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(str, decontaminate.contamination(docs, bench, block_bytes=b).collect())) for b in (10**6, 100))
    assert one == many and len(one) == len(rows)
    got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.longest_match, r.match_word, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {(None, 21): (20, 1, 20, 1, True), (None, 1): (0, 0, 0, None, False), (7, 30): (29, 2, 15, 0, True), (7, 3): (2, 1, 2, 1, True), (7, 0): (0, 0, 0, None, False), (8, 33): (33, 1, 19, 0, True)}


def test_mixing(spark, rows):
    r = random.Random(6)
    full = [(i, t, [None, "a", "b", "c", "d"][r.choice([0, 1, 1, 1, 1, 2, 3, 4])]) for i, t in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, source string")
    got = mixing.mix_sources(df, range_docs=7).collect()
    assert sorted(got) == sorted(mixing.mix_sources(df.repartition(3), range_docs=7).collect())
    size = {i: len(brute.WORD.findall(t or "")) for i, t in rows}
    src = {i: s for i, _, s in full}
    totals = {s: sum(size[i] for i in src if src[i] == s) for s in sorted({x for x in src.values() if x}) + [None]}
    want = brute.targets(totals)
    taken = {s: 0 for s in totals}
    for x in got:
        assert x.size == size[x.doc_id] and x.source_size == totals[src[x.doc_id]] and x.target == pytest.approx(want[src[x.doc_id]])
        assert 0 <= x.taken <= 3 * x.size and x.taken // max(1, x.size) >= int(x.target // max(1, x.source_size)) * (x.size > 0)
        taken[src[x.doc_id]] += x.taken
    assert all(abs(taken[s] - want[s]) < 1 for s in totals)
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_mixing_equals_sql(spark, rows):
    import duckdb

    df = spark.createDataFrame([(i, t, None if i % 9 == 0 else f"s{i % 4}") for i, t in rows], "doc_id long, text string, source string")
    documents = df.toArrow()
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(tuple(r) for r in mixing.mix_sources(df).collect()) == sorted(con.sql(mixing.ORACLE).fetchall())
