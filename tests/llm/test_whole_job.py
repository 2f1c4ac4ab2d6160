"""Cases in which an operator once did less than its whole job."""

import random

import corpus_pipeline as C
from quern.llm import paragraphs, queries, setjoin

from . import brute
from .test_operators import by_id, corpus


def test_paragraphs_of_a_large_family_edited_apart(spark):
    """Copies that link with the original only, in bands of far more than SMALL classes."""
    r = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 601):
        w = list(base)
        for k in r.sample(range(5, 195), 4):
            w[k] = f"x{r.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    r.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = {i: x.removed_spans for i, x in by_id(paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"))).items()}
    want = brute.paragraphs(rows)
    lost = [i for i in want if want[i] and not got[i]]
    assert sum(map(bool, want.values())) > 550 and len(lost) <= 6 and not any(got[i] and not want[i] for i in want)


def test_jaccard_when_the_larger_set_probes(spark, monkeypatch):
    """Longer copies link with the base only, and meet it from either side of a block pair."""
    trie = setjoin.Trie()
    trie.add((1, 100, 0, 1), list(range(7, 17)))  # under gram 6: Y, whose path is 6 to 16
    assert trie.probe((2, 105, 5, 2), list(range(7, 12)), 90) == {1}  # X is Y and the rarer 1 to 5: its path ends at 11
    monkeypatch.setattr(setjoin, "BLOCK", 2)
    base = [f"w{k}" for k in range(100)]
    rows = [(0, " ".join(base + [f"z{k}" for k in range(14)])), (1, " ".join(base))]
    rows += [(i, " ".join(base + [f"x{i}y{k}" for k in range(8 + i % 3)])) for i in range(2, 30)]
    got = by_id(setjoin.document_components(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute.jaccard(rows)
    assert {i: tuple(x)[1:] for i, x in got.items()} == want and len({c for _, c in want.values()}) == 2


def test_pipeline_rows_without_an_id_of_their_own(spark, tmp_path):
    """Null and repeated ids: secrets, benchmark passages and junk are found row by row."""
    words = lambda tag, n=40: " ".join(f"{tag}{k}" for k in range(n))
    key = "password = abcdefGHIJKL0123"
    spark.createDataFrame([(1, words("bench"))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    texts = lambda df: sorted(r.text for r in df.collect())

    junk, good = " ".join(["again and again and again and again and"] * 8), words("good")
    assert texts(C.quality_rules(spark, frame([(None, junk), (None, good), (None, "few words"), (1, good)]), str(tmp_path))) == [good, good]
    leaked = words("bench") + " end"
    assert texts(C.decontaminate_benchmark(spark, frame([(None, leaked), (None, good), (2, leaked), (3, good)]), str(tmp_path))) == [good, good]
    rows = [(None, f"{words('a')} {key}"), (None, words("b")), (4, f"{key} {words('c')}"), (4, f"{words('d')} {key} end"), (4, words("e"))]
    redacted = C.redact_secrets(spark, frame(rows), str(tmp_path)).collect()
    assert sorted(r.text for r in redacted) == sorted(t.replace(key, "[ASSIGN]") for _, t in rows)
    assert all(r.n_chars == len(r.text) for r in redacted)


def test_paragraph_query_takes_short_lines(spark, tmp_path):
    """Lines of 5 to 24 words, hard-wrapped passages among them, against brute force without the floor."""
    wrapped = "\n".join(" ".join(f"p{k}q{j}" for j in range(10)) for k in range(6))
    rows = [*corpus(100, seed=21), (20_000, "one two three four five"), (20_001, "x\nOne two three four five\ntoo short line"), (20_002, wrapped), (20_003, "head\n" + wrapped)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {i: x.removed_spans for i, x in by_id(queries.op1_paragraph_dedup(spark, str(tmp_path))).items()}
    want = brute.paragraphs(rows, least=5)
    pairs = lambda x: {(i, s) for i, v in x.items() for s in v.split(",") if s}
    assert set(got) == set(want) and pairs(got) <= pairs(want) and len(pairs(got)) >= 0.97 * len(pairs(want))
    assert got[20_001] == want[20_001] != "" and len(got[20_003].split(",")) == 6


def test_batches_by_bytes(spark, monkeypatch):
    """Blocks over the byte limit are dealt id by id, rows without an id in batches of their own: the results stay."""
    from quern.llm import common, scoring, suffixes

    rows = corpus(120, seed=31)
    none = [(None, f"row without an id {k} " * 12) for k in range(700)]
    docs = spark.createDataFrame(rows + none, "doc_id long, text string").repartition(3)
    run = lambda: [
        {tuple(r) for r in suffixes.remove_repeats(docs).collect() if r.doc_id is not None}, {tuple(r) for r in setjoin.document_components(docs).collect() if r.doc_id is not None},
        {(r.doc_id, r.n_known, round(r.base_score, 6)) for r in scoring.score_documents(docs).collect() if r.doc_id is not None},
    ]
    whole = run()
    assert common.batched(docs).where("doc_id is null").select("batch").distinct().count() >= 2
    monkeypatch.setattr(common, "BATCH_BYTES", 2000)
    assert common.batched(docs).where("doc_id is not null").groupBy("batch").count().where("count > 1").count() < 10
    assert run() == whole and whole[0] == {(i, *x) for i, x in brute.suffixes(rows).items()}


def test_redaction_without_ids(spark):
    """Every row's own secrets go, whatever its other columns hold; nothing is joined."""
    from quern.llm import secrets

    key = "token = abcdefghijklmnop1234"
    rows = [(None, f"a {key}"), (1, f"{key} b"), (1, f"c c c {key}"), (2, None), (2, "")]
    got = secrets.redact_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t).replace(key, "[ASSIGN]")) for i, t in rows)


def test_passages_in_other_surroundings(spark, tmp_path):
    """Passages of over 50 words inside longer lines and over other line breaks are found; clean texts are left alone."""
    r = random.Random(41)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9)))
    some = lambda n: [word() for _ in range(n)]
    wrap = lambda w: "".join(x + r.choice([" ", " ", " ", "\n"]) for x in w)
    passages = [some(r.randrange(52, 90)) for _ in range(20)]
    rows = [(i, wrap(some(r.randrange(40, 200)))) for i in range(200)]
    planted = [(1000 + i, wrap(some(r.randrange(5, 60))) + wrap(passages[i % 20]) + wrap(some(r.randrange(5, 60)))) for i in range(100)]
    spark.createDataFrame(rows + planted, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = by_id(queries.op1_paragraph_dedup(spark, str(tmp_path)))
    later = [i for i, _ in planted[20:]]
    assert sum(got[i].passage_words >= 25 for i in later) >= 0.95 * len(later)
    assert not any(got[i].passage_words for i, _ in rows + planted[:20])
    for i, t in rows + planted:
        n, gone = len(t.split()), (got[i].words_removed, got[i].passage_words)  # lines and passages may overlap
        assert got[i].n_words == n and n - sum(gone) <= got[i].words_kept <= n - max(gone)
