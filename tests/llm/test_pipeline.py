"""The pipeline's stages against what their operators decide."""

import corpus_pipeline as C
from quern.llm import secrets

from . import brute
from .test_operators import corpus


def test_stages(spark, tmp_path):
    rows = corpus(120, seed=8)
    items = [(1, rows[11][1]), (2, rows[40][1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    full = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    columns, texts = docs.columns, dict(rows)
    seen = [sorted(texts)]
    for i, (_, stage) in enumerate(C.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"s{i}"))
        docs = spark.read.parquet(str(tmp_path / f"s{i}"))
        if i < 4:
            assert docs.columns == columns
        seen.append(sorted(r.doc_id for r in docs.collect()))
        if i == 3:
            after = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    kept = seen[1]
    assert all(not brute.quality(texts[i])[5] for i in kept)
    groups = brute.jaccard([(i, texts[i]) for i in kept])
    assert seen[2] == [i for i in kept if groups[i][1] == i]
    bad = brute.contamination([(i, texts[i]) for i in seen[2]], items)
    assert seen[3] == [i for i in seen[2] if not bad[i][4]] and len(seen[3]) < len(seen[2])
    assert seen[4] == seen[3] == seen[5]
    for i, (t, n) in after.items():
        assert t == secrets.redact(texts[i], brute.line(brute.secrets(texts[i]))) and n == len(t)
    assert sorted(map(tuple, C.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_and_odd_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string"
    words = " ".join(f"w{k}" for k in range(30))
    for name, rows in (("none", []), ("odd", [(1, words, None, None, None, "k"), (1, words, None, None, None, "k"), (None, words + " x", "en", "s", 3, "k"), (2, None, "en", "s", 0, None)])):
        docs = spark.createDataFrame(rows, schema)
        for k, (_, stage) in enumerate(C.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            docs.write.parquet(str(tmp_path / f"{name}{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{k}"))
        assert sorted(str(r.doc_id) for r in docs.collect()) == ([] if name == "none" else ["1", "None"])


def test_columns_of_any_name_and_kind(spark, tmp_path):
    """A column named as an older intermediate one, and a map beside repeated ids."""
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words, "en", "s", 3, 7, {"b": 2}), (1, words, "en", "s", 3, 7, {"a": 1}), (2, words + " and some more", "en", "s", 3, None, None), (3, "short", "en", "s", 3, 1, {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bad_row long, more map<string, int>")
    for k, (_, stage) in enumerate(C.STAGES[:4]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
    assert [(r.doc_id, r.bad_row, r.more) for r in docs.collect()] == [(1, 7, {"a": 1})]
