"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Fixed rules of the contract come first (base_failed). The method then replaces
fixed cutoffs by fences learnt from the corpus with KLL sketches per language
and source, merged upwards to languages and to the whole corpus, in two rounds:

1. Dense features (word_length): quartiles. A fence lies SPREAD scales from the
   median, where the scale is the distance from the median to the upper (or lower)
   quartile; texts shorter than the group's median length vary more, by the root of
   the ratio of lengths. Documents within CORE scales that pass the base are the core.
2. Sparse features (symbols, repeated lines, repeated words), whose quartiles are 0
   in most groups: the upper tail (TAILS) of the core alone, so that junk which its
   word lengths give away doesn't widen the fence against itself. The fence is the
   higher tail quantile plus its distance from the lower one. A document is beyond it
   if the lower limit of its own rate is, (sqrt(events) - 1)^2 events in place of
   what was counted (two standard deviations of a count), so that one event never is.

Small groups lean on the wider ones: a quantile is the mean of the group's own, weighted
by its documents, and that of the next wider level, weighted by LEAN documents, or TAIL_LEAN
(ten documents beyond the higher tail quantile) for tails. A group without core documents
has the wider level's tails; a corpus without any has no tail fence.

Defined results: a null or blank text has no words and fails the base; null
languages and sources are groups of their own; repeated rows are judged one by
one; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels as K
from .common import maybe_broadcast, pieces, saved

NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
SPREAD, CORE, LEAN = 8.0, 3.0, 50
LENGTH, QUARTILES = "length", (0.25, 0.5, 0.75)
TAILS, TAIL_LEAN = (0.9, 0.99), 1000
#: Rank errors below 0.2 % of the rows, which the tails need; groups of fewer rows than this are exact, so reruns agree.
KLL_K = 2000
#: sparse feature -> (events, what they are counted among, how many of these one event marks)
SPARSE = {"symbol_ratio": ("n_symbols", "n_words", 1), "dup_line_ratio": ("n_dup_lines", "n_lines", 1), "repeat_ratio": ("n_repeat_words", "n_words", WINDOW)}

FEATURES = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def text_features(col: pa.Array) -> dict[str, np.ndarray]:
    """Contract features of every text of an Arrow column."""
    data, offsets = K.string_buffers(col)
    starts, ends, first = K.word_bounds(data, offsets)
    n_docs, n_words = len(col), np.diff(first)
    cps = K.code_points(data)
    in_words = np.concatenate([[0], np.cumsum(cps[ends] - cps[starts])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    words = K.word_hashes(data, starts, ends, lower=False)
    # words inside windows of 8 that are found twice or more in the same text
    grams = K.gram_hashes(words, WINDOW)
    owner = np.repeat(np.arange(n_docs), n_words)
    repeat = np.zeros(n_docs, np.int64)
    if len(grams):
        whole = owner[: len(grams)] == owner[WINDOW - 1 :]
        at = np.flatnonzero(whole)
        key = K.mix(grams[at] ^ K.mix(owner[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        twin = np.zeros(len(at), bool)
        same = ordered[1:] == ordered[:-1]
        twin[order[1:]] |= same
        twin[order[:-1]] |= same
        diff = np.zeros(len(words) + 1, np.int64)
        hit = at[twin]
        np.add.at(diff, hit, 1)
        np.add.at(diff, hit + WINDOW, -1)
        repeat = np.bincount(owner[np.cumsum(diff[:-1]) > 0], minlength=n_docs)
    # \n-split lines with a word that equal an earlier line of their text
    line_start, line_end, line_first = K.word_bounds(data, offsets, NEWLINE)
    line_doc = np.repeat(np.arange(n_docs), np.diff(line_first))
    wordy = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    a, b, doc = line_start[wordy], line_end[wordy], line_doc[wordy]
    h = K.mix(K.word_hashes(data, a, b, lower=False) ^ K.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, once = np.unique(h, return_index=True)
    dup = np.bincount(doc, minlength=n_docs) - np.bincount(doc[once], minlength=n_docs)
    return {
        "n_words": n_words, "word_chars": in_words[first[1:]] - in_words[first[:-1]], "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": dup, "n_repeat_words": repeat, "n_lines": np.bincount(doc, minlength=n_docs),
    }


def _feature_batches(batches):
    for b in pieces(batches):
        f = text_features(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), b.column("source"), *(pa.array(x, pa.int64()) for x in f.values())], ["doc_id", "lang", "source", *f])


def quality_features(docs: DataFrame) -> DataFrame:
    picked = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    return picked.mapInArrow(_feature_batches, FEATURES)


def _ratios(f: DataFrame) -> DataFrame:
    rate = lambda events, among: F.col(events) / F.greatest(F.col(among), F.lit(1))
    sparse = {x: rate(events, among) for x, (events, among, _) in SPARSE.items()}
    return f.withColumns({**sparse, "word_length": rate("word_chars", "n_words"), LENGTH: F.col("n_words").cast("double")})


def group_quantiles(features: DataFrame, names: list[str], at: tuple[float, ...], lean: int) -> tuple[DataFrame, DataFrame, list]:
    """Quantiles `at` of every column of `names`: (by language and source, by language, of the corpus).

    The first has own_<x>, the second wide_<x> (already leaning on the corpus), arrays as long as `at`;
    the last is one list of arrays, None where there are no rows.
    """
    sketch = [F.kll_sketch_agg_double(F.col(x), F.lit(KLL_K)).alias(x) for x in names]
    sketches = saved(features.groupBy("lang", "source").agg(F.count("*").alias("n"), *sketch))

    def read(df, tag, n):
        values = [F.array(*(F.kll_sketch_get_quantile_double(F.col(x), F.lit(q)) for q in at)).alias(f"{tag}_{x}") for x in names]
        return df.select(*[c for c in ("lang", "source") if c in df.columns], F.col("n").alias(n), *values)

    def merged(*keys):
        return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(F.col(x)).alias(x) for x in names))

    corpus = read(merged(F.lit(1)), "all", "n").first()  # one row of a few numbers; none of an empty table
    whole = [corpus[f"all_{x}"] if corpus else None for x in names]
    wide = read(merged("lang"), "wide", "n_wide")
    if corpus:
        wide = wide.withColumns({f"wide_{x}": _lean(f"wide_{x}", "n_wide", F.array(*map(F.lit, w)), lean) for x, w in zip(names, whole, strict=True)})
    return read(sketches, "own", "n_own"), wide, whole


def _lean(own: str, n: str, wider, lean: int):
    return F.zip_with(F.col(own), wider, lambda a, b: (F.col(n) * a + F.lit(lean) * b) / (F.col(n) + F.lit(lean)))


def with_quantiles(groups: DataFrame, features: DataFrame, names: list[str], at: tuple[float, ...], lean: int) -> DataFrame:
    """groups (q_lang, q_source, ...) with q_<x>: its quantiles of `features`, leaning on the wider levels."""
    own, wide, whole = group_quantiles(features, names, at, lean)
    j = groups.join(own, F.col("q_lang").eqNullSafe(own["lang"]) & F.col("q_source").eqNullSafe(own["source"]), "left").drop("lang", "source")
    j = j.join(wide, F.col("q_lang").eqNullSafe(wide["lang"]), "left").drop("lang")

    def value(x, w):
        corpus = F.array(*map(F.lit, w)) if w else F.lit(None).cast("array<double>")
        wider = F.coalesce(F.col(f"wide_{x}"), corpus)
        return F.coalesce(_lean(f"own_{x}", "n_own", wider, lean), wider).alias(f"q_{x}")

    return j.select(*groups.columns, *(value(x, w) for x, w in zip(names, whole, strict=True)))


def _far(scales: float):
    """Whether the word length lies more than so many scales from its group's median."""
    x = F.col("word_length")
    low, mid, high = (F.element_at("q_word_length", k) for k in (1, 2, 3))
    short = F.sqrt(F.greatest(F.lit(1.0), F.element_at(f"q_{LENGTH}", 2) / F.greatest(F.col("n_words"), F.lit(1))))
    return (x - mid > F.lit(scales) * (high - mid) * short) | (mid - x > F.lit(scales) * (mid - low) * short)


def _beyond_tail(x: str):
    """Whether the lower limit of sparse feature x lies beyond its group's tail fence."""
    events, among, size = SPARSE[x]
    root = F.greatest(F.sqrt(F.col(events) / F.lit(size)) - F.lit(1.0), F.lit(0.0))
    low, high = (F.element_at(f"q_{x}", k) for k in (1, 2))
    return F.lit(size) * root * root / F.greatest(F.col(among), F.lit(1)) > high + (high - low)


def _of_group(f: DataFrame, limits: DataFrame) -> DataFrame:
    return f.join(limits, f["lang"].eqNullSafe(limits["q_lang"]) & f["source"].eqNullSafe(limits["q_source"]), "left")


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(REPEAT_PERCENT) * F.col("n_words"))


def fences(f: DataFrame) -> DataFrame:
    """(q_lang, q_source, q_<feature>): quartiles of the dense features, tails of the sparse ones among the core."""
    usable = f.where("n_words > 0")
    groups = usable.select(F.col("lang").alias("q_lang"), F.col("source").alias("q_source")).distinct()
    dense = saved(with_quantiles(groups, usable, ["word_length", LENGTH], QUARTILES, LEAN))
    core = _of_group(usable, maybe_broadcast(dense)).where(~_base_failed() & ~_far(CORE)).select("lang", "source", *SPARSE)
    return saved(with_quantiles(dense, core, list(SPARSE), TAILS, TAIL_LEAN))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: features, base_failed, kept and the features out of their fences."""
    f = _ratios(saved(quality_features(docs)))
    out = [*(F.when(_beyond_tail(x), F.lit(x)) for x in SPARSE), F.when(_far(SPREAD), F.lit("word_length"))]
    j = _of_group(f, maybe_broadcast(fences(f))).withColumn("base_failed", _base_failed()).withColumn("outlier_in", F.array_join(F.array_compact(F.array(*out)), ","))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("outlier_in") == "")).alias("kept"), "outlier_in")
