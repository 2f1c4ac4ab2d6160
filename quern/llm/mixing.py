"""Mixing sources to target weights (Efraimidis-Spirakis), native SQL only.

Each document gets the exponential key of weighted sampling without
replacement, u ** (1 / quality weight) with u from a hash of its id; documents
are read by falling key within their source until the source's word budget is
used up. Whole epochs are taken first and the remainder by the key order; the
document at the budget's edge is cut there, so a source's taken words are its
target rounded down.

Defined results: null or blank texts have size 0 and take 0; a null source is
a source of its own and comes last; equal keys are read by id and size;
repeated ids are separate documents of the same key; no documents give no
rows; other columns of the input are ignored.

No source meets in one task: keys are cut into ranges (about RANGE_DOCS documents
each; the fourth root of the key evens the ranges out to four times that at most), ranges are summed
first, and prefix sums run over the totals of blocks of RANGES ranges, over the ranges of a block, and inside
a range. One row a source is all that meets in one task, to share the budget out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import maybe_broadcast, saved

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
RANGE_DOCS, RANGES = 2000, 1000
#: Mean word lengths of running text.
USUAL_WORD = (3.0, 10.0)
BLANKS = " \t\n\x0b\x0c\r"


def quality_weight(size, letters):
    """Documents of under 200 words are drawn less often, down to half, and those whose
    words are no running text's by their mean length half as often again: 0.25 to 1."""
    mean = letters.cast("double") / F.greatest(size, F.lit(1)).cast("double")
    usual = F.when((mean >= F.lit(USUAL_WORD[0])) & (mean <= F.lit(USUAL_WORD[1])), F.lit(1.0)).otherwise(F.lit(0.5))
    return (F.lit(0.5) + F.lit(0.5) * F.least(F.lit(1.0), size.cast("double") / F.lit(200.0))) * usual


def hashed_uniform(col):
    """(0, 1] from the first 52 bits of the id's md5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return (bits + 1).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(sk, source_size, n_docs, target): weights by code point order of the
    source, capped at max_epochs times its size; the excess is reshared by
    weight, which is the level at which all uncapped sources meet."""
    n = len(weights)
    per = sizes.groupBy("sk").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = W.orderBy("sk")
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(n)) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    everything = W.partitionBy(F.lit(1))
    per = per.withColumn("ratio", F.col("cap") / F.col("w")).withColumn("total", F.sum("source_size").over(everything).cast("double") * F.lit(share))
    order = everything.orderBy("ratio", "sk")
    per = per.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    per = per.withColumn("level", (F.col("total") - F.col("before")) / F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sk"))).over(everything)
    per = per.withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("w")))
    return per.select("sk", "source_size", "n_docs", target.alias("target"))


def mix_sources(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=SOURCE_WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, range_docs: int = RANGE_DOCS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sizes = saved(docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("0"), F.col(source_col).cast("string")), F.lit("1")).alias("sk"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.coalesce(F.length(F.translate(F.col(text_col), BLANKS, "")), F.lit(0)).cast("long").alias("letters"),
    ))
    targets = saved(source_targets(sizes, weights, share, max_epochs))
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0)).cast("long")
    d = sizes.join(maybe_broadcast(targets), "sk")
    d = d.withColumn("p", F.pow(hashed_uniform(F.col("doc_id")), F.lit(1.0) / quality_weight(F.col("size"), F.col("letters"))))
    d = d.withColumn("range", F.floor((F.lit(1.0) - F.pow("p", F.lit(0.25))) * F.ceil(F.col("n_docs") / F.lit(range_docs))).cast("long"))
    d = d.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + F.lit(1e-6)).cast("long"))
    ranges = d.groupBy("sk", "range").agg(F.sum("size").alias("range_size"))
    ranges = ranges.withColumn("block", F.floor(F.col("range") / RANGES))
    blocks = ranges.groupBy("sk", "block").agg(F.sum("range_size").alias("block_size"))
    blocks = blocks.withColumn("ahead", F.sum("block_size").over(W.partitionBy("sk").orderBy("block")) - F.col("block_size")).drop("block_size")
    inside = F.sum("range_size").over(W.partitionBy("sk", "block").orderBy("range")) - F.col("range_size")
    ranges = ranges.withColumn("inside", inside).join(blocks, ["sk", "block"]).select("sk", "range", (F.col("ahead") + F.col("inside")).alias("offset"))
    d = d.join(ranges, ["sk", "range"])
    within = W.partitionBy("sk", "range").orderBy(F.desc("p"), "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    start = F.col("offset") + F.sum("size").over(within) - F.col("size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - start))
    return d.withColumn("part", part).select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


#: DuckDB SQL of the same rows.
ORACLE = r"""
WITH s AS (SELECT doc_id, coalesce('0' || source, '1') AS sk,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce(length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')), 0)::BIGINT AS letters FROM documents),
p AS (SELECT sk, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM s GROUP BY sk),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY sk) - 1) % 3 + 1)::INT]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM p),
r AS (SELECT *, cap / w AS ratio, sum(source_size) OVER ()::DOUBLE AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(w) OVER (ORDER BY ratio, sk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r),
v AS (SELECT lev FROM l WHERE lev <= ratio ORDER BY ratio, sk LIMIT 1),
t AS (SELECT sk, source_size, n_docs, CASE WHEN (SELECT lev FROM v) IS NULL THEN cap ELSE least(cap, (SELECT lev FROM v) * w) END AS target FROM l),
d AS (SELECT s.doc_id, s.size, t.sk, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(3, floor(t.target / t.source_size))::BIGINT ELSE 0 END AS epochs,
    pow((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496.0,
        1.0::DOUBLE / ((0.5::DOUBLE + 0.5::DOUBLE * least(1.0::DOUBLE, s.size::DOUBLE / 200.0::DOUBLE))
            * CASE WHEN s.letters::DOUBLE / greatest(s.size, 1) BETWEEN 3.0 AND 10.0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)) AS p
    FROM s JOIN t USING (sk)),
e AS (SELECT *, floor(target - epochs * source_size + 0.000001)::BIGINT AS rest,
    (sum(size) OVER (PARTITION BY sk ORDER BY p DESC, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start FROM d)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken FROM e
"""
