"""A training-corpus pipeline of five operators.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.

1. quality_rules: documents that the adaptive quality rules reject go.
2. near_duplicates: of every component of the n-gram Jaccard join the document
   of the smallest id stays; documents without words have no links and stay.
3. decontaminate: documents contaminated by benchmark passages go.
4. redact_secrets: secrets in the texts are replaced by [KIND]; no rows go.
5. mix: one row per document with the words that the mix takes.

Rows that share a doc_id share their fate in stages 1 to 3 (an id is rejected
if any of its rows is); rows without an id are judged by what they hold in
stages 1 and 3 and kept by stage 2, whose choice goes by id (of several rows of one id the
least by its other columns stays); stage 4 redacts every row in place, whatever its id; an empty table gives an empty result; columns beside doc_id,
text, lang and source pass through, and n_chars follows the redacted text.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.llm import decontaminate, mixing, quality, secrets, setjoin
from quern.llm.common import saved


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs whose doc_id is not in ids (doc_id); null ids stay."""
    return docs.join(ids.where("doc_id is not null").distinct(), "doc_id", "left_anti").select(*docs.columns)


def _judged(docs: DataFrame, verdicts, bad: str, *held: str) -> DataFrame:
    """docs without the rows that verdicts(docs) finds bad. A row without an id
    goes by a hash of the columns it is judged by (nulls told from values)."""
    salt = F.lit("row without an id")
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(salt, *(x for c in held for x in (F.col(c).isNull(), F.col(c)))))
    name = f"bad_{uuid.uuid4().hex}"  # no column of docs has it
    out = verdicts(docs.withColumn("doc_id", own)).where(bad).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(out, own == F.col(name), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _judged(docs, quality.quality_verdicts, "not kept", "text", "lang", "source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = setjoin.document_components(docs)
    out = _without(docs, groups.where("component_id <> doc_id").select("doc_id"))
    # rows that share an id are one node; the least of them stays
    again = saved(groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return out
    rest = [c for c in docs.columns if c != "doc_id"]
    # maps and variants have no order; their JSON has
    order = [F.to_json(F.struct(c)) if re.search("map<|variant", docs.schema[c].dataType.simpleString()) else F.col(c) for c in rest]
    least = out.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return _without(out, again).unionByName(least.select("doc_id", *(F.col("row").getField(c).alias(c) for c in rest)))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _judged(docs, lambda x: decontaminate.contamination(x, benchmark), "contaminated", "text")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate_benchmark),
    ("redact_secrets", redact_secrets),
    ("mix", mix),
]

#: Quality sketches and the randomness battery have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs)
    return docs
