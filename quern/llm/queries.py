"""The queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from . import conversations, decontaminate, lexical, mixing, neighbours, paragraphs, personal, quality, scoring, secrets, setjoin, suffixes, warc


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_paragraph_dedup(spark, sf_dir):
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"), min_words=paragraphs.SHINGLE)


def op2_suffix_array_dedup(spark, sf_dir):
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op4_warc_round_trip(spark, sf_dir):
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op5_ngram_jaccard_join(spark, sf_dir):
    return setjoin.document_components(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark, sf_dir):
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op7_language_model_scores(spark, sf_dir):
    return scoring.score_documents(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_mix_sources(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_personal_data(spark, sf_dir):
    return personal.personal_spans(table(spark, sf_dir, "documents"))


def op11_turn_reassembly(spark, sf_dir):
    return conversations.digests(conversations.replay(table(spark, sf_dir, "conversations")))


def op12_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op13_ranked_search(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_paragraph_dedup, op2_suffix_array_dedup, op3_quality_rules, op4_warc_round_trip, op5_ngram_jaccard_join, op6_secret_scan, op7_language_model_scores, op8_decontaminate, op9_mix_sources, op10_personal_data, op11_turn_reassembly, op12_nearest_neighbours, op13_ranked_search)}
ORACLES = {"op4_warc_round_trip": warc.ORACLE, "op5_ngram_jaccard_join": setjoin.ORACLE, "op8_decontaminate": decontaminate.ORACLE, "op9_mix_sources": mixing.ORACLE, "op13_ranked_search": lexical.ORACLE}
