"""Ranked lexical search by a threshold-seeded join.

`ranked` gives every item's k documents of the highest score, where a document
scores c * w * ((1000000000 * tf) div (1000 * tf + 8 * m)) for each of the
item's terms (c: its occurrences in the item).

1. Postings (document, term, tf) of the items' terms are counted in one pass
   over the documents and stored, with one more row per document for N and L.
2. Each term stores its k best impacts: the k-th bounds the k-th score of every
   item that holds the term from below, the best bounds its share from above.
   The documents behind the stored impacts are scored exactly; the k-th best of
   them is the item's seed where it is higher.
3. An item's terms, by rising upper bound, are pruned as long as their bounds
   add up to less than a part (PRUNED) of the seed: a document that holds only
   such terms cannot be among the k best. The other terms generate candidates;
   one whose sum and the pruned terms' bounds stay below the seed goes.
4. What is left is scored exactly over all terms of the item and ranked.

Nothing is capped: bounds are strict, so that ties with the k-th stay in. Terms
never meet in one task (counts and best impacts are partial first), and only
the items' side of a join is broadcast, after its rows were counted.

Defined cases: a null or empty text has no term, and a document without terms
is not counted; rows of documents are documents of their own, whatever their
ids, and null ids come last among equal scores; rows that share an item_id
(nulls too) are one item with all their terms; items without a scoring document
have no rows; empty tables give none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import maybe_broadcast, saved

#: Fixed by the contract of the query: what separates terms.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The term of the row that every document has for itself.
WHOLE = -1
#: Part of an item's seed that the bounds of its pruned terms may add up to. Above 0 and at most 1; it moves work
#: between counting candidates (more terms) and rescoring them (more candidates), and results are the same.
PRUNED = 0.25


def _terms(text):
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS, -1), "")


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(place, doc_id, n, term, tf) of the terms of vocabulary (word, term); place tells rows apart, and
    every document with a term has a row of term WHOLE."""
    rows = docs.select(F.monotonically_increasing_id().alias("place"), F.col("doc_id").cast("long").alias("doc_id"), _terms(F.col("text")).alias("words")).where(F.size("words") > 0)
    each = rows.select("place", "doc_id", F.size("words").cast("long").alias("n"), F.explode(F.array_append("words", "")).alias("word"))
    whole = docs.sparkSession.createDataFrame([("", WHOLE)], "word string, term long")
    known = each.join(maybe_broadcast(vocabulary.unionByName(whole)), "word")
    return known.groupBy("place", "doc_id", "n", "term").agg(F.count("*").alias("tf"))


def _scores(pairs: DataFrame, impacts: DataFrame, parts: DataFrame) -> DataFrame:
    """(item, place, doc_id, score) of pairs (item, place), over all terms of the item."""
    held = impacts.join(pairs, "place").join(maybe_broadcast(parts), ["item", "term"])
    return held.groupBy("item", "place", "doc_id").agg(F.sum(F.col("c") * F.col("impact")).alias("score"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents of a score above 0, ties by doc_id."""
    names = saved(items.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()))
    words = items.join(names, items["item_id"].eqNullSafe(names["item_id"])).select("item", F.explode(_terms(F.col("text"))).alias("word"))
    words = saved(words.groupBy("item", "word").agg(F.count("*").alias("c")))
    vocabulary = saved(words.select("word").distinct().withColumn("term", F.monotonically_increasing_id()))
    held = saved(postings(docs, vocabulary))

    size = held.where(F.col("term") == WHOLE).agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    held = held.where(F.col("term") != WHOLE)
    weight = F.floor(1000 * F.log(F.lit(2.0 * size.n + 2) / (2 * F.col("df") + 1)))
    weights = saved(held.groupBy("term").agg(F.count("*").alias("df")).select("term", "df", weight.alias("w")))
    # integer division; w, m and impact are whole numbers of 64 bits
    fraction = F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)")
    length = F.expr(f"100 - 75 + (75 * n * {size.n}) div {size.l or 1}")
    impacts = held.join(maybe_broadcast(weights.where("w > 0").select("term", "w")), "term").withColumn("m", length).select("place", "doc_id", "term", (F.col("w") * fraction).alias("impact"))

    order = W.partitionBy("term").orderBy(F.desc("impact"), "place")
    stored = saved(impacts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k))
    bounds = stored.groupBy("term").agg(F.max("impact").alias("most"), F.max(F.when(F.col("r") == k, F.col("impact"))).alias("kth"))
    parts = words.join(vocabulary, "word").join(bounds, "term")
    parts = saved(parts.select("item", "term", "c", (F.col("c") * F.col("most")).alias("bound"), (F.col("c") * F.col("kth")).alias("kth")))

    near = saved(parts.select("item", "term").join(stored.select("term", "place"), "term").select("item", "place").distinct())
    exact = _scores(near, impacts.join(maybe_broadcast(near.select("place").distinct()), "place", "left_semi"), parts.select("item", "term", "c"))
    best = W.partitionBy("item").orderBy(F.desc("score"), "place")
    kth = exact.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("item").agg(F.max(F.when(F.col("r") == k, F.col("score"))).alias("scored"))
    seeds = parts.groupBy("item").agg(F.max("kth").alias("kth")).join(kth, "item", "left").select("item", F.coalesce(F.greatest("kth", "scored"), F.lit(0)).alias("seed"))

    rising = W.partitionBy("item").orderBy("bound", "term").rowsBetween(W.unboundedPreceding, 0)
    cut = saved(parts.join(seeds, "item").withColumn("below", F.sum("bound").over(rising)))
    pruned = F.col("below") < F.col("seed") * PRUNED
    rest = cut.groupBy("item", "seed").agg(F.coalesce(F.max(F.when(pruned, F.col("below"))), F.lit(0)).alias("rest"))
    seen = impacts.join(maybe_broadcast(cut.where(~pruned).select("item", "term", "c")), "term").groupBy("item", "place").agg(F.sum(F.col("c") * F.col("impact")).alias("part"))
    candidates = saved(seen.join(F.broadcast(rest), "item").where("part + rest >= seed").select("item", "place"))

    scores = _scores(candidates, impacts, parts.select("item", "term", "c")).where("score > 0")
    last = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "place")
    top = scores.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return top.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE = """
WITH d AS (
    SELECT row_number() OVER () AS place, doc_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), docs AS (SELECT place, doc_id, words, len(words)::BIGINT AS n FROM d WHERE len(words) > 0),
size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM docs),
parts AS (
    SELECT item_id, word, count(*)::BIGINT AS c
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark)
    GROUP BY item_id, word
), tf AS (
    SELECT place, doc_id, n, word, count(*)::BIGINT AS tf
    FROM (SELECT place, doc_id, n, unnest(words) AS word FROM docs)
    WHERE word IN (SELECT word FROM parts) GROUP BY place, doc_id, n, word
), weights AS (
    SELECT word, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT word, count(*)::BIGINT AS df FROM tf GROUP BY word), size
), impacts AS (
    SELECT place, doc_id, word, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS impact
    FROM tf JOIN weights USING (word), size
), scores AS (SELECT item_id, place, doc_id, sum(c * impact)::BIGINT AS score FROM parts JOIN impacts USING (word) GROUP BY item_id, place, doc_id)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, place)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
) WHERE rank <= 10
"""
