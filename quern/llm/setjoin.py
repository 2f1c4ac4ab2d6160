"""N-gram Jaccard self-join: equal or near-equal documents as components.

A document's set are the hashes of its distinct word n-grams. Two sets link
when PERCENT of their union is shared. Equal sets are one class from the start.

1. Lossless filter. By any fixed global order, two linking sets share at least
   ell(n) grams among their first n - need(n) + ell(n) (need: least overlap a
   partner must have). Batches ask hash buckets which of these grams occur in
   another class; a class with too few such grams links with nothing.
2. Prefix trees. Grams of the remaining classes are ordered rarest first, so
   that a class's first n - need(n) + 1 grams form its path. Paths meet under
   every shared gram. In each gram's subtree the least class is verified
   against the others first, and verified links are joined to components.
   Only subtrees that still hold two components are stored as tries and
   traversed: a probe shares the partial overlap of all paths below a node and
   leaves a node once the overlap so far and the remaining length can't reach
   the needed overlap (grams past the end of the probe's own path, which is cut
   where the row's may go on, count as possible hits). The pairs that survive are verified on whole sets.
   Large subtrees are dealt in blocks, so that no task holds one whole.

Thousands of near copies therefore cost a line of verified links, not all
pairs; no link between different texts is lost as far as components go.

Defined results: texts without words (null too) have an empty set and link
with nothing; fewer words than n give one gram; repeated rows are equal sets;
rows that share an id count as one node; null ids have no component; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import kernels as K, routing as R
from .common import BATCH_IDS, batched, bucket_count, components, release, saved

GRAM, PERCENT, BLOCK = 3, 90, 256


def needed(nx, ny, percent: int = PERCENT):
    """Least intersection of linking sets of nx and ny grams."""
    return -(-percent * (nx + ny) // (100 + percent))


def least_overlap(n, percent: int = PERCENT):
    """Least intersection with any partner (all of a smaller one, or this much)."""
    return -(-percent * n // 100)


def ell(n):
    return n // 20 + 1


def opening(s: np.ndarray, percent: int) -> np.ndarray:
    return s[: len(s) - least_overlap(len(s), percent) + ell(len(s))] if len(s) else s


class Batch:
    """Sets, set hashes and opening grams of a batch of documents."""

    def __init__(self, t: pa.Table, gram: int, percent: int):
        t = R.sorted_rows(t)
        self.ids = t["doc_id"].to_pylist()
        self.sets = []
        for b in t.to_batches():
            for part in _runs(b):
                data, offsets = K.string_buffers(part.column("text"))
                starts, ends, first = K.word_bounds(data, offsets)
                self.sets += K.sets_of_grams(K.word_hashes(data, starts, ends), first, gram)
        self.keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in self.sets]
        self.open = [opening(s, percent) for s in self.sets]
        grams = np.concatenate([*self.open, np.zeros(0, np.uint64)])
        owner = np.repeat(np.array([int.from_bytes(k[:8], "little") for k in self.keys], np.uint64), [len(o) for o in self.open])
        self.grams, place = np.unique(grams, return_inverse=True)
        low, high = np.full(len(self.grams), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(self.grams), np.uint64)
        np.minimum.at(low, place, owner)
        np.maximum.at(high, place, owner)
        self.marks = np.where(low == high, low, np.uint64(0))  # 0: several classes in this batch
        self.place = place


def _runs(b, limit: int = 4_000_000):
    from .common import pieces

    return pieces([b], limit=limit)


def shared_elsewhere(t: pa.Table) -> pa.Table:
    """Bucket: 1 for grams of two or more classes."""
    keys, marks, row = R.gather(t)
    _, place = np.unique(keys, return_inverse=True)
    n = place.max() + 1 if len(place) else 0
    low, high = np.full(n, np.iinfo(np.uint64).max, np.uint64), np.zeros(n, np.uint64)
    np.minimum.at(low, place, marks)
    np.maximum.at(high, place, marks)
    return R.reply(t, row, ((low != high) | (low == 0)).astype(np.uint8)[place])


def _verify(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(np.intersect1d(x, y, assume_unique=True)) >= needed(len(x), len(y), percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(keep, pa.int64())), b.column("b").take(pa.array(keep, pa.int64()))], ["a", "b"])

    return run


def verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    a = classes.select(F.col("cid").alias("a"), F.col("grams").alias("sa"))
    b = classes.select(F.col("cid").alias("b"), F.col("grams").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(_verify(percent), "a long, b long")


class Trie:
    """Paths of one gram's subtree. A node keeps the extremes below it."""

    def __init__(self):
        self.root = self._node()

    @staticmethod
    def _node():
        return {"next": {}, "rows": [], "least": 2**62, "most": 0, "tail": 0}

    def add(self, row, path):
        """row: (cid, n, at, label); path: grams after the subtree's own, in the global order of ints."""
        node = self.root
        for depth, g in enumerate([None, *path]):
            if depth:
                node = node["next"].setdefault(g, self._node())
            node["least"], node["most"] = min(node["least"], row[1]), max(node["most"], row[1])
            node["tail"] = max(node["tail"], row[1] - row[2] - 1 - depth)  # grams after this node
        node["rows"].append(row)

    def probe(self, row, path, percent):
        """Ids of other components whose overlap can still suffice. The row's
        set may hold any gram that comes after the last one of its path."""
        cid, n, at, label = row
        own, out, stack = set(path), set(), [(self.root, 1)]
        last = path[-1] if path else -1  # the subtree's own gram comes before all others of it
        while stack:
            node, shared = stack.pop()
            if node["most"] * 100 < percent * n or node["least"] * percent > 100 * n:
                continue
            if shared + min(node["tail"], n - at - shared) < needed(n, max(node["least"], least_overlap(n, percent)), percent):
                continue
            for c, m, p, l in node["rows"]:
                if l != label and 100 * min(m, n) >= percent * max(m, n) and min(m - p, n - at) >= needed(n, m, percent):
                    out.add(c)
            stack += [(child, shared + (g in own or g > last)) for g, child in node["next"].items()]
        return out


def _subtree(percent: int):
    def run(key, t):
        rows = t.to_pylist()
        trie, pairs = Trie(), set()
        # one int a gram that sorts as the global order does: how many classes hold it, then the gram
        after = lambda r, c, kind: np.frombuffer(r[c], kind)[r["at"] + 1 :].tolist()
        paths = [[f << 64 | g for f, g in zip(after(r, "freq", np.uint32), after(r, "path", np.uint64), strict=True)] for r in rows]
        own = [(r["cid"], r["n"], r["at"], r["label"]) for r in rows]
        for r, o, p in zip(rows, own, paths, strict=True):
            if r["block"] == key[1].as_py():
                trie.add(o, p)
        for r, o, p in zip(rows, own, paths, strict=True):
            if r["block"] == key[2].as_py():
                pairs |= {(max(o[0], c), min(o[0], c)) for c in trie.probe(o, p, percent)}
        return pa.table([pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.int64())], names=["a", "b"])

    return run


def document_components(docs: DataFrame, *, gram: int = GRAM, percent: int = PERCENT, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    t = batched(docs, id_col, text_col)

    def opening_grams(key, x):
        b = Batch(x, gram, percent)
        return R.ask(key[0].as_py(), b.grams, b.marks, buckets)

    def remaining(key, x, back):
        b = Batch(x, gram, percent)
        hit = R.answers(back, b.grams, buckets)[b.place].astype(np.int64)
        first = np.concatenate([[0], np.cumsum([len(o) for o in b.open])])
        sums = np.concatenate([[0], np.cumsum(hit)])
        count, seen, grams = sums[first[1:]] - sums[first[:-1]], set(), []
        for k, s, c in zip(b.keys, b.sets, count.tolist(), strict=True):
            grams.append(s.tobytes() if len(s) and k not in seen and c >= ell(len(s)) else None)
            seen.add(k)
        return pa.table([pa.array(b.ids, pa.int64()), pa.array([len(s) for s in b.sets], pa.int64()), pa.array(b.keys, pa.binary()), pa.array(grams, pa.binary())], names=["doc_id", "n", "key", "grams"])

    asked = t.groupBy("batch").applyInArrow(opening_grams, R.ASK)
    back = asked.groupBy("bucket").applyInArrow(shared_elsewhere, R.ANSWER)
    members = saved(t.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(remaining, "doc_id long, n long, key binary, grams binary"))
    release(spark)
    classes = saved(members.where("grams is not null").groupBy("key").agg(F.min("doc_id").alias("cid"), F.max("n").alias("n"), F.max("grams").alias("grams")).where("cid is not null").drop("key"))

    # rarest first: how many classes hold each gram
    c = classes.select(F.floor(F.col("cid") / BATCH_IDS).alias("batch"), "cid", "n", "grams")

    def all_grams(key, x):
        keys, counts = np.unique(np.concatenate([np.frombuffer(g, np.uint64) for g in x["grams"].to_pylist()]), return_counts=True)
        return R.ask(key[0].as_py(), keys, counts.astype(np.uint32), buckets)

    def frequency(x):
        keys, counts, row = R.gather(x, mark_type=np.uint32)
        _, place = np.unique(keys, return_inverse=True)
        total = np.bincount(place, counts)
        return R.reply(x, row, np.minimum(total, 2**32 - 1).astype(np.uint32)[place])

    def paths(key, x, back):
        if not x.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.binary()), pa.array([], pa.list_(pa.int64()))], names=["cid", "n", "path", "freq", "shared"])
        sets = [np.frombuffer(g, np.uint64) for g in x["grams"].to_pylist()]
        keys = np.unique(np.concatenate(sets))
        df = R.answers(back, keys, buckets, np.uint32)
        out, freq, shared = [], [], []
        for s in sets:
            f = df[np.searchsorted(keys, s)]
            order = np.lexsort((s, f))[: len(s) - least_overlap(len(s), percent) + 1]
            out.append(s[order].tobytes())
            freq.append(f[order].astype(np.uint32).tobytes())
            shared.append(np.flatnonzero(f[order] > 1).tolist())
        return pa.table([x["cid"], x["n"], pa.array(out, pa.binary()), pa.array(freq, pa.binary()), pa.array(shared, pa.list_(pa.int64()))], names=["cid", "n", "path", "freq", "shared"])

    counts = c.groupBy("batch").applyInArrow(all_grams, R.ASK).groupBy("bucket").applyInArrow(frequency, R.ANSWER)
    path = saved(c.groupBy("batch").cogroup(counts.groupBy("batch")).applyInArrow(paths, "cid long, n long, path binary, freq binary, shared array<long>"))

    release(spark)

    def post(batches):
        for b in batches:
            at = b.column("shared").to_pylist()
            size = [len(a) for a in at]
            grams = [np.frombuffer(p, np.int64)[a] for p, a in zip(b.column("path").to_pylist(), at, strict=True) if a]
            rep = lambda name: pa.array(np.repeat(np.array(b.column(name).to_pylist(), np.int64), size))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*grams, np.zeros(0, np.int64)])), rep("cid"), rep("n"), pa.array([i for a in at for i in a], pa.int64())], ["gram", "cid", "n", "at"])

    posts = saved(path.mapInArrow(post, "gram long, cid long, n long, at long"))
    fits = lambda n, m, p, q: (F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)) & (F.lit(100 + percent) * F.least(n - p, m - q) >= F.lit(percent) * (n + m))

    # the least class of each gram against the others; here and below aggregates are saved before they
    # are joined back on their key, so that both sides are dealt anew and a hot key's rows can be split
    hubs = saved(posts.groupBy("gram").agg(F.min(F.struct("cid", "n", "at")).alias("h"), F.count("*").alias("k")).where("k > 1"))
    lines = posts.join(hubs, "gram").where((F.col("cid") != F.col("h.cid")) & fits(F.col("n"), F.col("h.n"), F.col("at"), F.col("h.at")))
    links = saved(verified(lines.select(F.col("cid").alias("a"), F.col("h.cid").alias("b")).distinct(), classes, percent))
    labels = components(links).withColumnsRenamed({"id": "cid", "component": "label"})

    # subtrees that still hold two components
    named = saved(posts.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid")))
    slack = F.col("n") - F.ceil(F.lit(percent) * (F.col("n") + F.greatest(F.col("least_n"), F.ceil(F.lit(percent) * F.col("n") / 100))) / (100 + percent))
    split = lambda df: df.groupBy("gram").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.min("n").alias("least_n"), F.count("*").alias("k")).where("l <> h").drop("l", "h")
    live = saved(named.join(saved(split(named)), "gram").where(F.col("at") <= slack).select("gram", "cid", "n", "at", "label"))
    live = live.join(split(live), "gram").withColumn("blocks", F.ceil(F.col("k") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    live = live.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    live = live.select("gram", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cid", "n", "at", "label", "block").join(path.select("cid", "path", "freq"), "cid")
    more = live.groupBy("gram", "i", "j").applyInArrow(_subtree(percent), "a long, b long").distinct()
    links = links.union(saved(verified(more, classes, percent)))

    component = components(links).withColumnsRenamed({"id": "cid"})
    ids = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("cid"))
    ids = saved(ids.join(component, "cid", "left").select("key", F.coalesce("component", "cid").alias("component")))
    out = members.select("doc_id", "n", "key").join(ids, "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


#: DuckDB SQL of document_components' rows (GRAM, PERCENT) where ids are unique and not null.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
g AS (SELECT doc_id, n, list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS l, pos FROM u),
s AS (SELECT DISTINCT doc_id, array_to_string(l, ' ') AS k FROM g WHERE len(l) = 3 OR (n < 3 AND pos = 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN c a ON a.doc_id = x JOIN c b ON b.doc_id = y WHERE 100 * shared >= 90 * (a.n + b.n - shared)),
z AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT r.doc_id, z.y FROM r JOIN z ON z.x = r.m)
SELECT r.doc_id, coalesce(any_value(c.n), 0)::BIGINT AS n_shingles, min(m) AS component_id FROM r LEFT JOIN c ON c.doc_id = r.doc_id GROUP BY 1
"""
