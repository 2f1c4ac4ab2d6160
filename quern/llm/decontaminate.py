"""Benchmark decontamination by suffix arrays over shards of training text.

A shard is a run of whole documents of one Arrow batch (about 2 MB of text),
its alphabet are hashed words. The shard's suffix array is kept sparse without loss: a suffix
whose first words (as many as the shortest benchmark window, QGRAM at most)
open no benchmark suffix can match no window, so it is left out before
sorting. The rest is sorted to a depth of DEPTH words, and every benchmark
suffix is found by binary search, which gives its matches, the
documents and word positions. Matches at consecutive words of a document and of an item
are one verbatim match, whose length and places are reported for the longest one. The benchmark goes to the
executors in blocks of about BLOCK_BYTES of text (some 40 MB of arrays), each block one pass over the documents; what
a pass finds comes back by the number of the document's row (its place in the input, which
scans of files repeat), so that one block and many give the same rows.

Defined results: null or wordless texts have no words and are clean; items
without words match nothing; items without an id hit but are not listed; items that share an id are
one; rows that share an id are judged one by one; of equally long matches the first in the document
and the least item counts; empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels as K
from .common import pieces

#: Bytes that part words: all ASCII but digits and lower-case letters.
SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
SEPARATOR[65:91] = False  # upper case is folded first
DEPTH, QGRAM, SHARE, BLOCK_BYTES = 13, 4, 20, 4_000_000


class Probe:
    """One block of the benchmark: its words, and its windows in suffix order."""

    def __init__(self, ids: list[int | None], texts: pa.Array, depth: int = DEPTH):
        data, offsets = K.string_buffers(texts)
        starts, ends, first = K.word_bounds(data, offsets, SEPARATOR)
        self.depth, self.words = depth, K.word_hashes(data, starts, ends)
        n = np.diff(first)
        self.item = np.array([-1 if i is None else k for k, i in enumerate(ids)], np.int64)  # place in ids, -1 without an id
        self.ids, self.first = ids, first
        size = np.minimum(n, depth)
        count = np.where(n > 0, n - size + 1, 0)
        owner = np.repeat(np.arange(len(n)), count)
        at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(n) else [], count).astype(np.int64) + np.arange(int(count.sum()))
        self.q = int(min([QGRAM, *size[n > 0].tolist()]))
        self.heads = np.unique(K.gram_hashes(self.words, self.q)[at]) if len(at) else np.zeros(0, np.uint64)
        keys = _suffixes(self.words, at, size[owner], depth)
        order = np.lexsort((at, size[owner], keys))
        self.at, self.owner, self.size, keys = at[order], owner[order], size[owner][order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (self.size[1:] != self.size[:-1])
        self.group = np.flatnonzero(new)  # first window of each distinct one
        self.stop = np.append(self.group[1:], len(keys))
        self.keys: dict[int, np.ndarray] = {}  # of the distinct windows of each size, made by the worker

    def keys_of(self, size: int, own: np.ndarray) -> np.ndarray:
        if size not in self.keys:
            self.keys[size] = _suffixes(self.words, self.at[self.group[own]], np.full(len(own), size), size)
        return self.keys[size]

    def matches(self, words: np.ndarray, owner: np.ndarray):
        """(distinct window, position) of all occurrences inside one document."""
        none = np.zeros(0, np.int64)
        grams = K.gram_hashes(words, self.q)
        if not len(grams) or not len(self.heads):
            return none, none
        slot = np.minimum(np.searchsorted(self.heads, grams), len(self.heads) - 1)
        at = np.flatnonzero((self.heads[slot] == grams) & (owner[: len(grams)] == owner[self.q - 1 :]))
        if not len(at):
            return none, none
        left = np.searchsorted(owner, owner[at], "right") - at  # words to the document's end
        suffixes = _suffixes(words, at, left, self.depth)
        order = np.argsort(suffixes, kind="stable")
        suffixes, at, left = suffixes[order], at[order], left[order]
        windows, places = [none], [none]
        for size in np.unique(self.size).tolist():  # the windows of a size, searched in the suffixes cut to it
            own = np.flatnonzero(self.size[self.group] == size)
            keys = self.keys_of(size, own)
            cut = suffixes if size == self.depth else np.ascontiguousarray(suffixes.view(f"S{8 * self.depth}").astype(f"S{8 * size}"))
            low, high = np.searchsorted(cut, keys, "left"), np.searchsorted(cut, keys, "right")
            found = np.repeat(own, high - low)
            p = np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low) + np.arange(int((high - low).sum()))
            whole = left[p] >= size
            windows.append(found[whole])
            places.append(at[p][whole])
        return np.concatenate(windows), np.concatenate(places)

    def longest(self, windows: np.ndarray, places: np.ndarray, owner: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
        """Document -> (words, -place in the batch, -item's place, -word in the item) of its longest verbatim match."""
        count = self.stop[windows] - self.group[windows]
        w = np.repeat(self.group[windows] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else [], count).astype(np.int64) + np.arange(int(count.sum()))
        p = np.repeat(places, count)
        b, item = self.at[w], self.owner[w]
        order = np.lexsort((p, item, p - b))
        p, b, item, size = p[order], b[order], item[order], self.size[w[order]]
        new = np.ones(len(p), bool)
        if len(p):
            new[1:] = ((p - b)[1:] != (p - b)[:-1]) | (item[1:] != item[:-1]) | (p[1:] != p[:-1] + 1) | (owner[p[1:]] != owner[p[:-1]])
        run = np.flatnonzero(new)
        length = np.append(run[1:], len(p)) - run - 1 + size[run] if len(run) else run
        out: dict[int, tuple[int, int, int, int]] = {}
        for d, n, s, i, k in zip(owner[p[run]].tolist(), length.tolist(), p[run].tolist(), item[run].tolist(), (b[run] - self.first[item[run]]).tolist(), strict=True):
            out[d] = max(out.get(d, (0, 0, 0, 0)), (n, -s, -i, -k))
        return out


def _suffixes(words: np.ndarray, at: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
    """The words from each place, `size` at most, as bytes that sort like words; the rest are zeros."""
    reach = np.arange(depth)[None, :]
    if not len(at):
        return np.zeros(0, f"S{8 * depth}")
    keys = np.where(reach < size[:, None], words[np.minimum(at[:, None] + reach, len(words) - 1)] | np.uint64(1), np.uint64(0)).astype(">u8")
    return np.ascontiguousarray(keys).view(f"S{8 * depth}").ravel()


_RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
FOUND = "row long, doc_id long, n_words long, runs array<struct<a:long,b:long>>, items array<long>, n long, word long, item long, item_word long"


def _judge(probe: Probe, every: bool):
    """Hits of each document of a pass; documents without any are left out unless `every`."""
    def run(batches):
        for b in pieces(batches):
            data, offsets = K.string_buffers(b.column("text"))
            starts, ends, first = K.word_bounds(data, offsets, SEPARATOR)
            words, n_words = K.word_hashes(data, starts, ends), np.diff(first)
            owner = np.repeat(np.arange(b.num_rows), n_words)
            windows, places = probe.matches(words, owner)
            size = probe.size[probe.group[windows]] if len(windows) else windows
            diff = np.zeros(len(words) + 1, np.int64)
            np.add.at(diff, places, 1)
            np.add.at(diff, places + size, -1)
            hit = np.cumsum(diff[:-1]) > 0
            edge = np.ones(len(hit), bool)
            edge[1:] = owner[1:] != owner[:-1]
            opens = hit & (edge | np.concatenate([[True], ~hit[:-1]])) if len(hit) else hit
            closes = hit & np.concatenate([edge[1:] | ~hit[1:], [True]]) if len(hit) else hit
            runs, items = {}, {}
            for s, e in zip(np.flatnonzero(opens).tolist(), np.flatnonzero(closes).tolist(), strict=True):
                d = int(owner[s])
                runs.setdefault(d, []).append({"a": int(s - first[d]), "b": int(e + 1 - first[d])})
            pair = np.unique(np.stack([owner[places], windows], 1), axis=0) if len(windows) else np.zeros((0, 2), np.int64)
            for d, w in pair.tolist():
                own = items.setdefault(d, set())
                for i in np.unique(probe.item[probe.owner[probe.group[w] : probe.stop[w]]]).tolist():
                    if i >= 0:
                        own.add(probe.ids[i])
            best = probe.longest(windows, places, owner)
            keep = range(b.num_rows) if every else sorted(runs)
            far = [best.get(d) for d in keep]
            take = pa.array(list(keep), pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column("row").take(take), b.column("doc_id").take(take), pa.array(n_words, pa.int64()).take(take),
                pa.array([runs.get(d, []) for d in keep], _RUNS), pa.array([sorted(items.get(d, ())) for d in keep], pa.list_(pa.int64())),
                pa.array([x[0] if x else 0 for x in far], pa.int64()), pa.array([-x[1] - int(first[d]) if x else None for d, x in zip(keep, far, strict=True)], pa.int64()),
                pa.array([probe.ids[-x[2]] if x else None for x in far], pa.int64()), pa.array([-x[3] if x else None for x in far], pa.int64()),
            ], [c.split()[0] for c in FOUND.replace("struct<a:long,b:long>", "").split(", ")])

    return run


VERDICT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, longest_match long, match_word long, match_item long, item_word long"


def _merge(batches):
    """All passes' finds of a document: runs of hit words overlaid, items joined."""
    for b in batches:
        rows = []
        for i, n_words, runs, items, best in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_words", "runs", "items", "best")), strict=True):
            n_hit = end = 0
            for s, e in sorted((r["a"], r["b"]) for r in runs):
                n_hit += max(0, e - max(s, end))
                end = max(end, e)
            found = sorted(set(items))
            at = (None, None, None) if not best["n"] else (-best["w"], None if best["i"] is None else -best["i"], -best["k"])
            rows.append((i, n_words, n_hit, len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), best["n"], *at))
        names = [c.split()[0] for c in VERDICT.split(", ")]
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in VERDICT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(names), kinds, strict=True)], names)


def contamination(docs: DataFrame, benchmark: DataFrame, *, depth: int = DEPTH, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document with its hits and the verdict `contaminated`."""
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))

    def probe_of(k: int) -> Probe:
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy(F.col("item_id").asc_nulls_last(), "text").collect()  # about block_bytes of text
        return Probe([r[0] for r in rows], pa.array([r[1] for r in rows], pa.string()), depth)

    found = docs.mapInArrow(_judge(probe_of(0), True), FOUND)
    for k in range(1, blocks):
        found = found.unionByName(docs.mapInArrow(_judge(probe_of(k), False), FOUND))
    # every document's finds meet by its row: one of each pass at most
    best = F.max(F.struct("n", (-F.col("word")).alias("w"), (-F.col("item")).alias("i"), (-F.col("item_word")).alias("k")))
    met = found.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("items")).alias("items"), best.alias("best"))
    bad = (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
    return met.drop("row").mapInArrow(_merge, VERDICT).withColumn("contaminated", bad)


#: DuckDB SQL of the contract's columns (DEPTH, SHARE) where document ids are unique.
ORACLE = r"""
WITH f AS (SELECT doc_id, NULL::BIGINT AS item_id, text FROM documents UNION ALL SELECT NULL, item_id, text FROM benchmark),
t AS (SELECT doc_id, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM f),
u AS (SELECT doc_id, item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM t),
l AS (SELECT doc_id, item_id, n, pos, list(word) OVER (PARTITION BY doc_id, item_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS l FROM u),
b AS (SELECT DISTINCT item_id, least(13, n) AS size, array_to_string(l, ' ') AS k FROM l WHERE item_id IS NOT NULL AND len(l) = least(13, n)),
z AS (SELECT DISTINCT size FROM b),
h AS (SELECT doc_id, pos, size, array_to_string(list_slice(l, 1, size), ' ') AS k FROM l, z WHERE doc_id IS NOT NULL AND len(l) >= size),
m AS (SELECT doc_id, pos, size, item_id FROM h JOIN b USING (k, size)),
x AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM m GROUP BY 1),
y AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, pos, size FROM m) v, unnest(range(pos, pos + size)) q(p) GROUP BY 1)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM t LEFT JOIN x ON x.doc_id = t.doc_id LEFT JOIN y ON y.doc_id = t.doc_id WHERE t.item_id IS NULL AND t.doc_id IS NOT NULL
"""
