"""Substring deduplication by paragraphs: MinHash banding, exact Jaccard, components.

A text has paragraphs at two scales. A *line* of min_words words or more is
one (MIN_WORDS unless the caller says so; the query takes every line that has a
shingle). A *passage* is what lies between two content-defined breaks of the
word sequence, whatever its line breaks: a break stands before a word pair whose hash is
the least within REACH words either way, so a passage that is copied into other
surroundings has the same breaks inside, and its parts meet as sets of their own.

A paragraph's set are its distinct SHINGLE-word hashes; sets of fewer than
LEAST_NEAR link with equal sets only and have no bands. Bands of ROWS MinHash values
find pairs of Jaccard 0.8 with probability 0.998 (lines: 9 bands of 3) or 0.993
(passages: 7 of 3). Batches ask hash buckets which bands collide with a different
paragraph and which paragraphs occur again (40 key bits within a bucket; marks of 31
bits, so that two marks agree by chance once in 2e9); the rest is done with. Equal sets
are one class. In every band the least class by a salted hash is
verified against the others on whole sets (so a group of n classes meets one
such hub a band, n pairs each), links become components, and bands that still
hold several components are settled: all their cross pairs where they have at
most SMALL classes; larger ones get a second hub, of a class outside the
band's largest component, and what is still apart then is verified against the
whole band, block by block, so that no colliding pair that could join two
components is left out. Aggregates are
saved before they are joined back on their key, so that both sides are dealt
anew and a hot key's rows can be split. In every component the first line and the
first passage stay (smallest doc_id, then place). The other lines go, and the other
passages in runs of RUN words or more: repeated passages one after another, fewer than
SHINGLE words between them.

Defined results: null or wordless texts have no paragraphs; rows that share an
id are documents of their own, ordered by text; repeated rows are further
occurrences; null ids come last; an empty table gives no rows; other columns are
ignored. Spans are code points, ends exclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels as K, routing as R
from .common import batched, bucket_count, components, release, saved
from .quality import NEWLINE
from .setjoin import _runs, needed, verified

SHINGLE, MIN_WORDS, PERCENT, SMALL = 5, 25, 80, 32
#: Words either way within which a break's hash is the least; fewest words of a run of repeated passages that goes.
REACH, RUN = 8, 25
#: (bands, MinHash values a band) of lines and of passages.
LINE, PASSAGE = 0, 1
SHAPE = {LINE: (9, 3), PASSAGE: (7, 3)}
#: Most classes, and about the most bytes of sets, in a block of a large band.
BLOCK, BLOCK_BYTES = 512, 4_000_000
#: Fewest shingles with which another set can share PERCENT of the union: a of a + 1.
LEAST_NEAR = -(-PERCENT // (100 - PERCENT))
KEY_BYTES = 5
_rng = np.random.default_rng(99)
FACTOR = _rng.integers(1, 2**63, max(b * r for b, r in SHAPE.values()), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(1, 2**63, len(FACTOR), dtype=np.uint64)
NONE = np.uint64(2**64 - 1)


def band_keys(grams: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraphs x bands) keys of sets laid end to end (none of them empty)."""
    out = np.zeros((len(first) - 1, bands), np.uint64)
    if len(out):
        with np.errstate(over="ignore"):
            for k in range(bands * rows):
                low = np.minimum.reduceat(grams * FACTOR[k] + SHIFT[k], first[:-1])
                out[:, k // rows] = out[:, k // rows] * np.uint64(0x9E3779B97F4A7C15) + (low >> np.uint64(7))
            out = K.mix(out + np.arange(bands * 100 + rows, bands * 100 + rows + bands, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93))
    return out


def breaks(words: np.ndarray, first: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Places where a passage begins: every text's first word, and content-defined breaks."""
    n = len(words)
    begin = np.zeros(n, bool)
    if n:
        pair = np.full(n, NONE)
        with np.errstate(over="ignore"):
            pair[:-1] = K.mix(words[:-1] * K.GRAM_WEIGHT[2] + words[1:] * K.GRAM_WEIGHT[3])
        filled = first[1:][np.diff(first) > 0]
        pair[filled - 1] = NONE  # a text's last word opens no pair
        edge = np.full(reach, NONE)
        begin = (pair == K.sliding_min(np.concatenate([edge, pair, edge]), 2 * reach + 1)) & (pair != NONE)
        begin[first[:-1][np.diff(first) > 0]] = True
    return np.flatnonzero(begin)


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (size[i] of them) for all i, one after another."""
    skip = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(start - skip[:-1], size) + np.arange(skip[-1])


class Batch:
    """Paragraphs of a batch of documents: place, words, set, band keys."""

    def __init__(self, t: pa.Table, least: int, reach: int):
        t = R.sorted_rows(t)
        self.ids = t["doc_id"].to_pylist()
        none = np.zeros(0, np.int64)
        cols, grams, unit, self.n_lines, self.n_words = [[none] * 6], [np.zeros(0, np.uint64)], [none], [], []
        for b in t.to_batches():
            for part in _runs(b):
                base = len(self.n_lines)
                data, offsets = K.string_buffers(part.column("text"))
                starts, ends, first = K.word_bounds(data, offsets)
                hashes = K.word_hashes(data, starts, ends)
                ls, le, lf = K.word_bounds(data, offsets, NEWLINE)
                a, z = np.searchsorted(starts, ls), np.searchsorted(starts, le)
                line_of = np.repeat(np.arange(part.num_rows), np.diff(lf))
                self.n_lines += np.bincount(line_of[z > a], minlength=part.num_rows).tolist()
                self.n_words += np.diff(first).tolist()
                cps = K.code_points(data)
                on = z - a >= least
                pa_, word_of = breaks(hashes, first, reach), np.repeat(np.arange(part.num_rows), np.diff(first))
                pz = np.append(pa_[1:], len(hashes))
                pp = pz - pa_ >= SHINGLE
                pa_, pz = pa_[pp], pz[pp]
                w0, w1 = np.concatenate([a[on], pa_]), np.concatenate([z[on], pz])
                doc = np.concatenate([line_of[on], word_of[pa_]])
                lo, hi = np.concatenate([cps[ls[on]], cps[starts[pa_]]]), np.concatenate([cps[le[on]], cps[ends[pz - 1]]])
                kind = np.repeat([LINE, PASSAGE], [int(on.sum()), len(pa_)])
                order = np.lexsort((kind, w0))
                doc, w0, w1, lo, hi, kind = (x[order] for x in (doc, w0, w1, lo, hi, kind))
                zero, word = cps[offsets[doc]], first[doc]
                done = sum(len(c[0]) for c in cols)
                g = K.gram_hashes(hashes, SHINGLE)
                size = w1 - w0 - SHINGLE + 1
                grams.append(g[_flat(w0, size)])
                unit.append(np.repeat(np.arange(len(w0)) + done, size))
                cols.append([doc + base, w0 - word, w1 - word, lo - zero, hi - zero, kind])
        self.doc, self.w0, self.w1, self.lo, self.hi, self.kind = (np.concatenate(x).astype(np.int64) for x in zip(*cols, strict=True))
        grams, unit = np.concatenate(grams), np.concatenate(unit)
        order = np.lexsort((grams, unit))
        grams, unit = grams[order], unit[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (unit[1:] != unit[:-1])
        self.grams, unit = grams[new], unit[new]
        n = len(self.doc)
        self.size = np.bincount(unit, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        with np.errstate(over="ignore"):
            self.key = K.mix(np.add.reduceat(K.mix(self.grams ^ np.uint64(0x5DEECE66D)), self.first[:-1])) if n else np.zeros(0, np.uint64)
        # asked: bands (marked by their set) and sets (marked by the batch; 0 if twice in it)
        self.wide, flat = {}, []
        for k, (bands, rows) in SHAPE.items():
            at = self.wide[k] = np.flatnonzero((self.kind == k) & (self.size >= LEAST_NEAR))
            size = self.size[at]
            flat.append(band_keys(self.grams[_flat(self.first[at], size)], np.concatenate([[0], np.cumsum(size)]), bands, rows))
        own = (self.key >> np.uint64(32) | np.uint64(1)).astype(np.uint32)
        self.cut = np.cumsum([0, *(x.size for x in flat)])
        self.band = flat
        self.asked, self.place = np.unique(np.concatenate([*(x.ravel() for x in flat), K.mix(self.key)]), return_inverse=True)
        self.low, high = np.full(len(self.asked), 2**32 - 1, np.uint32), np.zeros(len(self.asked), np.uint32)
        marks = np.concatenate([*(np.repeat(own[self.wide[k]], SHAPE[k][0]) for k in SHAPE), np.arange(1, n + 1, dtype=np.uint32)])
        np.minimum.at(self.low, self.place, marks)
        np.maximum.at(high, self.place, marks)
        self.one = self.low == high

    def marks(self, batch: int) -> np.ndarray:
        m = np.where(self.one, self.low, np.uint32(0))
        is_set = np.zeros(len(m), bool)
        is_set[self.place[self.cut[-1] :]] = True
        mine = np.uint32(int(K.mix(np.array([batch % 2**64], np.uint64))[0]) >> 32 | 1)
        return np.where(is_set & self.one, mine, m)

    def hits(self, answer: np.ndarray) -> tuple[np.ndarray, dict[int, list[int]]]:
        """(paragraphs that occur again, paragraph -> its colliding bands)."""
        hit, bands = answer.astype(bool)[self.place], {}
        for i, (k, flat) in enumerate(zip(SHAPE, self.band, strict=True)):
            h = hit[self.cut[i] : self.cut[i + 1]].reshape(flat.shape)
            for r in np.flatnonzero(h.any(1)).tolist():
                bands[int(self.wide[k][r])] = flat[r][h[r]].view(np.int64).tolist()
        return np.flatnonzero(hit[self.cut[-1] :]), bands


def _shared(t: pa.Table) -> pa.Table:
    """Bucket: 1 for keys with two different marks, or an ambiguous one."""
    keys, marks, row = R.gather(t, KEY_BYTES, np.uint32)
    _, place = np.unique(keys, return_inverse=True)
    n = place.max() + 1 if len(place) else 0
    low, high = np.full(n, 2**32 - 1, np.uint32), np.zeros(n, np.uint32)
    np.minimum.at(low, place, marks)
    np.maximum.at(high, place, marks)
    return R.reply(t, row, ((low != high) | (low == 0)).astype(np.uint8)[place])


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 4096) -> np.ndarray:
    """(left x right) sizes of the intersections of sets, by incidence matrices of some grams at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[place] > 1
    col, owner = (np.cumsum(count > 1) - 1)[place][keep], owner[keep]
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, z = np.searchsorted(col, [low, low + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:z], col[a:z] - low] = 1
        out += m[left] @ m[right].T
    return out.astype(np.int64)


def _cross(percent: int):
    """Links that join components of two blocks of a band (one link a join)."""
    def run(key, t):
        cid, label, block = (np.array(t[c].to_pylist(), np.int64) for c in ("cid", "label", "block"))
        sets = [np.frombuffer(g, np.uint64) for g in t["grams"].to_pylist()]
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        up, a, b = {x: x for x in label.tolist()}, [], []

        def find(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        if len(left) and len(right):
            n = np.array([len(s) for s in sets], np.int64)
            hit = (overlaps(sets, left, right) >= needed(n[left][:, None], n[right][None, :], percent)) & (label[left][:, None] != label[right][None, :])
            for i, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
                x, y = find(int(label[left[i]])), find(int(label[right[j]]))
                if x != y:
                    up[x] = y
                    a.append(max(cid[left[i]], cid[right[j]]))
                    b.append(min(cid[left[i]], cid[right[j]]))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


PARTS = "batch long, row int, doc_id long, place int, kind int, n_lines long, n_words long, w0 long, w1 long, start long, stop long, key long, grams binary, bands array<long>"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.binary(), pa.list_(pa.int64())]


def joined(spans: list[tuple[int, int, int, int]], gap: int, least: int) -> list[tuple[int, int, int, int]]:
    """Runs of (w0, w1, start, stop) with fewer than gap words between, of `least` words or more."""
    out: list[list[int]] = []
    for w0, w1, s, e in sorted(spans):
        if out and w0 - out[-1][1] < gap:
            out[-1][1], out[-1][3] = max(out[-1][1], w1), max(out[-1][3], e)
        else:
            out.append([w0, w1, s, e])
    return [tuple(r) for r in out if r[1] - r[0] >= least]


RESULT = "doc_id long, n_paragraphs long, n_words long, n_removed long, words_removed long, removed_spans string, n_passages long, passage_words long, passage_spans string, words_kept long"


def _result(run_words: int):
    line = lambda spans: ",".join(f"{s}:{e}" for *_, s, e in spans)

    def run(batches):
        for b in batches:
            rows = []
            for i, n_lines, n_words, gone in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_lines", "n_words", "gone")), strict=True):
                lines = sorted((g["w0"], g["w1"], g["start"], g["stop"]) for g in gone if g["kind"] == LINE)
                runs = joined([(g["w0"], g["w1"], g["start"], g["stop"]) for g in gone if g["kind"] == PASSAGE], SHINGLE, run_words)
                words = lambda spans: sum(w1 - w0 for w0, w1, *_ in spans)
                rows.append((i, n_lines, n_words, len(lines), words(lines), line(lines), len(runs), words(runs), line(runs), n_words - words(joined([*lines, *runs], 1, 0))))
            names = [c.split()[0] for c in RESULT.split(", ")]
            kinds = [pa.string() if c.endswith("string") else pa.int64() for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(names), kinds, strict=True)], names)

    return run


def repeated_paragraphs(docs: DataFrame, *, min_words: int = MIN_WORDS, reach: int = REACH, run_words: int = RUN, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: its paragraphs, the lines and the runs of passages that go, and the words left."""
    least = max(min_words, SHINGLE)
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    t = batched(docs, id_col, text_col)

    def ask(key, x):
        b = Batch(x, least, reach)
        return R.ask(key[0].as_py(), b.asked, b.marks(key[0].as_py()), buckets, KEY_BYTES)

    def sift(key, x, back):
        b, batch = Batch(x, least, reach), key[0].as_py()
        again, bands = b.hits(R.answers(back, b.asked, buckets))
        rows = [(batch, r, i, None, None, n, w, *[None] * 7) for r, (i, n, w) in enumerate(zip(b.ids, b.n_lines, b.n_words, strict=True))]
        seen = set()
        for p in sorted({*again.tolist(), *bands}):
            k = int(b.key[p].view(np.int64))
            near = p in bands and k not in seen
            if p in bands:
                seen.add(k)
            grams = b.grams[b.first[p] : b.first[p + 1]].tobytes() if near else None
            rows.append((batch, int(b.doc[p]), None, p, int(b.kind[p]), None, None, int(b.w0[p]), int(b.w1[p]), int(b.lo[p]), int(b.hi[p]), k, grams, bands[p] if near else None))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_KINDS)
        return pa.table([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=[c.split()[0] for c in PARTS.split(", ")])

    back = t.groupBy("batch").applyInArrow(ask, R.ASK).groupBy("bucket").applyInArrow(_shared, R.ANSWER)
    parts = saved(t.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(sift, PARTS))
    release(spark)
    component = class_components(parts).withColumnsRenamed({"id": "key"})

    found = parts.where("place is not null").select("batch", "row", "place", "kind", "w0", "w1", "start", "stop", "key").join(component, "key", "left").withColumn("group", F.coalesce("component", "key"))
    order = F.struct("batch", "place")
    kept = saved(found.groupBy("group", "kind").agg(F.min(order).alias("first")))
    gone = found.join(kept, ["group", "kind"]).where(order != F.col("first")).select("batch", "row", F.struct("kind", "w0", "w1", "start", "stop").alias("unit"))
    every = parts.where("place is null").select("batch", "row", "doc_id", "n_lines", "n_words").unionByName(gone, allowMissingColumns=True)
    heads = [F.max(c).alias(c) for c in ("doc_id", "n_lines", "n_words")]  # one head a document
    return every.groupBy("batch", "row").agg(*heads, F.collect_list("unit").alias("gone")).drop("batch", "row").mapInArrow(_result(run_words), RESULT)


def class_components(parts: DataFrame) -> DataFrame:
    """(id, component) of the classes that colliding bands and whole sets link."""
    classes = saved(parts.where("grams is not null").groupBy("key").agg(F.max("grams").alias("grams"), F.max("bands").alias("bands")).withColumnRenamed("key", "cid"))
    posts = saved(classes.select("cid", F.floor(F.octet_length("grams") / 8).alias("n"), F.explode("bands").alias("band")))
    fits = lambda a, b: F.lit(100) * F.least(a, b) >= F.lit(PERCENT) * F.greatest(a, b)

    def hub_pairs(rows: DataFrame, salt: int) -> DataFrame:
        """rows: band, cid, n, label, outside. Every class with its band's hub, one of those outside."""
        hub = saved(rows.where("outside").groupBy("band").agg(F.min(F.struct(F.xxhash64(F.lit(salt), "band", "cid").alias("r"), "cid", "n", "label")).alias("h")))
        j = rows.join(hub, "band").where((F.col("label") != F.col("h.label")) & fits(F.col("n"), F.col("h.n")))
        return j.select(F.greatest("cid", "h.cid").alias("a"), F.least("cid", "h.cid").alias("b")).distinct()

    def undecided(least: int, labels: DataFrame) -> DataFrame:
        """Classes of the bands of `least` classes or more that still hold several components."""
        named = saved(posts.join(labels.withColumnsRenamed({"id": "cid", "component": "label"}), "cid", "left").withColumn("label", F.coalesce("label", "cid")))
        split = named.groupBy("band").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("k")).where(f"l <> h and k >= {least}").select("band", "k")
        return saved(named.join(saved(split), "band"))

    def large(live: DataFrame) -> DataFrame:
        """outside: not of the band's largest component."""
        rows = live.where(F.col("k") > SMALL)
        top = saved(rows.groupBy("band", "label").agg(F.count("*").alias("c")).groupBy("band").agg(F.max(F.struct("c", "label")).alias("top")))
        return saved(rows.join(top, "band").withColumn("outside", F.col("label") != F.col("top.label")).drop("k", "top"))

    links = saved(verified(hub_pairs(posts.withColumns({"label": F.col("cid"), "outside": F.lit(True)}), 0), classes, PERCENT))
    labels = components(links)
    live = undecided(2, labels)
    if live.isEmpty():
        return labels
    few = live.where(F.col("k") <= SMALL)
    other = few.select("band", F.col("cid").alias("c2"), F.col("n").alias("n2"), F.col("label").alias("l2"))
    pairs = few.join(other, "band").where((F.col("cid") > F.col("c2")) & (F.col("label") != F.col("l2")) & fits(F.col("n"), F.col("n2"))).select(F.col("cid").alias("a"), F.col("c2").alias("b"))
    if not live.where(F.col("k") > SMALL).isEmpty():
        pairs = pairs.union(hub_pairs(large(live), 1))
    links = saved(links.union(verified(pairs.distinct(), classes, PERCENT)))
    labels = components(links)
    live = undecided(SMALL + 1, labels)
    if live.isEmpty():
        return labels

    # what is outside the largest component against the whole band
    rows = large(live)
    blocks = lambda inside: F.ceil(F.greatest(F.count_if(inside) / BLOCK, F.sum(F.when(inside, F.col("n") * 8).otherwise(0)) / BLOCK_BYTES))
    size = saved(rows.groupBy("band").agg(blocks(F.col("outside")).alias("bo"), blocks(~F.col("outside")).alias("bb")))
    rows = rows.join(size, "band").withColumn("block", F.when(F.col("outside"), F.pmod(F.xxhash64("cid"), F.col("bo"))).otherwise(F.col("bo") + F.pmod(F.xxhash64("cid"), F.col("bb"))))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("outside"), F.col("bo") + F.col("bb")).otherwise(F.col("bo")) - 1)))
    rows = rows.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cid", "label", "block").join(classes.select("cid", "grams"), "cid")
    links = saved(links.union(rows.groupBy("band", "i", "j").applyInArrow(_cross(PERCENT), "a long, b long")).distinct())
    return components(links)
