"""Suffix-array deduplication of repeated byte strings of a threshold length.

Every byte covered by a THRESHOLD-byte string that also starts earlier (smaller
doc_id, or earlier in the same document) goes. The suffixes are radix-sorted
to the threshold only, most significant digit first, and every pass drops the
groups of one:

1. Content-defined heads. A THRESHOLD-byte window's head is the least hash of
   its DIGIT-byte strings, so equal windows have equal heads at equal offsets.
   All windows of one head form a stretch (about 30 windows). First digit: the
   head. Second digit: the whole stretch. Batches of documents send both per
   bucket; a bucket answers for each stretch whether its head is alone (done),
   the same stretch stands in an earlier batch (all its windows repeat), it is
   the first of a head with one stretch only (done), or needs the last pass.
2. Last digit: the windows of the remaining stretches, sorted by whole-window
   hash (96 bits together with the head); equal groups are the repeats.

Batches are blocks of ids, so the order of batches is the order of documents,
and repeats inside a batch are settled where they are. A head with many
stretches in one batch is sent as one mark, so hot passages cost a bucket a few
entries a batch. Equality is by 64-bit head and stretch hashes and 96-bit
window hashes.

Defined results: null text is empty; texts under the threshold lose nothing;
rows that share an id are ordered by text; equal rows repeat each other; null
ids come last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K, routing as R
from .common import batched, bucket_count

THRESHOLD, DIGIT, PIECE, STRETCHES = 100, 36, 1 << 20, 8
PLACE = np.uint64((1 << 24) - 1)
ALONE, EARLIER, OPEN = 0, 1, 2


class Batch:
    """Stretches of a batch's documents, in document order."""

    def __init__(self, t: pa.Table, threshold: int = THRESHOLD, digit: int = DIGIT):
        t = R.sorted_rows(t)
        self.ids = t["doc_id"].to_pylist()
        self.threshold, self.digit = threshold, digit
        self.data, self.offsets = K.string_buffers(t["text"])
        heads, stretches, starts, counts = [], [], [], []
        last = len(self.data) - threshold
        edges = self.offsets[1:]
        for a in range(0, last + 1, PIECE):
            n = min(PIECE, last + 1 - a)  # windows that start in this piece
            prefix = K.prefix_hash(self.data[a : a + n - 1 + threshold])
            at = np.arange(len(prefix) - digit)
            h = K.span_hash(prefix, at, at + digit)
            least = K.sliding_min((h & ~PLACE) | at.astype(np.uint64), threshold - digit + 1)
            head = (least & PLACE).astype(np.int64)
            w = np.arange(n)
            whole = w + a + threshold <= edges[np.minimum(np.searchsorted(edges, w + a, "right"), len(edges) - 1)]
            first = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (whole[1:] != whole[:-1])]))
            stop = np.append(first[1:], n)
            first, stop = first[whole[first]], stop[whole[first]]
            heads.append(h[head[first]])
            with np.errstate(over="ignore"):
                stretches.append(K.mix(K.span_hash(prefix, first, stop - 1 + threshold) * np.uint64(31) + (head[first] - first).astype(np.uint64)) | np.uint64(1))
            starts.append(first + a)
            counts.append(stop - first)
        cat = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)]).astype(kind)
        self.head, self.stretch = cat(heads, np.uint64), cat(stretches, np.uint64)
        self.start, self.count = cat(starts, np.int64), cat(counts, np.int64)
        self._group()

    def _group(self):
        """Distinct (head, stretch) pairs and the entries that are sent."""
        order = np.lexsort((np.arange(len(self.head)), self.stretch, self.head))
        head, stretch = self.head[order], self.stretch[order]
        new_head = np.ones(len(head), bool)
        new_head[1:] = head[1:] != head[:-1]
        new_pair = new_head.copy()
        new_pair[1:] |= stretch[1:] != stretch[:-1]
        self.first = order[new_pair]  # first stretch of each distinct pair
        self.repeat = np.ones(len(head), bool)
        self.repeat[self.first] = False  # equal stretches stand earlier in this batch
        group = np.cumsum(new_head[new_pair]) - 1  # head of each pair
        size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        self.several = size[group] > 1  # pairs whose head has other stretches in this batch
        many = size > STRETCHES
        pair_head, pair_stretch = head[new_pair], stretch[new_pair]
        lead = new_head[new_pair]
        sent = ~many[group] | lead if len(group) else np.zeros(0, bool)
        self.keys, self.marks = pair_head[sent], np.where(many[group], np.uint64(0), pair_stretch)[sent] if len(group) else pair_stretch
        place = np.cumsum(sent) - 1
        self.entry = np.where(many[group], place[np.searchsorted(group, group)], place) if len(group) else place

    def open_pairs(self, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pairs to expand here, whether their windows go to the last pass)."""
        status = answer[self.entry]
        expand = (status == OPEN) | (self.several & (status != EARLIER))
        return np.flatnonzero(expand), (status == OPEN)[expand]

    def windows(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts in document order, place of each one's pair in `pairs`)."""
        s, c = self.start[self.first[pairs]], self.count[self.first[pairs]]
        skip = np.concatenate([[0], np.cumsum(c)])
        at = np.repeat(s - skip[:-1], c) + np.arange(skip[-1])
        owner = np.repeat(np.arange(len(pairs)), c)
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    def hashes(self, at: np.ndarray) -> np.ndarray:
        """Whole-window hashes at sorted starts, piece by piece."""
        out, k = np.empty(len(at), np.uint64), 0
        while k < len(at):
            lo = int(at[k])
            e = int(np.searchsorted(at, lo + PIECE))
            prefix = K.prefix_hash(self.data[lo : int(at[e - 1]) + self.threshold])
            out[k:e] = K.span_hash(prefix, at[k:e] - lo, at[k:e] - lo + self.threshold)
            k = e
        return out

    def last_pass(self, answer: np.ndarray):
        """Windows of the open pairs: starts, first of equal ones here, and the
        distinct ones that are sent (indices, keys, marks)."""
        pairs, send = self.open_pairs(answer)
        at, owner = self.windows(pairs)
        h = self.hashes(at)
        tail = (self.head[self.first[pairs]][owner] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.lexsort((np.arange(len(h)), tail, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (tail[order][1:] != tail[order][:-1])
        first = np.zeros(len(h), bool)
        first[order[new]] = True
        # a window goes on if any stretch that holds it here is open
        group = np.cumsum(new) - 1
        wanted = np.zeros(int(group[-1]) + 1 if len(group) else 0, bool)
        np.logical_or.at(wanted, group, send[owner[order]])
        sent = order[new][wanted]
        return at, first, sent, h[sent], tail[sent]


def _stretch_answers(t: pa.Table) -> pa.Table:
    keys, marks, row = R.gather(t)
    batch = np.asarray(t["batch"])[row]
    order = np.lexsort((batch, marks, keys))
    k, m = keys[order], marks[order]
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_pair = new_key.copy()
    new_pair[1:] |= m[1:] != m[:-1]
    group = np.cumsum(new_key) - 1
    size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    pairs = np.bincount(group, new_pair) if len(group) else np.zeros(0)
    marked = np.bincount(group, m == 0) > 0 if len(group) else np.zeros(0, bool)
    many = ((pairs > 1) | (marked & (size > 1)))[group]
    status = np.where(size[group] == 1, ALONE, np.where(~new_pair & (m != 0), EARLIER, np.where(many, OPEN, ALONE))).astype(np.uint8)
    out = np.empty(len(k), np.uint8)
    out[order] = status
    return R.reply(t, row, out)


def _window_answers(t: pa.Table) -> pa.Table:
    keys, marks, row = R.gather(t, mark_type=np.uint32)
    batch = np.asarray(t["batch"])[row]
    order = np.lexsort((batch, marks, keys))
    k, m = keys[order], marks[order]
    later = np.zeros(len(k), bool)
    later[1:] = (k[1:] == k[:-1]) & (m[1:] == m[:-1])
    out = np.empty(len(k), np.uint8)
    out[order] = later
    return R.reply(t, row, out)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, *, threshold: int = THRESHOLD, digit: int = DIGIT, id_col="doc_id", text_col="text", with_text: bool = False) -> DataFrame:
    """One row per document; with_text adds the remaining bytes as kept."""
    buckets = bucket_count(docs.sparkSession)
    t = batched(docs, id_col, text_col)

    def stretches(key, x):
        b = Batch(x, threshold, digit)
        return R.ask(key[0].as_py(), b.keys, b.marks, buckets)

    def windows(key, x, back):
        b = Batch(x, threshold, digit)
        *_, keys, marks = b.last_pass(R.answers(back, b.keys, buckets))
        return R.ask(key[0].as_py(), keys, marks, buckets)

    def finish(key, x, back):
        b = Batch(x, threshold, digit)
        stage = np.asarray(back["stage"]) if back.num_rows else np.zeros(0)
        one = R.answers(back.filter(pa.array(stage == 1)), b.keys, buckets)
        at, first, sent, keys, _ = b.last_pass(one)
        gone = ~first
        gone[sent] |= R.answers(back.filter(pa.array(stage == 2)), keys, buckets).astype(bool)
        whole = b.repeat.copy()  # stretches that repeat as a whole
        whole[b.first] |= one[b.entry] == EARLIER
        diff = np.zeros(len(b.data) + 1, np.int32)
        for s, e in ((at[gone], at[gone] + threshold), (b.start[whole], b.start[whole] + b.count[whole] - 1 + threshold)):
            diff += np.bincount(s, minlength=len(diff)).astype(np.int32)
            diff -= np.bincount(e, minlength=len(diff)).astype(np.int32)
        cover = np.cumsum(diff[:-1], dtype=np.int32) > 0
        opens = cover.copy()
        opens[1:] &= ~cover[:-1]
        starts = b.offsets[:-1][np.diff(b.offsets) > 0]
        opens[starts] = cover[starts]
        total = lambda x: (lambda c: c[b.offsets[1:]] - c[b.offsets[:-1]])(np.concatenate([[0], np.cumsum(x)]))
        kept = [b.data[s:e][~cover[s:e]].tobytes() for s, e in zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist(), strict=True)]
        cols = [pa.array(b.ids, pa.int64()), pa.array(np.diff(b.offsets), pa.int64()), pa.array(total(cover), pa.int64()), pa.array(total(opens), pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
        names = [c.split()[0] for c in RESULT.split(", ")]
        if with_text:
            cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "kept"]
        return pa.table(cols, names=names)

    def marked(stage):
        def run(x):
            out = _stretch_answers(x) if stage == 1 else _window_answers(x)
            return out.append_column("stage", pa.array([stage] * out.num_rows, pa.int32()))

        return run

    answer = R.ANSWER + ", stage int"
    one = t.groupBy("batch").applyInArrow(stretches, R.ASK).groupBy("bucket").applyInArrow(marked(1), answer)
    two = t.groupBy("batch").cogroup(one.groupBy("batch")).applyInArrow(windows, R.ASK).groupBy("bucket").applyInArrow(marked(2), answer)
    return t.groupBy("batch").cogroup(one.unionByName(two).groupBy("batch")).applyInArrow(finish, RESULT + (", kept binary" if with_text else ""))
