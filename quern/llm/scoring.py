"""Language-model scoring by deleted interpolation of bigrams and unigrams.

The model learns from documents whose crc32 of the id is not divisible by
FOLDS. p(w | h) = lambda_b * c(h w) / c(h) + (1 - lambda_b) * p1(w), with the
base unigram p1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)); b is the bucket of the
context's frequency (its power of two). The mixture weights are learnt by
expectation-maximisation on deleted counts: every training bigram is scored by
counts from which its own occurrence was taken away, and these scores are
gathered in a histogram of bounded size (buckets x CELLS of the log ratio of
both estimates), on which EM runs.

Counts of all words and bigrams are gathered over all documents by the packed
hash exchange of routing.py; words go by whole 64-bit hashes and come back as whole counts, bigrams go by 40
bits within their bucket (46 bits and more in all) and come back as 32-bit floats (exact up to 16 million, 1e-7
beyond). The pass that has the counts stores a document's
token ratios (two bytes each) for the scoring that follows EM. Their steps of
1/FINE in log2 span all that counts can give (2**-48 to 2**48), so that score is within 2.3e-4 a
token of the exact mixture; base_score is exact.

Defined results: a null or wordless text is one end token; a document's first
context is a begin mark; repeated rows are separate documents; without any
training document all counts are 0 and p1 = 1; an empty table gives no rows;
null ids count as the empty text, whose crc32 is 0 (held
out); other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels as K, routing as R
from .common import batched, bucket_count, saved
from .setjoin import _runs

FOLDS, ADD, ROUNDS, SETTLED, BATCH, PAIR_BYTES = 10, 0.1, 500, 1e-6, 512, 5
BUCKETS, CELLS, STEP = 50, 384, 0.25  # context buckets; histogram cells of a quarter of log2
FINE, LOW = 680.0, -48.0  # stored ratios: log2 from LOW in steps of 1/FINE
END, BEGIN = np.uint64(0x1234567), np.uint64(0x7654321)


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0


class Batch:
    """Token ids of a batch of documents and its distinct words and bigrams."""

    def __init__(self, t: pa.Table):
        t = R.sorted_rows(t)
        self.ids = t["doc_id"].to_pylist()
        self.held = np.array([held_out(i) for i in self.ids], bool)
        words, sizes = [], []
        for b in t.to_batches():
            for part in _runs(b):
                data, offsets = K.string_buffers(part.column("text"))
                starts, ends, first = K.word_bounds(data, offsets)
                words.append(K.word_hashes(data, starts, ends))
                sizes.append(np.diff(first))
        w, n = np.concatenate([*words, np.zeros(0, np.uint64)]), np.concatenate([*sizes, np.zeros(0, np.int64)])
        self.size = n + 1
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.owner = np.repeat(np.arange(len(n)), self.size)
        tokens = np.empty(int(self.first[-1]), np.uint64)
        is_end = np.zeros(len(tokens), bool)
        is_end[self.first[1:] - 1] = True
        tokens[is_end], tokens[~is_end] = END, w
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]
        context[self.first[:-1]] = BEGIN
        with np.errstate(over="ignore"):
            pair = K.mix(context * K.GRAM_WEIGHT[0] + tokens * K.GRAM_WEIGHT[1])
        train = ~self.held[self.owner]
        self.words, self.word_of = np.unique(tokens, return_inverse=True)
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.word_marks = np.bincount(self.word_of, train, len(self.words)).astype(np.uint32)
        self.pair_marks = np.bincount(self.pair_of, train, len(self.pairs)).astype(np.uint32)
        self.begins = np.concatenate([[True], is_end[:-1]]) if len(tokens) else is_end
        self.train = train


def _ask(batch: int, b: Batch, buckets: int) -> pa.Table:
    one = R.ask(batch, b.words, b.word_marks, buckets)
    two = R.ask(batch, b.pairs, b.pair_marks, buckets, PAIR_BYTES)
    return pa.concat_tables([one.append_column("pair", pa.array([0] * one.num_rows, pa.int32())), two.append_column("pair", pa.array([1] * two.num_rows, pa.int32()))])


def _totals(t: pa.Table) -> pa.Table:
    """Bucket: the training count of each key; once more its own tallies."""
    pair = t["pair"][0].as_py()
    keys, counts, row = R.gather(t, PAIR_BYTES if pair else 8, np.uint32)
    _, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, counts)
    out = R.reply(t, row, total.astype(np.float32 if pair else np.float64)[place])
    out = out.append_column("pair", pa.array([pair] * out.num_rows, pa.int32()))
    own = pa.array([int((total > 0).sum()), *[0] * (out.num_rows - 1)], pa.int64())
    mass = pa.array([int(total.sum()), *[0] * (out.num_rows - 1)], pa.int64())
    return out.append_column("v", own).append_column("n", mass)


ASKED, ANSWERED = R.ASK + ", pair int", R.ANSWER + ", pair int, v long, n long"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, score_per_token double, gain_per_token double"
TOKENS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, buckets binary, ratios binary, cells array<int>, counts array<long>"


def weights_by_em(hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """lambda per context bucket from deleted counts (BUCKETS x (1 + CELLS);
    column 0: the bigram estimate is 0). Empty buckets take half."""
    ratio = np.concatenate([[0.0], 2.0 ** (LOW + STEP * (np.arange(CELLS) + 0.5))])
    lam = np.full(BUCKETS, 0.5)
    mass = hist.sum(1)
    for _ in range(rounds):  # until no weight moves by more than SETTLED
        share = lam[:, None] * ratio / (lam[:, None] * ratio + (1 - lam[:, None]))
        new = (hist * share).sum(1) / np.maximum(mass, 1)
        new = np.where(mass > 0, np.clip(new, 1e-4, 1 - 1e-4), 0.5)
        done, lam = np.abs(new - lam).max() < SETTLED, new
        if done:
            break
    return lam


def score_documents(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document with base and interpolated log10 probability, the latter and its gain per token too."""
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    t = batched(docs, id_col, text_col, BATCH)

    def count(key, x):
        return _ask(key[0].as_py(), Batch(x), buckets)

    got = saved(t.groupBy("batch").applyInArrow(count, ASKED).groupBy("bucket", "pair").applyInArrow(_totals, ANSWERED))
    v, n = got.where("pair = 0").agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    v, n = int(v), int(n)
    documents = docs.where(F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))), F.lit(FOLDS)) != 0).count()

    def tokens(key, x, back):
        b = Batch(x)
        kind = np.asarray(back["pair"])
        cw = R.answers(back.filter(pa.array(kind == 0)), b.words, buckets, np.float64)[b.word_of]
        cp = R.answers(back.filter(pa.array(kind == 1)), b.pairs, buckets, np.float32).astype(np.float64)[b.pair_of]
        ch = np.empty_like(cw)
        ch[1:] = cw[:-1]
        ch[b.begins] = documents
        p1 = (cw + ADD) / (n + ADD * (v + 1))
        base = np.bincount(b.owner, np.log10(p1), len(b.ids))
        known = np.bincount(b.owner, cw > 0, len(b.ids)).astype(np.int64)
        bucket = lambda c: np.where(c > 0, np.minimum(np.floor(np.log2(np.maximum(c, 1))) + 1, BUCKETS - 1), 0).astype(np.uint8)
        with np.errstate(divide="ignore", invalid="ignore"):
            fine = np.where(cp > 0, np.clip(np.round((np.log2(cp / ch / p1) - LOW) * FINE) + 1, 1, 65535), 0).astype(np.uint16)
            # deleted counts of the training tokens
            dp, dh = cp - 1, ch - 1
            d1 = (cw - 1 + ADD) / (n - 1 + ADD * (v + 1))
            cell = np.where((dp > 0) & (dh > 0), np.clip(np.floor((np.log2(dp / np.maximum(dh, 1) / d1) - LOW) / STEP), 0, CELLS - 1) + 1, 0).astype(np.int64)
        at = bucket(np.maximum(dh, 0)).astype(np.int64) * (1 + CELLS) + cell
        cells, counts = np.unique(at[b.train & (dh > 0)], return_counts=True)
        ctx = bucket(ch)
        cut = list(zip(b.first[:-1].tolist(), b.first[1:].tolist(), strict=True))
        rows = len(b.ids)
        return pa.table([
            pa.array(b.ids, pa.int64()), pa.array(b.held), pa.array(b.size, pa.int64()), pa.array(known), pa.array(base),
            pa.array([ctx[i:j].tobytes() for i, j in cut], pa.binary()), pa.array([fine[i:j].tobytes() for i, j in cut], pa.binary()),
            pa.array([cells.tolist(), *[[]] * (rows - 1)], pa.list_(pa.int32())), pa.array([counts.tolist(), *[[]] * (rows - 1)], pa.list_(pa.int64())),
        ], names=[c.split()[0] for c in TOKENS.split(", ")])

    scored = saved(t.groupBy("batch").cogroup(got.select("batch", "bucket", "answer", "pair").groupBy("batch")).applyInArrow(tokens, TOKENS))
    cells = scored.select(F.explode(F.arrays_zip("cells", "counts")).alias("x")).groupBy("x.cells").agg(F.sum("x.counts").alias("k")).collect()  # BUCKETS x CELLS rows at most
    hist = np.zeros(BUCKETS * (1 + CELLS))
    for c, k in cells:
        hist[c] = k
    lam = weights_by_em(hist.reshape(BUCKETS, 1 + CELLS))
    lam[0] = 0.0  # contexts that training has not seen

    def finish(batches):
        table = 2.0 ** (LOW + (np.arange(65536) - 1) / FINE)
        table[0] = 0.0
        for b in batches:
            gain = []
            for ctx, fine in zip(b.column("buckets").to_pylist(), b.column("ratios").to_pylist(), strict=True):
                at = lam[np.frombuffer(ctx, np.uint8)]
                gain.append(float(np.log10(at * table[np.frombuffer(fine, np.uint16)] + 1 - at).sum()))
            gain = np.array(gain, float)
            score = np.asarray(b.column("base_score")) + gain
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")), pa.array([n] * b.num_rows, pa.int64()), b.column("base_score"), pa.array(score), pa.array(score / np.asarray(b.column("n_tokens"))), pa.array(gain / np.asarray(b.column("n_tokens")))], [c.split()[0] for c in RESULT.split(", ")])

    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "buckets", "ratios").mapInArrow(finish, RESULT)
