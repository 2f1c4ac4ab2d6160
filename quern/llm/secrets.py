"""Secret scans: fixed base patterns plus a battery of randomness tests.

Base patterns (assign, access, hex) are the contract's. The method looks at
every other run of 16 or more token characters that holds a letter (runs of digits alone are
the base's): it infers the run's encoding (hex, letters of one or two cases, base36 or
base64 alphabet) and tests it against a uniform random source of that alphabet with a
chi-squared test of the counts, a runs test and two serial tests, plain lag-1 correlation and
correlation as the corpus has it: the mean log-likelihood of successive characters under the
bigrams of all runs of the corpus, whose mean and variance under the uniform source
are exact. Fisher's method combines the four.

What ordinary text gives by chance comes from these bigrams too: SIMULATED runs a length
band, drawn from the chain, are tested alike, with an exponential tail beyond TAIL of them. No
run is taken for ordinary by its alphabet: keys enter the bigrams by their share of the
characters only. A candidate gets its p-value from its band and the Benjamini-Hochberg rule at level
FDR decides band by band. Bigram counts and candidates are mergeable histograms of fixed
size, whatever the corpus size.

Defined results: null or empty texts have no spans; positions are code points,
ends exclusive; added spans never overlap base spans; repeated rows are
scanned one by one; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernels as K
from .common import pieces, saved

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(rb"AKIA[A-Z0-9]+"), re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "random")
MIN_RUN, LEVELS, FDR = 16, 64, 0.05
BANDS = (16, 18, 20, 24, 28, 32, 40, 48, 64)  # lower ends of the length bands
SIMULATED, TAIL, DECADES, SEED = 20_000, 0.01, 12, 20240101
FOLDED = 37  # 0-9, letters of either case, others

IN_RUN = np.zeros(256, bool)
IN_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
#: Character classes: 1 digit, 2 a-f, 4 g-z, 8 A-F, 16 G-Z, 32 other
CLASS = np.full(256, 32, np.uint8)
for _bytes, _bit in ((b"0123456789", 1), (b"abcdef", 2), (b"ghijklmnopqrstuvwxyz", 4), (b"ABCDEF", 8), (b"GHIJKLMNOPQRSTUVWXYZ", 16)):
    CLASS[list(_bytes)] = _bit
CODE = np.full(256, 63, np.int64)  # place in 0-9 a-z A-Z others
CODE[list(b"0123456789")] = np.arange(10)
CODE[list(b"abcdefghijklmnopqrstuvwxyz")] = np.arange(10, 36)
CODE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = np.arange(36, 62)
FOLD = np.where(CODE >= 62, 36, np.where(CODE >= 36, CODE - 26, CODE))
#: alphabet size -> how often a uniform source of it gives each folded character
ALPHABETS = {16: [1] * 16 + [0] * 21, 26: [0] * 10 + [1] * 26 + [0], 36: [1] * 36 + [0], 52: [0] * 10 + [2] * 26 + [0], 64: [1] * 10 + [2] * 27}


def _upper_tail(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def run_pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(folded pair, run) of every two successive characters of the runs."""
    n = np.maximum(ends - starts - 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(n) else np.zeros(0, np.int64)
    return FOLD[data[at]] * FOLDED + FOLD[data[at + 1]], owner


class Bigrams:
    """Log-likelihood of a character after another, and its moments under uniform sources."""

    def __init__(self, counts: np.ndarray):
        table = counts.reshape(FOLDED, FOLDED).astype(float) + 0.5
        self.chain = table / table.sum(1, keepdims=True)
        self.start = table.sum(1) / table.sum()
        self.score = np.log(self.chain)
        self.moments = {}
        for size, weights in ALPHABETS.items():
            w = np.array(weights, float) / sum(weights)
            mean = w @ self.score @ w
            dev = self.score - mean
            # successive pairs share a character: two neighbours' covariance counts twice
            self.moments[size] = (mean, w @ dev**2 @ w, (w * (w @ dev) * (dev @ w)).sum())

    def simulate(self, length: int, runs: int, seed: int) -> np.ndarray:
        """Runs drawn from the chain, as rows of lower-case bytes."""
        rng, steps = np.random.default_rng(seed), self.chain.cumsum(1)
        now = np.searchsorted(self.start.cumsum() / self.start.sum(), rng.random(runs))
        out = [now]
        for _ in range(length - 1):
            now = np.minimum((steps[now] < rng.random((runs, 1))).sum(1), FOLDED - 1)
            out.append(now)
        return np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz-", np.uint8)[np.stack(out, 1)]


def battery(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bigrams: Bigrams) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of the combined p-value of randomness, union of character classes) per run."""
    n = ends - starts
    if not len(n):
        return np.zeros(0), np.zeros(0, np.uint8)
    total = int(n.sum())
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    at = np.repeat(starts - first, n) + np.arange(total)
    owner = np.repeat(np.arange(len(n)), n)
    chars = data[at]
    kinds = np.bitwise_or.reduceat(CLASS[chars], first)
    # inferred encoding: alphabet size, and codes folded to one case where one case only is used
    digit, other = (kinds & 1) > 0, (kinds & 32) > 0
    lower, upper = (kinds & 6) > 0, (kinds & 24) > 0
    hexed = ~other & ((kinds & 20) == 0) & ~(lower & upper)
    size = np.where(other | (digit & lower & upper), 64, np.where(hexed, 16, np.where(lower & upper, 52, np.where(digit, 36, 26))))
    code = CODE[chars]
    code = np.where((size[owner] < 52) & (code >= 36), code - 26, code)
    code = np.where((size[owner] == 26) | (size[owner] == 52), code - 10, code)
    k, m = size.astype(float), n.astype(float)
    counts = np.bincount(owner * 64 + code, minlength=64 * len(n)).reshape(-1, 64).astype(float)
    chi = (counts**2).sum(1) * k / m - m
    p1 = _upper_tail((chi - (k - 1)) / np.sqrt(2 * (k - 1) * (1 - 1 / m)))
    high = code >= size[owner] / 2
    ones = np.add.reduceat(high.astype(float), first)
    turn = np.zeros(total)
    turn[1:] = (high[1:] != high[:-1]) & (owner[1:] == owner[:-1])
    runs = np.add.reduceat(turn, first) + 1
    mean = 2 * ones * (m - ones) / m + 1
    var = np.maximum((mean - 1) * (mean - 2) / (m - 1), 1e-9)
    p2 = np.where((ones == 0) | (ones == m), 0.5 ** (m - 1), 2 * _upper_tail(np.abs(runs - mean) / np.sqrt(var)))
    mid = code - (np.add.reduceat(code.astype(float), first) / m)[owner]
    lag = np.zeros(total)
    lag[1:] = mid[1:] * mid[:-1] * (owner[1:] == owner[:-1])
    r = np.add.reduceat(lag, first) / np.maximum(np.add.reduceat(mid * mid, first), 1e-9)
    p3 = 2 * _upper_tail(np.abs(r + 1 / m) * np.sqrt(m))
    pair, of = run_pairs(data, starts, ends)
    score = np.bincount(of, bigrams.score.ravel()[pair], minlength=len(n))
    mean, var, shared = (np.array([bigrams.moments[x][i] for x in size.tolist()]) for i in range(3))
    spread = np.maximum((m - 1) * var + 2 * (m - 2) * shared, 1e-9)
    p4 = _upper_tail((score - (m - 1) * mean) / np.sqrt(spread))
    half = -sum(np.log(np.clip(p, 1e-60, 1)) for p in (p1, p2, p3, p4))  # half of Fisher's statistic, eight degrees of freedom
    return (np.log(1 + half + half**2 / 2 + half**3 / 6) - half) / math.log(10), kinds


def _level(log_p: np.ndarray) -> np.ndarray:
    """0 looks least random."""
    return np.clip(((1 + log_p / DECADES) * LEVELS).astype(int), 0, LEVELS - 1)


def _cell(log_p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """band * LEVELS + level."""
    return (np.searchsorted(BANDS, n, "right") - 1) * LEVELS + _level(log_p)


def null_survival(bigrams: Bigrams) -> list[list[float]]:
    """Per band and level, how often ordinary text of the band's least length looks at least so random."""
    out = []
    for band, length in enumerate(BANDS):
        data = bigrams.simulate(length, SIMULATED, SEED + band).ravel()
        starts = np.arange(SIMULATED, dtype=np.int64) * length
        log_p = np.sort(battery(data, starts, starts + length, bigrams)[0])
        cut = log_p[int(SIMULATED * (1 - TAIL))]
        excess = max(float((log_p[log_p > cut] - cut).mean()) if log_p[-1] > cut else 0.0, DECADES / LEVELS)
        at = (np.arange(LEVELS) / LEVELS - 1) * DECADES  # least log p of a level
        seen = 1 - np.searchsorted(log_p, at) / SIMULATED
        kept = np.where(at > cut, TAIL * np.exp(-np.maximum(at - cut, 0) / excess), np.maximum(seen, TAIL))
        kept[0] = 1.0  # the lowest level holds all below it
        out.append(kept.tolist())
    return out


def _line(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


SCAN = "doc_id long, n_assign long, n_access long, n_hex long, base string, extra array<struct<s:long,e:long,cell:int>>"
_EXTRA = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("cell", pa.int32())]))


def _pair_counts(batches):
    total = np.zeros(FOLDED * FOLDED, np.int64)
    for b in pieces(batches):
        data, offsets = K.string_buffers(b.column("text"))
        starts, ends, _ = K.word_bounds(data, offsets, ~IN_RUN)
        total += np.bincount(run_pairs(data, starts, ends)[0], minlength=len(total))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["pair", "n"])


def corpus_bigrams(texts: DataFrame) -> Bigrams:
    """Of all runs of every whole text, which keys are a small share of."""
    counts = np.zeros(FOLDED * FOLDED, np.int64)
    for pair, n in texts.select("text").mapInArrow(_pair_counts, "pair int, n long").groupBy("pair").agg(F.sum("n")).collect():  # FOLDED^2 rows at most
        counts[pair] = n
    return Bigrams(counts)


def _scan(batches, bigrams: Bigrams):
    for b in pieces(batches):
        data, offsets = K.string_buffers(b.column("text"))
        rows = b.num_rows
        spans: dict[int, list] = {}
        starts, ends, first = K.word_bounds(data, offsets, ~IN_RUN)
        long_runs = np.flatnonzero(ends - starts >= MIN_RUN)
        starts, ends = starts[long_runs], ends[long_runs]
        doc = np.searchsorted(offsets, starts, "right") - 1
        log_p, kinds = battery(data, starts, ends, bigrams)
        cells = _cell(log_p, ends - starts)
        digit = (kinds & 1) > 0
        candidate = (kinds & 30) > 0
        point = {}

        def points(d, offset):
            if d not in point:
                point[d] = K.code_points(data[offsets[d] : offsets[d + 1]])
            return int(point[d][offset - offsets[d]])

        for d in np.flatnonzero(np.add.reduceat((data == 58) | (data == 61), np.minimum(offsets[:-1], max(len(data) - 1, 0))) if len(data) else np.zeros(rows, bool)).tolist():
            if offsets[d + 1] > offsets[d]:
                text = data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "surrogateescape")
                for m in ASSIGN.finditer(text):
                    if len(m[2]) >= LEAST["assign"]:
                        spans.setdefault(d, []).append(("assign", m.start(), m.end()))
        extra: dict[int, list] = {}
        for i in np.flatnonzero(digit | ((kinds & 24) > 0) | ((kinds & ~np.uint8(3)) == 0) | ((kinds & 32) > 0)).tolist():
            d, a = int(doc[i]), int(starts[i])
            run = data[a : ends[i]].tobytes()
            for kind, pattern in (("access", ACCESS), ("hex", HEX)):
                for m in pattern.finditer(run):
                    if m.end() - m.start() >= LEAST[kind]:
                        spans.setdefault(d, []).append((kind, points(d, a + m.start()), points(d, a + m.end())))
        for i in np.flatnonzero(candidate).tolist():
            d = int(doc[i])
            extra.setdefault(d, []).append({"s": points(d, int(starts[i])), "e": points(d, int(ends[i])), "cell": int(cells[i])})
        # hex runs of lower-case letters can lie inside words of other letters
        for i in np.flatnonzero(~(digit | ((kinds & 24) > 0) | ((kinds & ~np.uint8(3)) == 0) | ((kinds & 32) > 0))).tolist():
            run = data[starts[i] : ends[i]].tobytes()
            for m in HEX.finditer(run):
                if m.end() - m.start() >= LEAST["hex"]:
                    d = int(doc[i])
                    spans.setdefault(d, []).append(("hex", points(d, int(starts[i]) + m.start()), points(d, int(starts[i]) + m.end())))
        for d, found in extra.items():
            base = [(s, e) for _, s, e in spans.get(d, ())]
            extra[d] = [x for x in found if not any(s < x["e"] and x["s"] < e for s, e in base)]
        count = lambda kind: pa.array([sum(k == kind for k, _, _ in spans.get(d, ())) for d in range(rows)], pa.int64())
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), count("assign"), count("access"), count("hex"), pa.array([_line(spans.get(d, ())) for d in range(rows)], pa.string()),
            pa.array([extra.get(d, []) for d in range(rows)], _EXTRA),
        ], ["doc_id", "n_assign", "n_access", "n_hex", "base", "extra"])


def admitted_levels(survival: list[list[float]], cand: dict[int, int], fdr: float = FDR) -> dict[int, int]:
    """band -> least admitted level, by the Benjamini-Hochberg rule."""
    out = {}
    for band in range(len(BANDS)):
        n_cand = sum(cand.get(band * LEVELS + x, 0) for x in range(LEVELS))
        above = 0
        for level in range(LEVELS - 1, -1, -1):
            above += cand.get(band * LEVELS + level, 0)
            if above and survival[band][level] <= fdr * above / n_cand:
                out[band] = level
    return out


def _finish(limits: dict[int, int]):
    def run(batches):
        for b in batches:
            base, spans, digest = b.column("base").to_pylist(), [], []
            for line, extra in zip(base, b.column("extra").to_pylist(), strict=True):
                more = [("random", x["s"], x["e"]) for x in extra if x["cell"] % LEVELS >= limits.get(x["cell"] // LEVELS, LEVELS)]
                known = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in line.split(",") if x)]
                spans.append(_line([*known, *more]))
                digest.append(hashlib.sha256(line.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex")), pa.array(digest, pa.string()), pa.array(spans, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def _limits(cells: DataFrame, bigrams: Bigrams, fdr: float) -> dict[int, int]:
    """Of a column `cell` with the cells of all candidates."""
    tally = {r[0]: r[1] for r in cells.groupBy("cell").count().collect()}  # at most bands x LEVELS rows
    return admitted_levels(null_survival(bigrams), tally, fdr)


def _scanner(bigrams: Bigrams):
    return lambda batches: _scan(batches, bigrams)


def secret_spans(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """One row per document: counts, digest of the base spans, all spans."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bigrams = corpus_bigrams(own)
    found = saved(own.mapInArrow(_scanner(bigrams), SCAN))
    limits = _limits(found.select(F.explode("extra.cell").alias("cell")), bigrams, fdr)
    return found.mapInArrow(_finish(limits), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars", fdr: float = FDR) -> DataFrame:
    """docs with the secrets of each row's text replaced where they stand, whatever its
    other columns hold; chars_col, if there is one, follows the text. The levels
    are learnt in two passes; the third scans and redacts a row at once, without a join."""
    own = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bigrams = corpus_bigrams(own)
    limits = _limits(own.mapInArrow(_scanner(bigrams), SCAN).select(F.explode("extra.cell").alias("cell")), bigrams, fdr)
    names, finish = docs.columns, _finish(limits)

    def run(batches):
        for b in pieces(batches, text_col):
            i = b.schema.get_field_index(text_col)
            seen = pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int64()), b.column(i)], ["doc_id", "text"])
            spans = [s for out in finish(_scan([seen], bigrams)) for s in out.column("spans").to_pylist()]
            texts = [redact(t, s) for t, s in zip(b.column(i).to_pylist(), spans, strict=True)]
            out = b.set_column(i, text_col, pa.array(texts, pa.string()))
            j = out.schema.get_field_index(chars_col)
            if j >= 0:
                out = out.set_column(j, chars_col, pa.array([None if t is None else len(t) for t in texts], pa.int64()))
            yield out.select(names)

    schema = docs.schema if chars_col not in names else docs.withColumn(chars_col, F.lit(0).cast("long")).schema
    return docs.mapInArrow(run, schema)


def redact(text: str | None, spans: str, mark: str = "[{}]") -> str | None:
    """The text with its spans (overlaps merged) replaced by their kind."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, s, e in sorted(((k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans.split(","))), key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], mark.format(kind.upper())]
        at = max(at, e)
    return "".join(out) + text[at:]
