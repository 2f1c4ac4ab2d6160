"""Vectorised text kernels shared by the training-data operators.

All kernels look at one Arrow string column at a time: the UTF-8 bytes of a
whole batch lie in one buffer, so word bounds, hashes and windows of every
document are computed by a handful of numpy passes without Python strings.
Words are cut at ASCII white space (fixed set: 0x20, 0x09-0x0D), which is the
same on bytes and on code points because UTF-8 continuation bytes are >= 0x80.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.default_rng(20240607)
#: Random byte weights, odd multiplier and its inverse modulo 2**64.
BYTE_WEIGHT = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = int(0x9E3779B97F4A7C15)
BASE_INV = pow(BASE, -1, 2**64)
GRAM_WEIGHT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)

#: Bytes hashed at a time.
CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (cached, grown by doubling)."""
    if "p" not in _pow or len(_pow["p"]) < n:
        m = 1 << max(16, int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            for key, b in (("p", BASE), ("i", BASE_INV)):
                a = np.full(m, U64(b))
                a[0] = 1
                _pow[key] = np.cumprod(a, dtype=np.uint64)
    return _pow["p"][:n], _pow["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (murmur3 style)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(33)
        x = x * U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(33)
    return x


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes uint8[], offsets int64[n+1]) of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type) else b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of all words; first[d]:first[d+1] are document d's words."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(is_sep[data], out=inside[1 : n + 1])
    begin = inside[1:] & ~inside[:-1]
    stop = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    joint = cuts[inside[cuts] & inside[cuts + 1]]  # a word can't run over a document's end
    begin[joint] = True
    stop[joint] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop)
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """Prefix sums P with hash(i, j) = (P[j] - P[i]) * BASE**-i."""
    p, _ = _powers(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    weight = BYTE_WEIGHT if fold is None else BYTE_WEIGHT[fold]
    with np.errstate(over="ignore"):
        np.cumsum(weight[data] * p[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    _, inv = _powers(len(prefix))
    with np.errstate(over="ignore"):
        return mix((prefix[ends] - prefix[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hashes of sorted disjoint spans, a megabyte of text at a time."""
    out, at, fold = np.empty(len(starts), np.uint64), 0, LOWER if lower else None
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        lo = int(starts[at])
        prefix = prefix_hash(data[lo : int(ends[end - 1])], fold)
        out[at:end] = span_hash(prefix, starts[at:end] - lo, ends[at:end] - lo)
        at = end
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows of the whole sequence (len(words)-n+1)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            acc += words[k : k + m] * GRAM_WEIGHT[k]
        acc += U64(n)
    return mix(acc)


def sets_of_grams(words: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """For each document its sorted distinct n-gram hashes; a document of
    fewer words, but not none, has its whole sequence as its one gram."""
    grams = gram_hashes(words, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(gram_hashes(words[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    k = 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[: len(x) - (w - k)], x[w - k :]) if w > k else x


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte (length n+1)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
