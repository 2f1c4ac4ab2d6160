"""Plain versions of the operators' contracts, for small fixtures."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CODE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def _overlaps(sets):
    inverse, count = defaultdict(list), Counter()
    for k, s in sets.items():
        for g in s:
            inverse[g].append(k)
    for ks in inverse.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                count[(b, a)] += 1
    return count


def paragraphs(docs, least=25, n=5, percent=80):
    items = []
    for i, t in sorted(docs):
        at = 0
        for line in (t or "").split("\n"):
            w = WORD.findall(lower(line))
            if len(w) >= least:
                items.append((i, at, at + len(line), frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1))))
            at += len(line) + 1
    sets = dict(enumerate(dict.fromkeys(x[3] for x in items)))
    place, u = {s: k for k, s in sets.items()}, Union(sets)
    for (a, b), c in _overlaps(sets).items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            u.join(a, b)
    seen, gone = set(), defaultdict(list)
    for i, s, e, g in items:
        c = u.find(place[g])
        if c in seen:
            gone[i].append(f"{s}:{e}")
        seen.add(c)
    return {i: ",".join(gone[i]) for i, _ in docs}


def suffixes(docs, size=100):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda x: (x[0], x[1] or "")):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if b[s : s + size] in seen:
                cover[s : s + size] = b"\1" * size
            seen.add(b[s : s + size])
        spans = sum(1 for k in range(len(b)) if cover[k] and not (k and cover[k - 1]))
        out[i] = (len(b), sum(cover), spans, sha(bytes(c for c, m in zip(b, cover, strict=True) if not m)))
    return out


def quality(t):
    t = t or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = {j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w)


def fenced(rows, spread, core_spread, lean, tails, tail_lean):
    """Names of the features beyond their fences, from exact quantiles of the rows (id, text, lang, source)."""
    feats = {}
    for i, t, _, _ in rows:
        n, chars, symbols, dup, repeat, failed = quality(t)
        lines = sum(bool(WORD.search(x)) for x in (t or "").split("\n"))
        counts = {"symbol_ratio": (symbols, n, 1), "dup_line_ratio": (dup, lines, 1), "repeat_ratio": (repeat, n, 8)}
        feats[i] = {"counts": counts, "word_length": chars / max(n, 1), "n": n, "failed": failed, **{f: k / max(of, 1) for f, (k, of, _) in counts.items()}}

    def quants(ids, names, at):
        sort = {f: sorted(feats[i][f] for i in ids) for f in names}
        return {f: [x[max(0, math.ceil(q * len(x)) - 1)] for q in at] for f, x in sort.items()}

    def fitted(some, names, at, weight):
        def mean(own, wider):
            if not own:
                return wider
            q = quants(own, names, at)
            return {f: [(len(own) * a + weight * b) / (len(own) + weight) for a, b in zip(q[f], wider[f], strict=True)] for f in names}

        corpus = quants([i for i, *_ in some], names, at)
        return lambda lang, source: mean([i for i, a, b in some if (a, b) == (lang, source)], mean([i for i, a, _ in some if a == lang], corpus))

    some = [(i, lang, source) for i, _, lang, source in rows if feats[i]["n"]]
    dense = fitted(some, ("word_length", "n"), (0.25, 0.5, 0.75), lean)

    def far(i, lang, source, scales):
        x, q = feats[i], dense(lang, source)
        (low, mid, high), short = q["word_length"], math.sqrt(max(1, q["n"][1] / max(x["n"], 1)))
        return x["word_length"] - mid > scales * (high - mid) * short or mid - x["word_length"] > scales * (mid - low) * short

    tail = fitted([x for x in some if not feats[x[0]]["failed"] and not far(*x, core_spread)], ("symbol_ratio", "dup_line_ratio", "repeat_ratio"), tails, tail_lean)
    out = {}
    for i, _, lang, source in rows:
        q, bad = tail(lang, source), []
        for f, (k, of, size) in feats[i]["counts"].items():
            if size * max(math.sqrt(k / size) - 1, 0) ** 2 / max(of, 1) > 2 * q[f][1] - q[f][0]:
                bad.append(f)
        out[i] = ",".join([*bad, *["word_length"] * far(i, lang, source, spread)])
    return out


def warc(pages):
    groups = defaultdict(list)
    for i, h in pages:
        groups[h or ""].append(i)
    out = {}
    for h, ids in groups.items():
        b, top = h.encode(), max(ids)
        for i in ids:
            out[i] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == top else "revisit", None if i == top else top)
    return out


def jaccard(docs, n=3, percent=90):
    sets = {}
    for i, t in docs:
        w = WORD.findall(lower(t))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    u = Union(sets)
    for (a, b), c in _overlaps(sets).items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            u.join(a, b)
    return {i: (len(s), u.find(i)) for i, s in sets.items()}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(t):
    t = t or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(t):
    t, d = t or "", lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(d(m[0])) <= 19 and luhn(d(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(d(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], ("email", "ip", "card", "phone").index(x[0])))


def line(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scores(docs):
    tokens = [(i, WORD.findall(lower(t)) + [None]) for i, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in docs]
    c = Counter(x for (_, w), h in zip(tokens, held, strict=True) if not h for x in w)
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) for _, w in tokens]
    return {i: (h, len(w), sum(c[x] > 0 for x in w), n, b) for (i, w), h, b in zip(tokens, held, base, strict=True)}


def contamination(docs, items, size=13):
    windows = defaultdict(set)
    for i, t in items:
        w = CODE_WORD.findall(lower(t))
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    out = {}
    for i, t in docs:
        w, hit, found = CODE_WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def targets(sizes, weights=(5, 2, 1), cap=3):
    """sizes: source -> words, sources in order. The excess is reshared until no source is above its cap."""
    names = list(sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def longest_matches(docs, items, size=13):
    """Words of each document's longest run that stands in an item too, of a window's length at least."""
    parts = defaultdict(list)
    texts = [CODE_WORD.findall(lower(t)) for _, t in items]
    for x in texts:
        n = min(size, len(x))
        for k in range(len(x) - n + 1 if n else 0):
            parts[tuple(x[k : k + n])].append((x, k))
    out = {}
    for i, t in docs:
        w, best = CODE_WORD.findall(lower(t)), 0
        for n in {len(p) for p in parts}:
            for p in range(len(w) - n + 1):
                for x, k in parts.get(tuple(w[p : p + n]), ()):
                    m = n
                    while n == size and p + m < len(w) and k + m < len(x) and w[p + m] == x[k + m]:
                        m += 1
                    best = max(best, m)
        out[i] = best
    return out


def _model(docs):
    tokens = [(i, WORD.findall(lower(t)) + [None]) for i, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in docs]
    one = Counter(x for (_, w), h in zip(tokens, held, strict=True) if not h for x in w)
    two = Counter(p for (_, w), h in zip(tokens, held, strict=True) if not h for p in zip(["begin", *w], w))
    context = one + Counter({"begin": sum(not h for h in held)})
    context[None] = 0  # an end opens nothing
    return tokens, held, one, two, context, sum(one.values()), len(one)


def _level(c):
    return int(math.log2(c)) + 1 if c > 0 else 0


def mixture_scores(docs, lam):
    """log10 probability by the interpolation with weights lam[bucket of the context's count]."""
    tokens, _, one, two, context, n, v = _model(docs)
    out = {}
    for i, w in tokens:
        total = 0.0
        for h, x in zip(["begin", *w], w):
            p1 = (one[x] + 0.1) / (n + 0.1 * (v + 1))
            share = lam[_level(context[h])] if context[h] else 0.0
            total += math.log10((share * two[h, x] / context[h] if share else 0.0) + (1 - share) * p1)
        out[i] = total
    return out


def mixture_weights(docs, rounds=300):
    """bucket -> weight by EM on every training token's deleted estimates, where a bucket has 50 tokens or more."""
    tokens, held, one, two, context, n, v = _model(docs)
    cases = defaultdict(list)
    for (_, w), out in zip(tokens, held, strict=True):
        if not out:
            for h, x in zip(["begin", *w], w):
                if context[h] > 1:
                    cases[_level(context[h] - 1)].append(((two[h, x] - 1) / (context[h] - 1), (one[x] - 1 + 0.1) / (n - 1 + 0.1 * (v + 1))))
    out = {}
    for b, pairs in cases.items():
        if len(pairs) >= 50:
            lam = 0.5
            for _ in range(rounds):
                lam = min(1 - 1e-4, max(1e-4, sum(lam * p2 / (lam * p2 + (1 - lam) * p1) for p2, p1 in pairs) / len(pairs)))
            out[b] = lam
    return out
