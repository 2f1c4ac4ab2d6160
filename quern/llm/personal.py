"""Personal data: fixed base patterns plus boosted trees over wide candidates.

High-recall generators propose overlapping spans, each on its own: around every plain or spelled-out
at sign the address with plain dots only and the one with spelled-out dots, on either side; every run of digit groups
with any separators, whole and cut by four rules: at blanks, before parentheses, where plain numbers meet compound ones,
and at both of the last; four to eight colon groups of hexadecimal digits, as addresses have. A number has 7 characters
at least; no other length is bounded. Each has features of format, context and what it leaves of its run. The base patterns know one way of
writing each kind; gradient-boosted trees learn the others. Their positive cases are
true base spans, rewritten where they stand, in their own context, into forms that the
base doesn't match (spelled-out addresses, numbers without a plus sign or with other separators,
addresses in hexadecimal groups); their negative cases are, in the same contexts, values of the same
shapes that are nobody's data (failing check digits, octets and digit counts out of range, dates, versions, amounts,
plain words around "at") and, of all values, proposals with other bounds, so that neither the base's format marks nor
the context alone decide; a quarter of the numbers also stand beside another number.
All base spans are used: trees grow by histograms that tasks make and Spark sums up, in as many tasks as
there are TASK_CASES cases, however many files the input has. Each generator has its own threshold, calibrated on the
cases held out: under the last positive case down to which precision reaches PRECISION, half way
to the next case; without one nothing is added. Of the proposals over the threshold that touch no base span, the one of the
highest score (then the longest, then the first) is added as kind `other`, then the best that doesn't overlap it, and so on.

Defined results: null or empty texts have no spans; positions are code points,
ends exclusive; repeated rows are scanned one by one; empty tables give no
rows; a corpus without base spans has no cases and adds none; other columns are ignored. The
fitted model depends only on the rows, not on their order.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect, bisect_left, insort
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  match_substring below
from pyspark.sql import DataFrame, functions as F

from . import kernels as K
from .boosting import BoostedTrees
from .common import pieces, saved

#: An address is found from its at sign backwards and an octet group from a
#: run's first digit: the same matches as of the whole patterns from left to
#: right, without their quadratic time on very long runs.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "other")
#: Generators: an address around an at sign (also spelled out), colon groups, digits with separators. What stands on
#: either side of an at sign is matched from there, on the left in the reversed text: time grows with the text.
_PART, _DOT = "[A-Za-z0-9_%+-]++", r"\x20?[(\[]dot[)\]]\x20?|\x20dot\x20"
AT = re.compile(r"@|\x20?[(\[]at[)\]]|\x20at(?=\x20)", re.I | re.A)
LEFT = [re.compile(rf"{_PART}(?:(?:\.{dot}){_PART})*+", re.I | re.A) for dot in ("", r"|\x20?[)\]]tod[(\[]\x20?|\x20tod\x20")]
RIGHT = [re.compile(rf"{_PART}(?:(?:\.{dot}){_PART})++", re.I | re.A) for dot in ("", f"|{_DOT}")]
GROUPS = re.compile("(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
RUN, NUMBER, WORD = re.compile(r"[0-9]++(?:[\x20().:/_-]++[0-9]++)*+"), re.compile("[0-9]++"), re.compile("[0-9A-Za-z]")
#: The fewest characters of a proposal of digits.
LEAST = 7
GENERATORS = ("address", "groups", "digits")
CUES = ("mail", "tel", "phone", "call", "card", "visa", "fax", "contact", "ip", "@")
PRECISION, CONTEXT = 0.98, 24
#: A level of a tree is one small job, so cases are dealt to tasks by their number, not by the input's files.
TASK_CASES = 20_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        done = at + 1  # nothing before this sign can belong to a later match
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    out += [("email", s, e) for s, e in emails(text)]
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def features(text: str, s: int, e: int, before: int, after: int) -> list[float]:
    t, d = text[s:e], _digits(text[s:e])
    around = (text[max(0, s - CONTEXT) : s] + " " + text[e : e + CONTEXT]).lower()
    parts = [p for p in re.split(r"[^0-9]+", t) if p]
    words = [p for p in re.split(r"[^A-Za-z]+", t) if p]
    return [
        float(x) for x in (
            e - s, len(d), len(d) / (e - s), t.count("@"), t.count("."), t.count(" "), t.count("-"), t.count(":"), t.count("/"), t.count("("),
            len(parts), max(map(len, parts), default=0), min(map(len, parts), default=0), all(int(p) < 256 for p in parts if len(p) < 6) and len(parts) == 4, len(d) > 1 and luhn(d),
            len(words), len(words[-1]) if words else 0, sum(map(len, words)), t.startswith("00"), len(d) and d[0] == "0", t.lower().count("dot"), sum(c in "([" for c in t), before, after, *(c in around for c in CUES),
        )
    ]


def rewritten(kind: str, value: str, pick: int) -> list[tuple[str, int]]:
    """(form, 1 if it is personal data) of a base span's value: other ways to write it, and look-alikes."""
    d = _digits(value)
    if kind == "email":
        name, host = value.split("@")
        at, dot = ((" (at) ", "."), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)"))[pick % 4]
        word = re.sub(r"[^A-Za-z]", "", host) or "there"
        return [(name + at + host.replace(".", dot), 1), (f"{re.sub(r'[^A-Za-z]', '', name) or 'look'} at {word[:6]}.{word[:4].capitalize()}", 0), (f"meet at {word[:5]}.{word[-3:].capitalize()}", 0)]
    if kind == "phone":
        return [("00" + d, 1) if pick % 3 == 0 else (f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", 1) if pick % 3 == 1 else (f"{d[-10:-7]}.{d[-7:-4]}.{d[-4:]}", 1), (f"{1900 + pick % 130}-{1 + pick % 12:02d}-{1 + pick % 28:02d}", 0), (f"{d[:3]}.{d[3:6]}.{d[6:7]}", 0), (f"{d[:4]}/{d[4:8]}", 0)]
    if kind == "card":
        wrong = d[:-1] + str((int(d[-1]) + 1 + pick % 9) % 10)
        sep = (".", "/", "  ", "_")[pick % 4]
        cut = lambda x: sep.join(x[k : k + 4] for k in range(0, len(x), 4))
        return [(cut(d), 1), (cut(wrong), 0), (wrong, 0), (f"{d[:2]}:{d[2:4]}:{d[4:6]}", 0)]
    octets = [int(p.lstrip("0") or 0) for p in value.split(".")]
    groups = [f"{octets[0]:02x}{octets[1]:02x}", f"{octets[2]:02x}{octets[3]:02x}", f"{octets[0] * 7 % 4096:x}", f"{octets[3] * 11 % 4096:x}"]
    return [(":".join(["2001", "db8", *groups]), 1), (":".join(["2001", *groups, f"{pick % 65536:x}", "0", "1"]), 1), (f"{octets[0] % 24:02d}:{octets[1] % 60:02d}:{octets[2] % 60:02d}:{octets[3] % 60:02d}", 0), (".".join(str(o + 256) for o in octets), 0), (f"{octets[0]}.{octets[1]}.{octets[2]}.{octets[3]}.{pick % 90}", 0)]


def _line(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


_PROPOSED = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("g", pa.int32()), ("x", pa.list_(pa.float32()))]))
_CASES = pa.list_(pa.struct([("kind", pa.string()), ("left", pa.string()), ("value", pa.string()), ("right", pa.string())]))
SCAN = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, proposed array<struct<s:long,e:long,g:int,x:array<float>>>, cases array<struct<kind:string,left:string,value:string,right:string>>"
_MARKS = np.zeros(256, bool)
_MARKS[list(b"0123456789@(:[")] = True


def addresses(text: str):
    """(start, end, characters of the wider address before, and after it), around every at sign."""
    back = None
    for m in AT.finditer(text):
        at = m.end() + (m[0] != "@" and text.startswith(" ", m.end()))
        rights = [r.end() for pattern in RIGHT if (r := pattern.match(text, at))]
        if rights:
            back = text[::-1] if back is None else back
            lefts = [m.start() - (x.end() - x.start()) for pattern in LEFT if (x := pattern.match(back, len(text) - m.start()))]
            for s, e in itertools.product(sorted(set(lefts)), sorted(set(rights))):
                yield s, e, s - lefts[-1], rights[-1] - e


def numbers(text: str):
    """(start, end, digits of the group before, and after it in the run), of every run and of its parts by each rule."""
    for run in RUN.finditer(text):
        if run.end() - run.start() < LEAST:
            continue
        groups = [m.span() for m in NUMBER.finditer(text, *run.span())]
        gaps = [text[a:b] for (_, a), (b, _) in itertools.pairwise(groups)]
        blank = [" " in x for x in gaps]
        # a number is compound if it has separators of its own
        words = [0, *itertools.accumulate(blank)]
        compound = [False] * (words[-1] + 1)
        compound[0] = text.endswith("(", 0, run.start())
        for k, x in enumerate(gaps):
            compound[words[k]] |= x[0] != " "
            compound[words[k + 1]] |= x[-1] != " "
        open_ = ["(" in x for x in gaps]
        kind = [b and compound[words[k]] != compound[words[k + 1]] for k, b in enumerate(blank)]
        spans = set()
        for rule in ([False] * len(gaps), blank, open_, kind, [a or b for a, b in zip(open_, kind, strict=True)]):
            edges = [0, *(k + 1 for k, cut in enumerate(rule) if cut), len(groups)]
            spans.update((a, b - 1) for a, b in itertools.pairwise(edges))
        sizes = [0, *(e - s for s, e in groups), 0]
        held = run.start() > 0 and (text[run.start() - 1] == "+" or WORD.match(text, run.start() - 1)), WORD.match(text, run.end())
        for i, j in sorted(spans):
            # what is part of a word, or follows a plus sign, is left to the base
            i, j = i + bool(held[0] and not i), j - bool(held[1] and j == len(groups) - 1)
            if i <= j and groups[j][1] - groups[i][0] >= LEAST:
                s = groups[i][0]
                s -= text.endswith("(", 0, s) and not (s > 1 and (text[s - 2] == "+" or WORD.match(text, s - 2)))
                yield s, groups[j][1], sizes[i], sizes[j + 2]


def proposals(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Generated spans that touch no base span, with their features. They overlap."""
    out, starts, ends = [], [s for _, s, _ in base], list(itertools.accumulate((e for _, _, e in base), max))
    found = (addresses(text), ((*m.span(), 0, 0) for m in GROUPS.finditer(text)), numbers(text))
    for g, spans in enumerate(found):
        for s, e, before, after in dict.fromkeys(spans):
            k = bisect_left(starts, e)
            if not k or ends[k - 1] <= s:
                out.append({"s": s, "e": e, "g": g, "x": features(text, s, e, before, after)})
    return out


def chosen(spans: list[tuple[float, int, int]]) -> list[tuple[int, int]]:
    """Spans (score, start, end) that don't overlap, the best first."""
    out: list = []
    for _, _, s, e in sorted((-q, s - e, s, e) for q, s, e in spans):
        k = bisect(out, (s, e))
        if (not k or out[k - 1][1] <= s) and (k == len(out) or out[k][0] >= e):
            insort(out, (s, e))
    return out


def _scan(batches):
    for b in pieces(batches):
        data, offsets = K.string_buffers(b.column("text"))
        marks = np.concatenate([[0], np.cumsum(_MARKS[data])])
        some = marks[offsets[1:]] - marks[offsets[:-1]] > 0
        base, proposed, cases = [()] * b.num_rows, [[]] * b.num_rows, [[]] * b.num_rows
        spelled = np.asarray(pa.compute.match_substring(b.column("text").fill_null(""), " at ", ignore_case=True)) if b.num_rows else some
        for d in np.flatnonzero(some | spelled).tolist():
            text = data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace")
            base[d] = base_spans(text)
            proposed[d] = proposals(text, base[d])
            cases[d] = [{"kind": k, "left": text[max(0, s - CONTEXT) : s], "value": text[s:e], "right": text[e : e + CONTEXT]} for k, s, e in base[d]]
        count = lambda kind: pa.array([sum(k == kind for k, _, _ in x) for x in base], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(count(k) for k in KINDS[:4]), pa.array([_line(x) for x in base], pa.string()), pa.array(proposed, _PROPOSED), pa.array(cases, _CASES)], ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base", "proposed", "cases"])


def labelled(cases: list[tuple[int, str, str, str, str]]) -> list[tuple[bool, int, int, list[float]]]:
    """(held out, generator, label, features) of all proposals that touch a rewritten form of (rank, kind, left, value, right);
    of a form that is personal data, the proposals of just its bounds are positive."""
    out = []
    for rank, kind, left, value, right in cases:
        pick = rank >> 2 & 0xFFFF
        beside = [(f"{pick % 97} ", ""), ("", f" {pick % 97}")][pick // 4 % 2 :][:1] if kind in ("phone", "card") and pick % 4 == 0 else []
        for form, y in rewritten(kind, value, pick):
            if base_spans(form):
                continue
            for more, less in [("", ""), *beside]:
                text, s = left + more + form + less + right, len(left + more)
                e = s + len(form)
                out += [(rank % 4 == 0, p["g"], int(y and (p["s"], p["e"]) == (s, e)), p["x"]) for p in proposals(text, base_spans(text)) if p["s"] < e and p["e"] > s]
    return out


EXAMPLE = "held boolean, g int, y int, x array<float>"


def examples(found: DataFrame) -> DataFrame:
    """The rewritten forms of every base span, as rows of EXAMPLE; a quarter of the spans, by hash, is held out."""
    cases = found.select("doc_id", F.posexplode("cases").alias("at", "c")).select(F.xxhash64("doc_id", "at", "c.value").bitwiseAND(F.lit(2**63 - 1)).alias("rank"), "c.*")

    def run(batches):
        for b in batches:
            rows = labelled(list(zip(*(b.column(c).to_pylist() for c in ("rank", "kind", "left", "value", "right")), strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.float32())))], ["held", "g", "y", "x"])

    return cases.mapInArrow(run, EXAMPLE)


def _arrays(rows):
    """Triples of arrays (x, y, g) of a partition's rows, TASK_CASES rows at a time."""
    for some in itertools.batched(rows, TASK_CASES):
        yield np.array([r.x for r in some], float), np.array([r.y for r in some], float), np.array([r.g for r in some])


def gathered(cases: DataFrame, n: int):
    """The n cases as an RDD of triples of arrays, in about n / TASK_CASES partitions."""
    return cases.select("x", "y", "g").coalesce(max(1, -(-n // TASK_CASES))).rdd.mapPartitions(_arrays)


def fit(cases: DataFrame) -> tuple[BoostedTrees, list[float]]:
    """Model and each generator's threshold (2: adds nothing), of all rows of EXAMPLE."""
    limits, seen = [2.0] * len(GENERATORS), {(r.held, r.g, r.y): r.n for r in cases.groupBy("held", "g", "y").agg(F.count("*").alias("n")).collect()}
    if len({y for held, _, y in seen if not held}) < 2:
        return BoostedTrees(), limits
    parts = lambda held: gathered(cases.where(F.col("held") == held), sum(n for (h, *_), n in seen.items() if h == held))
    model = BoostedTrees().fit_spread(parts(False).map(lambda p: p[:2]))
    if not any(held for held, _, _ in seen):
        return model, limits

    def scored(part):
        p = np.round(model.predict(part[0]), 6)  # so that as many scores as there are steps meet on the driver
        return {(g, q): np.array(c) for g in range(len(GENERATORS)) for q, c in _tally(p[part[2] == g], part[1][part[2] == g])}

    def together(a, b):
        return a | {k: v + a[k] if k in a else v for k, v in b.items()}

    scores = parts(True).map(scored).treeReduce(together)
    for g in range(len(GENERATORS)):
        own = sorted(((q, *c) for (k, q), c in scores.items() if k == g), reverse=True)
        if len({y for held, k, y in seen if held and k == g}) < 2:
            continue
        p, hits, n = np.array(own).T
        at = np.flatnonzero((np.cumsum(hits) / np.cumsum(n) >= PRECISION) & (hits > 0))
        if len(at):  # half way to the next lower score
            limits[g] = float(np.append(p, 0.0)[at[-1] : at[-1] + 2].mean())
    return model, limits


def _tally(p: np.ndarray, y: np.ndarray):
    """Each score with (positive cases, cases)."""
    scores, at = np.unique(p, return_inverse=True)
    return zip(scores.tolist(), zip(np.bincount(at, y, len(scores)).tolist(), np.bincount(at, minlength=len(scores)).tolist(), strict=True), strict=True)


def _finish(model: BoostedTrees, limits: list[float]):
    def run(batches):
        for b in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            lines, spans, more = b.column("base").to_pylist(), [], []
            for line, rows in zip(lines, b.column("proposed").to_pylist(), strict=True):
                known = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in line.split(",") if x)]
                free = [r for r in rows if limits[r["g"]] <= 1]
                scores = model.predict(np.array([r["x"] for r in free], float)).tolist() if free else []
                added = [("other", s, e) for s, e in chosen([(q, r["s"], r["e"]) for r, q in zip(free, scores, strict=True) if q >= limits[r["g"]]])]
                more.append(len(added))
                spans.append(_line(known + added))
            digest = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
            names = ["doc_id", *(f"n_{k}" for k in KINDS[:4])]
            total = np.sum([np.asarray(b.column(c)) for c in names[1:]], 0) + np.array(more, np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(more, pa.int64()), pa.array(total, pa.int64()), pa.array(digest, pa.string()), pa.array(spans, pa.string())], [*names, "n_other", "n_personal", "base_sha256", "spans"])

    return run


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_other long, n_personal long, base_sha256 string, spans string"


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the base spans, all spans."""
    found = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCAN))
    model, limits = fit(saved(examples(found)))
    return found.mapInArrow(_finish(model, limits), RESULT)
