"""Name matching: classes, blocks of hot tokens, ties."""

import random

import pytest

from quern.operators import matching as M


def brute(targets, candidates):
    import re

    words = lambda s: frozenset(re.findall("[a-z0-9]{2,}", (s or "").lower())) - {"as"}
    score = {}
    for t, n, c in targets:
        for k, m, d in candidates:
            a, b = words(n), words(m)
            if a and b and len(a & b) / len(a | b) >= 0.5:
                score[t, k] = round(4 * len(a & b) / len(a | b) + (3 if c is not None and c == d else 0), 4)
    best = lambda side, x: [p for p in score if p[side] == x and score[p] == max(score[q] for q in score if q[side] == x)]
    out = {}
    for t, _, _ in targets:
        mine = best(0, t)
        status = "no_match" if not mine else "ambiguous" if len(mine) > 1 else "assigned" if best(1, mine[0][1]) == mine else "contested"
        out[t] = (status, mine[0][1] if status == "assigned" else None, score[mine[0]] if mine else None)
    return out


@pytest.mark.parametrize("block", [2, 10_000])
def test_assignment(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    r = random.Random(block)
    words = [f"w{i}" for i in range(25)]
    name = lambda: " ".join(r.choice(words) for _ in range(r.randrange(1, 6)))
    targets = [(i, name(), r.choice(["a", "b", None])) for i in range(60)] + [(100, None, "a"), (101, "AS", "a"), (102, "", None)] + [(200 + i, "common name", "a") for i in range(20)]
    candidates = [(i, r.choice(targets)[1] if i % 2 else name(), r.choice(["a", "b", None])) for i in range(60)] + [(300 + i, "Common  NAME as", "a") for i in range(20)] + [(400, None, None)]
    kind = "id long, name string, city string, token string, class int"
    t, c = (spark.createDataFrame([(*x, "x", 1) for x in rows], kind) for rows in (targets, candidates))
    got = {x.target: (x.status, x.candidate, x.score) for x in M.assign(t, c, "id", "name", {"city": 3.0}).collect()}
    assert got == brute(targets, candidates) and {s for s, _, _ in got.values()} == {"assigned", "ambiguous", "contested", "no_match"}
    assert M.assign(t.limit(0), c, "id", "name", {}).count() == 0
    assert {x.status for x in M.assign(t, c.limit(0), "id", "name", {"city": 1.0}).collect()} == {"no_match"}
