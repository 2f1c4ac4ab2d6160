"""Turn reassembly, nearest neighbours and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import conversations, lexical, neighbours


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def events(turns, batches=10, quiet=2):
    """The contract of op11, batch by batch, over (conv_id, turn, role, text)."""
    turns = [(c, t, r or "", x or "") for c, t, r, x in turns if c is not None and t is not None]
    first, arriving, out = {}, defaultdict(list), []
    for c, t, r, x in turns:
        first[c] = min(t, first.get(c, t))
        h = int(sha(f"{c}:{t}")[:8], 16)
        arriving[h % batches].append((c, t, r, x))
        if h % 7 < 2:
            arriving[(h + 5) % batches].append((c, t, "user", x))
    kept, after, last, closed = defaultdict(dict), dict(first), {}, set()

    def close(c, b):
        k = kept[c]
        closed.add(c)
        left, most = sorted(t for t in k if t >= after[c]), max(k)
        out.append(("close", sha(",".join(map(str, left))), c, -1, b, sum(t not in k for t in range(first[c], most + 1)), sum(t - 1 in k and k[t - 1][0] == k[t][0] for t in k)))

    for b in range(batches):
        one = {}
        for c, t, r, x in arriving[b]:
            one[c, t] = min(one.get((c, t), (f"{r}|{x}".encode(), r.encode())), (f"{r}|{x}".encode(), r.encode()))
        for (c, t), (payload, role) in one.items():
            if c in closed:
                out.append(("reject", sha(payload.decode()), c, t, b, None, None))
                continue
            last[c] = b
            kept[c].setdefault(t, (role.decode(), payload.decode()))
        for c in last:
            if c in closed:
                continue
            while after[c] in kept[c]:
                out.append(("release", sha(kept[c][after[c]][1]), c, after[c], b, None, None))
                after[c] += 1
            if b - last[c] >= quiet:
                close(c, b)
    for c in last:
        if c not in closed:
            close(c, batches)
    return out


def turns(n=40, seed=4):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice([None, "", "é", f"said {c} {t}", "a|b"])) for c in range(n) for t in range(r.choice([-2, 0, 3]), r.randrange(4, 12)) if r.random() > 0.1]
    rows += [(c, t, "user", "another") for c, t, _, _ in rows[:60]] + rows[:40]
    rows += [(77, t, "user", "long") for t in range(150)] + [(None, 1, "user", "x"), (1, None, "user", "x"), (None, None, None, None)]
    return rows


def test_reassembly(spark):
    rows = turns()
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "conv_id long, turn long, role string, text string, batch int, first int").repartition(3)
    got = [tuple(x) for x in conversations.digests(conversations.replay(df)).collect()]
    want = events(rows)
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {x[0] for x in want} == {"release", "reject", "close"} and any(x[4] == 10 for x in want) and any(0 < x[4] < 10 for x in want if x[0] == "close")


def test_reassembly_of_no_turns(spark):
    assert conversations.replay(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), batches=2).count() == 0


def test_stores_share_their_memory(spark, monkeypatch):
    held, start, name = [], conversations.reassemble, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"

    def seen(*a, **k):
        held.append(spark.conf.get(name, None))
        return start(*a, **k)

    monkeypatch.setattr(conversations, "reassemble", seen)
    out = conversations.replay(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b")], "conv_id long, turn long, role string, text string"), batches=1)
    assert held == ["true"] * 2 and spark.conf.get(name, None) is None
    assert sorted((r.event, r.turn, r.batch) for r in out.collect()) == [("close", -1, 1), ("release", 0, 0), ("release", 1, 0)]


@pytest.mark.parametrize("held", [1000, 3])
def test_the_stream_finds_each_turns_smallest_payload(spark, monkeypatch, held):
    """Repeats of a turn in a batch reach the operator, in any order, for open and for closed conversations."""
    monkeypatch.setattr(conversations, "HELD", held, raising=False)
    rows, deal = turns(25, seed=8), conversations.dealt
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def repeated(table, batches):
        out = deal(table, batches)
        return out.unionByName(out.withColumn("text", F.concat(F.lit("~ larger"), "text")).withColumn("role", F.lit("~"))).unionByName(out)

    monkeypatch.setattr(conversations, "dealt", repeated)
    key = lambda x: tuple(str(v) for v in x)
    want = events(rows)
    assert sorted((tuple(x) for x in conversations.digests(conversations.replay(df)).collect()), key=key) == sorted(want, key=key)
    assert {x[0] for x in want} == {"release", "reject", "close"}


def test_a_start_opens_one_store_a_partition(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(conversations, "scratch", lambda spark: str(tmp_path))
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "a"), (2, 4, "user", "c")], "conv_id long, turn long, role string, text string")
    out = conversations.digests(conversations.replay(df, batches=1)).select("event", "conv_id", "turn", "batch", "sha256", "n_missing", "n_breaks").collect()
    released = [("release", c, t, 0, sha(f"user|{x}"), None, None) for c, t, x in ((1, 0, "a"), (1, 1, "a"), (2, 4, "c"))]
    assert sorted(tuple(r) for r in out) == [("close", 1, -1, 1, sha(""), 0, 1), ("close", 2, -1, 1, sha(""), 0, 0), *released]
    assert [x.name for x in (tmp_path / "state" / "state").iterdir() if x.name.isdigit()] == ["0"]


def neighbours_of(rows, k=10):
    """{query: [(id, distance)]} by brute force; rows (id, vector), queries ids divisible by 100."""
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and ok(v)]
    out = {}
    for q in {i for i, _ in rows if i % 100 == 0}:
        near = {}
        for i, v in rows:
            if i != q:
                d = min(float(np.sqrt(((v - w) ** 2).sum())) for j, w in rows if j == q)
                near[i] = min(d, near.get(i, d))
        out[q] = sorted(near.items(), key=lambda x: (x[1], x[0]))[:k]
    return out


def vectors(n, d, seed, scale=False):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) / math.sqrt(d)
    if scale:
        x = x * r.uniform(0.5, 4, n)[:, None]
    return x


@pytest.mark.parametrize("scale", [False, True])
def test_neighbours(spark, scale, monkeypatch):
    """Random vectors, the hardest for a hash; copies, near copies and blocks of a few rows."""
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    x = vectors(3000, 24, 7, scale)
    x[1000:1900] = x[5]
    x[2000:2300] = x[6] + np.random.default_rng(1).normal(size=(300, 24)) * 1e-3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cid int, tab string, bucket int")
    got = defaultdict(list)
    for r in neighbours.nearest(df.repartition(4), "vec_id % 100 = 0").orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = neighbours_of(rows)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) >= 0.9 * 10 * len(want)
    for q in (1000, 1500):
        assert got[q] == want[q]
    for q, v in got.items():
        assert all(s == pytest.approx(float(np.sqrt(((x[q] - x[i]) ** 2).sum())), rel=1e-12) for i, s in v)
        assert v == sorted(v, key=lambda x: (x[1], x[0]))


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [-0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [3.0, 3.0]), (100, [1.0, 0.0]), (200, [0.0, -0.0]), (10, [1.0, 2.0, 3.0])]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 100 = 0").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, pytest.approx(r.score)))
    want = neighbours_of([x for x in rows if x[0] != 10])
    assert got == want and [i for i, _ in got[0]] == [2, 100, 1, 9]
    for none in ([], [(0, None)]):
        assert neighbours.nearest(spark.createDataFrame(none, "vec_id long, embedding array<float>"), "vec_id % 100 = 0").count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(alone, "vec_id % 100 = 0").count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs, items, k=10):
    terms = lambda t: TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(w), len(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    n_docs, total, df = len(bags), sum(n for _, _, n in bags), Counter(w for _, b, _ in bags for w in b)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(terms(t))
    out = []
    for item, q in asked.items():
        found = []
        for i, b, n in bags:
            m = 25 + 75 * n * n_docs // total
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 8 * m)) for w, c in q.items() if w in b)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize("pruned", [0.01, 0.25, 1.0])
def test_search(spark, pruned, monkeypatch):
    monkeypatch.setattr(lexical, "PRUNED", pruned)
    r = random.Random(9)
    words = [f"w{i}É" if i % 7 == 0 else f"W{i}" for i in range(300)]
    text = lambda n: " ".join(words[min(299, int(r.expovariate(0.03)))] for _ in range(n))
    docs = [(i, text(r.randrange(1, 120))) for i in range(400)]
    docs += [(i + 1000, docs[i % 5][1]) for i in range(60)] + [(7, docs[3][1]), (None, docs[0][1]), (None, docs[0][1]), (900, None), (901, ""), (902, " -.,\n"), (903, "w1 " * 20_000), (904, " x  _y_"), (3, docs[3][1])]
    items = [(i, " ".join(text(r.randrange(1, 25)).split() + docs[i][1].split()[:12])) for i in range(25)] + [(25, None), (26, ""), (27, "nowhere"), (28, "x "), (29, "W1 w1 w1 w2"), (29, "w3"), (None, "w4 w5")]
    d = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, item int, n int, word string").repartition(3)
    q = spark.createDataFrame([(i, t, 1, "y") for i, t in items], "item_id long, text string, doc_id int, word string")
    got = [tuple(x) for x in lexical.ranked(d, q).select("item_id", "rank", "doc_id", "score").collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=order) == sorted(search(docs, items), key=order)


def test_search_of_nothing(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    items, no_items = spark.createDataFrame([(1, "a")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert lexical.ranked(none, items).count() == lexical.ranked(docs, no_items).count() == 0
    assert [tuple(x) for x in lexical.ranked(docs, items).collect()] == [tuple(x) for x in search([(1, "a b")], [(1, "a")])]
