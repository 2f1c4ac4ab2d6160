"""State on disk: changelog streams over restarts, replays and crashes; runs that were killed."""

import json
import random

import pytest

from quern.operators import resume as U
from quern.streaming import changelog as Z

LOG = "uuid int, seq int, status string"


def batch(spark, log):
    return sorted(tuple(r) for r in Z.compact(spark.createDataFrame(log, LOG), "uuid", ["seq"], "status").select("uuid", "seq", "status").collect())


def feed(spark, path, log):
    spark.createDataFrame(log, LOG).coalesce(1).write.mode("append").parquet(str(path))


def stream(spark, tmp_path, source="in", checkpoint="ck", files=1):
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).parquet(str(tmp_path / source))
    Z.compact_stream(log, "uuid", ["seq"], "status", str(tmp_path / "out"), str(tmp_path / checkpoint), 4).trigger(availableNow=True).start().awaitTermination()


def state(spark, tmp_path):
    return sorted(tuple(r) for r in Z.read_compacted(spark, str(tmp_path / "out"), "status").select("uuid", "seq", "status").collect())


def test_changelog_over_checkpoints(spark, tmp_path):
    feed(spark, tmp_path / "in", [(1, 1, "ACTIVE"), (2, 2, "ACTIVE")])
    stream(spark, tmp_path)
    feed(spark, tmp_path / "more", [(1, 2, "INACTIVE"), (3, 1, "ACTIVE"), (2, 1, "INACTIVE")])
    stream(spark, tmp_path, "more", "other")
    assert state(spark, tmp_path) == [(2, 2, "ACTIVE"), (3, 1, "ACTIVE")]
    # the whole log once more under a new checkpoint, and a late change of a deleted key
    stream(spark, tmp_path, "in", "third")
    feed(spark, tmp_path / "late", [(1, 1, "ACTIVE")])
    stream(spark, tmp_path, "late", "fourth")
    assert state(spark, tmp_path) == [(2, 2, "ACTIVE"), (3, 1, "ACTIVE")]
    assert all(len(v) <= 2 for v in Z._versions(spark, str(tmp_path / "out")).values())
    assert len(list((tmp_path / "out" / "_manifests").glob("*.json"))) == 2


@pytest.mark.parametrize("where", ["write", "commit"])
def test_changelog_after_a_crash(spark, tmp_path, monkeypatch, where):
    r = random.Random(3)
    log = [(r.randrange(12), i, r.choice(["ACTIVE", "INACTIVE"])) for i in range(40)]
    for i in range(0, 40, 8):
        feed(spark, tmp_path / "in", log[i : i + 8])
    commit, calls = Z._commit, []

    def broken(*args):
        calls.append(1)
        if where == "commit" or len(calls) != 3:  # the data is written; the manifest is, or is not
            commit(*args)
        if len(calls) == 3:
            raise OSError("lost")

    monkeypatch.setattr(Z, "_commit", broken)
    with pytest.raises(Exception):
        stream(spark, tmp_path)
    whole = state(spark, tmp_path)
    n = 16 if where == "write" else 24
    assert whole == batch(spark, log[:n])
    monkeypatch.setattr(Z, "_commit", commit)
    stream(spark, tmp_path)
    assert state(spark, tmp_path) == batch(spark, log)
    last = sorted((tmp_path / "out" / "_manifests").glob("*.json"))[-1]
    assert list(json.loads(last.read_text())["applied"].values()) == [4]


def test_resumed_runs(spark, tmp_path):
    rows, path = spark.createDataFrame([(i, f"n{i}") for i in range(95)], "id long, name string"), str(tmp_path / "run")
    seen, tries = spark.createDataFrame([(5,), (7,)], "id long"), []

    def work(part):
        tries.append(sorted(r[0] for r in part.select("chunk").distinct().collect()))
        if len(tries) == 3:
            raise OSError("killed")
        return part.where("id % 10 <> 9").select("id", "chunk", "name")

    U.run(rows, "id", 10, work, path, wave=2, waves=1, done=seen)
    with pytest.raises(OSError):
        U.run(rows, "id", 10, work, path, wave=3)
    done = {r.chunk: (r.n_rows, r.n_results) for r in U.ledger(spark, path).collect()}
    assert sorted(done) == [0, 1, 2, 3, 4]
    U.run(rows, "id", 10, work, path, wave=3)
    assert U.run(rows, "id", 10, work, path, wave=3).count() == 10
    assert tries == [[0, 1], [2, 3, 4], [5, 6, 7], [5, 6, 7], [8, 9]]
    got = sorted((r.id, r.chunk) for r in U.results(spark, path).collect())
    want = [i for i in range(95) if i not in (5, 7)]
    assert got == [(i, k // 10) for k, i in enumerate(want) if i % 10 != 9]
    assert {r.chunk: (r.n_rows, r.n_results) for r in U.ledger(spark, path).collect()}[9] == (3, 3)


def test_chunks_over_sampled_ranges(spark):
    """Bounds of the ranges come from samples; the key's count and the rows must still agree."""
    from quern.operators import sampling as S

    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.execution.rangeExchange.sampleSizePerPartition": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(20_000).selectExpr("id * 7919 % 20011 AS id", "concat('n', id) AS name").coalesce(1)
        got = sorted((r.id, r.chunk) for r in S.chunks(rows, "id", 100).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [c for _, c in got] == [i // 100 for i in range(20_000)]
