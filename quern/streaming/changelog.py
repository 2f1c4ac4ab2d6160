"""Changelog compaction, event merge and windowed counts, batch and streaming."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F


def compact(log: DataFrame, key: str, order: list[str], status: str, active: str = "ACTIVE") -> DataFrame:
    """Last change per key, kept while active (upserts and deletes)."""
    rest = [c for c in log.columns if c != key]
    last = log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")
    return last.where(F.col(status) == active)


BUCKETS = 64


def compact_stream(log: DataFrame, key: str, order: list[str], status: str, path: str, checkpoint: str, buckets: int = BUCKETS):
    """The same as a stream: last changes (deletes kept as tombstones) stand in buckets of the key's hash,
    and a micro-batch rewrites only the buckets that it touches, as a new version of each.

    A manifest names every bucket's version and the last micro-batch of every checkpoint. It is written after
    the data and put in place by one rename, so that a reader sees a micro-batch whole or not at all: what
    a crash leaves behind is in no manifest and is overwritten. A micro-batch that the manifest has is not
    applied again; a new checkpoint is another stream, whose changes meet the state by `order`. One stream
    writes at a time. read_compacted gives the state; versions before the last but one are removed."""
    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        number, manifest = _manifest(spark, path)
        if manifest["applied"].get(stream, -1) >= epoch:
            return
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # `buckets` numbers at most
        versions = {int(b): v for b, v in manifest["versions"].items()}
        if touched:
            if kept := [f"{path}/bucket={b}/v={versions[b]}" for b in touched if b in versions]:
                new = new.unionByName(spark.read.schema(batch.schema).parquet(*kept).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
            rest = [c for c in new.columns if c not in (key, "bucket")]
            last = new.groupBy("bucket", key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select("bucket", F.lit(number + 1).alias("v"), key, "r.*")
            last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "v").parquet(path)
        before, versions = versions, versions | {b: number + 1 for b in touched}
        _commit(spark, path, number + 1, {"versions": versions, "applied": manifest["applied"] | {stream: epoch}})
        for b in touched:  # of an older manifest a reader may still hold the version before
            for v in _versions(spark, path).get(b, ()):
                if v not in (versions[b], before.get(b)):
                    _fs(spark, path).delete(_path(spark, f"{path}/bucket={b}/v={v}"), True)

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def _path(spark, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark, path: str) -> dict[int, list[int]]:
    """bucket -> its versions, by the names of the folders alone."""
    out: dict[int, list[int]] = {}
    for s in _fs(spark, path).globStatus(_path(spark, f"{path}/bucket=*/v=*")) or []:
        bucket, v = (x.partition("=")[2] for x in s.getPath().toString().rsplit("/", 2)[1:])
        out.setdefault(int(bucket), []).append(int(v))
    return out


def _manifest(spark, path: str) -> tuple[int, dict]:
    """The number of the last manifest and what it says; 0 and nothing before the first."""
    names = sorted(s.getPath().getName() for s in _fs(spark, path).globStatus(_path(spark, f"{path}/_manifests/*.json")) or [])
    if not names:
        return 0, {"versions": {}, "applied": {}}
    return int(names[-1].split(".")[0]), json.loads(spark.read.text(f"{path}/_manifests/{names[-1]}").first()[0])


def _commit(spark, path: str, number: int, manifest: dict) -> None:
    fs, folder = _fs(spark, path), f"{path}/_manifests"
    made = fs.create(_path(spark, f"{folder}/.{number:012d}"), True)
    made.write(bytearray(json.dumps(manifest).encode()))
    made.close()
    if not fs.rename(_path(spark, f"{folder}/.{number:012d}"), _path(spark, f"{folder}/{number:012d}.json")):
        raise OSError(f"manifest {number} of {path} could not be put in place")
    fs.delete(_path(spark, f"{folder}/{number - 2:012d}.json"), False)


def read_compacted(spark, path: str, status: str, active: str = "ACTIVE") -> DataFrame:
    """The active rows of compact_stream's state: the versions that the last manifest names."""
    files = [f"{path}/bucket={b}/v={v}" for b, v in _manifest(spark, path)[1]["versions"].items()]
    return spark.read.parquet(*files).where(F.col(status) == active)


def merge_events(seeds: DataFrame, events: DataFrame, key: str, at: str) -> DataFrame:
    """Latest event per seed; a seed without any gets a source_error row."""
    rest = [c for c in events.columns if c != key]
    last = events.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(at)).alias("r")).select(key, "r.*", F.lit("captured").alias("state"))
    missing = seeds.select(key).distinct().join(events.select(key).distinct(), key, "left_anti").withColumn("state", F.lit("source_error"))
    return last.unionByName(missing, allowMissingColumns=True)


def windowed_counts(events: DataFrame, ts: str, window: str, *keys: str, late: str | None = None) -> DataFrame:
    """Tumbling counts; a watermark where `late` is given (TIMESTAMP_NTZ columns
    are cast, as watermarks need an instant)."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if late:
        e = e.withWatermark("_ts", late)
    g = e.groupBy(F.window("_ts", window).alias("w"), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("window_start"), *keys, "n")


def session_counts(events: DataFrame, ts: str, gap: str, *keys: str) -> DataFrame:
    e = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    g = e.groupBy(F.session_window("_ts", gap).alias("s"), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), *keys, "n")
