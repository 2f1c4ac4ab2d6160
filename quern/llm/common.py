"""Session-level helpers of the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .kernels import string_buffers

#: Documents whose ids fall into one block of this many ids are handled
#: together by the operators that send packed hash arrays between executors.
BATCH_IDS = 256
#: Most bytes of text of such a block; one document is never cut.
BATCH_BYTES = 32_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="quern-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_folders: set[str] = set()


def scratch(spark: SparkSession) -> str:
    """A new path in the application's own part of the shared folder, which is removed when the driver ends."""
    own = f"{shared_dir(spark)}/quern-{spark.sparkContext.applicationId}"
    if own not in _folders:
        _folders.add(own)

        def remove():
            with contextlib.suppress(Exception):  # the session may be gone before
                path = spark._jvm.org.apache.hadoop.fs.Path(own)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

        atexit.register(remove)
    return f"{own}/{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read back."""
    spark = df.sparkSession
    path = scratch(spark)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files of plans that nothing refers to any more go now, not when the driver's heap is next collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession) -> int:
    """Buckets for packed hashes: they follow the session's shuffle width, so
    that a bucket's memory stays level as the input and the width grow."""
    return max(64, shuffle_width(spark))


def small_enough(df: DataFrame, rows: int) -> bool:
    """True if df has at most so many rows; reads no more than one beyond."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """Broadcast hint only after the row count of df was checked."""
    return F.broadcast(df) if small_enough(df, rows) else df


def batched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids: int = BATCH_IDS, most: int | None = None) -> DataFrame:
    """(batch, doc_id, text): documents that are handled together, batches in the order of ids.

    A batch is a block of `ids` ids; a block of over `most` (BATCH_BYTES) bytes of text is
    dealt id by id. Rows without an id come last, about `ids` of them a batch.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))
    block = F.col("doc_id") - F.pmod("doc_id", F.lit(ids))
    load = rows.groupBy(block.alias("heavy")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"))
    load = saved(load.where(F.col("heavy").isNull() | (F.col("bytes") > (BATCH_BYTES if most is None else most))))
    bare = load.where("heavy is null").agg(F.sum("n")).first()[0] or 0
    heavy = load.where("heavy is not null").select("heavy")
    if not heavy.isEmpty():
        rows = rows.join(maybe_broadcast(heavy), block == F.col("heavy"), "left")
        block = F.when(F.col("heavy").isNull(), block).otherwise(F.col("doc_id"))
    last = F.lit(2**63 - 2**32) + F.pmod(F.xxhash64("place"), F.lit(-(-bare // ids) or 1))
    return rows.select(F.coalesce(block, last).alias("batch"), "doc_id", "text")


def pieces(batches, col: str = "text", limit: int = 2_000_000):
    """Record batches cut to runs of rows of about `limit` text bytes (one row
    at least), which bounds the kernels' working memory."""
    for b in batches:
        if not b.num_rows:
            continue
        _, offsets = string_buffers(b.column(col))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield b.slice(at, end - at)
            at = end


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of an edge list (a, b) of longs: smallest reachable id.

    Alternating large-star and small-star rounds; each round's edges go to the
    shared folder, so that a lost executor costs one round at most. Every
    vertex sends at most its own edges and no component meets in one task: the
    groups are read by partial aggregates only. A round that leaves the edges
    as they were (count and xor of their hashes, observed while they are
    written) ends it.
    """
    def marked(df):
        seen = Observation()
        out = saved(df.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")))
        return out, (seen.get["n"], seen.get["x"])

    now, sign = marked(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while sign[0]:
        least = now.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
        large = saved(now.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b")))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = large.join(down, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        (now, new), before = marked(stars.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b")), sign
        sign = new
        if sign == before:
            break
    return saved(now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component"))
