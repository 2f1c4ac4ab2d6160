"""Long runs over a universe in chunks that can be killed and go on.

A run's folder holds the plan (the universe with its chunk numbers, made once),
the results of waves of chunks, each in a folder of its own name, and a ledger
of finished chunks. A wave's ledger rows are written after its results, in one
file: a wave that was killed is in no ledger, its results are never read, and
the next start runs its chunks again. Finished chunks are anti-joined away.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sampling import chunks

LEDGER = "chunk long, attempt string, n_rows long, n_results long"


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, attempt, n_rows, n_results) of the finished chunks of a run."""
    if not _there(spark, f"{path}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger")


def plan(universe: DataFrame, key: str, size: int, path: str, done: DataFrame | None = None) -> DataFrame:
    """The universe (without the keys of `done`) with chunk numbers; the first call writes it, later ones read it."""
    spark = universe.sparkSession
    if not _there(spark, f"{path}/plan/_SUCCESS"):
        left = universe if done is None else universe.join(done.select(key).distinct(), key, "left_anti")
        chunks(left, key, size).repartitionByRange("chunk").sortWithinPartitions("chunk").write.mode("overwrite").parquet(f"{path}/plan")
    return spark.read.parquet(f"{path}/plan")


def run(universe: DataFrame, key: str, size: int, work: Callable[[DataFrame], DataFrame], path: str, wave: int = 16, waves: int | None = None, done: DataFrame | None = None) -> DataFrame:
    """Work through the chunks that no ledger row has, `wave` at a time and `waves` waves at most; the ledger after that.

    work takes rows of the plan and returns results with their chunk; a chunk may have none."""
    spark = universe.sparkSession
    rows, count = plan(universe, key, size, path, done), 0
    while waves is None or count < waves:
        left = rows.groupBy("chunk").agg(F.count("*").alias("n_rows")).join(ledger(spark, path), "chunk", "left_anti")
        ends = left.orderBy("chunk").limit(wave).agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).first()
        if ends.a is None:
            break
        attempt, todo = uuid.uuid4().hex, left.where(F.col("chunk").between(ends.a, ends.b))
        work(rows.where(F.col("chunk").between(ends.a, ends.b)).join(todo.select("chunk"), "chunk", "left_semi")).write.parquet(f"{path}/results/attempt={attempt}")
        made = spark.read.parquet(f"{path}/results/attempt={attempt}").groupBy("chunk").agg(F.count("*").alias("n_results"))
        record = todo.join(made, "chunk", "left").select(F.col("chunk").cast("long").alias("chunk"), F.lit(attempt).alias("attempt"), "n_rows", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"))
        record.coalesce(1).write.mode("append").parquet(f"{path}/ledger")  # `wave` rows
        count += 1
    return ledger(spark, path)


def results(spark: SparkSession, path: str) -> DataFrame:
    """The results of finished chunks, each from the attempt that finished it."""
    return spark.read.parquet(f"{path}/results").join(ledger(spark, path).select("chunk", "attempt"), ["chunk", "attempt"], "left_semi")
