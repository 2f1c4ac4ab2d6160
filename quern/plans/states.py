"""Queries that keep state on disk: a compacted changelog and resumed runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import resume as U
from ..sources.tables import shared_folder, table
from ..streaming import changelog as Z
from .catalogue import query


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("changelog_stream", """SELECT client_id, change_id, seq, state, segment, city FROM (SELECT *, CASE WHEN op = 'D' OR op = 'delete' THEN 'INACTIVE' ELSE 'ACTIVE' END AS state FROM client_changes
 QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY seq DESC NULLS LAST, change_id DESC NULLS LAST) = 1) WHERE state = 'ACTIVE'""")
def changelog_stream(spark, d):
    """client_changes as a stream, stopped in the middle and begun anew with another checkpoint."""
    folder, source = _folder(spark, "changelog"), table(spark, d, "client_changes")
    rows = source.select("client_id", "change_id", "seq", F.when(F.col("op").isin("D", "delete"), "INACTIVE").otherwise("ACTIVE").alias("state"), "segment", "city")
    rows.withColumn("half", F.pmod(F.xxhash64("change_id"), F.lit(2))).write.partitionBy("half").parquet(f"{folder}/log")
    for half, checkpoint in ((0, "first"), (1, "second")):  # the second reads a part of the log that the first hasn't seen
        log = spark.readStream.schema(rows.schema).parquet(f"{folder}/log/half={half}")
        Z.compact_stream(log, "client_id", ["seq", "change_id"], "state", f"{folder}/state", f"{folder}/{checkpoint}", 16).trigger(availableNow=True).start().awaitTermination()
    return Z.read_compacted(spark, f"{folder}/state", "state").drop("bucket", "v")


@query("resumed_chunks", "SELECT client_id, ((row_number() OVER (ORDER BY client_id) - 1) // 100)::BIGINT AS chunk, upper(segment) AS segment, round(balance, 0)::BIGINT AS balance FROM clients WHERE client_id % 7 <> 0")
def resumed_chunks(spark, d):
    """Clients in chunks, of which a first run finishes three, a second is killed at its results, a third does the rest."""
    clients, folder = table(spark, d, "clients"), _folder(spark, "chunks")
    seen, rows = clients.where("client_id % 7 = 0").select("client_id"), clients.select("client_id", "segment", "balance")
    n = rows.count() // 100 // 3 + 1
    work = lambda x: x.select("client_id", "chunk", F.upper("segment").alias("segment"), F.round("balance", 0).cast("long").alias("balance"))
    U.run(rows, "client_id", 100, work, folder, wave=n, waves=1, done=seen)
    work(U.plan(rows, "client_id", 100, folder)).where("chunk >= 3").write.parquet(f"{folder}/results/attempt=killed")
    U.run(rows, "client_id", 100, work, folder, wave=n)
    return U.results(spark, folder).select("client_id", "chunk", "segment", "balance")
