"""Approximate nearest neighbours by cross-polytope hashing.

`nearest` finds the `k` nearest rows of every query row by Euclidean distance.

1. Equal vectors are one class; a class keeps its k + 1 smallest ids, the only
   ones of it that can stand among k results (ties go to the smaller id).
2. A table hashes a unit vector by pseudo-rotations (three rounds of random
   signs and a fast Hadamard transform): the nearest signed axis is a digit of
   the bucket. How many bits a bucket has, and how many buckets of each table a
   query probes (in the order of its summed coordinates), is fitted: SAMPLE
   query classes are compared with every class, and of all settings under which
   at least TARGET of the true neighbours are met the cheapest is taken. Where
   none is (as with a handful of rows), all rows are one bucket.
3. Every class goes to its bucket of each table, every query class to those it
   probes. Buckets of over BLOCK classes are cut into blocks, which the queries
   visit one by one; a task holds one block and streams the queries past it.
4. The blocks' best are ranked by the exact distance of the original vectors.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id and vectors that haven't the
most frequent length. Repeated rows count once. Rows of one id with different
vectors are rows of their own; a query never finds its own id, and each id it
finds has the nearest of its distances. An empty table gives no rows. Columns
beside the id and the vector are ignored. A bucket into which many different
vectors fall is searched whole, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import maybe_broadcast, saved, shuffle_width

TABLES = 8
#: Query classes that the setting is fitted on, and the share of their neighbours that it has to meet.
SAMPLE, TARGET = 128, 0.97
#: Classes of a bucket that a task holds at a time.
BLOCK = 2048
#: Expected classes of a bucket, at least, and most probes that are ranked.
LEAST, PROBES = 64, 4096
#: What a probe costs beside the distances it takes, in distances.
PROBE_COST = 100


def _padded(dim: int) -> int:
    return 1 << max(0, dim - 1).bit_length()


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """x (rows of a power of two's length) after three rounds of random signs and Hadamard."""
    rng, (n, d) = np.random.default_rng(seed), x.shape
    for _ in range(3):
        x = x * rng.choice([-1.0, 1.0], d)
        half = 1
        while half < d:
            pair = x.reshape(n, d // (2 * half), 2, half)
            x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, d)
            half *= 2
        x = x / np.sqrt(d)
    return x


def digits(bits: int, dim: int) -> list[int]:
    """Bits of each digit of a bucket: whole signed axes first, the rest from the first coordinates."""
    whole = _padded(dim).bit_length()
    return [whole] * (bits // whole) + [bits % whole] * (bits % whole > 0)


def scores(vectors: np.ndarray, table: int, place: int, bits: int) -> np.ndarray:
    """(rows, 2^bits): coordinates on the signed axes of one digit, negative axes last."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    wide = np.zeros((len(unit), _padded(unit.shape[1])))
    wide[:, : unit.shape[1]] = unit
    r = rotated(wide, 1000 * table + place)[:, : 1 << (bits - 1)]
    return np.concatenate([r, -r], 1)


def bucket(vectors: np.ndarray, table: int, bits: int) -> np.ndarray:
    out = np.zeros(len(vectors), np.int64)
    for place, b in enumerate(digits(bits, vectors.shape[1])):
        out = (out << b) | scores(vectors, table, place, b).argmax(1)
    return out


def probed(vectors: np.ndarray, table: int, bits: int, most: int) -> np.ndarray:
    """(rows, probes): buckets by falling sum of coordinates; each one's own comes first."""
    out, total = np.zeros((len(vectors), 1), np.int64), np.zeros((len(vectors), 1))
    for place, b in enumerate(digits(bits, vectors.shape[1])):
        s = scores(vectors, table, place, b)
        keep = np.argsort(-s, 1, kind="stable")[:, :most]
        total = (total[:, :, None] + np.take_along_axis(s, keep, 1)[:, None, :]).reshape(len(s), -1)
        out = ((out[:, :, None] << b) | keep[:, None, :]).reshape(len(s), -1)
        best = np.argsort(-total, 1, kind="stable")[:, :most]
        out, total = np.take_along_axis(out, best, 1), np.take_along_axis(total, best, 1)
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of list<double> of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of each query's k nearest rows and what ties with the last.

    Products choose what may be among them, with room for their rounding; the
    distances themselves are roots of summed squared differences.
    """
    size = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
    rough, room = size - 2 * queries @ rows.T, size * 1e-11
    if rows.shape[0] > k:
        last = np.partition(rough + room, k - 1, 1)[:, k - 1 : k]
        q, r = np.nonzero(rough - room <= last)
    else:
        q, r = (x.ravel() for x in np.indices(rough.shape))
    return q, r, np.sqrt(((queries[q] - rows[r]) ** 2).sum(1))


def _hasher(bits: int, probes: int | None, vectors: bool):
    """(tab, bucket, kind, cid[, vec]): a row's bucket in each table, or (probes) those it probes."""
    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            x = matrix(t.column("vec"))
            for table in range(TABLES):
                homes = bucket(x, table, bits)[:, None] if probes is None else probed(x, table, bits, probes)
                step = max(1, 20_000 // homes.shape[1])
                for a in range(0, len(x), step):
                    part = homes[a : a + step]
                    at = pa.array(np.repeat(np.arange(a, a + len(part)), part.shape[1]))
                    cols = [pa.array(np.full(part.size, table, np.int32)), pa.array(part.ravel()), pa.array(np.full(part.size, int(probes is not None), np.int32)), t.column("cid").take(at)]
                    yield pa.RecordBatch.from_arrays(cols + [t.column("vec").take(at)] * vectors, names=["tab", "bucket", "kind", "cid"] + ["vec"] * vectors)

    return run


HASHED = "tab int, bucket long, kind int, cid long"


def _search(k: int):
    """Partitions sorted by (tab, bucket, block, kind): a block's classes, then the queries that visit it."""
    def run(batches):
        now, held, ids, rows = None, [], [], None
        for t in batches:
            if not t.num_rows:
                continue
            key = np.stack([t.column(c).to_numpy() for c in ("tab", "bucket", "block")], 1)
            kind, cid, x = t.column("kind").to_numpy(), t.column("cid").to_numpy(), matrix(t.column("vec"))
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), t.num_rows], strict=True):
                if now is None or (key[a] != now).any():
                    now, held, ids, rows = key[a], [], [], None
                if not kind[a]:
                    held.append(x[a:b])
                    ids.append(cid[a:b])
                elif held:
                    if rows is None:
                        rows, names = np.concatenate(held), np.concatenate(ids)
                    for c in range(a, b, 512):
                        q, r, s = best(x[c : min(b, c + 512)], rows, k)
                        yield pa.RecordBatch.from_arrays([pa.array(cid[c : min(b, c + 512)][q]), pa.array(names[r]), pa.array(s)], names=["query", "cid", "score"])

    return run


FOUND = "query long, cid long, score double"


def _exhaustive(sample: np.ndarray, names: np.ndarray, k: int):
    def run(batches):
        for t in batches:
            if t.num_rows:
                q, r, s = best(sample, matrix(t.column("vec")), k)
                yield pa.RecordBatch.from_arrays([pa.array(names[q]), t.column("cid").take(pa.array(r)), pa.array(s)], names=["query", "cid", "score"])

    return run


def fitted(classes: DataFrame, asked: DataFrame, n: int, k: int) -> tuple[int, int]:
    """(bits, probes): the cheapest setting that meets TARGET of the sample's true neighbours."""
    sample = asked.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return 0, 1
    names, x = sample["cid"].to_numpy(), matrix(sample["vec"])
    near = classes.select("cid", "vec").mapInArrow(_exhaustive(x, names, k), FOUND).where("query <> cid")
    top = near.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy("score", "cid"))).where(F.col("rank") <= k)
    true = saved(top.select("query", "cid")).join(classes.select("cid", "vec"), "cid").toArrow()  # SAMPLE * k rows
    if not true.num_rows:
        return 0, 1
    y, of = matrix(true["vec"]), np.searchsorted(np.sort(names), true["query"].to_numpy())
    of, options = np.argsort(names)[of], []
    for bits in range(1, max(0, (n // LEAST).bit_length() - 1) + 1):
        rank = np.full(len(y), np.iinfo(np.int64).max)
        for table in range(TABLES):
            order, home = probed(x, table, bits, PROBES), bucket(y, table, bits)
            hit = order[of] == home[:, None]
            rank = np.minimum(rank, np.where(hit.any(1), hit.argmax(1), np.iinfo(np.int64).max))
        needed = int(np.sort(rank)[int(np.ceil(TARGET * len(rank))) - 1])
        if needed < PROBES:
            options.append(((needed + 1) * (n / (1 << bits) + PROBE_COST) * TABLES, bits, needed + 1))
    return min(options, default=(0, 0, 1))[1:]


def nearest(rows: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row for which `queries` (a condition on vec_id) holds."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda v: v != 0))
    length = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # 0.0 and -0.0 are one value
    rows = rows.where(F.size("vec") == length.d).select("vec_id", F.transform("vec", lambda v: v + F.lit(0.0)).alias("vec")).withColumn("h", F.xxhash64("vec"))

    first = W.partitionBy("h", "vec").orderBy("vec_id")
    few = rows.withColumn("r", F.dense_rank().over(first)).where(F.col("r") <= k + 1)
    classes = few.groupBy("h", "vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()))
    asking = saved(rows.where(queries).join(classes.select("h", "vec", "cid"), ["h", "vec"]).select(F.col("vec_id").alias("query_id"), "cid").distinct())
    asked = saved(classes.join(asking.select("cid").distinct(), "cid", "left_semi").select("cid", "vec"))
    bits, probes = fitted(classes, asked, classes.count(), k)

    data = classes.select("cid", "vec")
    blocks = data.mapInArrow(_hasher(bits, None, False), HASHED).groupBy("tab", "bucket").count().where(F.col("count") > BLOCK)
    blocks = maybe_broadcast(saved(blocks.select("tab", "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("n"))))
    def placed(df, probes, block):
        out = df.mapInArrow(_hasher(bits, probes, True), f"{HASHED}, vec array<double>").join(blocks, ["tab", "bucket"], "left")
        return out.select("tab", "bucket", block(F.coalesce("n", F.lit(1))).alias("block"), "kind", "cid", "vec")

    held = placed(data, None, lambda n: F.pmod(F.xxhash64("cid"), n).cast("int"))
    visits = placed(asked, probes, lambda n: F.explode(F.sequence(F.lit(0), n - 1)))
    dealt = held.unionByName(visits).repartition(max(64, shuffle_width(spark)), "tab", "bucket", "block").sortWithinPartitions("tab", "bucket", "block", "kind")
    found = dealt.mapInArrow(_search(k + 1), FOUND).groupBy("query", "cid").agg(F.min("score").alias("score"))
    found = found.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy("score", "cid")))
    # with ties all classes of the last distance count, as their ids decide
    last = F.max(F.when(F.col("r") <= k + 1, F.col("score"))).over(W.partitionBy("query"))
    near = found.withColumn("last", last).where(F.col("score") <= F.col("last")).join(classes.select("cid", "ids"), "cid")
    ids = near.select(F.col("query").alias("cid"), F.explode("ids").alias("vec_id"), "score").join(asking, "cid").where("query_id <> vec_id")
    ids = ids.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = ids.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
