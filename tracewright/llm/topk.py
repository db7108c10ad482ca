"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension: 1 where the component is over 0. Codes, as long as
the longest vector, are cut into m segments of about log2(n) bits. In round r = 0, 1, ...
a query looks up, in every segment, every value that differs from its own in exactly r bits,
and verifies what it finds by full Hamming distance. After round r every code within
m * (r + 1) - 1 has been seen; queries whose kth distance this covers are done, and only the
others go on.

Distribution: a code is sent once a segment, to the bucket of its value's upper bits; a query
only to those buckets that hold values it probes in this round. Buckets of more than
``shard_rows`` codes are dealt to shards by a hash of the code, so no task holds more. Equal
codes are one code with its smallest ids, and equal queries one query, so copies cost nothing.

Rows whose embedding is null are neither searched nor found. Missing components and NaN
give 0 bits, however long the longest vector is. A query does not find rows of its own id;
ties go to the smaller id; repeated rows count once. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm._shared import by_value, frugal, store, table

#: Codes of one shard, and queries compared with it at once.
SHARD_ROWS = 1 << 14
BLOCK_QUERIES = 256
K = 10
EVERY = 50
#: Bits of a segment, at least and at most.
NARROW, WIDE = 4, 24
#: Found codes verified at once.
VERIFIED = 1 << 18


def encoder(n_bytes: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                ids, lists = batch.column(0).slice(start, 1024), batch.column(1).slice(start, 1024)
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(sizes)), sizes)
                bits = np.zeros((len(sizes), n_bytes * 8), dtype=np.uint8)
                bits[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat > 0
                yield pa.RecordBatch.from_arrays([ids, pa.array([b.tobytes() for b in np.packbits(bits, axis=1)], pa.binary())], names=["vec_id", "code"])

    return encode


def flips(bits: int, radius: int) -> np.ndarray:
    """All numbers of ``bits`` bits with ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), radius)], dtype=np.int64)


def unpacked(column: pa.Array) -> np.ndarray:
    """Codes as rows of bits."""
    data = column.to_pylist()
    return np.unpackbits(np.frombuffer(b"".join(data), np.uint8).reshape(len(data), -1), axis=1) if data else np.zeros((0, 8), np.uint8)


class Segments:
    """Where codes are cut: m segments of nearly equal width, and how many upper bits of each name a bucket."""

    def __init__(self, bits: int, n: int, shard_rows: int) -> None:
        width = max(NARROW, min(WIDE, int(log2(max(n, 2)))))
        self.m = ceil(bits / width)
        self.edges = [bits * j // self.m for j in range(self.m + 1)]
        self.widths = [b - a for a, b in zip(self.edges, self.edges[1:], strict=False)]
        self.widest = max(self.widths)
        self.upper = [min(w, max(0, ceil(log2(max(n / shard_rows, 1))))) for w in self.widths]

    def values(self, bits: np.ndarray, j: int) -> np.ndarray:
        part = bits[:, self.edges[j] : self.edges[j + 1]].astype(np.int64)
        return part @ (1 << np.arange(part.shape[1] - 1, -1, -1, dtype=np.int64))


def places(cut: Segments):
    """Of rows (code): key (segment and bucket) and code, a row for each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = unpacked(batch.column(0))
            for j in range(cut.m):
                bucket = cut.values(bits, j) >> (cut.widths[j] - cut.upper[j])
                yield pa.RecordBatch.from_arrays([pa.array(bucket << 8 | j), batch.column(0)], names=["key", "code"])

    return run


def probes(cut: Segments, radius: int):
    """Of rows (query): key, query and rest, for each bucket with values at ``radius``: ``rest`` of the differing bits are below the bucket's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = unpacked(batch.column(0))
            for j in range(cut.m):
                lower = cut.widths[j] - cut.upper[j]
                bucket = cut.values(bits, j) >> lower
                for high in range(min(radius, cut.upper[j]) + 1):
                    if radius - high <= lower:
                        for flip in flips(cut.upper[j], high).tolist():
                            yield pa.RecordBatch.from_arrays([pa.array((bucket ^ flip) << 8 | j), batch.column(0), pa.array(np.full(len(bucket), radius - high, dtype=np.int32))], names=["key", "query", "rest"])

    return run


def searcher(cut: Segments, need: int, block: int):
    """Of one shard's rows (key, shard, code, ids) and the queries (key, shard, query, rest) sent there: the ``need`` nearest ids of each query at the probed values."""
    schema = pa.schema([("query", pa.binary()), ("neighbor_id", pa.int64()), ("distance", pa.int32())])

    def search(_: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        j = rows.column("key")[0].as_py() & 255
        lower = cut.widths[j] - cut.upper[j]
        mask = (1 << lower) - 1
        bits, asked = unpacked(rows.column("code").combine_chunks()), unpacked(queries.column("query").combine_chunks())
        values = cut.values(bits, j) & mask
        order = np.argsort(values, kind="stable")
        values, packed = values[order], np.packbits(bits, axis=1)[order]
        lists = rows.column("ids").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ids, begin = lists.values.to_numpy(), lists.offsets.to_numpy()[:-1][order]
        count = np.diff(lists.offsets.to_numpy())[order]
        rest, own, wanted = queries.column("rest").to_numpy(), cut.values(asked, j) & mask, np.packbits(asked, axis=1)
        out = []

        def verify(q: np.ndarray, at: np.ndarray) -> None:
            """Found places ``at`` of queries ``q``, which come together: the ids of the nearest."""
            far = np.bitwise_count(packed[at] ^ wanted[q]).sum(axis=1, dtype=np.int32)
            n = count[at]
            q, far = np.repeat(q, n), np.repeat(far, n)
            near = ids[np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            rank = np.lexsort((near, far, q))
            q, far, near = q[rank], far[rank], near[rank]
            first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
            nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
            out.append((q[nth < need], near[nth < need], far[nth < need]))

        for radius in np.unique(rest).tolist():
            flip = flips(lower, radius)
            mine = np.flatnonzero(rest == radius)
            for s in range(0, len(mine), max(1, min(block, VERIFIED // len(flip)))):
                q = mine[s : s + max(1, min(block, VERIFIED // len(flip)))]
                probe = own[q][:, None] ^ flip
                low, high = np.searchsorted(values, probe, "left"), np.searchsorted(values, probe, "right")
                n = (high - low).sum(axis=1)
                # Queries in runs of about VERIFIED found codes.
                group = np.cumsum(n) // VERIFIED
                for g in np.unique(group[n > 0]).tolist():
                    part = np.flatnonzero((group == g) & (n > 0))
                    size = (high - low)[part].ravel()
                    at = np.repeat(low[part].ravel() - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                    verify(np.repeat(q[part], n[part]), at)
        if not out:
            return schema.empty_table()
        q, near, far = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table([queries.column("query").combine_chunks().take(pa.array(q)), pa.array(near), pa.array(far.astype(np.int32))], schema=schema)

    return search


def nearest(points: DataFrame, asked: DataFrame, bits: int, need: int, shard_rows: int, block_queries: int) -> DataFrame:
    """points (code, ids), asked (query): query, neighbor_id and distance of the ``need`` nearest ids of each query, its own among them."""
    cut = Segments(bits, points.count(), shard_rows)
    placed = points.select("code").mapInArrow(frugal(places(cut)), "key long, code binary")
    placed = store(placed.join(points, "code").select("key", "code", "ids"), "topk-placed")
    # Of each bucket, its number of shards: rows are fewer than codes by a factor of shard_rows / m.
    shards = store(placed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("shards")), "topk-shards")
    dealt = store(placed.join(shards, "key").select("key", F.pmod(F.xxhash64("code"), F.col("shards")).cast("int").alias("shard"), "code", "ids"), "topk-dealt")
    best, left, found = None, asked, None
    for radius in range(cut.widest + 1):
        sent = left.mapInArrow(frugal(probes(cut, radius)), "key long, query binary, rest int").join(shards, "key")
        sent = sent.select("key", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "query", "rest")
        new = dealt.groupBy("key", "shard").cogroup(sent.groupBy("key", "shard")).applyInArrow(searcher(cut, need, block_queries), "query binary, neighbor_id long, distance int")
        # A code that several segments find comes several times.
        both = (new if best is None else new.union(best)).groupBy("query", "neighbor_id", "distance").agg(F.lit(1)).drop("1")
        rank = Window.partitionBy("query").orderBy("distance", "neighbor_id")
        best = store(both.withColumn("nth", F.row_number().over(rank)).filter(F.col("nth") <= need), "topk-best")
        covered = best.filter((F.col("nth") == need) & (F.col("distance") <= cut.m * (radius + 1) - 1)).select("query")
        done = best.join(covered, "query", "left_semi") if radius < cut.widest else best
        done = done.select("query", "neighbor_id", "distance")
        found = done if found is None else found.union(done)
        left = store(left.join(covered, "query", "left_anti"), "topk-left")
        if radius == cut.widest or left.isEmpty():
            break
        best = best.join(left, "query", "left_semi").select("query", "neighbor_id", "distance")
    return found


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, query_code, neighbor_id, distance, rank: the k nearest codes of every row whose vec_id ``every`` divides."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    bits = 8 * max(1, ceil((rows.agg(F.max(F.size("embedding"))).first()[0] or 0) / 8))
    codes = rows.mapInArrow(frugal(encoder(bits // 8)), "vec_id long, code binary")
    codes = store(codes.dropDuplicates(["vec_id", "code"]), "topk-codes")
    asked = codes.filter(F.col("vec_id") % every == 0)
    # A query leaves out what has its own id: one code, unless ids are repeated with different vectors.
    own = asked.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    need = k + own
    least = Window.partitionBy("code").orderBy("vec_id")
    kept = codes.withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= need)  # Spark limits them before the exchange
    points = store(kept.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "topk-points")  # need ids at most
    queries = store(asked.select(F.col("code").alias("query")).distinct(), "topk-queries")
    found = store(nearest(points, queries, bits, need, shard_rows, block_queries), "topk-found")
    mine = asked.join(found, F.col("code") == F.col("query")).filter("vec_id <> neighbor_id")
    best = Window.partitionBy("vec_id", "code").orderBy("distance", "neighbor_id")
    ranked = mine.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("vec_id").alias("query_id"), F.col("code").alias("query_code"), "neighbor_id", F.col("distance").cast("long").alias("distance"), "rank")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings")).select("query_id", "neighbor_id", F.col("distance").cast("int").alias("distance"), F.col("rank").cast("int").alias("rank"))


OP10_SQL = """
WITH codes AS (
  SELECT DISTINCT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, hamming(q.code, v.code) AS distance
  FROM codes q, codes v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs)
SELECT query_id, neighbor_id, distance::INTEGER AS distance, rank::INTEGER AS rank FROM ranked WHERE rank <= 10
"""

by_value(__name__)
