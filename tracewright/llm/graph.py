"""Connected components of a distributed edge list by alternating star operations.

Each round hangs every node's larger neighbours, then its smaller ones, on the smallest
node it knows of, until all components are stars. Rounds are stored in the shared scratch
folder. The rows of a node with many neighbours meet a single minimum by a join that
Spark splits; no node's neighbours are gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm._shared import discard, mark, store


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b): node and root, the component's smallest node, of every node that is not a root."""
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    start = mark()
    now = store(ordered, "cc-edges")
    before = _signature(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store(large, "cc-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = store(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "cc-small")
        discard(start, 1)  # the round before is done with
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
