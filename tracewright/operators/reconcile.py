"""Declared against physical: episodes, files and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconciled(declared: DataFrame, rows: DataFrame, videos: DataFrame, keys: list[str]) -> DataFrame:
    """declared (keys, length), rows (keys, n), videos (keys, key, packets) to outcome and new_length.

    Equal counts keep an episode; rows on which all its videos agree repair its length (an
    episode without videos has none that disagrees); else it is dropped.
    """
    agree = videos.join(rows, keys).groupBy(*keys).agg(F.bool_and(F.col("packets") == F.col("n")).alias("agree"))
    found = declared.join(rows, keys, "left").join(agree, keys, "left").withColumn("n", F.coalesce("n", F.lit(-1)))
    outcome = F.when(F.col("n") == F.col("length"), "keep").when((F.col("n") > 0) & F.coalesce("agree", F.lit(True)), "repair").otherwise("drop")
    return found.withColumn("outcome", outcome).select(*keys, "length", "outcome", F.when(F.col("outcome") != "drop", F.col("n")).alias("new_length"))


def orphans(files: DataFrame, valid: DataFrame, keys: list[str]) -> DataFrame:
    return files.join(valid, keys, "left_anti")


def upserted(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of either; where both have one, the old value stays unless it is null."""
    return old.select(*keys, F.col(value).alias("_old")).join(new.select(*keys, F.col(value).alias("_new")), keys, "full").select(*keys, F.coalesce("_old", "_new").alias(value))


def corrections(declared: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """A row for each field whose values differ: keys, field, was, now."""
    both = declared.select(*keys, *[F.col(f).alias(f"_was_{f}") for f in fields]).join(actual.select(*keys, *fields), keys)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_was_{f}").cast("string").alias("was"), F.col(f).cast("string").alias("now")) for f in fields])
    return both.select(*keys, F.inline(cells)).filter("NOT (was <=> now)")


def agree(*sources: Column) -> Column:
    """Whether independent counts are the same."""
    return F.size(F.array_distinct(F.array(*sources))) == 1


def last_wins(manifest: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Of an append-only log, the last row of each key."""
    columns = [c for c in manifest.columns if c not in keys]
    return manifest.groupBy(*keys).agg(F.max_by(F.struct(*columns), position).alias("_last")).select(*keys, "_last.*")
