"""Schemas as data: features declared by datasets, and the columns, cameras and statistics that follow them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the format.
UNSUPPORTED = ("string", "list", "dict")
IMAGES = "observation.images."


def exploded(info: DataFrame, keys: list[str]) -> DataFrame:
    """info (keys, features map) to a row for each feature."""
    return info.select(*keys, F.explode("features").alias("key", "feature")).select(*keys, "key", "feature.*")


def declared(frames: DataFrame, features: dict[str, str]) -> DataFrame:
    """The columns that are declared and not video, in their order."""
    return frames.select(*[f"`{c}`" for c in frames.columns if features.get(c, "video") != "video"])


def hollow_cameras(features: DataFrame, files: DataFrame, totals: DataFrame, dataset: list[str]) -> DataFrame:
    """Video features with some, but fewer files than the dataset declares episodes: dataset, key, n_files."""
    videos = features.filter("dtype = 'video'").select(*dataset, "key")
    counted = videos.join(files.groupBy(*dataset, "key").agg(F.count(F.lit(1)).alias("n_files")), [*dataset, "key"])
    return counted.join(totals, dataset).filter("0 < n_files AND n_files < total_episodes").select(*dataset, "key", "n_files")


def flat_keys(features: DataFrame, dataset: list[str], prefix: str = IMAGES, flat: str = "observation.") -> DataFrame:
    """For each declared <prefix>X, the repair <flat>X -> <prefix>X, unless <flat>X is declared itself."""
    images = features.filter(F.col("key").startswith(prefix)).select(*dataset, F.concat(F.lit(flat), F.substring("key", len(prefix) + 1, 1 << 20)).alias("old"), F.col("key").alias("new"))
    taken = features.select(*dataset, F.col("key").alias("old"))
    return images.join(taken, [*dataset, "old"], "left_anti")


def positional_keys(ghosts: DataFrame, cameras: DataFrame, dataset: list[str]) -> DataFrame:
    """ghosts and cameras (dataset, key), matched in sorted order where a dataset has as many of either."""

    def ranked(df: DataFrame, name: str) -> DataFrame:
        per = Window.partitionBy(*dataset)
        return df.select(*dataset, F.col("key").alias(name), F.row_number().over(per.orderBy("key")).alias("nth"), F.count(F.lit(1)).over(per).alias("n"))

    return ranked(ghosts, "old").join(ranked(cameras, "new"), [*dataset, "nth", "n"]).select(*dataset, "old", "new")


def rekeyed(stats: Column, repairs: Column) -> Column:
    """A map with its keys replaced by those that ``repairs`` gives. Later entries win where keys meet (spark.sql.mapKeyDedupPolicy=LAST_WIN)."""
    return F.transform_keys(stats, lambda k, _: F.coalesce(F.try_element_at(repairs, k), k))


def pruned(stats: Column, keys: Column) -> Column:
    """The entries of a map whose keys are declared."""
    return F.map_filter(stats, lambda k, _: F.array_contains(keys, k))
