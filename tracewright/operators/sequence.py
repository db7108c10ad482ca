"""Order: dense numbers, offsets, global counters, video placement, and checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def densified(episodes: DataFrame, dataset: list[str], episode: str) -> DataFrame:
    """episodes with new_index: 0, 1, ... in the order of ``episode`` within a dataset."""
    return episodes.withColumn("new_index", (F.row_number().over(Window.partitionBy(*dataset).orderBy(episode)) - 1).cast("long"))


def offsets(episodes: DataFrame, dataset: list[str], episode: str, length: str = "length") -> DataFrame:
    """episodes with from_index and to_index: the running sum of lengths before and after each."""
    w = Window.partitionBy(*dataset).orderBy(episode).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(length).over(w).cast("long")
    return episodes.withColumn("to_index", upto).withColumn("from_index", F.col("to_index") - F.col(length))


def global_index(frames: DataFrame, dataset: list[str], episode: str, order: str) -> DataFrame:
    """frames with index: a counter over a dataset in the order of episode and frame.

    Episodes are counted first; their offsets, a row each, are joined to the place within
    the episode, so no dataset is ordered as a whole.
    """
    keys = [*dataset, episode]
    start = offsets(frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("length")), dataset, episode).select(*keys, "from_index")
    placed = frames.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    return placed.join(start, keys).withColumn("index", (F.col("from_index") + F.col("place")).cast("long")).drop("place", "from_index")


def index_ranges(frames: DataFrame, dataset: list[str], episode: str, index: str) -> DataFrame:
    """Per episode: whether the counter's extremes differ from its offset and length."""
    keys = [*dataset, episode]
    seen = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("length"), F.min(index).alias("low"), F.max(index).alias("high"))
    placed = offsets(seen, dataset, episode)
    return placed.withColumn("broken", (F.col("low") != F.col("from_index")) | (F.col("high") != F.col("to_index") - 1))


def boundary(frames: DataFrame, placed: DataFrame, dataset: list[str], episode: str, index: str) -> DataFrame:
    """The first and last frames of each dataset's first and last episodes. placed: dataset, episode, from_index, to_index."""
    ends = Window.partitionBy(*dataset)
    edge = placed.withColumn("first", F.min(episode).over(ends)).withColumn("last", F.max(episode).over(ends)).filter(f"{episode} = first OR {episode} = last")
    near = frames.join(edge.select(*dataset, episode, "from_index", "to_index"), [*dataset, episode])
    return near.filter((F.col(index) == F.col("from_index")) | (F.col(index) == F.col("to_index") - 1)).drop("from_index", "to_index")


def placements(spans: DataFrame, dataset: list[str], file: list[str]) -> DataFrame:
    """spans (dataset, file, episode, from_ts, to_ts) with out_file (dense number of the file) and the span's place in the joined video."""
    number = Window.partitionBy(*dataset).orderBy(*file)
    within = Window.partitionBy(*dataset, *file).orderBy("from_ts", "to_ts", "episode").rowsBetween(Window.unboundedPreceding, 0)
    length = F.col("to_ts") - F.col("from_ts")
    done = F.sum(length).over(within)
    return spans.withColumn("out_file", (F.dense_rank().over(number) - 1).cast("long")).withColumn("out_from", done - length).withColumn("out_to", done)


def within_band(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, half: float, how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` for which ``right`` has (left_semi) or lacks (left_anti) a row with abs(a - b) < half.

    Both are cut into cells of the band's width: an equi-join on the cell, the right side in
    three cells each, finds all partners, and no nested loop is planned.
    """
    cell = F.floor(F.col(a) / half).cast("long")
    near = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(b).alias("_b"), F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.floor(F.col(b) / half).cast("long") + d)).alias("_cell"))
    same = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    condition = (cell == F.col("_cell")) & (F.abs(F.col(a) - F.col("_b")) < half)
    for c in same:
        condition &= c
    return left.join(near, condition, how)
