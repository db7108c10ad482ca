"""Episode-quality rules. Cheap rules decide from episode lengths; frames are read for the rest only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.vectors import absolute_delta, all_below, all_finite, doubled, total


@dataclass(frozen=True)
class Thresholds:
    min_frames: int = 50
    min_seconds: float = 2.0
    fps: float = 30.0
    length_quantile: float = 0.995
    min_travel: float = 1e-3
    idle_max: float = 0.8
    min_episodes: int = 5
    #: A dimension stands still if it moves by less than this part of its range, or the floor.
    still_part: float = 0.01
    still_floor: float = 1e-6


def length_cutoff(episodes: DataFrame, quantile: float) -> DataFrame:
    """One row: max_frames, the exact quantile of all lengths, truncated."""
    return episodes.agg(F.floor(F.percentile("length", F.lit(quantile))).cast("long").alias("max_frames"))


def length_rules(episodes: DataFrame, t: Thresholds, cutoff: DataFrame | None = None) -> DataFrame:
    """episodes (.., length) with reason: short, brief, marathon or null. A column fps holds each dataset's own rate. ``cutoff`` comes from all sources, before any subset."""
    fps = F.col("fps") if "fps" in episodes.columns else F.lit(t.fps)
    one = F.broadcast(cutoff if cutoff is not None else length_cutoff(episodes, t.length_quantile))
    reason = F.when(F.col("length") < t.min_frames, "short").when(F.col("length") < F.lit(t.min_seconds) * fps, "brief").when(F.col("length") > F.col("max_frames"), "marathon")
    return episodes.join(one).withColumn("reason", reason).drop("max_frames")


def deltas(frames: DataFrame, keys: list[str], order: str, vector: str = "action") -> DataFrame:
    """frames with delta: absolute change of each dimension since the frame before; null on the first."""
    w = Window.partitionBy(*keys).orderBy(order)
    wide = frames.withColumn(vector, doubled(F.col(vector)))
    return wide.withColumn("delta", absolute_delta(F.col(vector), F.lag(vector).over(w)))


def trajectories(frames: DataFrame, keys: list[str], order: str, t: Thresholds, vector: str = "action", also: tuple[str, ...] = ()) -> DataFrame:
    """Per episode: n_frames, finite (``vector`` and the vectors ``also``), travel and idle (null without a second frame).

    Vectors may have any number of dimensions. An episode's ranges are one aggregate by
    episode and dimension, joined to its frames; deltas take one window.
    """
    names = [f"`{c}`" for c in (vector, *also)]
    frames = frames.select(*keys, order, *[F.col(n).alias(f"_v{i}") for i, n in enumerate(names)])
    per = frames.select(*keys, F.posexplode("_v0").alias("_dim", "_x")).groupBy(*keys, "_dim").agg((F.max("_x").cast("double") - F.min("_x").cast("double")).alias("_range"))
    limit = F.greatest(F.lit(t.still_part) * F.col("_range"), F.lit(t.still_floor))
    limits = per.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_dim", limit.alias("limit")))), lambda s: s["limit"]).alias("limits"))  # one entry a dimension
    moved = deltas(frames, keys, order, "_v0").join(limits, keys, "left")
    still = all_below(F.col("delta"), F.col("limits")).cast("double")
    finite = all_finite(F.col("_v0"))
    for i in range(1, len(names)):
        finite &= all_finite(F.col(f"_v{i}"))
    return moved.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.bool_and(finite).alias("finite"),
        F.coalesce(F.sum(total(F.col("delta"))), F.lit(0.0)).alias("travel"),
        F.avg(still).alias("idle"),
    )


def quality_plan(episodes: DataFrame, frames: DataFrame, keys: list[str], order: str, dims: int | None, t: Thresholds, cutoff: DataFrame | None = None, vector: str = "action", also: tuple[str, ...] = ()) -> DataFrame:
    """episodes (keys, length) with keep, reason and metric: the first rule that applies, in the order short, brief, marathon, nan_actions, zero_travel, idle.

    Episodes without frames are kept. NaN and infinite values count in ``vector`` and in the
    vectors ``also`` (the state); ``dims`` is not needed any more. Only survivors of the length rules meet their frames.
    """
    judged = length_rules(episodes, t, cutoff)
    left = judged.filter("reason IS NULL").select(*keys)
    moved = trajectories(frames.join(left, keys, "left_semi"), keys, order, t, vector, also)
    idle = F.col("idle").isNotNull() & ~F.isnan("idle") & (F.col("idle") >= t.idle_max)
    later = F.when(~F.col("finite"), "nan_actions").when(F.col("travel") < t.min_travel, "zero_travel").when(idle, "idle")
    found = moved.select(*keys, later.alias("later"), "travel", "idle")
    reason = F.coalesce("reason", "later")
    metric = F.when(F.col("reason").isNotNull(), F.col("length").cast("double")).when(F.col("later") == "zero_travel", F.col("travel")).when(F.col("later") == "idle", F.col("idle"))
    return judged.join(found, keys, "left").select(*keys, "length", reason.isNull().alias("keep"), reason.alias("reason"), metric.alias("metric"))


def survivors(plan: DataFrame, dataset: str, least: int) -> DataFrame:
    """Per dataset: episodes, kept and status; datasets with fewer than ``least`` kept episodes are dropped as a whole."""
    kept = F.sum(F.col("keep").cast("long"))
    return plan.groupBy(dataset).agg(F.count(F.lit(1)).alias("episodes"), kept.alias("kept")).withColumn("status", F.when(F.col("kept") < least, "dataset_dropped").otherwise("ok"))
