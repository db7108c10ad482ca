"""Exact statistics: quantiles, per-episode moments and their aggregation, and repairs of stored statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the format: names and levels.
QUANTILES = {"q01": 0.01, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}


def dimensions(frames: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """A row for each dimension of each vector: keys, dim, x (double)."""
    return frames.select(*keys, F.posexplode(vector).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))


def value_slice(x: Column) -> Column:
    """A number that never falls as ``x`` rises: slices of about half a percent of a value's size, finer near zero."""
    size = F.floor(F.least(F.log1p(F.abs(x) * F.lit(1e9)) * 200, F.lit(1e9)))
    return F.when(F.isnan(x), F.lit(1 << 40)).otherwise(F.when(x < 0, -size).otherwise(size)).cast("long")


def exact_quantiles(values: DataFrame, keys: list[str], x: str = "x") -> DataFrame:
    """Linear interpolation over all values of a group; NaN if any value is. Nulls are left out.

    Values are counted by slice, and only the slices in which a wanted rank falls are ordered,
    each for itself and equal values once, so a group may hold any share of the rows.
    """
    rows = values.select(*keys, F.col(x).cast("double").alias("_x")).filter("_x IS NOT NULL")
    slices = rows.groupBy(*keys, value_slice(F.col("_x")).alias("_slice")).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(F.isnan("_x")).alias("_odd"))
    up = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)  # slices, some thousands at most
    placed = slices.withColumn("_upto", F.sum("_n").over(up)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys))).withColumn("_nan", F.bool_or("_odd").over(Window.partitionBy(*keys)))
    ranks = [(name, F.floor(F.lit(q) * (F.col("_all") - 1)), F.ceil(F.lit(q) * (F.col("_all") - 1)), F.lit(q) * (F.col("_all") - 1)) for name, q in QUANTILES.items()]
    within = lambda rank, low, high: (low <= rank) & (rank < high)
    needed = F.lit(False)
    for _, low, high, _ in ranks:
        needed = needed | within(low, F.col("_upto") - F.col("_n"), F.col("_upto")) | within(high, F.col("_upto") - F.col("_n"), F.col("_upto"))
    chosen = placed.filter(needed).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"), (F.col("_upto") - F.col("_n")).alias("_before"), "_all", "_nan")
    same = F.col("_slice") == F.col("_s")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    near = rows.withColumn("_slice", value_slice(F.col("_x"))).join(chosen, same).groupBy(*keys, "_slice", "_x", "_before", "_all", "_nan").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*keys, "_slice").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = near.withColumn("_end", F.col("_before") + F.sum("_n").over(order)).withColumn("_begin", F.col("_end") - F.col("_n"))
    at = lambda rank: F.max(F.when(within(rank, F.col("_begin"), F.col("_end")), F.col("_x")))
    cells = [c for name, low, high, exact in ranks for c in (at(low).alias(f"_{name}"), at(high).alias(f"_up_{name}"), F.max(exact - low).alias(f"_part_{name}"))]
    found = ranked.groupBy(*keys).agg(*cells, F.bool_or("_nan").alias("_nan"))
    between = lambda n: F.col(f"_{n}") + F.when(F.col(f"_part_{n}") == 0, 0.0).otherwise((F.col(f"_up_{n}") - F.col(f"_{n}")) * F.col(f"_part_{n}"))
    return found.select(*keys, *[F.when(F.col("_nan"), F.lit(float("nan"))).otherwise(between(n)).alias(n) for n in QUANTILES])


def moments(values: DataFrame, keys: list[str], x: str = "x") -> DataFrame:
    """min, max, mean, population std and count of each group."""
    return values.groupBy(*keys).agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.count(x).alias("count"))


def combined(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of the union of groups from their moments: count-weighted mean, and the spread around it, which large means don't cancel."""
    n, mean, std = F.col("count"), F.col("mean"), F.col("std")
    whole = parts.groupBy(*keys).agg(F.min("min").alias("min"), F.max("max").alias("max"), (F.sum(n * mean) / F.sum(n)).alias("_mean"), F.sum(n).alias("count"))
    centre = whole.select(*keys, "_mean")
    apart = (parts.join(centre, keys) if keys else parts.join(F.broadcast(centre))).withColumn("_away", n * (std * std + (mean - F.col("_mean")) * (mean - F.col("_mean"))))
    spread = apart.groupBy(*keys).agg(F.sqrt(F.sum("_away") / F.sum("count")).alias("std"))
    both = whole.join(spread, keys) if keys else whole.join(F.broadcast(spread))
    return both.select(*keys, "min", "max", F.col("_mean").alias("mean"), "std", "count")


def mean_of_quantiles(parts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The count-weighted mean of groups' quantiles, which is not the quantile of their union."""
    return parts.groupBy(*keys).agg(*[(F.sum(F.col(q) * F.col("count")) / F.sum("count")).alias(q) for q in names])


def shrunk(low: Column, high: Column, mean: Column, std: Column, most: int = 64) -> dict[str, Column]:
    """Statistics of vectors of more than ``most`` dimensions as those of one: extremes, mean of means, and the spread of the whole."""
    wide = F.size(low) > most
    size = F.size(mean).cast("double")
    whole = F.aggregate(mean, F.lit(0.0), lambda acc, x: acc + x) / size
    square = F.aggregate(F.zip_with(std, mean, lambda s, m: s * s + m * m), F.lit(0.0), lambda acc, x: acc + x) / size
    one = {"min": F.array_min(low), "max": F.array_max(high), "mean": whole, "std": F.sqrt(F.greatest(square - whole * whole, F.lit(0.0)))}
    return {name: F.when(wide, F.array(one[name])).otherwise(old) for name, old in zip(one, (low, high, mean, std), strict=True)}


def shrunk_count(count: Column) -> Column:
    """The count that goes with ``shrunk``: it stays as it is, one where there is none."""
    return F.coalesce(count, F.array(F.lit(1).cast("bigint")))


def constant_stats(value: Column) -> dict[str, Column]:
    """Statistics of a number that is the same in every frame, as an episode's index is."""
    same = value.cast("double")
    return {"min": same, "max": same, "mean": same, "std": F.lit(0.0)} | dict.fromkeys(QUANTILES, same)


def index_stats(start: Column, n: Column) -> dict[str, Column]:
    """Statistics of the run of whole numbers start, start + 1, ... of n members, without reading it."""
    last = n - F.lit(1)
    out = {"min": start.cast("double"), "max": (start + last).cast("double"), "mean": (start + start + last) / F.lit(2.0), "std": F.sqrt((n * n - F.lit(1)) / F.lit(12.0))}
    return out | {name: start + F.lit(q) * last for name, q in QUANTILES.items()}


def largest_delta(old: DataFrame, new: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """One row: entries that both have, and the largest absolute difference (null if there are none)."""
    both = old.select(*keys, F.col(value).alias("was")).join(new.select(*keys, F.col(value).alias("now")), keys)
    return both.agg(F.count(F.lit(1)).alias("compared"), F.max(F.abs(F.col("was") - F.col("now"))).alias("max_delta"))


def unflattened(wide: DataFrame, keys: list[str], prefix: str = "stats/") -> DataFrame:
    """Columns stats/<feature>/<stat> as rows (keys, feature, stat, value); null cells are left out."""
    columns = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.unpivot(keys, [F.col(f"`{c}`").alias(c) for c in columns], "column", "value").filter("value IS NOT NULL")
    part = F.split("column", "/", 3)
    return long.select(*keys, part[1].alias("feature"), part[2].alias("stat"), "value")


def shaped(feature: Column, stat: Column, value: Column, images: str = "observation.images.") -> Column:
    """A statistic's flat values as JSON in its own form: counts as whole numbers, image statistics as [3, 1, 1], all else as a list of doubles."""
    pixels = F.transform(value, lambda x: F.array(F.array(x)))
    return F.when(stat == "count", F.to_json(F.transform(value, lambda x: x.cast("long")))).when(feature.startswith(images), F.to_json(pixels)).otherwise(F.to_json(value))


def normalised(value: Column) -> Column:
    """A statistic of any nesting (variant) as a flat array of doubles; a bare number is an array of one."""
    text = F.to_json(value)
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?[0-9][0-9.eE+-]*|NaN|-?Infinity)"), F.lit(1)), lambda x: x.cast("double"))


def merged(old: Column, new: Column) -> Column:
    """Maps of statistics: keys of ``new`` win, the others stay."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)
