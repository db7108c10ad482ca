import numpy as np
import pytest
from pyspark.sql import functions as F
from tracewright.operators import episodes, reconcile, stats
from tracewright.operators.episodes import Thresholds
from tracewright.sources import collection


def test_quantiles_by_slices(spark):
    rng = np.random.default_rng(3)
    groups = {"wide": np.concatenate((rng.normal(size=300) * 10.0 ** rng.integers(-12, 12, 300), [0.0, -0.0])), "near": 1e9 + rng.random(400), "equal": np.repeat([2.5, -1.0], [90, 10]), "one": np.array([7.0]), "huge": np.array([1e300, -1e300, 5e-324])}
    df = spark.createDataFrame([(k, float(x)) for k, v in groups.items() for x in v] + [("null", None), (None, 3.0)], "k string, x double").repartition(5)
    got = {r["k"]: r for r in stats.exact_quantiles(df, ["k"]).collect()}
    assert set(got) == {*groups, None} and got[None]["q50"] == 3.0
    for k, v in groups.items():
        assert [got[k][q] for q in stats.QUANTILES] == pytest.approx(np.quantile(v, list(stats.QUANTILES.values())), rel=1e-12)
    (whole,) = stats.exact_quantiles(df.filter("k = 'near'"), []).collect()
    assert whole["q50"] == pytest.approx(np.quantile(groups["near"], 0.5), rel=1e-15)


def test_large_means_keep_their_spread(spark):
    x = 1e9 + np.random.default_rng(1).random(400)
    df = spark.createDataFrame([(i % 7, float(v)) for i, v in enumerate(x)], "e long, x double").withColumn("f", F.lit("index"))
    for keys in (["f"], []):
        (row,) = stats.combined(stats.moments(df, ["e", "f"]), keys).collect()
        assert row["std"] == pytest.approx(x.std(), rel=1e-6) and row["mean"] == pytest.approx(x.mean()) and row["count"] == 400


def test_state_and_rate_of_each_dataset(spark):
    nan = float("nan")
    rows = [(e, i, [float(i)], [nan if (e, i) == (1, 3) else 0.0, 1.0]) for e in range(2) for i in range(60)]
    frames = spark.createDataFrame(rows, "e long, i long, action array<float>, `observation.state` array<float>")
    lengths = spark.createDataFrame([(0, 60, 30.0), (1, 60, 30.0), (2, 60, 60.0)], "e long, length long, fps double")
    t = Thresholds(min_frames=50, min_seconds=1.5, length_quantile=1.0)
    plan = {r["e"]: r["reason"] for r in episodes.quality_plan(lengths, frames, ["e"], "i", None, t, also=("observation.state",)).collect()}
    assert plan == {0: None, 1: "nan_actions", 2: "brief"}


def test_statistics_in_their_own_form(spark):
    df = spark.createDataFrame([("action", "count", [3.0]), ("observation.images.top", "mean", [0.1, 0.2, 0.3]), ("action", "mean", [1.0, 2.0])], "feature string, stat string, value array<double>")
    got = [r[0] for r in df.select(stats.shaped(F.col("feature"), F.col("stat"), F.col("value"))).collect()]
    assert got == ["[3]", "[[[0.1]],[[0.2]],[[0.3]]]", "[1.0,2.0]"]
    odd = spark.createDataFrame([("[[1, 2.5], [3, -4e-2]]",), ("7",), ("[]",)], "t string").select(stats.normalised(F.parse_json("t")))
    assert [r[0] for r in odd.collect()] == [[1.0, 2.5, 3.0, -0.04], [7.0], []]
    counts = spark.createDataFrame([([9],), (None,)], "c array<bigint>").select(stats.shrunk_count(F.col("c")))
    assert [r[0] for r in counts.collect()] == [[9], [1]]
    wide = spark.range(1).select(*[F.size(stats.shrunk(*[F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("double"))] * 4)["min"]).alias(str(n)) for n in (64, 65)]).first()
    assert (wide["64"], wide["65"]) == (64, 1)


def test_positions_of_a_manifest_are_distinct(spark, tmp_path):
    path = str(tmp_path / "m")
    for status in ("failed", "converted"):
        collection.append_manifest(spark.range(4000).select(F.col("id").alias("dataset"), F.lit(status).alias("status")).repartition(7), path)
    rows = spark.read.json(path)
    assert rows.select("position").distinct().count() == 8000
    last = reconcile.last_wins(rows.select("dataset", "status", "position"), ["dataset"], "position")
    assert last.count() == 4000 and last.filter("status = 'converted'").count() == 4000
