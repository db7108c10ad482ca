import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from tracewright.operators import episodes, reconcile, stats
from tracewright.operators.episodes import Thresholds
from tracewright.sources import collection
from tracewright.streaming.sweep import sweep


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Three datasets; in the second, episode 1 has fewer frames than declared and episode 2 no file."""
    top = tmp_path_factory.mktemp("collection")
    for user, name, version in (("a", "one", "v2.1"), ("a", "two", "v2.0"), ("b", "three", "v9")):
        d = top / user / name
        (d / "meta").mkdir(parents=True)
        features = {"action": {"dtype": "float32", "shape": [2]}, "observation.images.top": {"dtype": "video", "shape": [1]}}
        (d / "meta/info.json").write_text(json.dumps({"codebase_version": version, "total_episodes": 3, "features": features, "fps": 30}, indent=4))
        (d / "meta/episodes.jsonl").write_text("".join(json.dumps({"episode_index": i, "length": 60}) + "\n\n" for i in range(3)))
        (d / "meta/episodes_stats.jsonl").write_text(json.dumps({"episode_index": 0, "stats": {"action": {"min": [[0.5]]}}}) + "\n\n")
        for i in range(2 if name == "two" else 3):
            n = 40 if (name, i) == ("two", 1) else 60
            rng = np.random.default_rng(i)
            rows = [(i, f, [float(x) for x in rng.normal(size=2)] if i else [1.0, 1.0]) for f in range(n)]
            spark.createDataFrame(rows, "episode_index long, frame_index long, action array<float>").coalesce(1).write.parquet(str(d / f"data/part{i}"))
            (part,) = (d / f"data/part{i}").glob("*.parquet")
            part.rename(d / f"data/episode_{i:06d}.parquet")
            for x in (d / f"data/part{i}").iterdir():
                x.unlink()
            (d / f"data/part{i}").rmdir()
    return str(top)


def test_scans(spark, root):
    rows = {r["name"]: r for r in collection.info(spark, [root]).collect()}
    assert sorted(rows) == ["a/one", "a/two", "b/three"]
    assert rows["a/one"]["total_frames"] == 0 and rows["a/one"]["chunks_size"] == 1000 and rows["a/one"]["features"]["action"]["dtype"] == "float32"
    assert collection.episodes(spark, root).count() == 9
    assert collection.episode_stats(spark, root).select(F.variant_get("stats", "$.action.min[0][0]", "double")).first()[0] == 0.5
    counts = {(r["name"], r["episode_index"]): r["n"] for r in collection.footer_counts(spark, root).collect()}
    assert counts["a/two", 1] == 40 and len(counts) == 8
    assert all(r["size_bytes"] > 0 for r in collection.sizes(spark, root).collect())
    some, unknown = collection.subset(collection.info(spark, [root]), ["a/one", "x/y"])
    assert some.count() == 1 and unknown == ["x/y"]
    assert collection.duplicates(collection.info(spark, [root])).count() == 0


def test_reconcile_and_quality(spark, root):
    declared = collection.episodes(spark, root).select("name", "episode_index", "length")
    found = collection.footer_counts(spark, root).select("name", "episode_index", "n")
    videos = found.limit(0).select("name", "episode_index", F.lit("k").alias("key"), F.col("n").alias("packets"))
    out = {(r["name"], r["episode_index"]): (r["outcome"], r["new_length"]) for r in reconcile.reconciled(declared, found, videos, ["name", "episode_index"]).collect()}
    assert out["a/two", 1] == ("repair", 40) and out["a/two", 2] == ("drop", None) and out["a/one", 0] == ("keep", 60)
    frames = collection.frames(spark, root, ["episode_index", "frame_index", "action"])
    t = Thresholds(min_frames=50, min_seconds=1, length_quantile=1.0)
    plan = {(r["name"], r["episode_index"]): r["reason"] for r in episodes.quality_plan(declared, frames, ["name", "episode_index"], "frame_index", 2, t).collect()}
    assert plan["a/one", 0] == "zero_travel" and plan["a/one", 1] is None and plan["a/two", 2] is None


def test_rules_in_order(spark):
    nan, inf = float("nan"), float("inf")
    cases = {0: (10, [0.0]), 1: (55, [0.0]), 2: (300, [0.0]), 3: (60, [nan]), 4: (60, [inf]), 5: (60, [5.0]), 6: (60, None), 7: (60, list(range(60))), 8: (60, [0.0] * 59 + [1.0]), 9: (60, [])}
    rows, lengths = [], []
    for e, (n, values) in cases.items():
        lengths.append((e, n))
        if values:
            values = [float(values[i % len(values)]) for i in range(n)] if len(values) != 1 else [float(values[0])] * n
            rows += [(e, i, [v]) for i, v in enumerate(values)]
    t = Thresholds(min_frames=50, min_seconds=2.0, fps=30.0, length_quantile=0.9)
    plan = {r["e"]: r["reason"] for r in episodes.quality_plan(spark.createDataFrame(lengths, "e long, length long"), spark.createDataFrame(rows, "e long, i long, a array<float>").withColumnRenamed("a", "action"), ["e"], "i", 1, t).collect()}
    assert plan == {0: "short", 1: "brief", 2: "marathon", 3: "nan_actions", 4: "nan_actions", 5: "zero_travel", 6: None, 7: None, 8: "idle", 9: None}


def test_quantiles_equal_numpy(spark):
    x = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(0, float(v)) for v in x] + [(1, 1.0), (1, float("nan"))], "k long, x double")
    got = {r["k"]: r for r in stats.exact_quantiles(df, ["k"]).collect()}
    assert [got[0][q] for q in stats.QUANTILES] == pytest.approx(np.quantile(x, list(stats.QUANTILES.values())))
    assert np.isnan(got[1]["q50"])


def test_manifest_and_sweep(spark, root, tmp_path):
    query = sweep(spark, root, str(tmp_path / "manifest"), str(tmp_path / "check"))
    query.awaitTermination()
    sweep(spark, root, str(tmp_path / "manifest"), str(tmp_path / "check")).awaitTermination()
    lines = spark.read.json(str(tmp_path / "manifest"))
    assert {r["dataset"]: r["status"] for r in lines.collect()} == {"a/one": "todo", "a/two": "todo", "b/three": "unsupported"} and lines.count() == 3
    collection.append_manifest(spark.createDataFrame([("a/one", "converted")], "dataset string, status string"), str(tmp_path / "manifest"))
    last = reconcile.last_wins(spark.read.json(str(tmp_path / "manifest")).select("dataset", "status", "position"), ["dataset"], "position")
    assert {r["dataset"]: r["status"] for r in last.collect()}["a/one"] == "converted"


def test_written_frames(spark, root, tmp_path):
    frames = collection.frames(spark, root, ["episode_index", "frame_index", "action"]).drop("path")
    collection.write_frames(frames, str(tmp_path / "out"))
    collection.write_frames(frames.filter("name = 'a/one' AND episode_index = 0"), str(tmp_path / "out"))
    counts = {(r["user"], r["dataset"]): r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("user", "dataset").count().collect()}
    assert counts == {("a", "one"): 60, ("a", "two"): 100, ("b", "three"): 180}
