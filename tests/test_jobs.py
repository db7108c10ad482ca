import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tracewright.operators.episodes import Thresholds
from tracewright.plans import jobs
from tracewright.sources import collection

T = Thresholds(min_frames=50, min_seconds=1.0, length_quantile=1.0, min_episodes=2)


def dataset(top, name, kinds, quantiles=True, fps=30.0, camera=False, dims=6):
    """A v3 dataset; kinds: moving, still or nan, one an episode of 60 frames."""
    d = top / name
    (d / "meta/episodes/chunk-000").mkdir(parents=True)
    (d / "data/chunk-000").mkdir(parents=True)
    features = {f: {"dtype": "float32", "shape": [dims]} for f in jobs.FEATURES}
    if camera:
        features["observation.images.top"] = {"dtype": "video", "shape": [3, 4, 4]}
        (d / "videos/observation.images.top/chunk-000").mkdir(parents=True)
        (d / "videos/observation.images.top/chunk-000/file-000.mp4").write_bytes(b"video")
    rng = np.random.default_rng(len(name))
    episode, frame, action, state = [], [], [], []
    table = {c: [] for c in ("episode_index", "length", "dataset_from_index", "dataset_to_index")}
    moments = {f"stats/{f}/{k}": [] for f in (*jobs.FEATURES, "index") for k in ("min", "max", "mean", "std", "count")}
    for e, kind in enumerate(kinds):
        a = rng.normal(size=(60, 6)).astype(np.float32) if kind != "still" else np.ones((60, 6), np.float32)
        s = rng.normal(size=(60, 6)).astype(np.float32)
        if kind == "nan":
            s[3, 2] = np.nan
        episode += [e] * 60
        frame += range(60)
        action += a.tolist()
        state += s.tolist()
        for c, x in zip(table, (e, 60, 60 * e, 60 * e + 60), strict=True):
            table[c].append(x)
        for f, x in zip((*jobs.FEATURES, "index"), (a.astype(float), s.astype(float), np.arange(60 * e, 60 * e + 60, dtype=float)[:, None]), strict=True):
            for k, v in (("min", x.min(0)), ("max", x.max(0)), ("mean", x.mean(0)), ("std", x.std(0)), ("count", np.array([60.0]))):
                moments[f"stats/{f}/{k}"].append(v.tolist())
    vector = pa.list_(pa.float32())
    pq.write_table(pa.table({"episode_index": episode, "frame_index": frame, "index": range(len(frame)), "action": pa.array(action, vector), "observation.state": pa.array(state, vector)}), d / "data/chunk-000/file-000.parquet")
    pq.write_table(pa.table(table | moments), d / "meta/episodes/chunk-000/file-000.parquet")
    pq.write_table(pa.table({"task": ["x"]}), d / "meta/tasks.parquet")
    whole = {f: {"mean": [0.0] * 6, "count": [len(frame)]} | ({k: [0.5] * 6 for k in jobs.QUANTILE_KEYS} if quantiles else {}) for f in jobs.FEATURES}
    (d / "meta/stats.json").write_text(json.dumps(whole))
    (d / "meta/info.json").write_text(json.dumps({"codebase_version": "v3.0", "total_episodes": len(kinds), "total_frames": len(frame), "fps": fps, "features": features, "robot": "arm"}))
    return np.array(action, dtype=np.float32).astype(float), np.array(state, dtype=np.float32).astype(float), np.array(episode)


@pytest.fixture
def tree(tmp_path):
    made = {
        "a/whole": dataset(tmp_path / "in", "a/whole", ["moving"] * 3, camera=True),
        "a/part": dataset(tmp_path / "in", "a/part", ["moving", "still", "moving", "nan", "moving"]),
        "b/few": dataset(tmp_path / "in", "b/few", ["moving", "still"]),
        "b/slow": dataset(tmp_path / "in", "b/slow", ["moving"] * 2, fps=15.0),
        "b/bare": dataset(tmp_path / "in", "b/bare", ["moving"] * 2, quantiles=False),
        "b/film": dataset(tmp_path / "in", "b/film", ["moving", "still", "moving"], camera=True),
    }
    return tmp_path, made


def test_backfill(spark, tree):
    top, made = tree
    root = str(top / "in")
    (top / "in/b/slow/meta/stats.json").write_text(json.dumps({"action": {"mean": [0.0]}}))
    tried = {r["name"]: r for r in jobs.backfill(spark, root, force=True, dry_run=True).collect()}
    assert tried["a/whole"]["status"] == "dry-run" and tried["a/whole"]["detail"].endswith("over 10 entries") and tried["b/bare"]["detail"] == "no existing quantiles"
    results = jobs.backfill(spark, root)
    got = {r["name"]: (r["status"], r["detail"]) for r in results.collect()}
    assert got["a/whole"] == ("skipped", "quantiles already present") and got["b/bare"] == ("backfilled", "120 frames")
    assert got["b/slow"] == ("failed", "features missing from stats.json: observation.state") and jobs.exit_code(results) == 1
    new = json.loads((top / "in/b/bare/meta/stats.json").read_text())
    for f, x in zip(jobs.FEATURES, made["b/bare"], strict=False):
        assert new[f]["mean"] == [0.0] * 6 and new[f]["count"] == [120]
        for k, q in zip(jobs.QUANTILE_KEYS, (0.01, 0.1, 0.5, 0.9, 0.99), strict=True):
            assert new[f][k] == pytest.approx(np.quantile(x, q, axis=0).tolist())
    with pytest.raises(ValueError, match="unknown"):
        jobs.backfill(spark, root, ["x/y"])
    assert not (top / "in/.staging").exists()


def test_filter(spark, tree):
    top, made = tree
    root, out = str(top / "in"), str(top / "out")
    dry = {r["dataset"]: r for r in jobs.filter_collections(spark, [root], out, T, dry_run=True).collect()}
    assert dry["a/part"]["status"] == "dry_run" and dry["a/part"]["drops"] == {"1": "zero_travel (path 0.0000)", "3": "nan_actions"}
    assert not (top / "out/a").exists()
    results = jobs.filter_collections(spark, [root], out, T)
    got = {r["dataset"]: r for r in results.collect()}
    assert {n: (r["status"], r["mode"]) for n, r in got.items()} == {"a/whole": ("ok", "hardlink"), "a/part": ("ok", "rebuild"), "b/few": ("dataset_dropped", None), "b/slow": ("failed", None), "b/bare": ("failed", None), "b/film": ("failed", None)}
    assert "out of scope" in got["b/slow"]["error"] and "backfill" in got["b/bare"]["error"] and "codec" in got["b/film"]["error"] and jobs.exit_code(results) == 1
    assert (top / "out/a/whole/videos/observation.images.top/chunk-000/file-000.mp4").read_bytes() == b"video"
    assert (top / "out/a/whole/data/chunk-000/file-000.parquet").stat().st_ino == (top / "in/a/whole/data/chunk-000/file-000.parquet").stat().st_ino
    part = top / "out/a/part"
    info = json.loads((part / "meta/info.json").read_text())
    assert (info["total_episodes"], info["total_frames"], info["splits"], info["robot"]) == (3, 180, {"train": "0:3"}, "arm")
    frames = pa.concat_tables([pq.read_table(p) for p in sorted((part / "data/chunk-000").glob("*.parquet"))])
    action, state, episode = made["a/part"]
    keep = np.isin(episode, [0, 2, 4])
    assert frames["index"].to_pylist() == list(range(180)) and frames["episode_index"].to_pylist() == [0] * 60 + [1] * 60 + [2] * 60
    assert np.allclose(frames["action"].to_pylist(), action[keep])
    table = pa.concat_tables([pq.read_table(p) for p in sorted((part / "meta/episodes/chunk-000").glob("*.parquet"))])
    assert table["episode_index"].to_pylist() == [0, 1, 2] and table["dataset_from_index"].to_pylist() == [0, 60, 120] and table["stats/index/max"].to_pylist() == [[59], [119], [179]]
    stats = json.loads((part / "meta/stats.json").read_text())
    for f, x in zip(jobs.FEATURES, (action[keep], state[keep]), strict=True):
        assert stats[f]["mean"] == pytest.approx(x.mean(0).tolist()) and stats[f]["std"] == pytest.approx(x.std(0).tolist()) and stats[f]["count"] == [180]
        assert stats[f]["min"] == pytest.approx(x.min(0).tolist()) and stats[f]["q90"] == pytest.approx(np.quantile(x, 0.9, axis=0).tolist())
    assert stats["index"]["mean"] == pytest.approx([89.5]) and (part / "meta/tasks.parquet").exists()
    assert not (top / "out/.staging").exists()
    again = {r["dataset"] for r in jobs.filter_collections(spark, [root], out, T, names=["a/whole", "b/few"]).collect()}
    assert again == {"b/few"}  # what is there is left out
    forced = {r["dataset"]: r["status"] for r in jobs.filter_collections(spark, [root], out, T, names=["a/whole"], force=True).collect()}
    assert forced == {"a/whole": "ok"} and spark.read.json(f"{out}/filter_manifest.jsonl").count() == 8


def test_sources_of_v3(spark, tree):
    top, _ = tree
    root = str(top / "in")
    kinds = {(r["name"], r["column"]): r["type"] for r in collection.schemas(spark, root).collect()}
    assert kinds["a/part", "action"].startswith("list<") and kinds["a/part", "index"] == "int64"
    ends = {r["name"]: (r["rows"], r["low"], r["high"]) for r in collection.index_extremes(spark, root).collect()}
    assert ends["a/part"] == (300, 0, 299)
    dataset(top / "in2", "a/part", ["moving"])
    with pytest.raises(ValueError, match="several roots"):
        collection.discover(spark, [root, str(top / "in2")])
    (top / "none").mkdir()
    with pytest.raises(Exception, match="none"):
        collection.discover(spark, [str(top / "none")])
