import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from tracewright.plans import convert
from tracewright.plans.jobs import exit_code

CAM, HALF = "observation.images.top", "observation.images.half"


def dataset(top, name, version, lengths, rows, camera=True, stats=(), half=False, chunk=0):
    d = top / name
    for below in ("meta", f"data/chunk-{chunk:03d}"):
        (d / below).mkdir(parents=True)
    features = {"action": {"dtype": "float32", "shape": [2]}, "index": {"dtype": "int64", "shape": [1]}, "episode_index": {"dtype": "int64", "shape": [1]}, "frame_index": {"dtype": "int64", "shape": [1]}, "note": {"dtype": "string", "shape": [1]}}
    films = ([CAM] if camera else []) + ([HALF] if half else [])
    features |= {k: {"dtype": "video", "shape": [3, 4, 4]} for k in films}
    out = {}
    for e, n in rows.items():
        x = np.random.default_rng(e).normal(size=(n, 2)).astype(np.float32)
        out[e] = x.astype(float)
        table = {"episode_index": [e] * n, "frame_index": range(n), "index": range(n), "action": pa.array(x.tolist(), pa.list_(pa.float32())), "note": ["x"] * n, "stray": [True] * n}
        pq.write_table(pa.table(table), d / f"data/chunk-{chunk:03d}/episode_{e:06d}.parquet")
        for k in films:
            if k == CAM or e == 0:
                (d / f"videos/chunk-{chunk:03d}/{k}").mkdir(parents=True, exist_ok=True)
                (d / f"videos/chunk-{chunk:03d}/{k}/episode_{e:06d}.mp4").write_bytes(b"%d" % e)
    (d / "meta/episodes.jsonl").write_text("".join(json.dumps({"episode_index": e, "length": n, "tasks": ["t"]}) + "\n\n" for e, n in lengths.items()))
    (d / "meta/tasks.jsonl").write_text('{"task_index": 0, "task": "t"}\n')
    if stats:
        cell = lambda e: {"min": out[e].min(0).tolist(), "max": out[e].max(0).tolist(), "mean": out[e].mean(0).tolist(), "std": out[e].std(0).tolist(), "count": [len(out[e])]}
        image = {"min": [[[0]], [[0]], [[0]]], "max": [[[1.0]], [[1.0]], [[1.0]]], "mean": [[[0.5]], [[0.5]], [[0.5]]], "std": [[[0.1]], [[0.1]], [[0.1]]], "count": [10]}
        (d / "meta/episodes_stats.jsonl").write_text("".join(json.dumps({"episode_index": e, "stats": {"action": cell(e), "observation.top": image, "ghost": cell(e)}}) + "\n" for e in stats))
    info = {"codebase_version": version, "total_episodes": len(lengths), "total_frames": 999, "total_videos": 7, "chunks_size": 1000, "fps": 10, "splits": {"train": "0:9"}, "features": features, "robot": "arm"}
    (d / "meta/info.json").write_text(json.dumps(info))
    return out


def test_convert(spark, tmp_path):
    top, out = tmp_path / "in", tmp_path / "out"
    one = dataset(top, "a/one", "v2.1", {0: 20, 2: 30, 5: 25}, {0: 20, 2: 30, 5: 25, 9: 4}, stats=(0, 2), half=True)
    two = dataset(top, "a/two", "v2.0", {0: 20, 1: 22, 2: 9}, {0: 20, 1: 21}, camera=False, chunk=3)
    dataset(top, "b/none", "v2.1", {0: 5}, {0: 6})
    dataset(top, "b/old", "v1.0", {0: 5}, {0: 5})
    dataset(top, "b/blind", "v2.1", {0: 5}, {0: 5})
    import shutil

    shutil.rmtree(top / "b/blind/videos")
    results = convert.convert_collection(spark, str(top), str(out))
    got = {r["dataset"]: r for r in results.collect()}
    assert {n: r["status"] for n, r in got.items()} == {"a/one": "converted", "a/two": "converted", "b/none": "failed", "b/old": "unsupported", "b/blind": "failed"} and exit_code(results) == 1
    assert got["a/one"]["dropped_features"] == ["note", HALF] and "no videos" in got["b/blind"]["error"] and "consistent" in got["b/none"]["error"]
    fixes = got["a/two"]["corrections"]
    assert fixes["dropped_corrupt_episodes"] == [2] and fixes["repaired_episode_lengths"] == 1 and fixes["aggregates"]["total_frames"] == ("999", "41")
    info = json.loads((out / "a/one/meta/info.json").read_text())
    assert (info["codebase_version"], info["total_episodes"], info["total_frames"], info["total_videos"], info["splits"], info["robot"]) == ("v3.0", 3, 75, 3, {"train": "0:3"}, "arm")
    assert set(info["features"]) == {"action", "index", "episode_index", "frame_index", CAM}
    read = lambda p: pa.concat_tables([pq.read_table(f) for f in sorted(p.glob("*.parquet"))])
    frames = read(out / "a/one/data/chunk-000")
    assert frames["index"].to_pylist() == list(range(75)) and frames["episode_index"].to_pylist() == [0] * 20 + [1] * 30 + [2] * 25
    assert np.allclose(frames["action"].to_pylist(), np.concatenate([one[0], one[2], one[5]])) and "stray" not in frames.column_names
    assert (out / f"a/one/videos/{CAM}/chunk-000/file-002.mp4").read_bytes() == b"5" and not (out / f"a/one/videos/{HALF}").exists()
    table = read(out / "a/one/meta/episodes/chunk-000").to_pylist()
    assert [r["length"] for r in table] == [20, 30, 25] and table[1]["stats/index/min"] == [20.0] and table[2][f"videos/{CAM}/to_timestamp"] == 2.5
    assert np.allclose(table[2]["stats/action/mean"], one[5].mean(0)) and table[0][f"stats/{CAM}/mean"] == [0.5] * 3 and not any("ghost" in c for c in table[0])
    stats = json.loads((out / "a/two/meta/stats.json").read_text())
    both = np.concatenate([two[0], two[1]])
    assert np.allclose(stats["action"]["std"], both.std(0)) and stats["action"]["count"] == [41] and stats["index"]["max"] == [40.0]
    assert json.loads((out / "a/one/meta/stats.json").read_text())[CAM]["mean"] == [[[0.5]]] * 3
    assert not (out / ".staging").exists() and (out / "a/one/meta/tasks.jsonl").exists()
    again = {r["dataset"] for r in convert.convert_collection(spark, str(top), str(out)).collect()}
    assert again == {"b/none", "b/old", "b/blind"}


def test_card(spark):
    from pyspark.sql import functions as F
    from tracewright.operators import report

    census = lambda n, size: report.census(spark.createDataFrame([("v2.1", n, 12345, size)], "version string, episodes long, frames long, size_bytes long"))
    log = spark.createDataFrame([("a/x", "failed", "v2.0", "a|b"), ("a/y", "converted", "v2.1", None)], "dataset string, status string, source_version string, error string")
    fixes = F.struct(F.create_map(F.lit("splits"), F.struct(F.lit("1").alias("from"), F.lit("2").alias("to"))).alias("aggregates"), F.array(F.lit(3).cast("long")).alias("dropped_corrupt_episodes"), F.lit(0).cast("long").alias("repaired_episode_lengths"))
    full = log.filter("status = 'converted'").withColumn("corrections", fixes).withColumn("dropped_features", F.array(F.lit("k"))).withColumn("note", F.lit(None).cast("string"))
    text = report.card("things", census(3, 3_000_000_000), census(2, 1_000_000_000), report.exclusions(log), report.manifest_notes(full))
    assert "| episodes | 3 | 2 |" in text and "| frames | 12,345 | 12,345 |" in text and "| size | 3.0 GB | 1.0 GB |" in text and "smaller" in text
    assert "| `a/x` | v2.0 | a\\|b |" in text and "| `a/y` | stale `splits` recomputed; dropped 1 corrupt episode(s) [3]; dropped v3-incompatible features ['k'] |" in text
    assert text.startswith("---\nviewer")
