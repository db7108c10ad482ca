import random

from tracewright.llm import topk


def code(v):
    bits = [1 if x is not None and x > 0 else 0 for x in v[:64]] + [0] * 64
    return int("".join(map(str, bits[:64])), 2)


def by_force(rows, k, every):
    codes = sorted({(i, code(v)) for i, v in rows if i is not None and v is not None})
    out = set()
    for q, c in codes:
        if q % every == 0:
            near = sorted(((c ^ d).bit_count(), i) for i, d in codes if i != q)[:k]
            out |= {(q, i, far, n + 1) for n, (far, i) in enumerate(near)}
    return out


def check(spark, rows, k=5, every=10, **limits):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, code string")
    got = [(r["query_id"], r["neighbor_id"], r["distance"], r["rank"]) for r in topk.top_k(df, k, every, **limits).collect()]
    assert len(got) == len(set(got)) and set(got) == by_force(rows, k, every)


def test_random_codes(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(700)]
    check(spark, rows)
    check(spark, rows, shard_rows=100, block_queries=7)


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(7)
    same = [rng.uniform(-1, 1) for _ in range(64)]
    rows = [(i, same) for i in range(300)] + [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(300, 360)]
    rows += [(20, same), (400, None), (None, same), (410, []), (411, [1.0]), (412, same + [1.0]), (420, [float("nan")] * 64)]
    check(spark, rows, k=4)
    check(spark, rows[:1])
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {(r["query_id"], r["neighbor_id"], r["distance"], r["rank"]) for r in topk.op10_topk(spark, sf_dir).collect()}
    assert got == by_force(rows, 10, 50)


def whole_by_force(rows, k, every):
    """``by_force`` over vectors of any length."""
    width = max((len(v) for _, v in rows if v is not None), default=0)
    codes = sorted({(i, "".join("1" if x is not None and x > 0 else "0" for x in v).ljust(width, "0")) for i, v in rows if i is not None and v is not None})
    out = set()
    for q, c in codes:
        if q % every == 0:
            near = sorted((sum(x != y for x, y in zip(c, d, strict=True)), i) for i, d in codes if i != q)[:k]
            out |= {(q, i, far, n + 1) for n, (far, i) in enumerate(near)}
    return out


def test_long_vectors(spark):
    rng = random.Random(8)
    head = [1.0] * 64
    rows = [(i, head + [rng.uniform(-1, 1) for _ in range(64)]) for i in range(200)]
    rows += [(200 + i, [rng.choice((-1.0, 1.0)) for _ in range(n)]) for i, n in enumerate((1, 7, 8, 9, 100, 127, 128) * 10)]
    rows += [(300, [None, 1.0] * 40), (310, head), (310, head[:3]), (310, [-1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for shard_rows in (topk.SHARD_ROWS, 16):
        got = {(r["query_id"], r["neighbor_id"], r["distance"], r["rank"]) for r in topk.top_k(df, 6, 10, shard_rows=shard_rows).collect()}
        assert got == whole_by_force(rows, 6, 10)


def test_executors_need_no_package(tmp_path):
    """What is sent to executors runs in an interpreter that cannot import the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    cut = topk.Segments(64, 1000, 100)
    (tmp_path / "sent").write_bytes(cloudpickle.dumps([topk.encoder(8), topk.places(cut), topk.probes(cut, 2), topk.searcher(cut, 11, 256)]))
    code = """
import pickle, pyarrow as pa
encode, places, probes, search = pickle.load(open("sent", "rb"))
rows = pa.record_batch([pa.array([1, 2]), pa.array([[1.0] * 64, [-1.0, None]], pa.list_(pa.float32()))], names=["vec_id", "embedding"])
(codes,) = encode([rows])
(*placed,) = places([codes.select(["code"])])
(*asked,) = probes([codes.select(["code"]).rename_columns(["query"])])
key = placed[0].column(0)[0]
found = search((), pa.table([[key], [0], [placed[0].column(1)[0]], [[1]]], names=["key", "shard", "code", "ids"]), pa.table([[key], [0], [placed[0].column(1)[0]], pa.array([0], pa.int32())], names=["key", "shard", "query", "rest"]))
print(found.num_rows)
"""
    out = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert out.stdout.strip() == "1", out.stderr
