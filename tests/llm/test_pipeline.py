from collections import Counter

import pytest
from tracewright.llm import mixing, simhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from tracewright.llm._shared import store

    docs, out = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, ""), name)
        out.append(docs)
    assert all(d.columns == columns for d in out[:-1])
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), [d.collect() for d in out]


def test_language_stage_keeps_documents_with_a_language(stages):
    docs, (kept, *_) = stages
    assert {d["doc_id"] for d in kept} <= {d["doc_id"] for d in docs}
    gone = {d["doc_id"] for d in docs} - {d["doc_id"] for d in kept}
    assert len(gone) <= 0.03 * len(docs)


def test_one_document_of_each_group_stays(stages):
    _, (before, kept, *_) = stages
    sets = {d["doc_id"]: shingles(d["text"]) for d in before}
    ids = sorted(sets)
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert sorted(d["doc_id"] for d in kept) == sorted({root(i) for i in ids})


def test_secrets_are_masked(stages):
    from test_secrets import base_spans

    _, (_, before, clean, *_) = stages
    texts = {d["doc_id"]: d for d in clean}
    assert len(clean) == len(before)
    for d in before:
        spans = base_spans(d["text"])
        after = texts[d["doc_id"]]
        assert not base_spans(after["text"]) and len(after["text"]) == after["n_chars"]
        if spans:
            assert "[secret]" in after["text"]


def test_mix_repeats_documents(stages):
    _, (_, _, before, mixed, _) = stages
    times = Counter(d["doc_id"] for d in mixed)
    assert set(times) <= {d["doc_id"] for d in before} and max(times.values()) <= 2
    size = {d["doc_id"]: len((d["text"] or "").encode().split()) for d in before}
    total = sum(size.values())
    largest = max(size.values())
    assert sum(size[i] * n for i, n in times.items()) == pytest.approx(1.5 * total, abs=20 * largest / 2)


def test_encoded(stages):
    _, (*_, mixed, encoded) = stages
    assert {d["doc_id"] for d in encoded} == {d["doc_id"] for d in mixed}
    assert len(encoded) == sum(2 if d["text"] else 1 for d in mixed)


def test_similar_odd_rows(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "A b  c d e f g h i j"), (3, "a b c d e f g h i k"), (4, None), (5, ""), (6, "x"), (7, "x"), (None, "x"), (6, "x"), (9, "w " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in simhash.similar(df).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 6), (6, 6), (7, 6), (9, 9)]
    kept = sorted(r["doc_id"] or 0 for r in simhash.deduplicated(df).collect())
    assert kept == [0, 1, 3, 4, 6, 9]
    assert simhash.deduplicated(df.limit(0)).count() == 0


def test_different_texts_of_one_id_stay(spark):
    other = lambda n: " ".join(f"{w}{n}" for w in "k l m n o p q r s t u v".split())
    rows = [(5, other(1)), (5, other(2)), (5, other(2)), (5, other(3)), (4, other(3)), (9, other(1)), (None, other(1)), (5, None), (8, "")]
    rows += [(20 + i // 2, other(10 + i)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = sorted(((r["doc_id"] or 0, r["text"] or "") for r in simhash.deduplicated(df).collect()))
    assert kept == sorted([(0, other(1)), (5, other(1)), (5, other(2)), (4, other(3)), (5, "")] + rows[9:])
    groups = Counter(tuple(r) for r in simhash.similar(df).collect())
    assert sum(groups.values()) == len(rows) - 1 and groups[4, 4] == 1 and groups[5, 4] == 1 and groups[9, 5] == 1 and groups[8, 5] == 1


def mix_by_force(rows):
    """rows (doc_id, source, size): targets by bisection on the water level."""
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 4.0 * sum(sizes.values()) + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * sizes[s], mid * weight[s]) for s in names) < 1.5 * sum(sizes.values()) else (low, mid)
    return {s: min(2 * sizes[s], high * weight[s]) for s in names}


@pytest.mark.parametrize("slice_rows", [mixing.SLICE_ROWS, 5])
def test_mixing(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    texts = ["one two three " * (i % 7) for i in range(300)]
    rows = [(i, t, None if i % 11 == 0 else "s%d" % (i % 5), 1) for i, t in enumerate(texts)]
    rows += [(1000, "same words here", "s1", 1)] * 40 + [(None, "no id", "z\U0001f600", 1), (None, None, "empty", 1), (7, "", "empty", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    want = mix_by_force([(i, s, len((t or "").split())) for i, t, s, _ in rows])
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 40 for s, t in want.items())
    assert sorted(map(tuple, mixing.mix(df).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(df.limit(0)).count() == 0
