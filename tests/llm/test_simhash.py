import random

import numpy as np
import pytest
import xxhash
from tracewright.llm import simhash
from tracewright.llm.graph import components


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, fps, radius=2):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(d, least.get(root(i), d))
    return [least[root(i)] for i in range(len(ids))]


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {}
    fps = [fingerprint(d["text"]) for d in docs]
    for d, f, c in zip(docs, fps, classes([d["doc_id"] for d in docs], fps), strict=True):
        want[d["doc_id"]] = (f"{f:016x}", c)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op2_simhash(spark, sf_dir).collect()}
    assert got == want


def test_odd_texts(spark):
    texts = [None, "", " \t", "One", "one two", "ONE  two\x0bthree", "one two three", "one two", "a b c " * 70_000]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    got = sorted(tuple(r) for r in simhash.near_duplicates(df).collect())
    fps = [fingerprint(t) for t in texts[:-1]]
    assert [f & (2**64 - 1) for _, f, _ in got[:-1]] == fps
    assert [c for _, _, c in got[:-1]] == classes(range(len(fps)), fps)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def crowd(n, seed=1):
    """Fingerprints near each other and apart, with crowded keys."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        f = rng.getrandbits(64) if rng.random() < 0.3 or not out else rng.choice(sorted(out)[:50])
        out.add(f ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))))
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("most", [2, 1024])
def test_links_keep_components(spark, monkeypatch, radius, most):
    fps = crowd(400)
    monkeypatch.setattr(simhash, "compare_lists", lambda r, f=simhash.compare_lists: f(r, most))
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(nodes, radius)
    back = lambda x: x & (2**64 - 1)
    assert all((back(r["a"]) ^ back(r["b"])).bit_count() <= 2 * ((radius + 1) // 2) for r in edges.collect())
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert [roots.get(f, f) for f in signed] == classes(signed, fps, radius)


@pytest.mark.parametrize("radius", [0, 2, 3, 7, 16])
def test_bit_slices(radius):
    fps = np.array(crowd(300, 2), dtype=np.uint64)
    starts, sizes = np.array([0, 3, 100]), np.array([3, 97, 200])
    got = set()
    for a, b in simhash.BitSlices(fps, starts, sizes).links(radius):
        got |= set(zip(a.tolist(), b.tolist(), strict=True))
    want = {(i, j) for s, n in zip(starts, sizes, strict=True) for i in range(s, s + n) for j in range(i + 1, s + n) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert got == want


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, 1001: 1000}


def similar_classes(texts, similarity=0.8):
    sets = {}
    for i, t in texts:
        words = (t or "").encode().lower().split()
        sets[i] = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("side", [3, 1024])
def test_members_of_a_band_meet_each_other(spark, monkeypatch, side):
    """Texts about a shared passage: a band's first text is often like none of the others, which may be like each other."""
    monkeypatch.setattr(simhash, "SIDE", side)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(120)]
    texts = []
    for family in range(12):
        own = [f"f{family}w{i}" for i in range(60)]
        for _ in range(4):
            words = passage + own
            words[rng.randrange(20, 160)] = f"x{rng.random()}"
            texts.append((len(texts), " ".join(words)))
    rng.shuffle(texts)
    texts += [(100, None), (101, ""), (102, "one two"), (103, "one two"), (104, texts[0][1])]
    got = {r[0]: r[1] for r in simhash.similar(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == similar_classes(texts)
    assert len(set(got.values())) > 12


@pytest.mark.parametrize("bits", [0, 20])
def test_wanted_texts_are_told_by_bits_and_joined_exactly(spark, monkeypatch, bits):
    """With 64 bits in all nearly every row passes them; the join alone decides then."""
    monkeypatch.setattr(simhash, "WORD_BITS", bits)
    rows = [(i, None if i % 7 == 0 else f"text {i}", 1, 2, 3) for i in range(-200, 400)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, _word int, _bits int")
    ids = [*range(-90, 130, 3), (1 << 62)]
    got = sorted(tuple(r) for r in simhash.texts_of(docs, spark.createDataFrame([(i,) for i in ids], "id long")).collect())
    assert got == [(i, None if i % 7 == 0 else f"text {i}") for i in ids[:-1]]
    assert simhash.texts_of(docs, spark.createDataFrame([], "id long")).count() == 0


def test_wanted_bits_are_packed(spark):
    """What all tasks and the driver hold is a few rows, however many texts are wanted."""
    wanted = spark.range(0, 60_000, 1, 4).select("id")
    packs = simhash.wanted_bits(wanted).collect()
    assert len(packs) == 1 << simhash.WORD_BITS - simhash.PACK_BITS and {len(p["_words"]) for p in packs} == {1 << simhash.PACK_BITS}
    places = wanted.selectExpr("xxhash64(id) & ((1L << 26) - 1) AS place").collect()
    assert sum((w & (1 << 64) - 1).bit_count() for p in packs for w in p["_words"]) == len({r["place"] for r in places})
