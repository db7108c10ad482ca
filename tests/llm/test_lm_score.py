import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tracewright.llm import lm_score


def reference(docs):
    """Counts and base scores in plain Python."""
    words = {i: (t or "").encode().lower().split() for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    count = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    ends = sum(not h for h in held.values())
    n, v = sum(count.values()) + ends, len(count) + (ends > 0)
    out = {}
    for i, ws in words.items():
        cs = [count[w] for w in ws] + [ends]
        out[i] = (held[i], len(cs), sum(c > 0 for c in cs), n, sum(math.log10((c + 1) / (n + v + 1)) for c in cs))
    return out


def compare(rows, want):
    assert len(rows) == len(want)
    for r in rows:
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


@pytest.mark.parametrize("head", [40, 1 << 18])
def test_query_against_brute_force(spark, sf_dir, head):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = lm_score.score(docs, head).collect()
    compare(rows, reference([(r["doc_id"], r["text"]) for r in docs.collect()]))
    for held in (True, False):
        assert sum(r["score"] - r["base_score"] for r in rows if r["held_out"] == held) > 0


def test_odd_texts(spark):
    docs = [(i, t, "x") for i, t in enumerate([None, "", " \n", "A a\x0bB", "é É", "word " * 300_000, "x" * 3_000_000, "a"])]
    df = spark.createDataFrame(docs, "doc_id long, text string, h string")
    compare(lm_score.score(df).collect(), reference([(i, t) for i, t, _ in docs]))
    assert lm_score.score(df.limit(0)).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    model = lm_score.Model(np.arange(40, dtype=np.uint64), np.zeros(40, np.uint32), np.arange(40, 0, -1), np.full(lm_score.CLASSES, 9.0), np.full(lm_score.CLASSES, 3.0), 5)
    model.weights[:] = rng.normal(size=model.weights.shape)
    rows = np.repeat(rng.integers(0, lm_score.FEATURE_ROWS, (3, 1)), lm_score.CLASSES, axis=1)
    assert np.exp(model.class_logs(np.arange(lm_score.CLASSES), rows)).sum() == pytest.approx(1, abs=1e-5)
    # Within a class: V words with counts that sum to N, and one share for the rest.
    assert (sum(c + 1 for c in (4, 3, 2)) + 1) / model.total[20] == pytest.approx(1)


def test_tokens_do_not_depend_on_pieces(monkeypatch):
    texts = ["The café\tthe  Café x".encode(), None, b"", b"a the"] * 50
    whole = lm_score.tokens(texts, lm_score.Powers())
    monkeypatch.setattr(lm_score, "PIECE", 7)
    parts = lm_score.tokens(texts, lm_score.Powers())
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    words = [(x or b"").lower().split() for x in texts]
    assert whole[3].tolist() == list(map(len, words))
    names = dict(zip(whole[0].tolist(), sum(words, []), strict=True))
    assert [names[h] for h in whole[0].tolist()] == sum(words, []) and len(set(names.values())) == len(names)


def test_head_words_are_found():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    h[1000:1010] = h[1000] + np.arange(10, dtype=np.uint64)
    model = lm_score.Model(h[:4000], np.arange(4000, dtype=np.uint32), np.arange(4000, 0, -1), np.ones(lm_score.CLASSES), np.ones(lm_score.CLASSES), 1)
    at, known = model.find(h, np.arange(5000, dtype=np.uint32))
    assert known.tolist() == [True] * 4000 + [False] * 1000 and (model.count[at[:4000]] == np.arange(4000, 0, -1)).all()


def test_history_tells_words_of_one_class_apart(spark):
    rng = np.random.default_rng(2)
    common = " ".join(f"w{i} w{i}" for i in range(7))  # these are classes of their own
    halves = ["red walking", "blue talking"]
    docs = [(i, f"{common} " + " ".join(halves[k] for k in rng.integers(0, 2, 8))) for i in range(4000)]
    odd = [(9000, "red walking"), (9001, "red talking"), (9002, "blue walking"), (9003, "blue talking")]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["score"] for r in lm_score.score(df).collect()}
    assert len(set(lm_score.tokens([b"walking talking"], lm_score.Powers())[2].tolist())) == 1
    # The words' counts cancel.
    assert got[9000] - got[9001] + got[9003] - got[9002] > 0.2
