import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tracewright.llm import pieces


def small():
    names = [f"<0x{b:02X}>" for b in range(256)] + ["▁", "a", "b", "ab", "▁a", "aa", "▁ab", "ba"]
    return pieces.Vocabulary(names, ["byte"] * 256 + ["normal"] * 8, [0.0] * 256 + [-float(i) for i in range(8)])


def every(vocabulary, text):
    """All segmentations of a text without bytes, and their probabilities."""
    whole = ("▁" + text.replace(" ", "▁")) if text else ""
    names = {"▁": 256, "a": 257, "b": 258, "ab": 259, "▁a": 260, "aa": 261, "▁ab": 262, "ba": 263}

    def paths(at):
        if at == len(whole):
            yield ()
        for name, i in names.items():
            if whole.startswith(name, at):
                yield from ((i, *rest) for rest in paths(at + len(name)))

    weight = {p: math.exp(sum(vocabulary.log_p[i] for i in p)) for p in paths(0)}
    total = sum(weight.values())
    return {p: w / total for p, w in weight.items()}


@pytest.mark.parametrize("text", ["ab", "ab a", "aab"])
def test_draws_follow_the_distribution(text):
    v = small()
    want = every(v, text)
    n = 6000
    drawn = pieces.sample_group([text] * n, list(range(n)), pieces.Lattices(v), 3, 5)
    pairs, singles, weight = Counter(), Counter(), Counter()
    for d in drawn:
        found = [tuple(v.ids(e).tolist()) for e, *_ in d]
        assert len(set(found)) == len(found) == min(3, len(want))
        assert all(log_p == pytest.approx(math.log(want[p])) for p, (_, log_p, _, _) in zip(found, d, strict=True))
        values = [x[2] for x in d]
        assert values == sorted(values, reverse=True)
        singles[found[0]] += 1
        pairs[found[0], found[1]] += 1
        for p, (*_, inclusion) in zip(found, d, strict=True):
            weight[p] += want[p] / inclusion
    for p, share in want.items():
        assert singles[p] / n == pytest.approx(share, abs=4 * math.sqrt(share * (1 - share) / n) + 1e-3)
        # Inclusion scores make unbiased estimates of every probability.
        assert weight[p] / n == pytest.approx(share, rel=0.25, abs=0.01)
        for q, other in want.items():
            if p != q:
                chance = share * other / (1 - share)
                assert pairs[p, q] / n == pytest.approx(chance, abs=4 * math.sqrt(chance / n) + 1e-3)


def test_all_segmentations_of_a_short_text():
    v = small()
    want = every(v, "aba b")
    (drawn,) = pieces.sample_group(["aba b"], [1], pieces.Lattices(v), 1000, 1)
    assert {tuple(v.ids(e).tolist()) for e, *_ in drawn} == set(want)
    assert all(x[3] == 1.0 for x in drawn)


TEXTS = [None, "", " ", "  two  spaces ", "a\n\tb", "▁literal ▁▁", "é日本語🎉 ünï", "x" * 3000, "word " * 5000, "\x00\x7f퟿", "Hello world"]


def test_texts_are_restored(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, sample string")
    rows = pieces.decoded(pieces.segmentations(df, k=3)).collect()
    for i, text in enumerate(TEXTS):
        mine = [r for r in rows if r["row_key"] == i]
        few = {None: 1, "": 1, " ": 2, "a\n\tb": 2, TEXTS[9]: 1}  # these have no more
        assert len(mine) == few.get(text, 3)
        assert all(r["decoded"] == (text or "") for r in mine)
        assert len({tuple(r["ids"]) for r in mine}) == len(mine)
    assert pieces.segmentations(df.limit(0)).count() == 0


def test_agrees_with_sentencepiece():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    v = pieces.Vocabulary.load(pieces.MODEL)
    for text in TEXTS[6:] + ["one two"]:
        ids = model.encode(text)
        if text and "▁" not in text:
            assert v.decode(np.array(ids)).decode() == model.decode(ids) == text


def test_draws_do_not_depend_on_grouping(monkeypatch):
    v = pieces.Vocabulary.load(pieces.MODEL)
    texts, keys = [f"some words {i} and é more" for i in range(40)], list(range(40))
    whole = pieces.sample_group(texts, keys, pieces.Lattices(v), 3, 1)
    monkeypatch.setattr(pieces, "KEPT", 64)
    lattices = pieces.Lattices(v)
    single = [pieces.sample_group([t], [k], lattices, 3, 1)[0] for t, k in zip(texts, keys, strict=True)]
    for a, b in zip(whole, single, strict=True):
        assert [x[0].tolist() for x in a] == [x[0].tolist() for x in b]
        assert [x[2] for x in a] == pytest.approx([x[2] for x in b])


def test_memory_of_a_task():
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(400)) for _ in range(300)]
    v = pieces.Vocabulary.load(pieces.MODEL)
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], names=["row_key", "text"])
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in pieces.sampler(v, 2, 11, False)(iter([batch]))) == 600
        assert tracemalloc.get_traced_memory()[1] < 72 << 20
    finally:
        tracemalloc.stop()


def test_lattices_past_the_bound(monkeypatch):
    v = pieces.Vocabulary.load(pieces.MODEL)
    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(6)]
    whole = [pieces.sample_group([t], [i], pieces.Lattices(v), 2, 1)[0] for i, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "KEPT", 4096)
    lattices = pieces.Lattices(v)
    for _ in range(2):
        for i, (t, want) in enumerate(zip(texts, whole, strict=True)):
            (drawn,) = pieces.sample_group([t], [i], lattices, 2, 1)
            assert [x[0].tolist() for x in drawn] == [x[0].tolist() for x in want]


def test_query(spark, sf_dir):
    rows = pieces.op9_pieces(spark, sf_dir).collect()
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len(rows) == 2 * n and all(r["restored"] for r in rows)
    assert len({(r["doc_id"], r["ids_sha256"]) for r in rows}) == 2 * n


def test_query_returns_piece_ids(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = pieces.decoded(pieces.op9_pieces(spark, sf_dir)).collect()
    assert len(rows) == 2 * len(texts) and all(len(r["ids"]) == r["n_pieces"] and r["decoded"] == (texts[r["doc_id"]] or "") for r in rows)
