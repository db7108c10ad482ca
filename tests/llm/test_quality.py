import numpy as np
import pytest
from tracewright.llm import quality


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in quality.op8_quality(spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(rows[r["doc_id"]], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    right = sum(r["quality"] == q for r, q in held) / len(held)
    assert right > max(np.mean([q for _, q in held]), 0.9)


def test_pseudo_labels_help():
    rng = np.random.default_rng(2)

    def draw(n):
        y = rng.integers(0, 2, n)
        return y, [rng.normal(size=(n, 40)) + y[:, None] * 0.6, rng.normal(size=(n, 10)) + y[:, None] * 0.9]

    y, x = draw(40)
    _, pool = draw(4000)
    test_y, test = draw(4000)
    fold = np.arange(40) % quality.FOLDS
    both = quality.CoTrained().fit(x, y, fold, pool)
    alone = quality.CoTrained().fit(x, y, fold, [p[:0] for p in pool])
    accuracy = lambda m: ((m.odds(*test)[2] > 0) == test_y).mean()
    assert accuracy(both) > accuracy(alone) and accuracy(both) > 0.95


def test_logistic_against_closed_form():
    x = np.repeat([[0.0], [1.0]], 50, axis=0)
    y = np.concatenate((np.ones(10), np.zeros(40), np.ones(35), np.zeros(15)))
    odds = quality.Logistic(1).fit(x, y).odds(np.array([[0.0], [1.0]]))
    assert odds == pytest.approx([np.log(10 / 40), np.log(35 / 15)], abs=0.02)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 1), (2, "", "s", "en", 0, 1), (2, "a\nb " * 50_000, "s", "en", 3, 1), (None, "x", "s", "en", 1, 1), (4, "fine", "s", "en", 1, 1)], "doc_id long, text string, source string, lang string, n_chars long, label int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (4, None), (None, 1), (77, 1)], "doc_id long, quality int")
    got = quality.quality_scores(docs, quality.train(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    none = quality.quality_scores(docs, quality.train(docs, labels.limit(0))).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.quality_scores(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


def test_repeated_ids_leave_room_in_the_pool(spark, monkeypatch):
    monkeypatch.setattr(quality, "UNLABELLED", 5)
    taken = []
    monkeypatch.setattr(quality.CoTrained, "fit", lambda self, known, y, fold, pool: taken.append(len(pool[0])) or self)
    rows = [(i, f"text of {i}", "s", "en", 9) for i in range(20) for _ in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    quality.train(docs, spark.createDataFrame([(100, 1), (0, 0)], "doc_id long, quality int"))
    assert taken == [15]


def test_metadata_view_does_not_read_the_text(spark):
    docs = spark.createDataFrame([(1, "some text", "s", "en", 9), (2, "QUITE another\n\n1234", "s", "en", 9), (3, "some text", "s", None, None)], "doc_id long, text string, source string, lang string, n_chars long")
    rows = {r["doc_id"]: np.frombuffer(r["view"], np.float16) for r in quality.viewed(docs).collect()}
    assert (rows[1][quality.TEXT :] == rows[2][quality.TEXT :]).all() and (rows[1][: quality.TEXT] != rows[2][: quality.TEXT]).any()
    assert (rows[1][: quality.TEXT] == rows[3][: quality.TEXT]).all() and (rows[1][quality.TEXT :] != rows[3][quality.TEXT :]).any()


def test_exchange_over_the_whole_table_against_brute_force(spark):
    """Histograms, turning points and gradients over several partitions equal those over all rows at once, and pseudo-labels help."""
    rng = np.random.default_rng(4)
    n = 6000
    y = rng.integers(0, 2, n)
    x = rng.normal(size=(n, quality.TEXT + quality.META)) * 0.5 + y[:, None] * np.where(np.arange(quality.TEXT + quality.META) % 40 == 0, 0.6, 0.0)
    x = x.astype(np.float16)
    rows = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "doc_id long, view binary").repartition(7)
    both = [x[:, : quality.TEXT].astype(np.float32), x[:, quality.TEXT :].astype(np.float32)]
    fold = quality.fold_of(list(range(n)))
    model = quality.CoTrained().fit([v[:200] for v in both], y[:200], fold[:200], [v[:0] for v in both])
    before = [(m.w.copy(), m.b) for m in model.models]
    inside = (fold != quality.CALIBRATE) & (fold != quality.HELD_OUT)
    counts = np.zeros((2, quality.BINS), int)
    for r in rows.mapInArrow(quality.histograms(model), "view int, bin int, n long").collect():
        counts[r["view"], r["bin"]] += r["n"]
    edges = []
    for v in (0, 1):
        odds = model.models[v].odds(both[v][inside])
        assert (counts[v] == np.bincount(quality.bin_of(odds), minlength=quality.BINS)).all()
        low, high = quality.beyond(counts[v], 0.5, 0.1)
        place = quality.bin_of(odds)
        assert (place <= low).sum() <= 0.05 * inside.sum() < (place <= low + 1).sum() and (place >= high).sum() <= 0.05 * inside.sum() < (place >= high - 1).sum()
        edges.append((low, high))
    sums = [np.zeros(quality.TEXT + 2), np.zeros(quality.META + 2)]
    for r in rows.mapInArrow(quality.gradients(model, edges), "view int, dim int, value double").collect():
        sums[r["view"]][r["dim"] + 1] += r["value"]
    for v in (0, 1):
        want, taught = np.zeros(len(sums[v]) - 1), 0
        for i in np.flatnonzero(inside):
            place = quality.bin_of(model.models[1 - v].odds(both[1 - v][i : i + 1]))[0]
            if place <= edges[1 - v][0] or place >= edges[1 - v][1]:
                m = model.models[v]
                z = (both[v][i] - m.mean) / m.scale
                want += np.append(z, 1.0) * (1 / (1 + np.exp(-(z @ m.w + m.b))) - (place >= edges[1 - v][1]))
                taught += 1
        assert sums[v][0] == taught > 0 and sums[v][1:] == pytest.approx(want, rel=1e-3, abs=1e-2)
    accuracy = lambda: ((model.odds(*[v[fold == quality.HELD_OUT] for v in both])[2] > 0) == y[fold == quality.HELD_OUT]).mean()
    start = accuracy()
    quality.exchange(model, rows, [v[:200] for v in both], y[:200], fold[:200])
    assert accuracy() >= start and any((m.w != w).any() for m, (w, _) in zip(model.models, before, strict=True))
