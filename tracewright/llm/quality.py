"""Quality classifier by co-training of a text view and a metadata view.

The text view sees the content alone: hashed byte trigrams of the whole text and its layout
(lines, line lengths, repeated lines, shares of kinds of characters). The metadata view sees
source, language and declared length, and never the text. Each view's logistic regression
starts from the labelled documents. In every round each view labels the unlabelled documents
it is surest of, as many of either class as the labels' shares say, and the other view learns
from them. At the end each view is calibrated on labelled documents kept apart, and the
calibrated views are combined: their log odds are added and the prior's, which both contain,
is taken off once.

The views are computed once and stored (two bytes a number). A first model comes from a
bounded start: ``labelled`` labels and ``start`` unlabelled documents of the smallest id
hashes. Then the exchange covers the whole table: in each of ``WHOLE_ROUNDS`` rounds every
document of the training folds is scored by both views, histograms of the log odds give the
points beyond which the surest ``PART`` of the table lie, and both models go on by gradients
that are summed over all documents beyond those points, whose weight together is that of the
labels. All documents are scored, over their whole texts.

Null text counts as empty, null metadata as a value of its own. Very long texts are read as a
whole. Documents with several labels count with each; labels that are null are left out.
Without labels of both classes every score is 0.5. Repeated rows give equal rows, an empty
table none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm._shared import by_value, frugal, sliced, store, table
from tracewright.llm.langid import trigrams

#: Bounds of the start: labels that are fitted, and unlabelled ids of the first exchange. The exchange over the whole table has none.
LABELLED, UNLABELLED = 8000, 8000
#: How often a row of the start that occurs more often than this counts in it.
REPEATS = 64
TRIGRAMS, LAYOUT = 512, 10
TEXT = TRIGRAMS + LAYOUT
SOURCES, LANGUAGES, LENGTHS = 64, 16, 24
META = SOURCES + LANGUAGES + LENGTHS
ROUNDS, TAUGHT = 4, 300
#: The exchange over the whole table: rounds, gradient steps of each, part of the documents that each view teaches.
WHOLE_ROUNDS, WHOLE_STEPS, PART = 2, 3, 0.05
#: Bins of log odds, from -30 to 30.
BINS = 1200
#: Labels whose id falls in this fold calibrate; the fold before it is held out of everything.
FOLDS, CALIBRATE, HELD_OUT = 5, 3, 2
STEPS, RIDGE = 200, 1e-3

_CLASSES = np.full(256, 5)
for _start, _end, _kind in ((48, 58, 0), (65, 91, 1), (97, 123, 2), (9, 14, 3), (32, 33, 3), (128, 256, 4)):
    _CLASSES[_start:_end] = _kind


def text_view(text: str) -> np.ndarray:
    counts = trigrams(text).reshape(TRIGRAMS, -1).sum(axis=1)
    data = text.encode("utf-8", "replace")
    kinds = np.bincount(_CLASSES[np.frombuffer(data, np.uint8)], minlength=6) / max(len(data), 1)
    lines = data.split(b"\n")
    layout = [*kinds, np.log1p(len(data)) / 10, np.log1p(len(data) / len(lines)) / 10, np.log1p(max(map(len, lines))) / 10, len(set(lines)) / len(lines)]
    return np.concatenate((np.sqrt(counts / max(counts.sum(), 1)), layout)).astype(np.float16)


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META, dtype=np.float16)
    out[crc32(repr(source).encode()) % SOURCES] = 1
    out[SOURCES + crc32(repr(lang).encode()) % LANGUAGES] = 1
    out[SOURCES + LANGUAGES + (0 if n_chars is None else 1 + min(LENGTHS - 2, int(n_chars).bit_length() if n_chars > 0 else 0))] = 1
    return out


def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, source, lang, n_chars) to (doc_id, view): both views in one."""
    for batch in sliced(batches, 1):
        rows = zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
        made = [np.concatenate((text_view(t or ""), meta_view(source, lang, n))).tobytes() for t, source, lang, n in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "view"])


def viewed(docs: DataFrame) -> DataFrame:
    """doc_id and view of every row of ``docs`` (doc_id, text, source, lang, n_chars), stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    return store(rows.mapInArrow(frugal(views), "doc_id long, view binary"), "quality-views")


def unpacked(column: pa.Array) -> list[np.ndarray]:
    """The text and the metadata views of several rows."""
    both = np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, TEXT + META).astype(np.float32)
    return [both[:, :TEXT], both[:, TEXT:]]


class Logistic:
    def __init__(self, width: int) -> None:
        self.mean, self.scale, self.w, self.b = np.zeros(width), np.ones(width), np.zeros(width), 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        """Accelerated gradient descent on ridge-penalised log loss, columns scaled to unit variance."""
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        z = (x - self.mean) / self.scale
        z = np.column_stack((z, np.ones(len(z)))).astype(np.float32)
        rate = 4.0 / max((z * z).sum(axis=1).mean(), 1.0)
        w = v = np.zeros(z.shape[1], dtype=np.float32)
        ridge = np.append(np.full(z.shape[1] - 1, RIDGE), 0.0).astype(np.float32)
        for t in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
            new = v - rate * (z.T @ (p - y) / len(y) + ridge * v)
            w, v = new, new + (t / (t + 3)) * (new - w)
        self.w, self.b = w[:-1].astype(np.float64), float(w[-1])
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.w + self.b, -30, 30)


class CoTrained:
    """Two views' classifiers, their calibrations (slope, offset) and the prior log odds."""

    def __init__(self) -> None:
        self.models: list[Logistic] | None = None
        self.calibrated = [(1.0, 0.0), (1.0, 0.0)]
        self.prior = 0.0

    def fit(self, known: list[np.ndarray], y: np.ndarray, fold: np.ndarray, pool: list[np.ndarray]) -> CoTrained:
        train = fold != CALIBRATE
        if len(set(y[train].tolist())) < 2:
            return self
        share = float(y[train].mean())
        self.prior = float(np.log(share / (1 - share)))
        added: list[dict[int, int]] = [{}, {}]  # for each view, what the other taught it
        for r in range(ROUNDS + 1):
            self.models = []
            for v in (0, 1):
                rows, labels = list(added[v]), list(added[v].values())
                x = np.concatenate((known[v][train], pool[v][rows])) if rows else known[v][train]
                self.models.append(Logistic(x.shape[1]).fit(x, np.concatenate((y[train], labels)).astype(np.float32)))
            if r == ROUNDS or not len(pool[0]):
                break
            for v in (0, 1):
                odds = self.models[v].odds(pool[v])
                order = [int(i) for i in np.argsort(odds, kind="stable") if int(i) not in added[1 - v]]
                up = max(1, round(TAUGHT * share))
                down = max(1, TAUGHT - up)
                for i in order[-up:]:
                    if odds[i] > 0:
                        added[1 - v][i] = 1
                for i in order[:down]:
                    if odds[i] < 0:
                        added[1 - v][i] = 0
        self.calibrate(known, y, fold)
        return self

    def calibrate(self, known: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> None:
        """Platt's slope and offset of each view on the labels kept apart; none are fitted without both classes."""
        train = fold != CALIBRATE
        if len(set(y[~train].tolist())) == 2:
            for v in (0, 1):
                platt = Logistic(1).fit(self.models[v].odds(known[v][~train])[:, None], y[~train].astype(np.float32))
                slope = float(platt.w[0] / platt.scale[0])
                self.calibrated[v] = (max(slope, 0.0), platt.b - slope * float(platt.mean[0]))

    def odds(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated log odds of the text view, the metadata view and both."""
        if self.models is None:
            zero = np.zeros(len(text))
            return zero, zero, zero
        a, b = (s * m.odds(x) + o for m, x, (s, o) in zip(self.models, (text, meta), self.calibrated, strict=True))
        return a, b, a + b - self.prior


def fold_of(ids: list) -> np.ndarray:
    return np.array([crc32(str("" if i is None else i).encode()) % FOLDS for i in ids])


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Views of the rows in the training folds, some thousand at a time."""
    for batch in batches:
        for s in range(0, batch.num_rows, 2048):
            part = batch.slice(s, 2048)
            fold = fold_of(part.column(0).to_pylist())
            train = (fold != CALIBRATE) & (fold != HELD_OUT)
            yield [v[train] for v in unpacked(part.column(1))]


def histograms(model: CoTrained):
    """Rows (view, bin, n): how many documents of the training folds have which log odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), dtype=np.int64)
        for both in parts(batches):
            for v in (0, 1):
                counts[v] += np.bincount(bin_of(model.models[v].odds(both[v])), minlength=BINS)
        view, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(view.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(counts[view, place])], names=["view", "bin", "n"])

    return run


def bin_of(odds: np.ndarray) -> np.ndarray:
    return np.minimum(((odds + 30) * (BINS / 60)).astype(np.int64), BINS - 1)


def beyond(counts: np.ndarray, share: float, part: float) -> tuple[int, int]:
    """Of a histogram, the last bin that teaches the lower class and the first that teaches the upper one; only bins on the class's own side do."""
    wanted = part * counts.sum()
    low = int(np.searchsorted(np.cumsum(counts), wanted * (1 - share), side="right")) - 1
    high = BINS - int(np.searchsorted(np.cumsum(counts[::-1]), wanted * share, side="right"))
    return min(low, BINS // 2 - 1), max(high, BINS // 2)


def gradients(model: CoTrained, edges: list[tuple[int, int]]):
    """Rows (view, dim, value): sums of each view's gradient over what the other view teaches; their number at dim -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(m.w) + 1) for m in model.models]
        taught = [0, 0]
        for both in parts(batches):
            odds = [m.odds(x) for m, x in zip(model.models, both, strict=True)]
            for v in (0, 1):
                place, (low, high) = bin_of(odds[1 - v]), edges[1 - v]
                sure = (place <= low) | (place >= high)
                m = model.models[v]
                z = (both[v][sure] - m.mean) / m.scale
                off = 1 / (1 + np.exp(-odds[v][sure])) - (place[sure] >= high)
                sums[v] += np.append(z.T @ off, off.sum())
                taught[v] += int(sure.sum())
        for v in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sums[v]) + 1, v, np.int32)), pa.array(np.arange(-1, len(sums[v]), dtype=np.int32)), pa.array(np.append(float(taught[v]), sums[v]))], names=["view", "dim", "value"])

    return run


def exchange(model: CoTrained, rows: DataFrame, known: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> None:
    """Go on from ``model`` over all of ``rows`` (doc_id, view); ``known``, ``y`` and ``fold`` are the labelled documents."""
    train = fold != CALIBRATE
    share = float(y[train].mean())
    for _ in range(WHOLE_ROUNDS):
        counts = np.zeros((2, BINS), dtype=np.int64)
        for r in rows.mapInArrow(frugal(histograms(model)), "view int, bin int, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).collect():  # 2 * BINS rows at most
            counts[r["view"], r["bin"]] = r["n"]
        edges = [beyond(c, share, PART) for c in counts]
        for _ in range(WHOLE_STEPS):
            sums = [np.zeros(TEXT + 2), np.zeros(META + 2)]
            found = rows.mapInArrow(frugal(gradients(model, edges)), "view int, dim int, value double").groupBy("view", "dim").agg(F.sum("value").alias("value"))
            for r in found.collect():  # a row a weight
                sums[r["view"]][r["dim"] + 1] = r["value"]
            for v, m in enumerate(model.models):
                n, g = sums[v][0], sums[v][1:]
                z = (known[v][train] - m.mean) / m.scale
                off = 1 / (1 + np.exp(-m.odds(known[v][train]))) - y[train]
                # What is taught weighs as much as the labels, however large the table.
                whole = (np.append(z.T @ off, off.sum()) / len(z) + (g / n if n else 0.0)) / (2 if n else 1)
                rate = 4.0 / max(float((z * z).sum(axis=1).mean()) + 1, 1.0)
                m.w = m.w - rate * (whole[:-1] + RIDGE * m.w)
                m.b -= rate * float(whole[-1])
    model.calibrate(known, y, fold)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int | None = None, start: int | None = None) -> CoTrained:
    """docs (doc_id, text, source, lang, n_chars), labels (doc_id and 0 or 1 in ``label``)."""
    return train_on(viewed(docs), labels, label, labelled, start)


def train_on(rows: DataFrame, labels: DataFrame, label: str = "quality", labelled: int | None = None, start: int | None = None) -> CoTrained:
    """``train`` on stored views. ``labelled`` and ``start`` bound the start (LABELLED and UNLABELLED)."""
    labelled, start = LABELLED if labelled is None else labelled, UNLABELLED if start is None else start
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS
    sample = store(marked.filter(fold != HELD_OUT).orderBy(F.xxhash64("id"), "label").limit(labelled), "quality-labels")
    others = rows.select(F.col("doc_id").alias("id")).filter("id IS NOT NULL").join(marked.select("id"), "id", "left_anti")
    pool = store(others.distinct().orderBy(F.xxhash64(F.col("id"), F.lit(7)), "id").limit(start).select("id", F.lit(-1).alias("label")), "quality-pool")
    chosen = F.broadcast(sample.union(pool))  # labelled + start short rows at most
    # Copies of one id and view come once, with their number, so a repeated id costs one row.
    picked = rows.join(chosen, F.col("doc_id") == F.col("id")).groupBy("doc_id", "label", "view").agg(F.count(F.lit(1)).alias("n"))
    seen = picked.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending"), ("view", "ascending")])
    times = np.minimum(seen.column("n").to_numpy(), REPEATS) if seen.num_rows else np.zeros(0, np.int64)
    at = np.repeat(np.arange(seen.num_rows), times)
    y = np.array(seen.column("label").to_pylist(), dtype=np.int64)[at]
    x = [v[at] for v in unpacked(seen.column("view"))]
    known, folds = y >= 0, fold_of(seen.column("doc_id").to_pylist())[at]
    model = CoTrained().fit([v[known] for v in x], y[known], folds[known], [v[~known] for v in x])
    if model.models is not None:
        exchange(model, rows, [v[known] for v in x], y[known], folds[known])
    return model


def scores(rows: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, text_score, meta_score and score (probabilities of good quality) of stored views."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                odds = model.odds(*unpacked(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(1 / (1 + np.exp(-np.clip(o, -30, 30)))) for o in odds)], names=["doc_id", "text_score", "meta_score", "score"])

    return rows.mapInArrow(frugal(run), "doc_id long, text_score double, meta_score double, score double")


def quality_scores(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``scores`` of every row of ``docs``."""
    return scores(viewed(docs), model)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = viewed(docs)
    scored = scores(rows, train_on(rows, table(spark, sf_dir, "labels")))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).cast("int").alias("quality"))


by_value(__name__)
