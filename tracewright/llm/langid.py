"""Language identification by multilingual mixture inference.

Training counts hashed byte trigrams per language over every training document. A document
is then seen as a mixture: each of its trigrams comes from one of the languages, in
proportions that expectation-maximisation estimates from the trigrams' likelihoods. The
language set is chosen by penalised likelihood: languages enter in the order of their
proportions as long as each adds more log likelihood than the penalty for one more
proportion. The largest proportion within the set names the document's language.

The model is a table of ``BUCKETS`` counts a language, summed by shuffle and sent to all
tasks: its size depends on the number of languages only, not on the corpus.

Null texts and texts without a letter are ``und`` with score 0, as all are if nothing was
learned. Texts are read as a whole. Rows without an id count as training documents. Repeated
rows give equal rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm._shared import by_value, frugal, sliced, table

BUCKETS = 1 << 15
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
SMOOTHING = 0.5
ROUNDS, CLOSE = 30, 1e-4
#: Log likelihood that a further language must add, in units of log(trigrams) / 2. Trigrams
#: overlap and words repeat, so they carry less than independent draws would.
PENALTY = 12.0
#: Trigrams of a text hashed at once.
BLOCK = 1 << 22

_KEPT = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text: letters in lower case, all else one space."""
    a = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_KEPT) + b" ", dtype=np.uint8)
    space = a == 32
    a = a[np.concatenate(([True], ~(space[1:] & space[:-1])))]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for s in range(0, len(a) - 2, BLOCK):
        b = a[s : s + BLOCK + 2].astype(np.uint32)
        h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
        counts += np.bincount(h >> np.uint32(32 - 15), minlength=BUCKETS)
    return counts


def count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in sliced(batches, 0):
        for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = trigrams(text)
            if lang in sums:
                sums[lang] += counts
            else:
                sums[lang] = counts
    for lang, counts in sums.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["lang", "bucket", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """docs (text, lang): languages, and the log probability of each bucket under each (BUCKETS, languages)."""
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    sums = known.mapInArrow(frugal(count_languages), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(sums.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    if names:
        place = {name: i for i, name in enumerate(names)}
        counts[sums.column("bucket").to_numpy(), [place[x] for x in sums.column("lang").to_pylist()]] = sums.column("n").to_numpy()
    return names, np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))


def proportions(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Of the mixture that expectation-maximisation finds, from equal shares: proportions and log likelihood."""
    n = counts.sum()
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    for _ in range(ROUNDS):
        mixed = likelihood @ share
        new = share * ((counts / mixed) @ likelihood) / n
        moved = np.abs(new - share).max()
        share = new
        if moved < CLOSE:
            break
    return share, float(counts @ np.log(likelihood @ share))


def languages(text: str | None, log_p: np.ndarray, penalty: float = PENALTY) -> list[tuple[int, float]]:
    """(language, proportion) of the chosen set, the largest first; empty if the text has no letter."""
    if text is None or not log_p.shape[1] or not any(map(str.isalpha, text)):
        return []
    counts = trigrams(text)
    used = np.flatnonzero(counts)
    counts, logs = counts[used].astype(np.float64), log_p[used]
    top = logs.max(axis=1)
    likelihood, base = np.exp(logs - top[:, None]), float(counts @ top)
    share, _ = proportions(likelihood, counts)
    order = np.argsort(-share, kind="stable")
    cost = penalty * np.log(max(counts.sum(), 2.0)) / 2
    single = counts @ (logs[:, order[:1]] - top[:, None])
    chosen, best = [(int(order[0]), 1.0)], base + float(single[0])
    for size in range(2, len(order) + 1):
        among = order[:size]
        part, value = proportions(likelihood[:, among], counts)
        if base + value - (size - 1) * cost <= best - (len(chosen) - 1) * cost:
            break
        chosen, best = sorted(((int(i), float(p)) for i, p in zip(among, part, strict=True)), key=lambda x: -x[1]), base + value
    return [(i, p if len(chosen) > 1 else float(share[i])) for i, p in chosen]


def identify(docs: DataFrame, names: list[str], log_p: np.ndarray, keep: list[str], penalty: float = PENALTY) -> DataFrame:
    """``keep`` of every row of ``docs`` (text) with lang_pred, score and mixture (language to proportion)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0):
            found = [languages(t, log_p, penalty) for t in batch.column(0).to_pylist()]
            predicted = [names[f[0][0]] if f else UNKNOWN for f in found]
            score = [min(1.0, f[0][1]) if f else 0.0 for f in found]
            mixture = [[(names[i], p) for i, p in f] for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(predicted, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, pa.map_(pa.string(), pa.float64()))], names=[*batch.schema.names[1:], "lang_pred", "score", "mixture"])

    rows = docs.select(F.col("text").alias("_text"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(frugal(run), f"{kinds}, lang_pred string, score double, mixture map<string,double>")


def fold(docs: DataFrame) -> DataFrame:
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    return docs.withColumn("_held", number == HELD_OUT)


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and mixture of every row of ``docs`` (doc_id, text, lang)."""
    rows = fold(docs.select("doc_id", "text", "lang"))
    names, log_p = learn(rows.filter("NOT _held"))
    return identify(rows.select("text", "doc_id", F.col("_held").alias("held_out")), names, log_p, ["doc_id", "held_out"])


def recognised(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found: a learned one that at least ``least`` of the text is in."""
    names, log_p = learn(docs.select("text", "lang"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at):
            best = [languages(t, log_p)[:1] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([bool(b) and b[0][1] >= least for b in best]))

    return docs.mapInArrow(frugal(run), docs.schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", F.array_join(F.array_sort(F.map_keys("mixture")), ",").alias("lang_set"))


by_value(__name__)
