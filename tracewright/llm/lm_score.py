"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(class | history) * P(part | class, history) * P(cell | part, history)
* P(token | cell). The first factor is a softmax whose logits add a class bias and the weights
of three hashed features: the previous word, the classes of the last two tokens, and, skipping
one, the classes of the two before. The next two split the words of a class into ``PARTS`` parts,
and a part into as many cells, by bits of their hash; their softmaxes have the first two features,
each together with the class or part. All three are trained by distributed gradient updates: a round gives each task the current weights, the
task runs AdaGrad over the training documents of the round's fold, and the tasks' changes,
weighted by their tokens, are averaged by blocks of rows. The last factor, among the words of
one of some 24,000 cells, needs no training: (c + 1) / (N_cell + V_cell + 1), so that each cell
keeps one share for words it never saw. All factors are proper distributions, and so is their product.

The most frequent words, and the end of a text, are classes of their own. Other words'
classes follow from their last two bytes, so no table of the vocabulary is needed.

Counts are exact and cover every training document. The ``HEAD`` most frequent words are
sent to all tasks; what occurs besides is rare by definition, and its counts are joined by
word. Words are known by a 64-bit hash and 32 bits of length, first and last bytes.

Null text counts as empty: one end token. Repeated rows count as often as they occur. An
empty table gives no rows, and without training documents all counts are 0. Rows without
an id are trained on. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm._shared import by_value, store, table

CLASSES, OWN = 32, 7
END, START = 0, CLASSES
FEATURE_ROWS = 1 << 14
FEATURES = 3
#: Parts of a class and cells of a part, features that choose among them, and rows of their weights, which follow the first FEATURE_ROWS.
PARTS, DEEP_FEATURES, DEEP_BITS = 32, 2, 15
ALL_ROWS = FEATURE_ROWS + (1 << DEEP_BITS)
#: Lowest bits of a hash that name the part and the cell. Weight of a cell without words beside one with words, before training.
PART_BIT, CELL_BIT, EMPTY = 5, 10, 1 / 32
HEAD = 1 << 18
ROUNDS = 2
#: Step of AdaGrad for classes, and for parts and cells, of which each text shows less.
RATE, DEEP_RATE = 0.25, 0.1
#: Tokens of one gradient step, bytes tokenised at once, tokens counted at once, rows of weights averaged together.
STEP, PIECE, COUNTED, ROWS = 8192, 1 << 20, 1 << 22, 512
SCORED_AT_ONCE = 2048
#: Upper bits of a hash by which head words are found.
BUCKET_BITS = 20
FOLDS, HELD_OUT = 7, 2

MULTIPLIER = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finishing steps of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: The class of each pair of last bytes.
SUFFIX_CLASS = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(CLASSES - OWN - 1)).astype(np.int64) + OWN + 1


class Powers:
    """Powers of MULTIPLIER and of its inverse, modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, PIECE)
            self.up, self.down = self.powers(MULTIPLIER, n), self.powers(pow(MULTIPLIER, -1, 1 << 64), n)

    @staticmethod
    def powers(of: int, n: int) -> np.ndarray:
        out = np.full(n, of, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in order, cut at white space every PIECE bytes or later."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def tokens(texts: list[bytes | None], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, check bits and class by suffix of each word of several texts, and each text's number of words."""
    data = b"\n".join(x or b"" for x in texts)
    hashes, checks, suffixes, places, at = [], [], [], [], 0
    for piece in pieces(data):
        a = np.frombuffer(piece.lower(), dtype=np.uint8)
        inside = np.zeros(len(a) + 2, dtype=bool)
        np.logical_not(SPACE[a], out=inside[1:-1])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = turns[::2], turns[1::2]
        powers.upto(len(a) + 1)
        sums = np.zeros(len(a) + 1, dtype=np.uint64)
        np.cumsum((a + np.uint64(1)) * powers.up[: len(a)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * powers.down[starts]))
        length = ends - starts
        last = a[ends - 1].astype(np.uint32)
        before = np.where(length > 1, a[np.maximum(ends - 2, 0)], 0).astype(np.uint32)
        suffix = before << np.uint32(8) | last
        checks.append((length.astype(np.uint32) & np.uint32(255)) << np.uint32(24) | a[starts].astype(np.uint32) << np.uint32(16) | suffix)
        suffixes.append(SUFFIX_CLASS[suffix])
        places.append(starts + at)
        at += len(a)
    join = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
    begin = np.cumsum([0] + [len(x or b"") + 1 for x in texts])
    words = np.diff(np.searchsorted(join(places, np.int64), begin))
    return join(hashes, np.uint64), join(checks, np.uint32), join(suffixes, np.int64), words


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, check, class, n), a row for each word of some millions of tokens."""
    powers, held, size = Powers(), [], 0

    def flush() -> pa.RecordBatch:
        h, check, kind = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(h, kind="stable")
        h, check, kind = h[order], check[order], kind[order]
        # Words of one hash but other check bits are too rare to be worth a second sort; they make rows of their own.
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1]))))
        n = np.diff(np.append(first, len(h)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(check[first].astype(np.int64)), pa.array(kind[first].astype(np.int32)), pa.array(n)], names=["h", "check", "kind", "n"])

    for batch in batches:
        for s, e in grouped(batch, 0):
            found = tokens(raw(batch.column(0).slice(s, e - s)), powers)
            if len(found[0]):
                held.append(found[:3])
                size += len(found[0])
            if size >= COUNTED:
                yield flush()
                size = 0
    if held:
        yield flush()


class Model:
    """Weights, class tables and the counts of the head words; of fixed size."""

    def __init__(self, head_hash: np.ndarray, head_check: np.ndarray, head_count: np.ndarray, class_tokens: np.ndarray, class_words: np.ndarray, end_count: int, cell_tokens: np.ndarray | None = None, cell_words: np.ndarray | None = None) -> None:
        # head_* come in falling order of count: the first OWN are classes of their own.
        own = np.arange(len(head_hash)) < OWN
        order = np.argsort(head_hash, kind="stable")
        self.hash, self.check, self.count = head_hash[order], head_check[order], head_count[order]
        self.own = np.where(own, np.arange(len(head_hash)) + 1, 0)[order]
        # Where each value of the upper bits begins, and how many steps the longest run takes.
        self.begin = np.searchsorted(self.hash, np.arange((1 << BUCKET_BITS) + 1, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS))
        self.begin[-1] = len(self.hash)
        self.longest = int(np.diff(self.begin).max())
        self.total = class_tokens + class_words + 1.0
        prior = np.concatenate(([end_count], class_tokens[1:])) + 1.0
        self.bias = np.log(prior / prior.sum()).astype(np.float32)
        self.end_count = end_count
        self.per_token = 0.0
        self.weights = np.zeros((ALL_ROWS, CLASSES), dtype=np.float32)
        none = np.zeros(CLASSES * PARTS * PARTS)
        cell_tokens, cell_words = none if cell_tokens is None else cell_tokens, none if cell_words is None else cell_words
        self.cell_total = cell_tokens + cell_words + 1.0
        share = np.where(cell_words > 0, self.cell_total, EMPTY).reshape(CLASSES * PARTS, PARTS)
        parts = share.sum(axis=1).reshape(CLASSES, PARTS)
        #: The bias of each part given its class, and of each cell given its part.
        self.deep_bias = tuple(np.log(x / x.sum(axis=1, keepdims=True)).astype(np.float32) for x in (parts, share))

    def find(self, h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the head words, and whether it is one."""
        bucket = h >> np.uint64(64 - BUCKET_BITS)
        at, end = self.begin[bucket], self.begin[bucket + np.uint64(1)]
        known = np.zeros(len(h), dtype=bool)
        left = np.flatnonzero(at < end)
        for _ in range(self.longest):
            place = at[left]
            hit = (self.hash[place] == h[left]) & (self.check[place] == check[left])
            known[left[hit]] = True
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return at, known

    def sequence(self, h: np.ndarray, kind: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of several texts, each with three starts before and an end after it: classes and feature rows of all tokens, each text's first token, and the hashes of the first features."""
        scored = words + 1
        first = np.cumsum(scored) - scored
        text = np.repeat(np.arange(len(words)), words)
        place = np.arange(len(h)) + text + 3 * (text + 1)
        kinds = np.full(scored.sum() + 3 * len(words), START, dtype=np.uint64)
        hashes = np.zeros(len(kinds), dtype=np.uint64)
        kinds[place], hashes[place] = kind, h
        kinds[np.cumsum(scored) + 3 * np.arange(1, len(words) + 1) - 1] = END
        at = np.arange(scored.sum()) + 3 * np.repeat(np.arange(1, len(words) + 1), scored)
        one, two, three = kinds[at - 1], kinds[at - 2], kinds[at - 3]
        rows, keys = np.empty((FEATURES, len(at)), dtype=np.int64), np.empty((DEEP_FEATURES, len(at)), dtype=np.uint64)
        for i, x in enumerate((hashes[at - 1], one << np.uint64(8) | two | np.uint64(1 << 20), two << np.uint64(8) | three | np.uint64(2 << 20))):
            x = mix(x)
            rows[i] = (x % np.uint64(FEATURE_ROWS)).astype(np.int64)
            if i < DEEP_FEATURES:
                keys[i] = x
        return kinds[at].astype(np.int64), rows, first, keys

    def deeper(self, h: np.ndarray, kind: np.ndarray, words: np.ndarray, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For parts, then cells: places of the words that are no class of their own, what each takes, feature rows, the biases, and which of them holds."""
        which = np.flatnonzero(kind > OWN)
        at, path, h = which + np.repeat(np.arange(len(words)), words)[which], kind[which], h[which]
        for level, (bit, bias) in enumerate(zip((PART_BIT, CELL_BIT), self.deep_bias, strict=True)):
            taken = (h >> np.uint64(bit) & np.uint64(PARTS - 1)).astype(np.int64)
            salt = mix((path + (level + 1 << 20)).astype(np.uint64))
            rows = (FEATURE_ROWS + ((keys[:, at] ^ salt) * np.uint64(MULTIPLIER) >> np.uint64(64 - DEEP_BITS))).astype(np.int64)
            yield which, taken, rows, bias, path
            path = path * PARTS + taken

    def cells(self, h: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return (kind * PARTS + (h >> np.uint64(PART_BIT) & np.uint64(PARTS - 1)).astype(np.int64)) * PARTS + (h >> np.uint64(CELL_BIT) & np.uint64(PARTS - 1)).astype(np.int64)

    def odds(self, rows: np.ndarray, bias: np.ndarray | None = None) -> np.ndarray:
        """exp(logits), with the classes' bias or one for each token; logits are kept under 80, which 32 bits can hold."""
        out = np.take(self.weights, rows[0], axis=0)
        for r in rows[1:]:
            out += np.take(self.weights, r, axis=0)
        out += self.bias if bias is None else bias
        np.minimum(out, np.float32(80), out=out)
        return np.exp(out, out=out)

    def class_logs(self, kinds: np.ndarray, rows: np.ndarray, bias: np.ndarray | None = None, path: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithm of P(class | history) of each token, or of what it takes next, given ``path``."""
        out, ones = np.empty(len(kinds)), np.ones(CLASSES, dtype=np.float32)
        for s in range(0, len(kinds), SCORED_AT_ONCE):
            odds = self.odds(rows[:, s : s + SCORED_AT_ONCE], None if bias is None else bias[path[s : s + SCORED_AT_ONCE]])
            k = kinds[s : s + SCORED_AT_ONCE]
            out[s : s + SCORED_AT_ONCE] = np.log(odds[np.arange(len(k)), k]) - np.log(odds @ ones)
        return out

    def learn(self, kinds: np.ndarray, rows: np.ndarray, power: np.ndarray, bias: np.ndarray | None = None, path: np.ndarray | None = None) -> None:
        """AdaGrad steps; ``power`` holds the sums of squared gradients."""
        ones, rate = np.ones(CLASSES, dtype=np.float32), RATE if bias is None else DEEP_RATE
        for s in range(0, len(kinds), STEP):
            part, k = rows[:, s : s + STEP], kinds[s : s + STEP]
            g = self.odds(part, None if bias is None else bias[path[s : s + STEP]])
            g /= (g @ ones)[:, None]
            g[np.arange(len(k)), k] -= 1
            for r in part:
                order = np.argsort(r.astype(np.uint16), kind="stable")
                r = r[order]
                first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                step = np.add.reduceat(np.take(g, order, axis=0), first, axis=0)
                where = r[first]
                squares = np.take(power, where, axis=0) + step * step
                power[where] = squares
                self.weights[where] -= np.float32(rate) * step / np.sqrt(squares + 1e-6)


def grouped(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows with about PIECE bytes of text."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        size += n or 0
        if size >= PIECE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield start, batch.num_rows


def raw(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def read_texts(column: pa.Array, model: Model, powers: Powers) -> tuple[np.ndarray, ...]:
    """Hash, check, class, place among the head words and whether it is one, of each word; words of each text."""
    h, check, kind, words = tokens(raw(column), powers)
    at, known = model.find(h, check)
    own = np.zeros(len(h), dtype=np.int64)
    own[known] = model.own[at[known]]
    return h, check, np.where(own > 0, own, kind), at, known, words


def gradient_round(model: Model):
    """Texts to (block, change, tokens): the change of each block of weights times the task's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, before, power, n = Powers(), model.weights, None, 0
        model.weights = before.copy()
        for batch in batches:
            for s, e in grouped(batch, 0):
                h, _, kind, _, _, words = read_texts(batch.column(0).slice(s, e - s), model, powers)
                kinds, rows, _, keys = model.sequence(h, kind, words)
                power = np.zeros_like(before) if power is None else power
                model.learn(kinds, rows, power)
                for _, taken, rows, bias, path in model.deeper(h, kind, words, keys):
                    model.learn(taken, rows, power, bias, path)
                n += len(kinds)
        if n:
            change = (model.weights - before) * np.float32(n)
            blocks = range(0, ALL_ROWS, ROWS)
            yield pa.RecordBatch.from_arrays([pa.array([b // ROWS for b in blocks], pa.int32()), pa.array([change[b : b + ROWS].tobytes() for b in blocks], pa.binary()), pa.array([n] * len(blocks), pa.int64())], names=["block", "change", "n"])
        model.weights = before

    return run


def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, change, n) to one row a block; the sums stand in memory, however many rows come."""
    sums: dict[int, np.ndarray] = {}
    n: dict[int, int] = {}
    for batch in batches:
        for block, change, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            value = np.frombuffer(change, np.float32)
            sums[block] = sums[block] + value if block in sums else value.astype(np.float64)
            n[block] = n.get(block, 0) + k
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(v / n[b]).astype(np.float32).tobytes() for b, v in sums.items()], pa.binary()), pa.array([n[b] for b in sums], pa.int64())], names=["block", "change", "n"])


def train(docs: DataFrame, model: Model, rounds: int = ROUNDS) -> None:
    """docs (text, fold): one epoch, a fold of the documents a round."""
    kind = "block int, change binary, n long"
    for r in range(rounds):
        changes = docs.filter(F.col("fold") % rounds == r).select("text").mapInArrow(gradient_round(model), kind)
        for row in changes.repartition(FEATURE_ROWS // ROWS, "block").mapInArrow(average, kind).collect():  # the size of the weights
            model.weights[row["block"] * ROWS : (row["block"] + 1) * ROWS] += np.frombuffer(row["change"], np.float32).reshape(ROWS, CLASSES)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, h array<long>, check array<long>"


def score_texts(model: Model):
    """Per row: sums over the words in the head, and the other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        logs = np.log10(model.count + 1.0)
        per_cell = np.log10(model.cell_total)
        end = math.log10(model.end_count + 1.0)
        for batch in batches:
            for s, e in grouped(batch, 3):
                part = batch.slice(s, e - s)
                h, check, kind, at, known, words = read_texts(part.column(3), model, powers)
                kinds, rows, first, keys = model.sequence(h, kind, words)
                text = np.repeat(np.arange(len(words)), words)
                per_text = lambda x, t=text, n=len(words): np.bincount(t, weights=x, minlength=n)
                in_head = np.zeros(len(h))
                in_head[known] = logs[at[known]]
                base = per_text(in_head - model.per_token) + end - model.per_token  # term by term, as the terms of a long text may be tiny
                shared = per_text(np.where(kind > OWN, in_head - per_cell[model.cells(h, kind)], 0.0))
                for which, taken, deep, bias, path in model.deeper(h, kind, words, keys):
                    shared = shared + np.bincount(text[which], weights=model.class_logs(taken, deep, bias, path), minlength=len(words)) / math.log(10)
                known_words = per_text(known.astype(np.float64)).astype(np.int64) + (model.end_count > 0)
                rare = np.flatnonzero(~known)
                offsets = np.concatenate(([0], np.cumsum(words - known_words + (model.end_count > 0)))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (h[rare].view(np.int64), check[rare].astype(np.int64))]
                class_sum = np.add.reduceat(model.class_logs(kinds, rows), first) / math.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *map(pa.array, (words + 1, known_words, base, class_sum + shared)), *lists], names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "h", "check"])

    return run


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def score(docs: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (doc_id, text)."""
    fold = fold_of(F.col("doc_id"), FOLDS)
    training = docs.filter(fold != HELD_OUT).select("text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).alias("fold"))
    words = training.select("text").mapInArrow(count_words, "h long, check long, kind int, n long")
    words = store(words.groupBy("h", "check", "kind").agg(F.sum("n").alias("n")), "lm-words")
    ends = training.count()
    top = words.orderBy(F.col("n").desc(), "h", "check").limit(head).select("h", "check", "n").toArrow()
    h, check, n = (top.column(c).to_numpy() for c in ("h", "check", "n"))
    cell = (F.col("kind") * PARTS + F.shiftrightunsigned("h", PART_BIT).bitwiseAND(F.lit(PARTS - 1))) * PARTS + F.shiftrightunsigned("h", CELL_BIT).bitwiseAND(F.lit(PARTS - 1))
    cell_tokens, cell_words = np.zeros(CLASSES * PARTS * PARTS), np.zeros(CLASSES * PARTS * PARTS)
    cells = words.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()  # CLASSES * PARTS * PARTS rows at most
    places = cells.column("cell").to_numpy()
    cell_tokens[places], cell_words[places] = cells.column("n").to_numpy(), cells.column("v").to_numpy()
    tokens_in, words_in = (x.reshape(CLASSES, -1).sum(axis=1) for x in (cell_tokens, cell_words))
    distinct, total = int(words_in.sum()) + (ends > 0), int(tokens_in.sum()) + ends
    for row in words.orderBy(F.col("n").desc(), "h", "check").limit(OWN).withColumn("cell", cell).collect():  # these leave their classes
        tokens_in[row["kind"]] -= row["n"]
        words_in[row["kind"]] -= 1
        cell_tokens[row["cell"]] -= row["n"]
        cell_words[row["cell"]] -= 1
    tokens_in[1 : 1 + min(OWN, len(n))] = n[:OWN]
    model = Model(h.view(np.uint64), check.astype(np.uint32), n, tokens_in, words_in, ends, cell_tokens, cell_words)
    model.per_token = math.log10(total + distinct + 1)  # N + 1 * (V + 1)
    train(training, model, rounds)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (fold == HELD_OUT).alias("held_out"), "text")
    scored = store(rows.mapInArrow(score_texts(model), SCORED), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("h", "check")).alias("word")).select("row", "word.*")
    rest = rare.join(words.select("h", "check", "n"), ["h", "check"]).groupBy("row").agg(F.count(F.lit(1)).alias("rare"), F.sum(F.log10(F.col("n") + 1)).alias("logs"))
    rare_logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + rare_logs).alias("base_score"),
        (F.col("model") + rare_logs).alias("score"),
    )


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


by_value(__name__)
