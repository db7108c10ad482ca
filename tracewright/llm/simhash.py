"""SimHash near-duplicates: fingerprints compared in bit slices.

A text's fingerprint has bit b set if over half of its shingles' XXH64 hashes (seed 42)
have it. Equal fingerprints are joined first, so only distinct ones are compared.

Candidates: the 64 bits are cut into radius + 3 blocks; two fingerprints that differ in at
most ``radius`` bits agree in at least three whole blocks, so each fingerprint is listed
under every choice of three blocks, and only lists of equal keys are compared.

Comparison: the lists of a task are packed 64 fingerprints to a word, one word per bit
plane. A query bit is spread over a word and XORed with its plane; carry-save counters, a
few words wide, add the difference to 64 distances at once. Words in which every distance
has passed the radius are abandoned, and a query ends once none is left. Of a list's links
a spanning forest is kept, which joins the same components.

Long lists: keys are dealt by range, so a list is shared by tasks if it is large. A list
that ends a task's range, or holds more than ``LIST`` fingerprints, is not compared pair
by pair: its members go to an exact route whose work is linear. For radius 2, each gives
itself and its 64 neighbours at distance 1; two fingerprints differ in at most two bits
exactly if they share one of those, and no such point has more than 65 members. For radius
r the points are all within distance ceil(r / 2) (r even: exact alone; r odd: links at
distance r are found because one side gives one step more).

Null and empty texts have fingerprint 0, linked like any other. Texts are read as a whole.
Rows without an id share in the comparison; a component of such rows alone has a null
component_id. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm._shared import by_value, frugal, sliced, store, table
from tracewright.llm.graph import components

SEED = 42
WIDTH = 3
RADIUS = 2
#: Shingles hashed at once, and fingerprints of one list that are compared in one task.
BLOCK = 1 << 16
LIST = 1024
#: Words of 64 fingerprints compared at once.
WORDS = 2048
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes | None, width: int) -> Iterator[np.ndarray]:
    """Hashes of the whole text's shingles, in order, a block at a time. Words end at ASCII white space; A-Z is lower-cased."""
    words = (text or b"").lower().split()
    if words and len(words) < width:
        words = [b" ".join(words)]
        width = 1
    for at in range(0, len(words) - width + 1, BLOCK):
        part = words[at : at + BLOCK + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False)) if width > 1 else part
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=len(part) - width + 1)


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """As a signed 64-bit number."""
    votes, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, width):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0]) if n else 0


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            values = [fingerprint(x, width) for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(run), "doc_id long, fp long")


class BitSlices:
    """Lists of fingerprints, each in words of its own, as 64 bit planes."""

    def __init__(self, fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        words = -(-sizes // 64)
        self.list_of = np.repeat(np.arange(len(sizes)), words)
        self.nth = np.arange(len(self.list_of)) - np.repeat(np.cumsum(words) - words, words)
        self.fps, self.starts, self.sizes = fps, starts, sizes
        lanes = self.nth[:, None] * 64 + np.arange(64)
        inside = lanes < sizes[self.list_of][:, None]
        place = np.where(inside, starts[self.list_of][:, None] + lanes, 0)
        self.valid = np.ascontiguousarray(np.packbits(inside, axis=1, bitorder="little")).view(np.uint64)[:, 0]
        bits = np.unpackbits(np.ascontiguousarray(fps[place]).view(np.uint8).reshape(len(lanes), 64, 8), axis=2, bitorder="little")
        self.planes = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64)[:, :, 0]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of all pairs of one list that differ in at most ``radius`` bits, query by query."""
        depth = (radius + 1).bit_length()
        for k in range(int(self.sizes.max(initial=0)) - 1):
            # Lanes after the query's own.
            later = np.where(self.nth * 64 > k, ALL, np.where(self.nth == k // 64, (ALL << np.uint64(k % 64)) << np.uint64(1), np.uint64(0)))
            alive = np.where(self.sizes[self.list_of] > k + 1, self.valid & later, np.uint64(0))
            at = np.flatnonzero(alive)
            alive, query = alive[at], self.fps[np.minimum(self.starts[self.list_of[at]] + k, len(self.fps) - 1)]
            counter = [np.zeros(len(at), dtype=np.uint64) for _ in range(depth)]
            over = np.zeros(len(at), dtype=np.uint64)
            for bit in range(64):
                carry = self.planes[bit, at] ^ (np.uint64(0) - ((query >> np.uint64(bit)) & np.uint64(1)))
                for c in counter:
                    carry, c[:] = c & carry, c ^ carry
                over |= carry
                if bit % 8 == 7:
                    beyond, equal = over.copy(), np.full(len(at), ALL)
                    for i in reversed(range(depth)):
                        if radius >> i & 1:
                            equal &= counter[i]
                        else:
                            beyond |= equal & counter[i]
                            equal &= ~counter[i]
                    alive &= ~beyond
                    if not (left := alive != 0).all():
                        at, alive, query, over = at[left], alive[left], query[left], over[left]
                        counter = [c[left] for c in counter]
                    if not len(at):
                        break
            if len(at):
                word, lane = np.nonzero(np.unpackbits(np.ascontiguousarray(alive).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                of = self.list_of[at[word]]
                yield self.starts[of] + k, self.starts[of] + self.nth[at[word]] * 64 + lane


def forest(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs of places that join what links join, without cycles."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for a, b in BitSlices(fps, starts, sizes).links(radius):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if (p := root(x)) != (q := root(y)):
                parent[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def compare_lists(radius: int, most: int = LIST):
    """Of rows (key, fp) in the order of key: rows (a, b) for links, (fp, null) for members of the lists left to the other route."""

    def emit(a: list[int] | np.ndarray, b: list[int] | np.ndarray | None) -> pa.RecordBatch:
        second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), second], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        edge = None  # the key of a list that other tasks may share, or that is too long
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            fps = np.concatenate((fps, batch.column(1).to_numpy()))
            if not len(keys):
                continue
            edge = keys[0] if edge is None else edge
            n = int(np.searchsorted(keys, edge, side="right")) if keys[0] == edge else 0
            if n:
                yield emit(fps[:n], None)
                keys, fps = keys[n:], fps[n:]
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(np.append(starts, len(keys)))
            last = int(starts[-1])
            for s, n in zip(starts[:-1][sizes[:-1] > most].tolist(), sizes[:-1][sizes[:-1] > most].tolist(), strict=True):
                yield emit(fps[s : s + n], None)
            compared = (sizes > 1) & (sizes <= most)
            compared[-1] = False
            s, n = starts[compared], sizes[compared]
            order = np.argsort(n, kind="stable")
            s, n = s[order], n[order]
            groups = np.cumsum(-(-n // 64)) // WORDS
            for g in np.unique(groups):
                pairs = forest(fps.view(np.uint64), s[groups == g], n[groups == g], radius)
                if pairs:
                    a, b = np.array(pairs).T
                    yield emit(fps[a], fps[b])
            keys, fps = keys[last:], fps[last:]
            if len(keys) > most:
                edge = keys[0]
                yield emit(fps, None)
                keys, fps = keys[:0], fps[:0]
        if len(fps):
            yield emit(fps, None)

    return run


def list_keys(fp: Column, radius: int) -> Column:
    """Array of keys: the number of a choice of three blocks over those blocks' bits."""
    blocks = radius + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    out = []
    for number, chosen in enumerate(combinations(range(blocks), 3)):
        key = F.lit(number).cast("long")
        for i in chosen:
            width = edges[i + 1] - edges[i]
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << width) - 1)))
        out.append(key)
    return F.array(*out)


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """nodes (fp, distinct): edges (a, b) that join the components of all links of at most ``radius`` bits (2 at most)."""
    if not 0 <= radius <= 2:
        raise ValueError("the exact route for long lists covers a radius of 0, 1 or 2")
    listed = nodes.select(F.explode(list_keys(F.col("fp"), radius)).alias("key"), "fp")
    dealt = listed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp")
    found = store(dealt.mapInArrow(frugal(compare_lists(radius)), "a long, b long"), "simhash-links")
    rest = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    # Points within one bit; for radius 1 a member must be the point itself, which linking by the member's own value ensures.
    one_bit = [F.col("fp").bitwiseXOR(F.lit((1 << b) - (1 << 64) * (b == 63))) for b in range(64)]
    points = rest.select("fp", F.explode(F.array(F.col("fp"), *one_bit[: 64 if radius else 0])).alias("point"))
    met = points.groupBy("point").agg(F.collect_set("fp").alias("members"))  # 65 at most
    if radius == 1:
        met = met.filter(F.array_contains("members", F.col("point")))
        far = met.select(F.explode("members").alias("a"), F.col("point").alias("b"))
    else:
        far = met.filter(F.size("members") > 1).select(F.explode("members").alias("a"), F.array_min("members").alias("b"))
    return found.filter("b IS NOT NULL").union(far.filter("a <> b"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links reach, for every row of ``docs`` (doc_id, text)."""
    rows = store(fingerprints(docs, width), "simhash-docs")
    nodes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius))
    placed = store(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = placed.join(least, "root").select(F.col("fp").alias("named_fp"), "component_id")
    return rows.join(named, F.col("fp") == F.col("named_fp")).select("doc_id", "fp", "component_id")


#: MinHash bands of ``similar``, and hashes in each: of pairs that share 0.8 of their shingles, all but 2 in 10,000 meet in a band.
BANDS, PER_BAND = 16, 4
SIMILAR_WIDTH, SIMILARITY = 5, 0.8
#: Members of a list that are compared with as many others at once, and shingles that they have together.
SIDE, SHINGLES = 1024, 1 << 20
#: Words of the bits that tell which texts are wanted, and of them in one row, as powers of two: 2**10 rows of 8 kB are broadcast at most.
WORD_BITS, PACK_BITS = 20, 10


def least_equal(similarity: float) -> int:
    """MinHashes of a sketch that texts of ``similarity`` share, less 4.75 standard deviations: one pair in a million has fewer."""
    n = BANDS * PER_BAND
    return max(0, int(n * similarity - 4.75 * (n * similarity * (1 - similarity)) ** 0.5))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Of every row doc_id, digest of the words, fp, n (its different shingles), MinHash bands and a byte of each MinHash."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, BANDS * PER_BAND, dtype=np.uint64) | np.uint64(1)
    block = 1 << 12

    def one(text: bytes | None) -> tuple[bytes, int, int, np.ndarray, bytes]:
        least, votes, n = np.full(BANDS * PER_BAND, ALL), np.zeros(64, dtype=np.int64), 0
        digest, different = xxhash.xxh3_128(), [np.empty(0, np.uint64)]
        for hashes in shingle_hashes(text, width):
            digest.update(hashes.tobytes())
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            n += len(hashes)
            different.append(np.unique(hashes))
        shingles = np.unique(np.concatenate(different))
        for s in range(0, len(shingles), block):
            part = shingles[s : s + block]
            np.minimum(least, ((part ^ (part >> np.uint64(29)))[:, None] * factors).min(axis=0), out=least)
        fp = int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0]) if n else 0
        bands = [xxhash.xxh64_intdigest(b.tobytes(), seed=i) for i, b in enumerate(least.reshape(BANDS, PER_BAND))]
        return digest.digest(), fp, len(shingles), np.array(bands, dtype=np.uint64).view(np.int64), (least >> np.uint64(20)).astype(np.uint8).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            made = [one(x) for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "digest", "fp", "n", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(run), "doc_id long, digest binary, fp long, n long, bands array<long>, sketch binary")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            sets = [np.unique(np.concatenate([*shingle_hashes(x, width), np.empty(0, np.uint64)])).view(np.int64) for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return docs.select("id", "text").mapInArrow(frugal(run), "id long, shingles array<long>")


def bit_word(id_: str) -> Column:
    """The word that holds an id's bit."""
    return F.shiftright(F.xxhash64(id_), 6).bitwiseAND(F.lit((1 << WORD_BITS) - 1))


def bit_of(id_: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(id_).bitwiseAND(F.lit(63)).cast("int"))


def packed(rows: pa.Table) -> pa.Table:
    """(_pack, place, bits) of one pack: a row with all its words, 0 where there is none."""
    words = np.zeros(1 << PACK_BITS, dtype=np.int64)
    words[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return pa.table({"_pack": rows.column("_pack").slice(0, 1), "_words": pa.array([words], pa.list_(pa.int64()))})


def wanted_bits(wanted: DataFrame) -> DataFrame:
    """The bits that the ids of ``wanted`` set: _pack and _words, 2 ** PACK_BITS words a row."""
    words = wanted.groupBy(bit_word("id").alias("word")).agg(F.bit_or(bit_of("id")).alias("bits"))
    words = words.select(F.shiftright("word", PACK_BITS).alias("_pack"), F.col("word").bitwiseAND(F.lit((1 << PACK_BITS) - 1)).alias("place"), "bits")
    return words.groupBy("_pack").applyInArrow(packed, "_pack long, _words array<long>")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and text of the rows of ``docs`` (doc_id, text) whose doc_id is one of ``wanted`` (id, distinct), a row an id.

    Few texts are wanted as a rule, and moving all of them to the join would cost more than
    all else. So each wanted id sets one of 64 << WORD_BITS bits first; they go to all tasks,
    2 ** (WORD_BITS - PACK_BITS) rows of packed words at most whatever the input, and only
    rows whose bit is set take part in the exact join. Many ids fill the bits and let more
    rows through.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    word = F.element_at("_words", (bit_word("id").bitwiseAND(F.lit((1 << PACK_BITS) - 1)) + 1).cast("int"))
    likely = rows.join(F.broadcast(wanted_bits(wanted)), F.shiftright(bit_word("id"), PACK_BITS) == F.col("_pack")).filter(word.bitwiseAND(bit_of("id")) != 0)
    return likely.select("id", "text").join(wanted, "id").dropDuplicates(["id"])


def equal_bytes(s: str, t: str) -> Column:
    """Number of places at which two sketches have the same byte."""
    places = F.sequence(F.lit(1), F.lit(BANDS * PER_BAND))
    return F.size(F.filter(places, lambda i: F.substring(F.col(s), i, F.lit(1)) == F.substring(F.col(t), i, F.lit(1))))


def verified(pairs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts share ``similarity`` of their shingles, held against the whole sets."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = store(shingle_sets(texts_of(docs, wanted), width), "similar-sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    linked = both.select("a", "b", common.alias("n"), (F.size("x") + F.size("y")).alias("m")).filter(F.col("n") >= F.lit(similarity) * (F.col("m") - F.col("n"))).select("a", "b")
    return store(linked, "similar-links")


GROUP = ("key", "i", "j")


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Rows in which those of a (key, i, j) come together: tables with the places of their groups, all groups whole."""
    held: pa.Table | None = None

    def cut(rows: pa.Table) -> np.ndarray:
        where = np.stack([rows.column(c).to_numpy() for c in GROUP], axis=1)
        return np.flatnonzero(np.concatenate(([True], (where[1:] != where[:-1]).any(axis=1), [True])))

    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            edges = cut(held)
            if len(edges) > 2:
                done = int(edges[-2])
                yield held.slice(0, done).combine_chunks(), list(zip(edges[:-2].tolist(), edges[1:-1].tolist(), strict=True))
                held = held.slice(done)
    if held is not None:
        edges = cut(held)
        yield held.combine_chunks(), list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def flags(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """id, comp, inner, n and role of rows."""
    ids, comps, n, role = (rows.column(c).to_numpy() for c in ("id", "comp", "n", "role"))
    return ids, comps, rows.column("inner").to_numpy(zero_copy_only=False).astype(bool), n, role


def allowed(one: np.ndarray, two: np.ndarray, ids: np.ndarray, comps: np.ndarray, inner: np.ndarray, n: np.ndarray, similarity: float) -> np.ndarray:
    """Which places ``one`` may be linked to which places ``two``, by component and size. Two inner members meet from either side; one is enough."""
    open_ = (comps[one][:, None] != comps[two]) & (~inner[two] | (ids[one][:, None] < ids[two]))
    return open_ & (np.minimum(n[one][:, None], n[two]) >= similarity * np.maximum(n[one][:, None], n[two]))


def alike(similarity: float):
    """Of rows (key, i, j, role, id, comp, inner, n, sketch): key, i, j, role and id of those whose sketch is like one of the other role."""
    least = least_equal(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, places in by_group(batches):
            ids, comps, inner, n, role = flags(rows)
            sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BANDS * PER_BAND)
            marked = np.zeros(len(rows), dtype=bool)
            for s, e in places:
                one, two = s + np.flatnonzero(role[s:e] == 0), s + np.flatnonzero(role[s:e] == 1)
                step = max(1, (1 << 22) // max(1, len(two)))
                for t in range(0, len(one), step):
                    x, y = np.nonzero(allowed(one[t : t + step], two, ids, comps, inner, n, similarity))
                    for u in range(0, len(x), 1 << 16):
                        p, q = one[t + x[u : u + (1 << 16)]], two[y[u : u + (1 << 16)]]
                        near = (sketch[p] == sketch[q]).sum(axis=1) >= least
                        marked[p[near]] = marked[q[near]] = True
            yield from rows.select([*GROUP, "role", "id", "comp", "inner", "n"]).filter(pa.array(marked)).to_batches()

    return run


def linked_in_groups(similarity: float):
    """Of rows (key, i, j, role, id, comp, inner, n, shingles): links (a, b) of components that join what exact similarity joins, without cycles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, places in by_group(batches):
            ids, comps, inner, n, role = flags(rows)
            lists = rows.column("shingles").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            out = []
            for s, e in places:
                words, number = np.unique(flat[offsets[s] : offsets[e]], return_inverse=True)
                at = offsets[s : e + 1] - offsets[s]
                mark = np.zeros(len(words), dtype=bool)
                two = s + np.flatnonzero(role[s:e] == 1)
                here = comps[s:e].copy()
                for p in (s + np.flatnonzero(role[s:e] == 0)).tolist():
                    q = two[allowed(np.array([p]), two, ids, comps, inner, n, similarity)[0] & (here[two - s] != here[p - s])]
                    if not len(q):
                        continue
                    own = number[at[p - s] : at[p - s + 1]]
                    mark[own] = True
                    ends = np.cumsum(n[q])
                    common = np.add.reduceat(mark[np.concatenate([number[at[i] : at[i + 1]] for i in (q - s).tolist()])], ends - n[q], dtype=np.int64)
                    mark[own] = False
                    for i in q[common >= similarity * (n[p] + n[q] - common)].tolist():
                        if here[i - s] != here[p - s]:
                            out.append((comps[p], comps[i]))
                            here[here == here[i - s]] = here[p - s]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def across(texts: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """texts (id, comp, n, bands, sketch): links (a, b) of components, by pairs of members that share a band and are similar.

    A list whose members are of one component is done. Of any other, members outside its
    largest component (the inner ones) meet all members, in blocks of about ``SIDE`` members
    and ``SHINGLES`` shingles at most: a list of m members, o of them inner, gives about
    2 m o / SIDE rows, so one that a large group of copies fills costs in proportion to its
    length. Sketches tell which members of a block are like another; those come back with
    their whole sets, are compared exactly, and give a spanning forest, not all pairs.
    """
    listed = texts.select("id", "comp", "n", F.explode("bands").alias("key"))
    by_comp = listed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    open_ = by_comp.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("members"), F.sum("s").alias("all"), F.max(F.struct("c", "comp", "s")).alias("top")).filter("comps > 1")
    blocks = lambda c, s: F.greatest(F.ceil(c / F.lit(SIDE)), F.ceil(s / F.lit(SHINGLES)), F.lit(1)).cast("long")
    open_ = open_.select("key", F.col("top.comp").alias("top"), blocks(F.col("members"), F.col("all")).alias("nb"), blocks(F.col("members") - F.col("top.c"), F.col("all") - F.col("top.s")).alias("ob"))
    rows = listed.join(open_, "key").withColumn("inner", F.col("comp") != F.col("top")).withColumn("h", F.abs(F.xxhash64("id") % 1000003))
    long = lambda x: F.lit(x).cast("long")
    first = rows.filter("inner").select("key", (F.col("h") % F.col("ob")).alias("i"), F.explode(F.sequence(long(0), F.col("nb") - 1)).alias("j"), long(0).alias("role"), "id", "inner")
    second = rows.select("key", F.explode(F.sequence(long(0), F.col("ob") - 1)).alias("i"), (F.col("h") % F.col("nb")).alias("j"), long(1).alias("role"), "id", "inner")
    dealt = first.union(second).join(texts.select("id", "comp", "n", "sketch"), "id").select(*GROUP, "role", "id", "comp", "inner", "n", "sketch")
    together = lambda df: df.repartition(*GROUP).sortWithinPartitions(*GROUP)
    kinds = "key long, i long, j long, role long, id long, comp long, inner boolean, n long"
    marked = store(together(dealt).mapInArrow(frugal(alike(similarity)), kinds), "similar-marked")
    sets = store(shingle_sets(texts_of(docs, marked.select("id").distinct()), width), "similar-sets")
    return store(together(marked.join(sets, "id")).mapInArrow(frugal(linked_in_groups(similarity)), "a long, b long").distinct(), "similar-joined")


def linked_texts(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """``similar`` of ``docs`` in which all rows of a doc_id have the same text."""
    rows = store(sketches(docs.filter("doc_id IS NOT NULL"), width), "similar-docs")
    texts = store(rows.groupBy("digest").agg(F.min("doc_id").alias("id"), *(F.first(c).alias(c) for c in ("fp", "n", "bands", "sketch"))), "similar-texts")
    listed = texts.select("id", "n", F.explode("bands").alias("key"))
    heads = listed.groupBy("key").agg(F.min(F.struct("id", "n")).alias("head"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("key", F.col("head.id").alias("to"), F.col("head.n").alias("to_n"))
    sized = F.least("n", "to_n") >= F.lit(similarity) * F.greatest("n", "to_n")
    banded = listed.join(heads, "key").filter((F.col("id") != F.col("to")) & sized).select("id", "to")
    by_fp = texts.groupBy("fp").agg(F.min("id").alias("fp_id"))
    same_fp = texts.join(by_fp, "fp").filter("id <> fp_id").select("id", F.col("fp_id").alias("to"))
    close = links(by_fp.select("fp"), RADIUS)
    close = close.join(by_fp.select(F.col("fp").alias("a"), F.col("fp_id").alias("id")), "a").join(by_fp.select(F.col("fp").alias("b"), F.col("fp_id").alias("to")), "b").select("id", "to")
    pairs = banded.union(same_fp).union(close).select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct()
    pairs = pairs.join(texts.select(F.col("id").alias("a"), F.col("sketch").alias("s")), "a").join(texts.select(F.col("id").alias("b"), F.col("sketch").alias("t")), "b")
    pairs = store(pairs.filter(equal_bytes("s", "t") >= least_equal(similarity)).select("a", "b"), "similar-pairs")
    roots = components(verified(pairs, docs, width, similarity))
    placed = store(texts.join(roots, F.col("id") == F.col("node"), "left").select("digest", "id", F.coalesce("root", "id").alias("comp"), "n", "bands", "sketch"), "similar-placed")
    roots = components(across(placed, docs, width, similarity))
    named = placed.join(roots, F.col("comp") == F.col("node"), "left").select("digest", F.coalesce("root", "comp").alias("component_id"))
    return rows.select("doc_id", "digest").join(named, "digest").select("doc_id", "component_id")


def separated(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``docs`` with a doc_id, with a number _node for each doc_id and text, and the numbers that are not doc_ids (id, _node).

    A doc_id's first text has the doc_id itself, further ones a hash; None if there are none.
    """
    rows = docs.filter("doc_id IS NOT NULL")
    of = (F.col("doc_id").cast("long"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    texts = store(rows.select(of[0].alias("id"), of[1].alias("sha")).distinct(), "similar-variants")
    several = texts.groupBy("id").agg(F.min("sha").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    more = store(texts.join(several, "id").filter("sha <> least").select("id", "sha"), "similar-further")
    if more.isEmpty():
        return rows.withColumn("_node", of[0]), None
    for seed in range(8):
        named = store(more.withColumn("_node", F.xxhash64("id", "sha", F.lit(seed))), "similar-named")
        used = named.select("_node").union(texts.select("id").distinct())
        if used.groupBy("_node").count().filter("count > 1").isEmpty():
            break
    else:
        raise ValueError("no free numbers for further texts")
    wide = rows.withColumn("_id", of[0]).withColumn("_sha", of[1])
    found = wide.join(named.withColumnRenamed("_node", "_further"), (F.col("_id") == F.col("id")) & (F.col("_sha") == F.col("sha")), "left")
    return found.withColumn("_node", F.coalesce("_further", "_id")).select(*(rows[f"`{c}`"] for c in rows.columns), "_node"), named.select("id", "_node")


def grouped(nodes: DataFrame, further: DataFrame | None, width: int, similarity: float) -> DataFrame:
    """Of each row of ``nodes``: _node, its doc_id and the component's number."""
    found = linked_texts(nodes.select(F.col("_node").alias("doc_id"), "text"), width, similarity).select(F.col("doc_id").alias("_node"), F.col("component_id").alias("component"))
    if further is None:
        return found.withColumn("doc_id", F.col("_node"))
    return found.join(further, "_node", "left").select("_node", F.coalesce("id", "_node").alias("doc_id"), "component")


def similar(docs: DataFrame, width: int = SIMILAR_WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and component_id of every row: the smallest doc_id that links of ``similarity`` or more reach.

    Texts of equal words are one. Candidates are fingerprints that bit slices find within
    ``RADIUS`` bits, and members of one MinHash band; what links them is the exact share of
    common shingles. A band's members first meet its first text only, which joins a group
    of copies by one pair a member. Those that this leaves in different components then meet
    each other (``across``), so no two members of a band that are similar stay apart.
    Null and empty texts are one text. Rows without a doc_id are left out. Different texts
    of one doc_id are linked each for itself.
    """
    nodes, further = separated(docs)
    found = grouped(nodes, further, width, similarity)
    if further is None:
        return found.select("doc_id", F.col("component").alias("component_id"))
    found = store(found, "similar-grouped")
    return found.join(found.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("doc_id", "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, of each group of near-duplicates the one of the smallest doc_id; of rows of one id and text, one. Rows without an id stay."""
    nodes, further = separated(docs)
    found = grouped(nodes, further, SIMILAR_WIDTH, SIMILARITY)
    if further is None:
        first = found.filter("_node = component").select(F.col("_node").alias("_kept")).distinct()
    else:
        first = found.groupBy("component").agg(F.min(F.struct("doc_id", "_node")).alias("least")).select(F.col("least._node").alias("_kept"))
    kept = nodes.join(first, F.col("_node") == F.col("_kept"), "left_semi").dropDuplicates(["_node"]).drop("_node")
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


by_value(__name__)
