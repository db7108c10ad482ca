"""SentencePiece lattices: distinct sampled segmentations by Gumbel top-k, and decoding.

A text's segmentations are the paths of a lattice whose edges are vocabulary pieces;
characters without a piece become their byte pieces. A piece's probability falls with its
rank, and a path's is the product of its pieces'. ``k`` distinct paths are drawn without
replacement: every path has its log probability plus Gumbel noise, and the k largest are
wanted. Best-first search finds them without listing paths. The maximum over a subtree of
the lattice's paths is itself Gumbel, located at the subtree's log mass; the search descends
from the largest, keeps for each step the truncated maximum of the alternatives not taken,
and takes the next path from the largest of those. With threshold t, the perturbed value of
path k + 1, a path of log probability l has inclusion score 1 - exp(-exp(l - t)).

Spaces become the meta symbol, one stands before a text, and no piece has it after another
character, so a lattice falls apart into chunks that begin with spaces. Chunks recur: a task
keeps the lattices of those it met, up to ``KEPT`` edges or those of one group of texts, and
then begins anew. All walks of a group of about ``GROUP`` bytes advance together, one edge at a
time, so a task's memory does not grow with its rows, only with its longest text.

Noise is a hash of seed, row key, path, chunk and step, so it does not depend on how rows
are dealt to tasks. Decoding restores every text exactly, a literal meta symbol too.

Null and empty texts have one segmentation, of no pieces. Texts with fewer than k
segmentations give all of them. Rows of one key and text give equal rows; rows of a null key
share the key 0. Texts are read as a whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm._shared import by_value, frugal, sliced, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
META = 0x2581
#: Stands for a meta symbol in the text itself; beyond Unicode, so no piece has it.
LITERAL = 0x110000
#: Ids from here on are characters (less this) written as byte pieces.
BYTES = 1 << 22
K, SEED = 2, 11
#: Bytes of text walked together, and edges of lattices that a task keeps (13 bytes each, and 5 a node).
GROUP, KEPT = 1 << 16, 1 << 21
WORD = (1 << 64) - 1
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, path: int, chunk: np.ndarray | int, step: np.ndarray | int) -> np.ndarray:
    """Between 0 and 1, both excluded."""
    x = seed + np.uint64(path * 0xD1B54A32D192ED03 & WORD)
    x = x + (chunk.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7) if isinstance(chunk, np.ndarray) else np.uint64(chunk * 0x8CB92BA72F3D8DD7 & WORD))
    x = x + (step.astype(np.uint64) * MULTIPLIER if isinstance(step, np.ndarray) else np.uint64(step * int(MULTIPLIER) & WORD))
    return ((mix(mix(x)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def one_uniform(seed: int, path: int, step: int) -> float:
    """The same for one number, chunk 0."""
    x = (seed + path * 0xD1B54A32D192ED03 + step * int(MULTIPLIER)) & WORD
    for _ in range(2):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & WORD
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & WORD
        x ^= x >> 31
    return ((x >> 11) + 0.5) / 2.0**53


class Vocabulary:
    """Pieces, their log probabilities, and a trie of them in a hash table."""

    def __init__(self, pieces: list[str], kinds: list[str], scores: list[float]) -> None:
        """kinds: normal, byte or other; scores: higher for pieces that rank before others."""
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        rank = {i: r for r, i in enumerate(sorted(normal, key=lambda i: (-scores[i], i)))}
        mass = np.log(sum(1.0 / (r + 10) for r in range(len(pieces))))
        self.log_p = np.full(len(pieces), -np.log(len(pieces) + 10.0) - mass)
        for i, r in rank.items():
            self.log_p[i] = -np.log(r + 10.0) - mass
        self.byte_log_p = float(self.log_p.min())
        self.byte_ids = {int(pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == "byte"}
        self.written = [p.replace("▁", " ").encode() if k == "normal" else bytes([int(p[3:5], 16)]) if k == "byte" else b"" for p, k in zip(pieces, kinds, strict=True)]
        self.of_ascii = np.array([self.byte_ids.get(b, 0) for b in range(128)], dtype=np.int64)
        self.lengths = np.array([len(w) for w in self.written])
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.written), dtype=np.uint8)
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        self.longest = max((len(pieces[i]) for i in normal), default=1)
        for i in normal:
            at = 0
            for c in pieces[i]:
                at = nodes.setdefault((at, ord(c)), len(nodes) + 1)
            ends[at] = i
        self.piece = np.full(len(nodes) + 1, -1, dtype=np.int64)
        self.piece[list(ends)] = list(ends.values())
        self.bits = max(8, int(len(nodes) * 4).bit_length())
        size = 1 << self.bits
        self.keys, self.next = np.full(size + 64, -1, dtype=np.int64), np.zeros(size + 64, dtype=np.int32)
        for (node, char), to in nodes.items():
            key = node << 21 | char
            slot = (key * int(MULTIPLIER) & (1 << 64) - 1) >> (64 - self.bits)
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.next[slot] = key, to

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model, read on the driver only."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = ["byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal" for i in ids]
        return cls([model.id_to_piece(i) for i in ids], kinds, [model.get_score(i) for i in ids])

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The trie's next nodes, 0 where there is none."""
        keys = nodes << 21 | chars
        slots = ((keys.astype(np.uint64) * MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.zeros(len(nodes), dtype=np.int64)
        left = np.arange(len(nodes))
        while len(left):
            found = self.keys[slots[left]]
            hit = found == keys[left]
            out[left[hit]] = self.next[slots[left[hit]]]
            left = left[~hit & (found >= 0)]
            slots[left] += 1
        return out

    def ids(self, pieces: np.ndarray) -> np.ndarray:
        """Piece ids, characters without a piece spelt in bytes."""
        pieces = pieces.astype(np.int64)
        bare = pieces >= BYTES
        if bare.any():
            ascii_ = bare & (pieces < BYTES + 128)
            pieces[ascii_] = self.of_ascii[pieces[ascii_] - BYTES]
            if (wide := np.flatnonzero(pieces >= BYTES)).size:
                spelt_out = [[self.byte_ids[b] for b in spelt(c)] for c in (pieces[wide] - BYTES).tolist()]
                at = np.repeat(wide, [len(x) for x in spelt_out])
                pieces = np.insert(np.delete(pieces, wide), at - (np.searchsorted(wide, at)), np.concatenate(spelt_out))
        return pieces.astype(np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a segmentation in UTF-8: what sentencepiece gives, but for literal meta symbols, which stay."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.offsets[ids] - ends + size, size)].tobytes()[1:] if len(ids) else b""


def spelt(char: int) -> bytes:
    return "▁".encode() if char == LITERAL else chr(char).encode("utf-8", "surrogatepass")


class Table:
    """Numbers by 64-bit hashes, open addressing; half full at most."""

    def __init__(self) -> None:
        self.held = 0
        self.empty(10)

    def empty(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros((1 << bits) + 4096, dtype=np.uint64)
        self.values = np.full(len(self.keys), -1, dtype=np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' values, -1 for those that are not there."""
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        while len(left):
            at = slots[left]
            value = self.values[at]
            hit = (value >= 0) & (self.keys[at] == keys[left])
            out[left[hit]] = value[hit]
            left = left[(value >= 0) & ~hit]
            slots[left] += 1
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        self.held += len(keys)
        if 2 * self.held > 1 << self.bits:
            old = self.values >= 0
            keys, values = np.concatenate((self.keys[old], keys)), np.concatenate((self.values[old], values))
            self.empty((2 * self.held - 1).bit_length())
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            at = slots[left]
            free = self.values[at] < 0
            # Of several keys that want a free slot, the last to write has it.
            self.keys[at[free]] = keys[left[free]]
            self.values[at[free]] = values[left[free]]
            left = left[~(free & (self.keys[at] == keys[left]))]
            slots[left] += 1


class Lattices:
    """Lattices of the chunks met: a node for each place in a chunk, edges in the order of their nodes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.up = np.ones(1, dtype=np.uint64)
        self.p = np.zeros(0)
        self.clear(KEPT)

    def clear(self, edges: int) -> None:
        self.table = Table()  # a chunk's hash: its first node
        self.nodes = self.edges = 0
        if len(self.p) == edges:  # written over: new ones would come from a heap that holds on to the old
            return
        self.begin = self.end = self.length = self.piece = self.p = None  # the old ones go first
        self.begin = np.zeros(edges + 1, dtype=np.int32)  # node: its first edge
        self.end = np.zeros(edges, dtype=bool)  # node: the end of a chunk
        self.length = np.zeros(edges, dtype=np.min_scalar_type(self.v.longest))  # characters, and nodes from source to target
        self.piece = np.zeros(edges, dtype=np.int32)
        self.p = np.zeros(edges)  # probability among the node's edges

    def hashes(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) < len(chars):
            # Powers of an odd number and, for the shift to a chunk's start, of its inverse.
            n = max(len(chars), GROUP)
            self.up = np.full(n, MULTIPLIER, dtype=np.uint64)
            self.down = np.full(n, pow(int(MULTIPLIER), -1, 1 << 64), dtype=np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        sums = np.zeros(len(chars) + 1, dtype=np.uint64)
        np.cumsum((chars + np.uint64(1)) * self.up[: len(chars)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def place(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The first node of each chunk, whose lattice is made if it is new."""
        values = self.hashes(chars.astype(np.uint64), starts, ends)
        out = self.table.find(values)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new, first = np.unique(values[missing], return_index=True)
            s, e = starts[missing[first]], ends[missing[first]]
            made = self.build(chars, s, e)
            if made is None:  # no room: begin anew with this group's chunks
                self.clear(KEPT)
                return self.place(chars, starts, ends)
            self.table.add(new, made)
            out[missing] = self.table.find(values[missing])
        return out

    def build(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        sizes = ends - starts
        offsets = np.cumsum(sizes + 1) - sizes - 1
        total = int((sizes + 1).sum())
        # Places of all characters, node by node; each chunk's last node is its end.
        place = np.arange(sizes.sum())
        of = np.repeat(np.arange(len(sizes)), sizes)
        node = place + of
        text = chars[place + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)].astype(np.int64)
        left = np.repeat(np.cumsum(sizes), sizes) - place
        at, trie, depth = place, np.zeros(len(place), dtype=np.int64), 0
        found, number = [], np.zeros(total, dtype=np.int64)
        while len(at):
            trie = self.v.step(trie, text[at + depth])
            depth += 1
            if depth == 1 and (bare := at[self.v.piece[trie] < 0]).size:
                found.append((node[bare], 1, text[bare] + BYTES))
            on = trie > 0
            at, trie = at[on], trie[on]
            piece = self.v.piece[trie]
            hit = piece >= 0
            found.append((node[at[hit]], depth, piece[hit]))
            on = left[at] > depth
            at, trie = at[on], trie[on]
        for where, _, _ in found:
            number[where] += 1
        head = np.zeros(total + 1, dtype=np.int64)
        np.cumsum(number, out=head[1:])
        n = int(head[-1])
        if self.edges + n > len(self.p) or self.nodes + total >= len(self.begin):
            if self.nodes:
                return None
            self.clear(max(n, total + 1))  # one group alone needs more than is kept
        source = np.repeat(np.arange(total), number)
        target, piece, next_ = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64), head[:-1].copy()
        for where, length, ids in found:
            slot = next_[where]
            target[slot], piece[slot] = where + length, ids
            next_[where] += 1
        plain = piece < BYTES
        log_p = self.v.log_p[np.where(plain, piece, 0)]
        if not plain.all():
            log_p[~plain] = [self.v.byte_log_p * len(spelt(c)) for c in (piece[~plain] - BYTES).tolist()]
        # Log mass of what follows each node, from the chunks' ends backwards, all chunks at once.
        remaining = np.zeros(total, dtype=np.int64)
        remaining[node] = left
        most = int(remaining.max(initial=0))
        order = np.argsort(remaining.astype(np.uint16) if most < 1 << 16 else remaining, kind="stable")
        cuts = np.searchsorted(remaining[order], np.arange(1, most + 2))
        mass = np.zeros(total)
        for a, b in zip(cuts, cuts[1:], strict=False):
            nodes = order[a:b]
            size = number[nodes]
            begin = np.cumsum(size) - size
            e = np.arange(int(size.sum())) + np.repeat(head[nodes] - begin, size)
            value = log_p[e] + mass[target[e]]
            top = np.maximum.reduceat(value, begin)
            mass[nodes] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, size)), begin))
        p = np.exp(log_p + mass[target] - mass[source])
        n0, e0 = self.nodes, self.edges
        self.begin[n0 : n0 + total + 1] = head + e0
        self.end[n0 : n0 + total] = remaining == 0
        cut = slice(e0, e0 + n)
        self.length[cut], self.piece[cut], self.p[cut] = target - source, piece, p
        self.nodes, self.edges = n0 + total, e0 + n
        return offsets + n0

    def choose(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node at which the running sum of probabilities passes u."""
        edge, last = self.begin[nodes].astype(np.int64), self.begin[nodes + 1] - 1
        upto = self.p[edge]
        left = np.flatnonzero((upto < u) & (edge < last))
        while len(left):
            edge[left] += 1
            upto[left] += self.p[edge[left]]
            left = left[(upto[left] < u[left]) & (edge[left] < last[left])]
        return edge

    def sources(self, edges: np.ndarray) -> np.ndarray:
        """The nodes that edges leave."""
        return np.searchsorted(self.begin[: self.nodes + 1], edges.astype(np.int32), side="right") - 1

    def walk(self, nodes: np.ndarray, seeds: np.ndarray, chunk: np.ndarray, path: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn from each node to its chunk's end, walk after walk, and the walks they belong to."""
        on = np.flatnonzero(~self.end[nodes])
        at, taken, step = nodes[on], [], 0
        while len(on):
            edge = self.choose(at, uniform(seeds[on], path, chunk[on], step))
            taken.append((on, edge))
            at = at + self.length[edge]
            go = ~self.end[at]
            on, at, step = on[go], at[go], step + 1
        if not taken:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        number = np.bincount(taken[0][0], minlength=len(nodes))
        for w, _ in taken[1:]:
            number[w] += 1
        offset = np.cumsum(number) - number
        out = np.empty(int(number.sum()), dtype=np.int64)
        for step, (w, edge) in enumerate(taken):
            out[offset[w] + step] = edge
        return out, np.repeat(np.arange(len(nodes)), number)


def gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def set_aside(p: np.ndarray, before: np.ndarray, value: np.ndarray | float, u: np.ndarray) -> np.ndarray:
    """The largest perturbed value among the paths passed by at each step, given that it is under ``value``."""
    with np.errstate(divide="ignore"):
        rest = before + np.log1p(-np.minimum(p, 1.0))
    noise = -np.log(u)
    near = rest - value
    near = np.flatnonzero(near > -60)  # elsewhere the bound adds less than rounding does
    over = np.broadcast_to(value, rest.shape)[near]
    noise[near] += np.exp(np.minimum(rest[near] - over, 700))
    return rest - np.log(noise)


class Path:
    """A drawn segmentation: its edges, their chunks, running log probabilities, and the best of what it passed by at each."""

    def __init__(self, edges: np.ndarray, chunks: np.ndarray, value: float, logs: np.ndarray, aside: np.ndarray) -> None:
        self.edges, self.chunks, self.value, self.logs, self.aside = edges, chunks, value, logs, aside
        self.log_p = float(logs[-1]) if len(logs) else 0.0
        self.passed: dict[int, list[int]] = {}

    def best(self) -> tuple[float, int]:
        if not len(self.aside):
            return -np.inf, -1
        i = int(np.argmax(self.aside))
        return float(self.aside[i]), i


def sample_group(texts: list[str | None], keys: list[int], lattices: Lattices, k: int, seed: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text, its paths in falling order of value: (edges, log probability, value, inclusion score)."""
    parts = [np.frombuffer((" " + t if t else "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    sizes = np.array([len(p) for p in parts])
    chars = np.concatenate(parts).copy() if len(parts) else np.empty(0, np.uint32)
    chars[chars == META] = LITERAL
    chars[chars == 32] = META
    text_start = np.cumsum(sizes) - sizes
    meta = chars == META
    opens = np.zeros(len(chars), dtype=bool)
    opens[1:] = meta[1:] & ~meta[:-1]
    opens[text_start[sizes > 0]] = True
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(chars))
    first_chunk = np.searchsorted(starts, text_start)
    last_chunk = np.append(first_chunk[1:], len(starts))
    roots = lattices.place(chars, starts, ends) if len(starts) else np.empty(0, np.int64)
    text_of = np.repeat(np.arange(len(texts)), last_chunk - first_chunk)
    seeds = mix(np.array(keys, dtype=np.int64).view(np.uint64) * MULTIPLIER + np.uint64(seed))
    nth = np.arange(len(roots)) - first_chunk[text_of]
    edges, of = lattices.walk(roots, seeds[text_of], nth, 0)
    cuts = np.searchsorted(of, np.append(first_chunk, len(roots)))
    tops = gumbel(uniform(seeds, 999, 0, 0))
    step_text = text_of[of]
    p = lattices.p[edges]
    logs = np.concatenate(([0.0], np.cumsum(np.log(p))))
    before = logs[:-1] - logs[cuts[:-1]][step_text]
    aside = set_aside(p, before, tops[step_text], uniform(seeds[step_text], 1000, 0, np.arange(len(edges)) - cuts[:-1][step_text]))
    logs = before + np.log(p)
    paths = [[Path(edges[a:b], of[a:b], top, logs[a:b], aside[a:b])] for a, b, top in zip(cuts[:-1].tolist(), cuts[1:].tolist(), tops.tolist(), strict=True)]
    threshold = [-np.inf] * len(texts)
    for number in range(1, k + 1):
        branches: list[tuple[int, float, Path, int]] = []  # text, value, path, place
        for d, drawn in enumerate(paths):
            if len(drawn) == number:
                value, place, path = -np.inf, -1, drawn[0]
                for candidate in drawn:
                    best, i = candidate.best()
                    if best > value:
                        value, place, path = best, i, candidate
                if place >= 0:
                    branches.append((d, value, path, place))
        if number == k or not branches:
            for d, value, _, _ in branches:
                threshold[d] = value
            break
        turned, walks, walk_text, walk_chunk = [], [], [], []
        sources = lattices.sources(np.array([path.edges[place] for _, _, path, place in branches])).tolist()
        for node, (d, value, path, place) in zip(sources, branches, strict=True):
            taken = path.passed.setdefault(place, [int(path.edges[place])])
            options = [e for e in range(lattices.begin[node], lattices.begin[node + 1]) if e not in taken]
            shares = [float(lattices.p[e]) for e in options]
            u, edge = one_uniform(int(seeds[d]), 3000 + number, 0) * sum(shares), options[-1]
            for e, share in zip(options, shares, strict=True):
                u -= share
                if u < 0:
                    edge = e
                    break
            taken.append(edge)
            # What no path takes at the branch is kept with the path it was passed by on.
            rest = sum(x for e, x in zip(options, shares, strict=True) if e != edge)
            start = float(path.logs[place - 1]) if place else 0.0
            path.aside[place] = set_aside(np.array([1.0 - rest]), start, value, np.array([one_uniform(int(seeds[d]), 2000 + number, 0)]))[0] if rest > 0 else -np.inf
            turned.append(edge)
            chunk, last = int(path.chunks[place]), int(last_chunk[d])
            walks.append(np.concatenate(([node + int(lattices.length[edge])], roots[chunk + 1 : last])))
            walk_text.append(np.full(last - chunk, d))
            walk_chunk.append(np.arange(chunk, last))
        text, chunks = np.concatenate(walk_text), np.concatenate(walk_chunk)
        edges, of = lattices.walk(np.concatenate(walks), seeds[text], chunks - first_chunk[text], number)
        bounds = np.searchsorted(text[of], [b[0] for b in branches] + [len(texts)]).tolist()
        where, p = chunks[of], lattices.p[edges]
        u = uniform(seeds[text[of]], 1000 + number, 0, np.arange(len(edges)) - np.array(bounds)[np.searchsorted([b[0] for b in branches], text[of])])
        for b, (d, value, path, place) in enumerate(branches):
            mine = slice(bounds[b], bounds[b + 1])
            turn = (float(path.logs[place - 1]) if place else 0.0) + float(np.log(lattices.p[turned[b]]))
            new_logs = turn + np.cumsum(np.log(p[mine]))
            passed = set_aside(p[mine], np.concatenate(([turn], new_logs[:-1]))[: len(new_logs)], value, u[mine])
            paths[d].append(
                Path(
                    np.concatenate((path.edges[:place], [turned[b]], edges[mine])),
                    np.concatenate((path.chunks[: place + 1], where[mine])),
                    value,
                    np.concatenate((path.logs[:place], [turn], new_logs)),
                    np.concatenate((np.full(place + 1, -np.inf), passed)),
                )
            )
    return [[(lattices.piece[p.edges], p.log_p, p.value, float(-np.expm1(-np.exp(min(p.log_p - t, 700.0)))) if t > -np.inf else 1.0) for p in drawn] for drawn, t in zip(paths, threshold, strict=True)]


def sampler(vocabulary: Vocabulary, k: int, seed: int, digest: bool):
    kinds = [("row_key", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64())]
    schema = pa.schema([*kinds, ("ids", pa.list_(pa.int32())), *([("ids_sha256", pa.string()), ("restored", pa.bool_())] if digest else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(vocabulary)
        for group in sliced(batches, 1, GROUP):
            keys, texts = (c.to_pylist() for c in group.columns)
            out: list[list] = [[] for _ in schema]
            for key, text, drawn in zip(keys, texts, sample_group(texts, [x or 0 for x in keys], lattices, k, seed), strict=True):
                for i, (edges, log_p, value, inclusion) in enumerate(drawn):
                    ids = vocabulary.ids(edges)
                    last = (ids, hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), vocabulary.decode(ids) == (text or "").encode()) if digest else (ids,)
                    for values, x in zip(out, (key, i + 1, len(ids), log_p, value, inclusion, *last), strict=True):
                        values.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return run


def segmentations(docs: DataFrame, key: str = "doc_id", k: int = K, seed: int = SEED, model: str = MODEL, digest: bool = False) -> DataFrame:
    """A row for each of up to k distinct segmentations of every text: row_key, sample (1 to k, in falling order of perturbed),
    n_pieces, log_prob, perturbed, inclusion, ids, and for ``digest`` their SHA-256 and whether decoding restores the text."""
    last = "ids array<int>" + (", ids_sha256 string, restored boolean" if digest else "")
    rows = docs.select(F.col(key).cast("long").alias("row_key"), F.col("text").alias("text"))
    return rows.mapInArrow(frugal(sampler(Vocabulary.load(model), k, seed, digest)), f"row_key long, sample int, n_pieces long, log_prob double, perturbed double, inclusion double, {last}")


def decoded(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of their array column ``ids`` (null: null) in a column decoded, in place of one of that name."""
    rows = rows.drop("decoded")
    vocabulary, at = Vocabulary.load(model), rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(np.array(x, dtype=np.int64)).decode("utf-8", "replace") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("row_key", "doc_id")


by_value(__name__)
