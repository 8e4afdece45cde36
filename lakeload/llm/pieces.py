"""SentencePiece encoding and decoding, with sampled segmentations.

A text's lattice holds every way to write it with pieces of the vocabulary. A segmentation's
probability is proportional to the product of its pieces' weights. The k segmentations of a
row are drawn without replacement by Gumbel top-k: a search over the lattice in which each
node, a prefix with its possible continuations, carries the largest perturbed value below it.
The first path takes the most from its parent, its siblings draw theirs below that, and the
best node left in the queue gives the next segmentation. Sums over continuations are exact,
so no path is expanded in vain.

No piece spans the start of a word, so the lattice of a text is a chain of the lattices of
its words. Tables are made once for the distinct words of a batch, and all words of all
texts are sampled side by side.
"""

from __future__ import annotations

import heapq
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_tables, trim

BLANK = "▁"
# No piece holds a line break, or a blank after another character.
_WORDS = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n[^{BLANK}\n]*")
SLICE_CHARS = 1_000_000  # text that is sampled side by side; a longer text is by itself
SEED = 41
SHARPNESS = 0.3  # the power of the pieces' frequencies; 0 makes all segmentations alike
KEPT_PLACES = 500_000  # characters of distinct words whose tables a task keeps
# No Gumbel value from 53 random bits is larger: -log(-log(1 - 2^-54)).
HIGHEST = 37.5

_U = np.uint64
_BASE = _U(0x100000001B3)
_SPREAD = _U(0x9E3779B97F4A7C15)
_TABLE_BITS = 22
_ALL = 2**64 - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = np.asarray(x, _U) + _SPREAD
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((_mixed(x) >> _U(11)).astype(float) + 0.5) * 2.0**-53


def _gumbel(x: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(_uniform(x)))


class Vocabulary:
    """Pieces of a model file, their weights, and a table to find them by hash."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes_from = names.index("<0x00>")
        plain = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.longest = max(len(names[i]) for i in plain)
        # Pieces are stored by falling frequency, so a piece's weight follows from its rank.
        self.byte_weight = -sharpness * math.log(size)
        hashes, prefixes = {}, set()
        for rank, i in enumerate(plain, 1):
            h = 0
            for k, c in enumerate(names[i], 1):
                h = (h * int(_BASE) + ord(c) + 1) & (2**64 - 1)
                prefixes.add(h)
            hashes[h] = (i, -sharpness * math.log(rank))
        self.hashes = np.array(sorted(hashes), _U)
        self.ids = np.array([hashes[int(h)][0] for h in self.hashes], np.int32)
        self.weights = np.array([hashes[int(h)][1] for h in self.hashes])
        self.table = np.zeros(1 << _TABLE_BITS, np.uint8)
        self.table[self.place(np.array(list(prefixes), _U))] |= 1
        own = self.place(self.hashes)
        self.table[own] |= 2
        # One of the pieces at a place; where there are several, the others are searched for.
        self.slot = np.zeros(1 << _TABLE_BITS, np.min_scalar_type(len(own)))
        self.slot[own] = np.arange(len(own))
        self.table[own[self.slot[own] != np.arange(len(own))]] |= 4
        self.text = [b""] * size
        for i in plain:
            self.text[i] = names[i].replace(BLANK, " ").encode()
        for b in range(256):
            self.text[self.bytes_from + b] = bytes([b])
        self.bytes = pa.array(self.text, pa.large_binary())

    @staticmethod
    def place(hashes: np.ndarray) -> np.ndarray:
        return (hashes * _SPREAD) >> _U(64 - _TABLE_BITS)

    def decode(self, ids) -> str:
        """The text of pieces; the blank that encoding puts in front is taken off."""
        raw = b"".join(map(self.text.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    return Vocabulary(path, sharpness)


def _plain(text: str | None) -> bool:
    """Whether each blank is between two others than blanks, so no piece spans several."""
    return not text or not ("  " in text or BLANK in text or text[0] == " ")


def words_of(text: str | None) -> list[str]:
    """What the lattice of a text is chained of: words without the blank in front.

    A word after a line break starts with that break in place of a blank.
    """
    if not text:
        return []
    if _plain(text):
        return text.replace("\n", " \n").split(" ")
    found = _WORDS.findall(BLANK + text.replace(" ", BLANK))
    return [w if w[0] == "\n" else w[1:] for w in found]


def _numbered(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word, and where each text's words begin."""
    plain = [_plain(t) for t in texts.to_pylist()]
    runs = [pa.array([], pa.string())]
    counts = np.zeros(len(texts), np.int64)
    start = 0
    while start < len(texts):
        end = start + 1
        if plain[start]:
            while end < len(texts) and plain[end]:
                end += 1
            part = texts.slice(start, end - start)
            split = pc.split_pattern(pc.replace_substring(part, "\n", " \n"), " ")
            full = pc.fill_null(pc.greater(pc.binary_length(part), 0), False)
            split = pc.if_else(full, split, pa.scalar(None, split.type))
            counts[start:end] = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
            runs.append(split.flatten())
        else:
            own = words_of(texts[start].as_py())
            counts[start] = len(own)
            runs.append(pa.array(own, pa.string()))
        start = end
    coded = pa.concat_arrays(runs).dictionary_encode()
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), bounds


class Lattices:
    """For every place in a growing set of words: the pieces that start there, as edges.

    Edges of a place stand together, the longest first: the piece's id, the log of its
    probability given that a segmentation comes by the place, the cumulated probability,
    and the place where it ends, or -1 at the end of the word. A character that is no
    piece is one edge with the id ``-1 - code point``.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.begin: dict[str, int] = {}
        self.first = np.zeros(1, np.int32)  # the first edge of each place, and the end
        self.to = np.empty(0, np.int32)
        self.ids = np.empty(0, np.int32)
        self.log = np.empty(0, np.float32)
        self.upto = np.empty(0, np.float32)

    def add(self, words: list[str]) -> None:
        words = [w for w in words if w not in self.begin]
        if not words:
            return
        base = len(self.first) - 1
        whole = [w if w[:1] == "\n" else BLANK + w for w in words]
        lengths = np.fromiter(map(len, whole), np.int64, len(whole))
        starts = np.cumsum(lengths) - lengths
        chars = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32)
        left = (np.repeat(starts + lengths, lengths) - np.arange(len(chars))).astype(np.int32)
        # Places go by their distance to the end of the word, so that sums of
        # continuations need one step for each distance.
        order = np.argsort(left.astype(np.int16) if left.max() < 32768 else left, kind="stable")
        rank = np.empty(len(chars), np.int32)
        rank[order] = np.arange(len(chars), dtype=np.int32)

        found = self._found(chars, left)
        counts = np.zeros(len(chars), np.int32)
        for at, _, _ in found:
            counts[rank[at]] += 1
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        edges = int(first[-1])
        to, ids = np.empty(edges, np.int32), np.empty(edges, np.int32)
        log, fill = np.empty(edges), first[:-1].copy()
        for length in range(len(found), 0, -1):
            at, own, weights = found[length - 1]
            mine = rank[at]
            e = fill[mine]
            fill[mine] += 1
            ends = left[at] == length
            to[e] = np.where(ends, -1, rank[np.minimum(at + length, len(chars) - 1)])
            ids[e], log[e] = own, weights
        steps = np.concatenate([[0], np.cumsum(np.bincount(left)[1:])])
        total = np.zeros(len(chars) + 1)  # the last, at index -1, stands for the end
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            if low == high:
                continue
            e = slice(first[low], first[high])
            heads = first[low:high] - first[low]
            values = log[e] + total[to[e]]
            top = np.maximum.reduceat(values, heads)
            width = counts[low:high]
            total[low:high] = top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, width)), heads))
            log[e] = values - np.repeat(total[low:high], width)
        # Summed place by place, so that no other word of the batch changes a rounding.
        chance = np.exp(log)
        for k in range(1, int(counts.max())):
            e = first[:-1][counts > k] + k
            chance[e] += chance[e - 1]
        upto = chance.astype(np.float32)
        upto[first[1:] - 1] = 2.0  # the last edge takes what rounding leaves

        for word, place in zip(words, rank[starts].tolist(), strict=True):
            self.begin[word] = base + place
        shift = len(self.to)
        self.to = np.concatenate([self.to, np.where(to < 0, -1, to + base).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        self.log = np.concatenate([self.log, np.minimum(log, 0.0).astype(np.float32)])
        self.upto = np.concatenate([self.upto, upto])
        self.first = np.concatenate([self.first, first[1:] + np.int32(shift)])

    def owner(self, edges):
        """The places at which edges start."""
        return np.searchsorted(self.first, np.asarray(edges, np.int32), side="right") - 1

    def _found(self, chars: np.ndarray, left: np.ndarray):
        """By length from 1: places, ids and log weights of the pieces that start there."""
        v = self.vocabulary
        at = np.arange(len(chars), dtype=np.int32)
        hashes = np.zeros(len(chars), _U)
        wide = chars.astype(_U) + _U(1)
        found = []
        for k in range(v.longest):
            if k:
                inside = left[at] > k
                at, hashes = at[inside], hashes[inside]
            hashes = hashes * _BASE + wide[at + k]
            slots = v.place(hashes)
            flags = v.table[slots]
            hit = np.flatnonzero(flags & 2)
            own = hashes[hit]
            near = v.slot[slots[hit]].astype(np.int64)
            several = np.flatnonzero(flags[hit] & 4)
            near[several] = np.minimum(np.searchsorted(v.hashes, own[several]), len(v.hashes) - 1)
            equal = v.hashes[near] == own
            near = near[equal]
            places, ids, weights = at[hit[equal]], v.ids[near], v.weights[near]
            if not k:
                alone = np.ones(len(chars), bool)
                alone[places] = False
                alone = np.flatnonzero(alone)
                places = np.concatenate([places, alone])
                ids = np.concatenate([ids, (-1 - chars[alone].astype(np.int64)).astype(np.int32)])
                weights = np.concatenate([weights, v.byte_weight * _utf8_length(chars[alone])])
            found.append((places, ids, weights))
            more = (flags & 1) > 0
            at, hashes = at[more], hashes[more]
        return found

    def paths(self, start: np.ndarray, seeds: np.ndarray):
        """A sampled path from each start (-1: none) to its word's end, all at once.

        The edges, path after path, and the number of edges of each.
        """
        at, step = start.astype(np.int64), 0
        active = np.flatnonzero(at >= 0)
        taken: list[tuple] = []
        counts = np.zeros(len(start), np.int64)
        while len(active):
            draw = _uniform(seeds[active] + _U(step + 1) * _BASE).astype(np.float32)
            edge = self.first[at[active]]
            open_ = np.flatnonzero(self.upto[edge] <= draw)
            while len(open_):
                edge[open_] += 1
                open_ = open_[self.upto[edge[open_]] <= draw[open_]]
            taken.append((active, edge))
            counts[active] += 1
            at[active] = to = self.to[edge]
            active = active[to >= 0]
            step += 1
        offsets = np.cumsum(counts) - counts
        edges = np.empty(int(counts.sum()), np.int64)
        for k, (who, edge) in enumerate(taken):
            edges[offsets[who] + k] = edge
        return edges, counts


def _utf8_length(chars: np.ndarray) -> np.ndarray:
    return 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)


def _in_bytes(ids: np.ndarray, bytes_from: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Ids with each character that is no piece as its bytes, and how many ids each became."""
    missing = ids < 0
    if not missing.any():
        return ids, None
    chars = np.where(missing, -1 - ids, 0)
    sizes = _utf8_length(chars)
    if sizes.max() == 1:
        return np.where(missing, chars + bytes_from, ids).astype(np.int32), None
    out = np.repeat(ids, sizes)
    first = np.cumsum(sizes) - sizes
    for n in np.unique(sizes[missing]):
        mine = np.flatnonzero(missing & (sizes == n))
        raw = np.frombuffer("".join(map(chr, chars[mine])).encode("utf-8"), np.uint8)
        out[first[mine][:, None] + np.arange(n)] = raw.reshape(len(mine), n).astype(np.int32) + bytes_from
    return out, sizes


class _Path:
    """A sampled segmentation: its edges, how many for each word, and its perturbed value.

    ``since`` is the first edge that is its own; ``excluded`` are edges at that place which
    other samples with the same beginning have taken.
    """

    __slots__ = ("edges", "excluded", "per_word", "since", "value")

    def __init__(self, edges, per_word, value, since=0, excluded=()):
        self.edges, self.per_word, self.value = edges, per_word, value
        self.since, self.excluded = since, excluded


class _Row:
    """The search of one text: its words, its queue of nodes, its samples so far."""

    def __init__(self, first: int, end: int, seed: int):
        self.first, self.end, self.seed = first, end, seed
        self.queue: list = []
        self.samples: list[_Path] = []


_kept: dict[tuple, Lattices] = {}
kept_tables += [_kept.clear, vocabulary.cache_clear]


def _lattices(path: str, sharpness: float, words: list[str]) -> Lattices:
    """Tables that hold these words; what earlier texts needed is kept, within bounds."""
    known = _kept.get((path, sharpness))
    if known is None or len(known.first) > KEPT_PLACES:
        known = _kept[(path, sharpness)] = Lattices(vocabulary(path, sharpness))
    known.add(words)
    return known


def sample(
    texts: pa.Array | list[str | None], keys: list[int], path: str, k: int, seed: int = SEED, sharpness: float = SHARPNESS
):
    """For each text a list of (ids, log_prob, log_inclusion), the most perturbed first."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    words, numbers, bounds = _numbered(column)
    lattices = _lattices(path, sharpness, words)
    begins = np.array([lattices.begin[w] for w in words], np.int64)[numbers]
    seeds = _mixed(np.array(keys, np.int64).view(_U) ^ _U(seed * 0x5851F42D4C957F2D & _ALL))
    rows = [_Row(a, b, int(s)) for a, b, s in zip(bounds[:-1].tolist(), bounds[1:].tolist(), seeds, strict=True)]

    value = _gumbel(seeds ^ _U(0x6A09E667))
    edges, counts = lattices.paths(begins, _word_seeds(rows, [r.first for r in rows], 0))
    ends = np.concatenate([[0], np.cumsum(counts)])
    for i, row in enumerate(rows):
        own = slice(ends[row.first], ends[row.end])
        row.samples.append(_Path(edges[own], counts[row.first : row.end], float(value[i])))
    _push([(r, r.samples[0]) for r in rows], lattices, 0, k)
    for turn in range(1, k):
        popped = [(row, heapq.heappop(row.queue)) for row in rows if row.queue]
        new = _draw(popped, lattices, begins, turn)
        for row, path_ in new:
            row.samples.append(path_)
        _push(new, lattices, turn, k)
    return _results(rows, lattices)


def _word_seeds(rows: list[_Row], since: list[int], turn: int) -> np.ndarray:
    """A seed for each word from ``since`` to a row's end: by row, turn and place of the word."""
    counts = np.array([r.end - s for r, s in zip(rows, since, strict=True)], np.int64)
    salts = np.array([(r.seed + (turn + 1) * 0x2545F4914F6CDD1D) & _ALL for r in rows], _U)
    skipped = np.array([s - r.first for r, s in zip(rows, since, strict=True)], np.int64)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - skipped, counts)
    return _mixed(np.repeat(salts, counts) ^ place.astype(_U))


def _results(rows: list[_Row], lattices: Lattices) -> list[list[tuple[np.ndarray, float, float]]]:
    paths = [s.edges for row in rows for s in row.samples]
    ends = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    edges = np.concatenate(paths) if paths else np.empty(0, np.int64)
    logs = np.concatenate([[0.0], np.cumsum(lattices.log[edges], dtype=float)])[ends]
    ids, sizes = _in_bytes(lattices.ids[edges], lattices.vocabulary.bytes_from)
    places = ends if sizes is None else np.concatenate([[0], np.cumsum(sizes)])[ends]
    out, at = [], 0
    for row in rows:
        own = []
        for _ in row.samples:
            log_prob = float(logs[at + 1] - logs[at])
            own.append((ids[places[at] : places[at + 1]], log_prob, _inclusion(row, log_prob)))
            at += 1
        out.append(own)
    return out


def _inclusion(row: _Row, log_prob: float) -> float:
    """The log of the chance that a segmentation's value exceeds the largest one not taken."""
    if not row.queue:
        return 0.0
    gap = log_prob + row.queue[0][0]
    return gap if gap < -30 else math.log(-math.expm1(-math.exp(min(gap, 700.0))))


def _draw(popped: list, lattices: Lattices, begins: np.ndarray, turn: int) -> list[tuple[_Row, _Path]]:
    """Complete the nodes taken from the queues; all their open words are sampled together."""
    branches, starts = [], []
    for row, (_, _, parent, index, excluded) in popped:
        place = int(lattices.owner(parent.edges[index]))
        options = slice(int(lattices.first[place]), int(lattices.first[place + 1]))
        chances = np.exp(lattices.log[options].astype(float))
        chances[[e - options.start for e in excluded]] = 0
        upto = np.cumsum(chances)
        draw = _uniform(np.array([(row.seed + (turn + 1) * 0x2545F4914F6CDD1D ^ 0x5DEECE66D) & _ALL], _U))[0]
        choice = min(int(np.searchsorted(upto, draw * upto[-1], side="right")), int(np.flatnonzero(chances)[-1]))
        ends = np.cumsum(parent.per_word)
        word = int(np.searchsorted(ends, index, side="right"))
        in_word = index - (int(ends[word - 1]) if word else 0)
        branches.append((options.start + choice, word, in_word))
        first = begins[row.first + word : row.end].copy()
        first[0] = lattices.to[options.start + choice]
        starts.append(first)
    if not popped:
        return []
    seeds = _word_seeds([r for r, _ in popped], [r.first + b[1] for (r, _), b in zip(popped, branches, strict=True)], turn)
    edges, counts = lattices.paths(np.concatenate(starts), seeds)
    ends = np.concatenate([[0], np.cumsum(counts)])
    out, at = [], 0
    for (row, (below, _, parent, index, excluded)), (edge, word, in_word), first in zip(popped, branches, starts, strict=True):
        own = counts[at : at + len(first)].copy()
        tail = edges[ends[at] : ends[at + len(first)]]
        own[0] += in_word + 1
        path = _Path(
            np.concatenate([parent.edges[:index], [edge], tail]),
            np.concatenate([parent.per_word[:word], own]),
            -below, index, excluded,
        )
        out.append((row, path))
        at += len(first)
    return out


def _push(new: list[tuple[_Row, _Path]], lattices: Lattices, turn: int, k: int) -> None:
    """Queue the siblings of the new paths' own edges, with values below the paths' own.

    Only as many as can still be taken, and one more for the inclusion score. A sibling so
    improbable that no value of 53 random bits brings it there is left out, which changes
    nothing.
    """
    most = k - turn
    span = 64
    while new:
        sizes = np.array([min(len(p.edges) - p.since, span) for _, p in new], np.int64)
        rows = np.repeat(np.arange(len(new)), sizes)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        edges = np.concatenate([p.edges[p.since : p.since + n] for (_, p), n in zip(new, sizes, strict=True)])
        log = np.zeros((len(new), span + 1))
        log[rows, inside + 1] = lattices.log[edges]
        before = np.array([lattices.log[p.edges[: p.since]].sum(dtype=float) if p.since else 0.0 for _, p in new])
        upto = before[:, None] + np.cumsum(log, 1)  # logs before each edge
        place = lattices.owner(edges)
        single = lattices.first[place + 1] - lattices.first[place] == 1
        with np.errstate(divide="ignore"):
            rest = np.where(single, -np.inf, np.log(-np.expm1(lattices.log[edges].astype(float))))
        for i, (_, p) in enumerate(new):
            if p.excluded:
                rest[np.searchsorted(rows, i)] = _rest(lattices, p)
        since = np.array([p.since for _, p in new], np.int64)
        salts = np.array([(r.seed + (turn + 1) * 0x9E6C63D0876A9A47) & _ALL for r, _ in new], _U)
        noise = _gumbel(_mixed((inside + since[rows]).astype(_U)) ^ salts[rows])
        values = np.full((len(new), span), -np.inf)
        values[rows, inside] = upto[rows, inside] + rest + noise
        count = min(most, span)
        best = np.argpartition(-values, count - 1, axis=1)[:, :count]
        ranked = np.take_along_axis(values, best, 1)
        # Edges further on are below upto; none can reach the last of those found.
        whole = np.array([len(p.edges) - p.since for _, p in new]) <= span
        settled = whole | (upto[:, -1] + HIGHEST < ranked.min(1))
        for i in np.flatnonzero(settled):
            row, path = new[i]
            for j, z in zip(best[i], ranked[i], strict=True):
                if z > -np.inf:
                    below = -float(np.logaddexp(-path.value, -z))
                    taken = int(path.edges[path.since + j])
                    out = (*path.excluded, taken) if j == 0 else (taken,)
                    heapq.heappush(row.queue, (-below, (turn, int(j)), path, int(path.since + j), out))
        new = [n for n, ok in zip(new, settled, strict=True) if not ok]
        span *= 4


def _rest(lattices: Lattices, path: _Path) -> float:
    """Log probability of the edges at the branching place that no sample has taken."""
    taken = (*path.excluded, int(path.edges[path.since]))
    place = int(lattices.owner(taken[0]))
    options = range(int(lattices.first[place]), int(lattices.first[place + 1]))
    left = [lattices.log[e] for e in options if e not in taken]
    return float(np.logaddexp.reduce(left)) if left else -np.inf


def _slices(batch: pa.RecordBatch):
    sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def _laid_out(drawn: list) -> tuple[np.ndarray, list, np.ndarray]:
    """The samples drawn for each text in one row: whose each is, the samples, the pieces of all."""
    at = np.repeat(np.arange(len(drawn)), [len(d) for d in drawn])
    flat = [s for d in drawn for s in d]
    return at, flat, np.concatenate([s[0] for s in flat])


def _decodes(texts: pa.Array, *given) -> pa.Array:
    """Whether the pieces of each sample give its text, but for U+2581, which gives a blank.

    Given are the row of each sample, the samples, the pieces of all of them and the vocabulary, or the
    samples as drawn for each text and the vocabulary. The bytes of the pieces stand together
    and are compared as they are; only those that differ are decoded.
    """
    samples, flat, ids, v = given if len(given) == 4 else (*_laid_out(given[0]), given[1])
    wanted = pc.replace_substring(pc.fill_null(texts, ""), BLANK, " ").to_pylist()
    raw = [w.encode("utf-8", "surrogatepass") for w in wanted]
    pieces = v.bytes.take(pa.array(ids, pa.int32()))
    lengths = pc.binary_length(pieces).to_numpy(zero_copy_only=False)
    places = np.concatenate([[0], np.cumsum(lengths)])
    every = pieces.buffers()[2].to_pybytes() if len(pieces) else b""
    ends = places[np.cumsum([0, *[len(s[0]) for s in flat]])].tolist()
    out = []
    for i, row in enumerate(samples.tolist()):
        start, end = ends[i], ends[i + 1]
        start += every[start : min(start + 1, end)] == b" "
        out.append(every[start:end] == raw[row] or v.decode(flat[i][0].tolist()) == wanted[row])
    return pa.array(out, pa.bool_())


def _sample_batches(path: str, k: int, seed: int, sharpness: float, columns: list[str], check: bool):
    names = [*columns, "sample", "ids", "log_prob", "log_inclusion", *(["decodes"] if check else [])]

    def run(batches):
        for whole in batches:
            for batch in _slices(whole):
                drawn = sample(batch.column(1), batch.column(0).to_pylist(), path, k, seed, sharpness)
                at, flat, every = _laid_out(drawn)
                sizes = [len(s[0]) for s in flat]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.array(every, pa.int32()))
                kept = [c.take(pa.array(at)) for c in batch.columns[2:]]
                ranks = pa.array([r + 1 for d in drawn for r in range(len(d))], pa.int32())
                numbers = [pa.array([s[i] for s in flat], pa.float64()) for i in (1, 2)]
                v = vocabulary(path, sharpness)
                held = [_decodes(batch.column(1), at, flat, every, v)] if check else []
                yield pa.RecordBatch.from_arrays([*kept, ranks, ids, *numbers, *held], names)
                del drawn, flat, every, ids, kept, numbers, held
                trim()
            whole = batch = None  # not kept while the next one is read
        _kept.clear()  # the worker lives on, for tasks of other operators too
        trim()

    return run


def sampled(
    docs: DataFrame,
    model_path: str,
    k: int,
    keep: list[str],
    key: str = "doc_id",
    seed: int = SEED,
    sharpness: float = SHARPNESS,
    check: bool = False,
) -> DataFrame:
    """Distinct sampled segmentations of each row's text, at most ``k``, without replacement.

    Columns ``keep`` of the row, then sample (from 1, by falling perturbed value), ids,
    log_prob and log_inclusion: the logarithms of the segmentation's probability and of the
    chance that its value exceeds the largest one not taken. Texts with fewer segmentations
    give all of them, each with inclusion 1. Null and empty texts have one, without pieces.
    With ``check`` every sample is decoded, and ``decodes`` says whether that is the text.
    Rows with equal keys and texts get equal samples, on every run and partitioning. The
    model file must be at the same path on every machine.
    """
    names = [f"_{i}" for i in range(len(keep))]
    chosen = docs.select(
        F.xxhash64(F.col(f"`{key}`")).alias("key"),
        F.col("text"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)],
    )
    fields = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True))
    schema = f"{fields}, sample int, ids array<int>, log_prob double, log_inclusion double"
    schema += ", decodes boolean" if check else ""
    out = chosen.mapInArrow(_sample_batches(model_path, k, seed, sharpness, names, check), schema)
    return out.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "sample", "ids", "log_prob", "log_inclusion",
        *(["decodes"] if check else []),
    )


def decoded(frame: DataFrame, model_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of the pieces in ``ids``; exact, but for U+2581, which gives a blank."""

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        v = vocabulary(model_path)
        return pa.array([None if x is None else v.decode(x) for x in column.to_pylist()], pa.string())

    return frame.withColumn(name, texts(F.col(f"`{ids}`")))


def encoded(docs: DataFrame, model_path: str, name: str = "ids") -> DataFrame:
    """Add the library's own, unsampled segmentation; null counts as empty."""

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        texts = [t or "" for t in column.to_pylist()]
        return pa.array(vocabulary(model_path).model.encode(texts, num_threads=1), pa.list_(pa.int32()))

    return docs.withColumn(name, ids(F.col("text")))
