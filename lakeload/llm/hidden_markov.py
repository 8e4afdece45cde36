"""A hidden Markov language model, trained by Baum-Welch over all training documents.

Tasks turn documents into blocks of token numbers once. Word counts, by block and by the
state a document starts with, are summed by word over all blocks. Each round of Baum-Welch
then meets every block with the emissions of its words, runs the forward and backward
recursions, and returns expected counts: transitions as one row for each block, emissions of
words that other blocks have too as packed rows, one for each range of word hashes. Those are
summed by range for the next round. Words of one block only stay with the block. So no task
and not the driver ever holds the vocabulary; the driver holds the transitions.

Expected counts travel as multiples of 2^-24 of a token, so their sums over blocks are exact
in any order.

Scores come from the scaled forward recursion, in which the scales' logarithms add up to the
exact log likelihood. Starting states are clusters of letter frequencies.

A state's emissions are its expected counts, smoothed with the counts of all states. The
unknown word is a symbol of its own: its probability in a state is what the words seen once
make up there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, saved, split_words

STATES = 6
TOLERANCE = 0.001  # rounds end once one gains less log likelihood (natural) a training token
SMOOTHING = 0.2  # the share of an emission that comes from the counts of all states
STARTS = 3  # rounds that move the centres of the starting clusters
BLOCK_CHARS = 32_000_000
GROUP_TOKENS = 1_000_000  # that are run side by side
LETTERS = 32
SLICE_ROWS = 2000  # texts whose words are split side by side
START_ROUNDS = 4  # that draw candidates for the centres from all documents
START_POINTS = 64  # candidates of each round
RANGE_WORDS = 250_000  # of all blocks that one range of word hashes holds, on average
UNIT = 1 << 24  # of these make one token in expected counts


def _profile(text: str | None) -> np.ndarray:
    """Roots of the shares of letters, of other ASCII characters and of bytes beyond ASCII."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
    seen = np.bincount(raw, minlength=256).astype(np.float32)
    out = np.zeros(LETTERS, np.float32)
    out[:26] = seen[97:123]
    out[26] = seen[48:58].sum()
    out[27] = seen[33:48].sum() + seen[58:65].sum()
    out[28] = seen[91:97].sum() + seen[123:127].sum()
    out[29:32] = seen[128:176].sum(), seen[176:192].sum(), seen[192:].sum()
    return np.sqrt(out / max(out.sum(), 1.0))


def _blocks(batches):
    """Documents as numbers: one row for each block."""
    held = Block()
    part, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        for start in range(0, len(whole), SLICE_ROWS):
            held.add(whole.slice(start, SLICE_ROWS))
            if held.chars >= BLOCK_CHARS:
                yield held.row((part << 32) + number)
                held, number = Block(), number + 1
    if held.ids:
        yield held.row((part << 32) + number)


def _packed(numbers: np.ndarray, level: int = 1) -> bytes:
    """Numbers from 0 in few bytes: low bytes, then higher ones, which are mostly equal."""
    numbers = np.ascontiguousarray(numbers, np.uint64)
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    planes = numbers.view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + zstandard.compress(b"".join(plane.tobytes() for plane in planes), level)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    for place, plane in enumerate(planes):
        out[:, place] = plane
    return out.view(np.int64).ravel()


class Block:
    def __init__(self):
        self.ids, self.out, self.profiles, self.lengths = [], [], [], []
        self.words: list[pa.Array] = []  # of each slice
        self.numbers: list[np.ndarray] = []
        self.chars = 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = batch.column(1)
        words, numbers, bounds = split_words(texts)
        self.words.append(words)
        self.numbers.append(numbers)
        self.lengths += np.diff(bounds).tolist()
        self.ids += batch.column(0).to_pylist()
        self.out += batch.column(2).to_pylist()
        self.profiles += [_profile(t) for t in texts.to_pylist()]
        self.chars += int(bounds[-1]) + (pc.sum(pc.binary_length(texts)).as_py() or 0)

    def row(self, number: int) -> pa.RecordBatch:
        coded = pa.concat_arrays(self.words).dictionary_encode()
        starts = np.cumsum([0, *map(len, self.words)])
        places = np.split(coded.indices.to_numpy(), starts[1:-1])
        tokens = np.concatenate([own[numbers] for own, numbers in zip(places, self.numbers, strict=True)])
        words = coded.dictionary
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.ids], pa.list_(pa.int64())),
                pa.array([self.out], pa.list_(pa.bool_())),
                pa.array([self.lengths], pa.list_(pa.int32())),
                pa.array([_packed(tokens, 3)], pa.binary()),
                pa.array([np.stack(self.profiles).tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                pa.array([len(words)], pa.int64()),
            ],
            ["block", "doc_ids", "held_out", "lengths", "tokens", "profiles", "words", "n_words"],
        )


_BLOCK = (
    "block long, doc_ids array<long>, held_out array<boolean>, lengths array<int>,"
    " tokens binary, profiles binary, words array<string>, n_words long"
)


def _cluster(profiles: bytes, centres: np.ndarray) -> np.ndarray:
    points = np.frombuffer(profiles, np.float32).reshape(-1, LETTERS)
    return ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)).argmin(1)


def _gaps(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to the nearest centre; rounding leaves no distance to the centre itself."""
    squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    least = squares.min(1)
    return np.where(least < 1e-5, 0, least)


def _candidates(centres: np.ndarray | None, turn: int):
    """Of each block, the documents with the least keys.

    A key is a draw from an exponential law whose rate is the squared distance to the nearest
    centre. The least keys of all blocks are so a sample of all documents without
    replacement, in proportion to those distances. Draws are hashes of id and letters.
    """

    def run(batches):
        for batch in batches:
            for ids, profiles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                points = np.frombuffer(profiles, np.float32).reshape(-1, LETTERS)
                seeds = [
                    xxhash.xxh3_64_intdigest(repr(i).encode() + p.tobytes(), seed=turn)
                    for i, p in zip(ids, points, strict=True)
                ]
                draws = -np.log((np.array(seeds, np.uint64) + 0.5) / 2.0**64)
                rates = np.ones(len(points)) if centres is None else _gaps(points, centres)
                keys = np.full(len(points), np.inf)
                np.divide(draws, rates, out=keys, where=rates > 0)
                at = [k for k in np.argsort(keys, kind="stable")[:START_POINTS] if keys[k] < np.inf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at], pa.float64()), pa.array([points[k].tobytes() for k in at], pa.binary())],
                    ["key", "point"],
                )

    return run


def _drawn(blocks: DataFrame, centres: np.ndarray | None, turn: int, limit: int) -> np.ndarray:
    rows = blocks.select("doc_ids", "profiles").mapInArrow(_candidates(centres, turn), "key double, point binary")
    rows = rows.orderBy("key", "point").limit(limit).collect()
    points = [np.frombuffer(r.point, np.float32) for r in rows]
    return np.stack(points) if points else np.empty((0, LETTERS), np.float32)


def _weights(blocks: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Documents by the nearest centre."""

    def run(batches):
        for batch in batches:
            for profiles in batch.column(0).to_pylist():
                counts = np.bincount(_cluster(profiles, centres), minlength=len(centres))
                yield pa.RecordBatch.from_pydict({"at": np.arange(len(counts)), "n": counts})

    out = np.zeros(len(centres))
    rows = blocks.select("profiles").mapInArrow(run, "at long, n long")
    for r in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def starting_centres(blocks: DataFrame, states: int) -> np.ndarray:
    """Centres of letter frequencies (k-means||): far ones of all documents, then moved by all."""
    chosen = _drawn(blocks, None, 0, 1)
    if not len(chosen):
        return np.zeros((states, LETTERS), np.float32)
    for turn in range(1, START_ROUNDS + 1):
        more = _drawn(blocks, chosen, turn, START_POINTS)
        if not len(more):
            break
        chosen = np.concatenate([chosen, more])
    # A candidate counts by the documents next to it, so single outliers are not chosen.
    weights = _weights(blocks, chosen)
    centres = [chosen[int(weights.argmax())]]
    while len(centres) < states:
        centres.append(chosen[int((weights * _gaps(chosen, np.stack(centres))).argmax())])
    centres = np.stack(centres).astype(np.float32)
    for _ in range(STARTS):
        now = centres

        def sums(batches, now=now):
            for batch in batches:
                for profiles in batch.column(0).to_pylist():
                    points = np.frombuffer(profiles, np.float32).reshape(-1, LETTERS)
                    near = _cluster(profiles, now)
                    total = np.zeros((len(now), LETTERS + 1))
                    np.add.at(total, near, np.column_stack([points, np.ones(len(points))]))
                    yield pa.RecordBatch.from_pydict({"sums": [total.ravel().tolist()]})

        rows = (
            blocks.select("profiles")
            .mapInArrow(sums, "sums array<double>")
            .select(F.posexplode("sums").alias("at", "value"))
            .groupBy("at")
            .agg(F.sum("value").alias("value"))
            .collect()
        )
        total = np.zeros(states * (LETTERS + 1))
        for r in rows:
            total[r["at"]] = r["value"]
        total = total.reshape(states, LETTERS + 1)
        some = total[:, -1] > 0
        centres = centres.copy()
        centres[some] = (total[some, :-1] / total[some, -1:]).astype(np.float32)
    return centres


class Tokens:
    """The documents of one block as arrays."""

    def __init__(self, row: dict, centres: np.ndarray):
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.tokens = _unpacked(row["tokens"])
        self.train = ~np.asarray(row["held_out"], bool)
        self.state = _cluster(row["profiles"], centres)
        self.states = len(centres)

    def counts(self, words: int) -> np.ndarray:
        """Training tokens by word and starting state."""
        kind = np.repeat(np.where(self.train, self.state, self.states), self.lengths)
        cells = np.bincount(self.tokens * (self.states + 1) + kind, minlength=words * (self.states + 1))
        return cells.reshape(-1, self.states + 1)[:words, : self.states]

    def groups(self, only: np.ndarray):
        """Documents by falling length, in groups, as tokens step by step.

        Yields documents, the numbers of documents still running at each step, and the
        tokens; the last of each document is its end, -1.
        """
        starts = np.cumsum(self.lengths) - self.lengths
        docs = np.flatnonzero(only)
        docs = docs[np.argsort(-self.lengths[docs], kind="stable")]
        at = 0
        while at < len(docs):
            upto = np.cumsum(self.lengths[docs[at:]] + 1)
            end = at + max(1, int(np.searchsorted(upto, GROUP_TOKENS, side="right")))
            mine = docs[at:end]
            sizes = self.lengths[mine] + 1
            steps = np.arange(sizes[0])
            running = np.searchsorted(-sizes, -steps, side="left")
            ends = np.cumsum(running)
            doc = np.arange(int(ends[-1])) - np.repeat(ends - running, running)
            step = np.repeat(steps, running)
            inside = step < sizes[doc] - 1
            token = np.full(len(doc), -1)
            token[inside] = self.tokens[starts[mine[doc[inside]]] + step[inside]]
            yield mine, running, token
            at = end


@dataclass
class Chain:
    """What all states share: transitions, the end's counts, unknown shares and totals."""

    start: np.ndarray
    move: np.ndarray
    totals: np.ndarray  # expected tokens in each state
    ends: np.ndarray  # expected ends in each state
    once: np.ndarray  # expected tokens of words seen once
    tokens: int  # in training, ends included
    words: int  # distinct in training, the end included
    docs: int  # in training

    def emissions(self, counts: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Probabilities of words, then of the end, in each state; unknown ones share a symbol."""
        unknown = (self.once + 1) / (self.totals + 2)
        expected = np.vstack([counts, self.ends])
        seen = np.append(seen, self.docs)
        known = (1 - SMOOTHING) * expected / np.maximum(self.totals, 1e-9)
        every = (seen + 1) / max(self.tokens + self.words, 1)
        # A state without tokens has the counts of all states alone.
        known = np.where(self.totals > 1e-6, known + SMOOTHING * every[:, None], every[:, None])
        return np.where(seen[:, None] > 0, (1 - unknown) * known, unknown)


def _forward(running: np.ndarray, token: np.ndarray, emit: np.ndarray, chain: Chain, keep: bool):
    """Log likelihoods; with ``keep`` also the scaled forward values, by state, and the scales."""
    log, emit = np.zeros(running[0]), np.ascontiguousarray(emit.T)
    scales = np.empty(len(token)) if keep else None
    # Emissions of many steps are looked up at once: of all, or as far as a group of short texts goes.
    room, ends = len(token) if keep else GROUP_TOKENS, np.cumsum(running)
    first = at = 0
    now = values = None
    for step, count in enumerate(running):
        if values is None or at - first == values.shape[1]:
            upto = ends[max(int(np.searchsorted(ends, at + room, side="right")) - 1, step)]
            first, values = at, np.empty((len(emit), upto - at))
            for own, every in zip(values, emit, strict=True):
                np.take(every, token[at:upto], out=own, mode="wrap")
        before = chain.start[:, None] if now is None else chain.move.T @ now[:, :count]
        now = values[:, at - first : at - first + count]
        now *= before
        scale = now.sum(0)
        now /= scale
        log[:count] += np.log(scale)
        if keep:
            scales[at : at + count] = scale
        at += count
    return (log, values, scales) if keep else (log, None, None)


def _expected(running: np.ndarray, token: np.ndarray, emit: np.ndarray, chain: Chain, forward=None):
    """Posterior states of every token, and sums of transitions and starts.

    A state's posterior over its forecast from the token before is its emission times its scaled
    backward value. So this needs no emissions. Forecasts are above 0, as all transitions are.
    """
    _, values, _ = forward or _forward(running, token, emit, chain, True)
    moves = np.zeros_like(chain.move)
    ends = np.cumsum(running)
    after = None
    for count, end in zip(running[::-1], ends[::-1], strict=True):
        own = values[:, end - count : end]
        if after is not None:
            now = own[:, : after.shape[1]]
            ratio = after / (chain.move.T @ now)
            moves += now @ ratio.T
            now *= chain.move @ ratio
        after = own
    return values.T, moves * chain.move, values[:, : running[0]].sum(1)


def _rows(table: pa.Table) -> dict:
    return {name: table.column(name)[0].as_py() for name in table.column_names if name not in ("words", "doc_ids")}


# Counts of the words of one block and one range, by rising place. Places are given by their
# steps, words by their number among the shared words of the range. Rows without places have the
# counts of a block's other words, or sums alone.
_SHARED = (
    "part long, block long, places binary, words binary, seen binary, counts binary, sums array<double>"
)
_SHARED_KINDS = pa.schema(
    [
        *[(n, pa.int64()) for n in ("part", "block")],
        *[(n, pa.binary()) for n in ("places", "words", "seen", "counts")],
        ("sums", pa.list_(pa.float64())),
    ]
)


def _counted(data: bytes, states: int) -> np.ndarray:
    return _unpacked(data).reshape(states, -1).T


class Emissions:
    """Counts of one block's words: sums over all blocks where shared, else the block's own."""

    def __init__(self, tokens: Tokens, words: int, shared: pa.Table):
        own = tokens.counts(words)
        self.seen = own.sum(1)
        self.counts = own.astype(float)
        self.shared, kept = [], None
        alone = np.ones(words, bool)
        for row in shared.select(_SHARED_KINDS.names).to_pylist():
            if row["places"] is None:
                kept = row["counts"]
                continue
            places = np.cumsum(_unpacked(row["places"]))
            alone[places] = False
            self.seen[places] = _unpacked(row["seen"])
            self.counts[places] = _counted(row["counts"], tokens.states) / UNIT
            self.shared.append((row, places))
        self.alone = np.flatnonzero(alone)
        if kept is not None:
            self.counts[self.alone] = _counted(kept, tokens.states) / UNIT


def _learn(chain: Chain, centres: np.ndarray):
    """One block's expected counts."""
    states = len(centres)

    def run(key, block: pa.Table, shared: pa.Table) -> pa.Table:
        if not len(block):
            return _SHARED_KINDS.empty_table()
        row = _rows(block)
        tokens = Tokens(row, centres)
        known = Emissions(tokens, row["n_words"], shared)
        emit = chain.emissions(known.counts, known.seen)
        counts = np.zeros((states, row["n_words"] + 1))
        moves, starts, likelihood = np.zeros((states, states)), np.zeros(states), 0.0
        for _, running, token in tokens.groups(tokens.train):
            forward = _forward(running, token, emit, chain, True)
            likelihood += forward[0].sum()
            posterior, moved, started = _expected(running, token, emit, chain, forward)
            place = np.where(token < 0, row["n_words"], token)
            for k in range(states):
                counts[k] += np.bincount(place, posterior[:, k], minlength=counts.shape[1])
            moves += moved
            starts += started
        words = counts[:, :-1]
        once = words[:, known.seen == 1].sum(1)
        sums = np.concatenate([moves.ravel(), starts, counts.sum(1), counts[:, -1], once, [likelihood]])
        units = np.rint(words * UNIT).astype(np.int64)
        number = key[0].as_py()
        rows = [{"part": -1 - number, "block": number, "counts": _packed(units[:, known.alone]), "sums": sums.tolist()}]
        rows += [{**r, "counts": _packed(units[:, places])} for r, places in known.shared]
        return pa.Table.from_pylist(rows, _SHARED_KINDS)

    return run


def _parts(batches):
    """The rows of each part; batches come in order of parts."""
    held = []
    for batch in batches:
        for i in range(len(batch)):
            row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
            if held and row["part"] != held[0]["part"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _sum_words(states: int):
    """Words of one range numbered over all blocks, and sums of their counts."""

    def run(batches):
        for rows in _parts(batches):
            texts = pa.array([zstandard.decompress(r["texts"]) for r in rows], pa.large_binary())
            split = pc.split_pattern(texts, "\n")
            word = split.flatten().dictionary_encode().indices
            words = np.split(word.to_numpy(), split.offsets.to_numpy()[1:-1])
            size = max(int(w.max()) for w in words) + 1
            total, blocks = np.zeros((size, states), np.int64), np.zeros(size, np.int64)
            for r, own in zip(rows, words, strict=True):
                total[own] += _counted(r["counts"], states)  # a block has a word once
                blocks[own] += 1
            seen = total.sum(1)
            sums = [(seen > 0).sum(), seen.sum(), *total[seen == 1].sum(0), *total.sum(0)]
            out = [{"part": rows[0]["part"], "sums": [float(x) for x in sums]}]
            number = np.cumsum(blocks > 1) - 1
            for r, own in zip(rows, words, strict=True):
                at = np.flatnonzero(blocks[own] > 1)
                if len(at):
                    mine, places = own[at], np.cumsum(_unpacked(r["places"]))[at]
                    out.append(
                        {
                            "part": r["part"],
                            "block": r["block"],
                            "places": _packed(np.diff(places, prepend=0)),
                            "words": _packed(number[mine]),
                            "seen": _packed(seen[mine]),
                            "counts": _packed(total[mine].T * UNIT),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, _SHARED_KINDS)

    return run


def _sum_counts(states: int):
    """Each block's counts of one range replaced by the sums over all blocks."""

    def run(batches):
        for rows in _parts(batches):
            if rows[0]["places"] is not None:
                words = [_unpacked(r["words"]) for r in rows]
                total = np.zeros((max(int(w.max()) for w in words) + 1, states), np.int64)
                for r, own in zip(rows, words, strict=True):
                    total[own] += _counted(r["counts"], states)
                for r, own in zip(rows, words, strict=True):
                    r["counts"] = _packed(total[own].T)
            yield pa.RecordBatch.from_pylist(rows, _SHARED_KINDS)

    return run


def _score(chain: Chain, centres: np.ndarray):
    """Scores of the documents of one block."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(key, block: pa.Table, shared: pa.Table) -> pa.Table:
        if not len(block):
            return pa.schema(list(zip(names, kinds, strict=True))).empty_table()
        row = _rows(block)
        tokens = Tokens(row, centres)
        known = Emissions(tokens, row["n_words"], shared)
        emit = chain.emissions(known.counts, known.seen)
        seen = np.append(known.seen, chain.docs)
        base = np.log10((seen + 1) / (chain.tokens + chain.words + 1))
        out = {n: np.zeros(len(tokens.lengths)) for n in ("known", "base", "score")}
        for docs, running, token in tokens.groups(np.ones(len(tokens.lengths), bool)):
            log, _, _ = _forward(running, token, emit, chain, False)
            out["score"][docs] = log / np.log(10)
            doc = np.arange(len(token)) - np.repeat(np.cumsum(running) - running, running)
            out["known"][docs] = np.bincount(doc, seen[token] > 0, minlength=len(docs))
            out["base"][docs] = np.bincount(doc, base[token], minlength=len(docs))
        columns = [
            block.column("doc_ids").combine_chunks().flatten(),
            pa.array(~tokens.train),
            pa.array(tokens.lengths + 1, pa.int64()),
            pa.array(out["known"].astype(np.int64)),
            pa.array(out["base"]),
            pa.array(out["score"]),
        ]
        return pa.table(columns, names=names)

    return run


def _word_rows(centres: np.ndarray, ranges: int):
    """For each block and range of hashes, the words with training counts by starting state."""

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                words = batch.column("words")[i].values.cast(pa.binary())
                row = _rows(pa.Table.from_batches([batch.slice(i, 1)]))
                counts = Tokens(row, centres).counts(len(words))
                hashes = map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False))
                part = np.fromiter(hashes, np.uint64, len(words)) % np.uint64(ranges)
                order = np.argsort(part, kind="stable")
                bounds = np.unique([0, *np.flatnonzero(np.diff(part[order])) + 1, len(order)])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.take(pa.array(order)))
                texts = pc.binary_join(lists, b"\n").to_pylist()
                for at, text in zip(np.split(order, bounds[1:-1]), texts, strict=False):  # no words: no texts
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": [int(part[at[0]])],
                            "block": [row["block"]],
                            "places": [_packed(np.diff(at, prepend=0))],
                            "texts": [zstandard.compress(text, 3)],
                            "counts": [_packed(counts[at].T)],
                        }
                    )

    return run


def score(docs: DataFrame, states: int = STATES, rounds: int | None = None, held_out=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``rounds`` of Baum-Welch at most; by default as many as raise the training likelihood by
    ``TOLERANCE`` a token.
    ``held_out`` is a column that is true for rows to score but not to learn from; by
    default those whose crc32 of the id as text leaves 2 by 7 (a null id counts as the text
    ''). Null and empty texts are the end alone. Repeated rows count as often as they occur.
    Without any training row all words are unknown. Other columns are ignored.
    """
    if held_out is None:
        text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        held_out = F.crc32(text_id.cast("binary")) % 7 == 2
    given = docs.select("doc_id", "text", held_out.alias("held_out"))
    blocks = saved(given.mapInArrow(_blocks, _BLOCK), "token-blocks")
    centres = starting_centres(blocks, states)
    # Few rows with much work each: they are dealt by number, not by their size.
    tasks = max(2 * blocks.row_count, 1)
    ranges = -(-(blocks.agg(F.sum("n_words")).first()[0] or 0) // RANGE_WORDS) or 1

    words = blocks.select("block", "held_out", "lengths", "tokens", "profiles", "words").mapInArrow(
        _word_rows(centres, ranges), "part long, block long, places binary, texts binary, counts binary"
    )
    dealt = words.repartition(ranges, "part").sortWithinPartitions("part", "block")
    shared = saved(dealt.mapInArrow(_sum_words(states), _SHARED), "shared-words")
    n_words, n_tokens, *sums = _sums(shared.where("block IS NULL"), 2 + 2 * states)
    once, totals = np.array(sums).reshape(2, states)
    by_state = _training_docs(blocks, centres)
    trained = int(by_state.sum())
    moves = np.diag(totals) + (1 + totals.sum() * 1e-6) / states
    chain = Chain(
        start=(by_state + 1) / (by_state + 1).sum(),
        move=moves / moves.sum(1, keepdims=True),
        totals=totals + by_state,
        ends=by_state,
        once=once,
        tokens=int(n_tokens) + trained,
        words=int(n_words) + (trained > 0),
        docs=trained,
    )

    def met(*more):
        """Blocks with the counts of their words."""
        lean = blocks.select("block", "held_out", "lengths", "tokens", "profiles", "n_words", *more)
        of_block = shared.where("block IS NOT NULL").repartition(tasks, "block")
        return lean.repartition(tasks, "block").groupBy("block").cogroup(of_block.groupBy("block"))

    number, before = 0, -np.inf
    while trained and (rounds is None or number < rounds):
        learned = met().applyInArrow(_learn(chain, centres), _SHARED)
        dealt = learned.repartition(ranges, "part").sortWithinPartitions("part", "block")
        learned = saved(dealt.mapInArrow(_sum_counts(states), _SHARED), "expected")
        dropped(shared)  # only the last round's counts are read from here on
        shared = learned
        chain, likelihood = _updated(chain, learned, states)
        # The likelihood is that of the chain before; this round's counts are used in any case.
        number += 1
        if likelihood - before < TOLERANCE * chain.tokens:
            break
        before = likelihood
    scored = met("doc_ids").applyInArrow(
        _score(chain, centres),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(chain.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


def _sums(rows: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    rows = rows.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "value"))
    for r in rows.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out


def _training_docs(blocks: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Training documents by starting state."""

    def run(batches):
        for batch in batches:
            for out, profiles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                near = _cluster(profiles, centres)[~np.asarray(out, bool)]
                counts = np.bincount(near, minlength=len(centres))
                yield pa.RecordBatch.from_pydict({"state": np.arange(len(counts)), "n": counts})

    rows = blocks.select("held_out", "profiles").mapInArrow(run, "state long, n long")
    out = np.zeros(len(centres))
    for r in rows.groupBy("state").agg(F.sum("n").alias("n")).collect():
        out[r.state] = r.n
    return out


def _updated(chain: Chain, learned: DataFrame, states: int) -> tuple[Chain, float]:
    """The chain from the sums of all blocks, and the log likelihood of the one before."""
    sums = _sums(learned, states * states + 4 * states + 1)
    moves = sums[: states * states].reshape(states, states) + 1e-3
    start, totals, ends, once = sums[states * states : -1].reshape(4, states)
    after = Chain(
        start=(start + 1) / (start + 1).sum(),
        move=moves / moves.sum(1, keepdims=True),
        totals=totals, ends=ends, once=once,
        tokens=chain.tokens, words=chain.words, docs=chain.docs,
    )
    return after, float(sums[-1])
