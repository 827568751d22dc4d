"""Scoring texts by a hidden Markov language model trained on the corpus."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import byte_words, staged

STATES = 8
BLOCK = 1 << 22  # tokens of the documents that share a dictionary; a longer document is a block
FREQUENT = 512  # words whose neighbours give the model its starting point
TIED_ROUNDS = 1  # of Baum-Welch with one emission a class but for the frequent words, before the last with one a word
SEQUENCE = 1024  # tokens of a training sequence; longer texts are cut into several
BATCH = 1 << 20  # tokens that are worked on at once
CLASSES = 4096  # by the hash of a word's last three bytes
SHRINK = 1.0  # occurrences by which a word is taken to be spread over the states as its class is
END = b""  # the token after the last word, which no word equals
_PACKED = ["p0", "p1"]  # shares of the states, 16 bits each
_BLOCK = (
    "ids array<long>, held array<boolean>, lengths array<long>, codes binary, "
    "words array<binary>, counts array<long>"
)


def _batches(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of sequences, longest first, in groups of about BATCH tokens."""
    order = np.argsort(-lengths, kind="stable")
    cut = np.flatnonzero(np.diff(np.cumsum(lengths[order]) // BATCH)) + 1
    yield from (x for x in np.split(order, cut) if len(x))


def forward(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: tuple, keep: bool = False):
    """Scaled forward recursion, for sequences sorted from long to short.

    Returns the natural log likelihood of each sequence; with ``keep`` also the scaled
    variables and the scales, step after step.
    """
    initial, transition, emission = model
    score, kept, every = np.zeros(len(starts)), [], np.ones_like(initial)
    longest = int(lengths[0]) if len(lengths) else 0
    for t, n in enumerate(np.searchsorted(-lengths, -np.arange(longest), side="left")):
        seen = emission[codes[starts[:n] + t]]
        a = (initial if t == 0 else a[:n] @ transition) * seen  # noqa: F821
        scale = a @ every
        a /= scale[:, None]
        score[:n] += np.log(scale)
        if keep:
            kept.append((a, scale))
    return score, kept


def expected_counts(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, model: tuple):
    """Expected starts, transitions and emissions of sequences sorted from long to short."""
    initial, transition, emission = model
    _, kept = forward(codes, starts, lengths, model, keep=True)
    moves = np.zeros_like(transition)
    later, posts, seen = None, [], []
    for t in range(len(kept) - 1, -1, -1):
        a, scale = kept[t]
        b = np.ones_like(a)
        if later is not None:
            m = len(later)
            b[:m] = later @ transition.T
            moves += a[:m].T @ later
        at = codes[starts[: len(a)] + t]
        posts.append(a * b)
        seen.append(at)
        later = emission[at] * b / scale[:, None]
    post = np.concatenate(posts)
    at = np.concatenate(seen)
    uses = np.stack([np.bincount(at, post[:, k], len(emission)) for k in range(post.shape[1])], 1)
    return posts[-1].sum(0), moves * transition, uses


def blocks(rows: DataFrame) -> DataFrame:
    """Documents (doc_id, held_out, text binary) in blocks of about BLOCK tokens, one row each.

    A block has a dictionary of its words, how often training documents use each, and the
    tokens of its documents as places in the dictionary, whose first word is END.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def empty() -> None:
            nonlocal place, ids, held, parts, tokens
            place, ids, held, parts, tokens = defaultdict(None, {END: 0}), [], [], [], 0
            place.default_factory = place.__len__

        def block() -> pa.RecordBatch:
            codes, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
            counts = np.bincount(codes[~np.repeat(np.array(held, bool), lengths)], minlength=len(place))
            planes = zstandard.ZstdCompressor(level=1).compress(codes.view(np.uint8).reshape(-1, 4).T.tobytes())
            values = [ids, held, lengths, planes, list(place), counts]
            kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in _BLOCK.split(", ")])

        place, ids, held, parts, tokens = {}, [], [], [], 0
        empty()
        for batch in batches:
            for doc, out, text in zip(*(batch.column(i) for i in range(3))):
                own = byte_words(text.as_py())
                codes = np.zeros(len(own) + 1, np.uint32)
                codes[:-1] = np.fromiter(map(place.__getitem__, own), np.uint32, len(own))
                ids.append(doc.as_py())
                held.append(out.as_py())
                parts.append(codes)
                tokens += len(codes)
                if tokens >= BLOCK:
                    yield block()
                    empty()
        if ids:
            yield block()

    return rows.mapInArrow(encode, _BLOCK)


class Block(NamedTuple):
    """A row of ``blocks`` as arrays; ``found`` are the rows that ``words_of`` brought."""

    ids: pa.Array
    held: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray
    words: pa.Array
    counts: np.ndarray
    found: pa.Table | None


def _blocks(batches: Iterator[pa.RecordBatch], found: pa.Table | None = None) -> Iterator[Block]:
    for batch in batches:
        for row in batch.to_struct_array():
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["codes"].as_py()), np.uint8)
            codes = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
            held, lengths, counts = (row[c].values.to_numpy(zero_copy_only=False) for c in ("held", "lengths", "counts"))
            yield Block(row["ids"].values, held.astype(bool), lengths, codes, row["words"].values, counts, found)


def words_of(data: DataFrame, table: DataFrame) -> DataFrame:
    """(of, at, c, p0, p1): the rows of ``table`` (word, c, p0, p1) for the words at each place of a block's dictionary.

    A word is in a block's dictionary once, so no word has more than a row a block.
    """
    own = data.select(F.col("block").alias("of"), F.posexplode("words").alias("at", "word"))
    return own.join(table, "word").select("of", "at", "c", *_PACKED)


def pair_counts(data: DataFrame, top: dict[bytes, int]) -> np.ndarray:
    """How often one of the words of ``top`` follows another in training documents."""
    size = len(top)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for block in _blocks(batches):
            codes = np.array([top.get(w, -1) for w in block.words.to_pylist()], np.int64)[block.codes]
            leads = ~np.repeat(block.held, block.lengths)
            leads[np.cumsum(block.lengths) - 1] = False
            both = leads[:-1] & (codes[:-1] >= 0) & (codes[1:] >= 0)
            total += np.bincount(codes[:-1][both] * size + codes[1:][both], minlength=size * size)
        pairs = np.flatnonzero(total)
        yield pa.record_batch([pa.array(pairs), pa.array(total[pairs])], ["pair", "n"])

    counted = data.select("held", "ids", "lengths", "codes", "words", "counts").mapInArrow(count, "pair long, n long")
    found = counted.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(size, size)


def starting_point(pairs: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(initial, transition, lift) from pair counts: words share a state if the same words precede them.

    Factors P(next | word) into P(state | word) P(next | state) by EM on the fixed-size
    matrix. lift is P(word | state) among these words.
    """
    random, size = np.random.default_rng(7), len(pairs)
    if size == 0:
        return np.full(states, 1 / states), np.full((states, states), 1 / states), np.zeros((0, states))
    to, out = random.dirichlet(np.ones(states), size), random.dirichlet(np.ones(size), states)
    for _ in range(60):
        ratio = pairs / np.maximum(to @ out, 1e-300)
        to, out = to * (ratio @ out.T) + 1e-9, out * (to.T @ ratio) + 1e-12
        to /= to.sum(1, keepdims=True)
        out /= out.sum(1, keepdims=True)
    transition = 0.9 * out @ to + 0.1 / states
    return np.full(states, 1 / states), transition / transition.sum(1, keepdims=True), out.T


def pack(uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows, and how they spread over the states as 16-bit shares in two words."""
    total = uses.sum(1)
    shares = np.rint(uses / np.where(total > 0, total, 1)[:, None] * 65535).astype(np.uint16)
    return total, np.ascontiguousarray(shares).view(np.int64)


def unpack(total: np.ndarray, packed: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(packed).view(np.uint16).reshape(-1, STATES) / 65535 * total[:, None]


def _share(k: int):
    """The ``k``-th of the packed shares, 0 to 65535."""
    return F.shiftrightunsigned(_PACKED[k // 4], 16 * (k % 4)).bitwiseAND(65535)


def _packed(uses: list, j: int):
    """Column p0 or p1 from the sums of the states."""
    total = sum(uses[1:], uses[0])
    out = F.lit(0).cast("long")
    for i in range(4):
        out = out.bitwiseOR(F.shiftleft(F.round(uses[4 * j + i] / total * 65535).cast("long"), 16 * i))
    return out


def units(block: Block, top: dict[bytes, int]) -> np.ndarray:
    """The frequent words' numbers, and of other words len(top) and their class."""
    return np.array([top[w] if w in top else len(top) + word_class(w) for w in block.words.to_pylist()], np.int64)


def tied_emissions(top: dict[bytes, int], lift: np.ndarray) -> Callable[[Block], np.ndarray]:
    """Emissions over the word's share of all tokens, one for each of ``units``."""
    return lambda block: lift[units(block, top)]


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def smoothed(c: np.ndarray, uses: np.ndarray, shares: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """P(word | state) from a word's count, its expected uses by state and its class's shares.

    A word's c + 1 occurrences are spread as ``uses`` and SHRINK more, which are spread as
    ``shares``. ``sums`` are the totals of that over all words and one unknown word a class,
    so that they make a distribution.
    """
    return ((c + 1) / (c + SHRINK))[:, None] * (uses + SHRINK * shares) / sums


def learned_emissions(shares: np.ndarray, sums: np.ndarray) -> Callable[[Block], np.ndarray]:
    """Emissions of a block's words from the rows found for them; other words are unknown."""

    def emissions(block: Block) -> np.ndarray:
        c, uses = np.zeros(len(block.words)), np.zeros((len(block.words), len(sums)))
        if block.found is not None:
            at = block.found["at"].to_numpy()
            c[at] = block.found["c"].to_numpy()
            uses[at] = unpack(c[at], np.stack([block.found[p].to_numpy() for p in _PACKED], 1))
        return smoothed(c, uses, shares[[word_class(w) for w in block.words.to_pylist()]], sums)

    return emissions


def class_shares(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How the words of each class spread over the states, each word alike, and ``smoothed``'s sums."""
    kind = (F.crc32(F.expr("substring(word, -3, 3)")) % CLASSES).alias("kind")
    weight = (F.col("c") + 1) / (F.col("c") + SHRINK)
    uses = [F.col("c") * _share(k) / 65535 for k in range(STATES)]
    parts = [f(u) for f in (lambda u: u, lambda u: u / F.col("c"), lambda u: weight * u) for u in uses]
    got = np.zeros((CLASSES, 2 + len(parts)))
    for r in table.groupBy(kind).agg(F.count("*"), F.sum(weight), *(F.sum(x) for x in parts)).collect():
        got[r["kind"]] = r[1:]
    n, weights, uses, each, weighted = (got[:, 0], got[:, 1], *np.split(got[:, 2:], 3, axis=1))
    overall = (uses.sum(0) + 1) / (uses.sum(0) + 1).sum()
    shares = (each + overall) / (n + 1)[:, None]
    return shares, weighted.sum(0) + ((SHRINK * weights + 1)[:, None] * shares).sum(0)


def baum_welch(data: DataFrame, model: tuple, tied: dict[bytes, int] | None = None):
    """Counts expected under the model (initial, transition, emissions), summed over all partitions.

    Returns (initial, transition) and the expected uses: a table (word, c, p0, p1) of every
    training word, or with ``tied`` an array by ``units``. A sequence is gone through in single
    precision, finer than the shares that are kept of it; sums over batches are doubles.
    """
    initial, transition, emissions = model
    states = len(initial)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, moves = np.zeros(states), np.zeros((states, states))
        pooled = np.zeros((len(tied) + CLASSES if tied is not None else 0, states))

        def rows(kind: np.ndarray, word: pa.Array, c: np.ndarray, uses: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(kind, pa.int32()), word, pa.array(c, pa.float64()), *(pa.array(p) for p in pack(uses)[1].T)]
            return pa.record_batch(columns, ["kind", "word", "c", *_PACKED])

        for block in _blocks(batches):
            whole = np.where(block.held, 0, block.lengths)
            first = np.cumsum(block.lengths) - block.lengths
            pieces = -(-whole // SEQUENCE)
            own = np.repeat(np.arange(len(whole)), pieces)
            offset = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEQUENCE
            starts, lengths = first[own] + offset, np.minimum(whole[own] - offset, SEQUENCE)
            single, uses = [x.astype(np.float32) for x in (initial, transition, emissions(block))], np.zeros((len(block.words), states))
            for chosen in _batches(lengths):
                a, b, c = expected_counts(block.codes, starts[chosen], lengths[chosen], single)
                begun += a
                moves += b
                uses += c
            if tied is not None:
                at = units(block, tied)
                for k in range(states):
                    pooled[:, k] += np.bincount(at, uses[:, k], len(pooled))
                continue
            at = np.flatnonzero(block.counts)
            yield rows(np.full(len(at), -1), block.words.take(pa.array(at)), block.counts[at], uses[at])
        whole = np.vstack([begun, moves, pooled])
        at = np.flatnonzero(whole.sum(1))
        yield rows(at, pa.array([END] * len(at), pa.binary()), whole.sum(1)[at], whole[at])

    # A word has one row a block at most, smaller than its sums: it is exchanged first, then summed.
    counted = data.mapInArrow(count, "kind int, word binary, c double, p0 long, p1 long").repartition("kind", "word")
    names = [f"u{k}" for k in range(states)]
    found = counted.groupBy("kind", "word").agg(F.sum("c").alias("c"), *(F.sum(F.col("c") * _share(k)).alias(u) for k, u in enumerate(names)))
    found = staged(found.select("kind", "word", "c", *(_packed([F.col(u) for u in names], j).alias(p) for j, p in enumerate(_PACKED))), "uses")
    got = found.where("kind >= 0").toArrow()
    sums = np.zeros((1 + states + (len(tied) + CLASSES if tied is not None else 0), states))
    sums[got["kind"].to_numpy()] = unpack(got["c"].to_numpy(), np.stack([got[p].to_numpy() for p in _PACKED], 1))
    begun, moves = sums[0] + 1, sums[1 : 1 + states] + 1
    table = found.where("kind < 0").select("word", F.col("c").cast("long").alias("c"), *_PACKED)
    return begun / begun.sum(), moves / moves.sum(1, keepdims=True), table if tied is None else sums[1 + states :]


def scored(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the rows of ``docs`` (doc_id, text) where the column ``held_out`` is false.
    Tokens are the words, A-Z in lower case, and one end. base_score is the add-one unigram
    log10 likelihood; score is that of a hidden Markov model, computed exactly over the whole
    text. Every training word, however rare, has its own emission by each state. These are
    a table that grows with the corpus and is never sent whole: documents are put in blocks,
    and a block's dictionary is joined with the table. Training begins with emissions tied by
    class but for the FREQUENT words and ends with a round that gives each word its own, kept
    as 16-bit shares of its count. A word's emission is drawn to that of its class the less the oftener it occurs; an
    unknown word has its class's. The driver sees the frequent words, their pairs and sums by
    class and state.

    Null texts are empty and have the end alone. A row with a null ``held_out`` is trained on.
    Repeated rows count and are scored as often as they occur. A text of any length is scored
    whole; one longer than BLOCK tokens is a block of its own. Words of equal count have equal
    rights but for the FREQUENT first, where ties go by the word. Without training rows every
    token is unknown and both scores are those of the smoothing alone. An empty table gives
    no rows; extra columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    data = staged(blocks(rows).withColumn("block", F.monotonically_increasing_id()), "blocks")
    used = data.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).where("w.counts > 0")
    counts = staged(used.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("c")), "word-counts")
    total, kinds = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).head())
    frequent = counts.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    top = {bytes(r["word"]): i for i, r in enumerate(frequent)}
    initial, transition, lift = starting_point(pair_counts(data, top), STATES)
    shares = np.array([r["c"] for r in frequent], float)[:, None] / max(total, 1)
    lift = np.vstack([0.9 * lift * shares.sum() / np.maximum(shares, 1e-300) + 0.1, np.ones((CLASSES, STATES))])
    for _ in range(TIED_ROUNDS):
        initial, transition, uses = baum_welch(data, (initial, transition, tied_emissions(top, lift)), top)
        overall = (uses.sum(0) + 1) / (uses.sum(0) + 1).sum()
        lift = (uses + overall) / (uses.sum(1, keepdims=True) + 1) / overall
    initial, transition, table = baum_welch(data, (initial, transition, tied_emissions(top, lift)))
    emissions = learned_emissions(*class_shares(table))
    below = float(np.log10(total + kinds + 1))

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for block in _blocks(rows.to_batches(), found):
            emission, c = emissions(block), np.zeros(len(block.words))
            c[found["at"].to_numpy()] = found["c"].to_numpy()
            starts = np.cumsum(block.lengths) - block.lengths
            likelihood = np.zeros(len(starts))
            for chosen in _batches(block.lengths):
                likelihood[chosen] = forward(block.codes, starts[chosen], block.lengths[chosen], (initial, transition, emission))[0]
            base = np.add.reduceat(np.log10(c + 1)[block.codes], starts) - block.lengths * below
            known = np.add.reduceat((c > 0).astype(np.int64)[block.codes], starts)
            columns = [block.ids, pa.array(block.held), pa.array(block.lengths), pa.array(known), pa.array(base), pa.array(likelihood / np.log(10))]
            out.append(pa.record_batch(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        return pa.Table.from_batches(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    # Words come to their block as sorted rows, one block at a time: no list of them is built in the heap.
    seen = data.groupBy("block").cogroup(words_of(data, table).groupBy("of")).applyInArrow(score, schema)
    return seen.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
