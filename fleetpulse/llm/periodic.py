"""Periodic runs of words: longest common extensions over a difference cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A perfect difference set: every difference modulo 31 occurs between two of its members,
# so of any two positions a common shift below 31 leads to two sampled ones.
CYCLE = 31
COVER = (1, 5, 11, 24, 25, 27)
LEAST_LENGTH = 24  # words of a run
LEAST_EXPONENT = 3  # repetitions of its period
PAIRS = 1 << 20  # grid points looked at together


def _shifts() -> np.ndarray:
    """[i mod CYCLE, j mod CYCLE] -> the least shift that brings both onto the cover."""
    sampled = np.isin(np.arange(2 * CYCLE) % CYCLE, COVER)
    out = np.zeros((CYCLE, CYCLE), np.int64)
    for i in range(CYCLE):
        for j in range(CYCLE):
            out[i, j] = np.flatnonzero(sampled[i : i + CYCLE] & sampled[j : j + CYCLE])[0]
    return out


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions of pairs of positions of a sequence of positive numbers.

    A query compares the few words up to the next two sampled positions. Only if they agree,
    the rest is the range minimum over the neighbours' common prefixes in the order of the
    sampled suffixes. That order and its sparse table are built when first asked for.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        # Zeros after the end differ from every word, so an extension stops there.
        self.values = np.concatenate([values, np.zeros(2 * CYCLE + 1, values.dtype)])
        self.table: list[np.ndarray] | None = None

    def _sort_samples(self) -> None:
        """Ranks the suffixes at sampled positions by doubling over blocks of CYCLE words."""
        classes = [np.arange(d, self.n + 1, CYCLE) for d in COVER]
        at = np.concatenate(classes)
        ends = np.cumsum([len(c) for c in classes])
        left = np.concatenate([np.arange(len(c), 0, -1) for c in classes])  # blocks to the end of the class
        windows = np.lib.stride_tricks.sliding_window_view(self.values, CYCLE)
        blocks = np.ascontiguousarray(windows[at])
        # The last block of each class holds zeros from another place on, so it is like no other.
        rank = np.unique(blocks.view(f"V{blocks.dtype.itemsize * CYCLE}").ravel(), return_inverse=True)[1].ravel()
        m, levels = len(at), [rank.astype(np.int64)]
        while m and levels[-1].max() + 1 < m:
            step, rank = 1 << (len(levels) - 1), levels[-1]
            later = np.where(left > step, rank[np.minimum(np.arange(m) + step, m - 1)] + 1, 0)
            levels.append(np.unique(rank * (m + 1) + later, return_inverse=True)[1].ravel())
        order = np.argsort(levels[-1])
        x, y = order[:-1].copy(), order[1:].copy()
        start = x.copy()
        for k in range(len(levels) - 2, -1, -1):
            moved = (levels[k][x] == levels[k][y]) << k
            x, y = x + moved, y + moved
        shared = (x - start) * CYCLE
        for a in range(0, len(x), 1 << 16):
            part = slice(a, a + (1 << 16))
            shared[part] += (blocks[x[part]] != blocks[y[part]]).argmax(1)
        self.rank, self.table = levels[-1], [shared]
        self.class_first = np.zeros(CYCLE, np.int64)
        self.class_first[list(COVER)] = [0, *ends[:-1]]
        width = 1
        while 2 * width <= len(shared):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _rank_at(self, position: np.ndarray) -> np.ndarray:
        return self.rank[self.class_first[position % CYCLE] + position // CYCLE]

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, for positions i < j <= n."""
        shift = SHIFTS[i % CYCLE, j % CYCLE]
        length, open_ = np.zeros(len(i), np.int64), np.arange(len(i))
        reached = []
        for t in range(CYCLE):
            there = shift[open_] == t
            reached.append(open_[there])
            open_ = open_[~there]
            if not len(open_):
                break
            same = self.values[i[open_] + t] == self.values[j[open_] + t]
            length[open_[~same]] = t
            open_ = open_[same]
        synchronised = np.concatenate(reached)
        if not len(synchronised):
            return length
        if self.table is None:
            self._sort_samples()
        s = shift[synchronised]
        a, b = self._rank_at(i[synchronised] + s), self._rank_at(j[synchronised] + s)
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            of = level == k
            row = self.table[k]
            length[synchronised[of]] = s[of] + np.minimum(row[low[of]], row[high[of] - (1 << k)])
        return length


def grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, period): the harmonic grid of n words, in portions.

    A run of period q holds at least max(LEAST_LENGTH, LEAST_EXPONENT * q) - q neighbouring
    places whose word is repeated q later, so one of them is a multiple of that number.
    """
    periods = np.arange(1, n // LEAST_EXPONENT + 1)
    step = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * periods) - periods
    points = -(-(n - periods) // step)
    upto = np.cumsum(points)
    a = 0
    while a < len(periods):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
        count = points[a:b]
        q = np.repeat(periods[a:b], count)
        place = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        yield place * np.repeat(step[a:b], count), q
        a = b


def find_runs(values: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs of positive numbers, by start and period.

    Each grid point whose word is repeated one period later is extended to both sides.
    Multiples of a period give the same stretch again; its smallest period is kept.
    """
    n, found = len(values), []
    if n < LEAST_LENGTH:
        return np.zeros((0, 3), np.int64)
    ahead, back = Extensions(values), Extensions(values[::-1])
    for i, q in grid(n):
        same = np.flatnonzero(values[i] == values[i + q])
        i, q = i[same], q[same]
        before = back(n - i - q, n - i)
        length = before + ahead(i, i + q) + q
        run = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q)
        found.append(np.stack([(i - before)[run], length[run], q[run]], 1))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside of any run's repetitions, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text).

    A run is a stretch of words with a smallest period q (words q apart are identical), of
    at least 24 words and three times q, that no neighbouring word extends. ``runs`` lists
    all of a text's by start, then period; ``collapsed`` is the text without what repeats:
    a word goes if some run contains it after that run's first q words. Runs may overlap.

    One pass, nothing shuffled: a text is a row and is read whole, however long. Work grows
    with n log n in its words and memory with n, as grid points are taken in portions. Null
    and empty texts have no runs and an empty ``collapsed``; null ids and repeated rows stay
    as they are; an empty table gives no rows; no other column is read, so names cannot clash.
    """
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, texts = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or b"").split()
                numbers = {w: k for k, w in enumerate(dict.fromkeys(words), 1)}
                rows = find_runs(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                counts.append(len(words))
                found.append(rows)
                texts.append(collapsed(words, rows))
            rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], fields=list(item))
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), runs),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
