"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import byte_words, row_key, staged

GRAM = 3  # words of a seed
EXPECTED = 5.0  # a seed is rare if words drawn at random would give it at most so often
RAREST = 4  # the rarest seeds of an item serve in any case
REACH = 64  # words that an alignment may extend beyond its outermost seeds
COUNTERS = 1 << 16  # word counters, by hash; their number is fixed
FILTER_BITS = 1 << 24  # of the filter that spares most n-grams the join; its size is fixed
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5  # share of the score of a verbatim copy
_CHUNK = 1024


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def gram_hashes(hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all runs of GRAM words."""
    n, out = len(hashes) - GRAM + 1, np.zeros(max(0, len(hashes) - GRAM + 1), np.uint64)
    for i in range(GRAM):
        out = (out ^ hashes[i : i + max(n, 0)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of words in all texts, by hash; COUNTERS numbers whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(word_hashes(byte_words(text.as_py())) % COUNTERS, minlength=COUNTERS) if text.is_valid else 0
        parts = total.reshape(-1, _CHUNK)
        yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts])], ["part", "counts"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in part["counts"])
        return pd.DataFrame({"part": part["part"].iloc[:1], "counts": [total.tobytes()]})

    schema = "part int, counts binary"
    rows = docs.select(F.col("text").cast("binary")).mapInArrow(count, schema).groupBy("part").applyInPandas(add, schema)
    out = np.zeros((COUNTERS // _CHUNK, _CHUNK), np.int64)
    for row in rows.collect():  # COUNTERS numbers
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def seeds(items: DataFrame, counts: np.ndarray) -> DataFrame:
    """(seed long, item_id): the rare n-grams of every item."""
    share = np.maximum(counts, 1) / max(1, counts.sum())
    total = max(1, int(counts.sum()))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = word_hashes(byte_words(text))
                grams = gram_hashes(hashes)
                if not len(grams):
                    continue
                p = share[hashes % COUNTERS]
                expected = total * np.prod([p[i : i + len(grams)] for i in range(GRAM)], axis=0)
                rare = np.unique(grams[(expected <= EXPECTED) | (expected <= np.sort(expected)[: RAREST][-1])])
                ids += [item] * len(rare)
                found.append(rare)
            if found:
                yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64)), pa.array(ids, pa.int64())], ["seed", "item_id"])

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).mapInArrow(pick, "seed long, item_id long")


def seed_filter(found: DataFrame) -> np.ndarray:
    """One bit per hash value modulo FILTER_BITS, set where there is a seed."""
    bit = F.pmod(F.col("seed"), F.lit(FILTER_BITS))
    rows = found.select(F.floor(bit / 32).cast("int").alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # FILTER_BITS / 32 rows at most
        bits[row["at"]] = row["bits"]
    return bits


def passages(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(row_key, doc_id, start, words, found): stretches around the n-grams that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = "row_key long, doc_id long, start int, words binary, found array<long>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            rows = []
            for key, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = byte_words(text.as_py())
                grams = gram_hashes(word_hashes(words))
                at = (grams.view(np.int64) % FILTER_BITS).astype(np.int64)
                hits = np.flatnonzero(bits[at >> 5] >> (at & 31).astype(np.uint32) & 1)
                if not len(hits):
                    continue
                for part in np.split(hits, np.flatnonzero(np.diff(hits) > REACH) + 1):
                    start, end = max(0, int(part[0]) - REACH), int(part[-1]) + GRAM + REACH
                    rows.append((key, doc, start, b" ".join(words[start:end]), np.unique(grams[part]).view(np.int64)))
            if rows:
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["row_key", "doc_id", "start", "words", "found"])

    return docs.select(
        row_key(docs).alias("row_key"), F.col("doc_id").cast("long"), F.col("text").cast("binary")
    ).mapInArrow(cut, schema)


def align(item: list[bytes], passage: list[bytes]) -> tuple[float, int, int]:
    """Best local alignment of two word sequences: (share of a verbatim copy's score, start, end).

    Linear gap costs let a whole row be filled at once: a gap in the passage is a running
    maximum. The start is carried along with every cell.
    """
    names = {w: i for i, w in enumerate(dict.fromkeys(item + passage))}
    a, b = [names[w] for w in item], np.array([names[w] for w in passage], np.int32)
    m, n = len(a), len(b)
    column = np.arange(n + 1, dtype=np.int64)
    # A cell is score * width + (width - 1 - start): one maximum takes the score and, of
    # equals, the smallest start.
    width = np.int64(n + 2)
    empty = width - 1 - column
    row, best, end = empty.copy(), np.int64(0), 0
    for i in range(m):
        step = np.where(b == a[i], MATCH, MISMATCH) * width
        new = empty.copy()
        np.maximum(new[1:], row[:-1] + step, out=new[1:])
        np.maximum(new, row + GAP * width, out=new)
        new = np.maximum.accumulate(new - GAP * width * column) + GAP * width * column
        row = np.maximum(new, empty)
        top = int(row.argmax())
        if row[top] // width > best // width:
            best, end = row[top], top
    score = int(best // width)
    start = int(width - 1 - best % width) if score else end
    return score / (MATCH * max(1, m)), start, end


def contamination(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(row_key, doc_id, item_id, score, start, end) for documents that hold a benchmark item.

    ``docs`` has doc_id and text, ``items`` item_id and text. Every document is searched in
    whole. A seed that is rare by the word counts of the corpus leads to a passage, the
    passage is aligned with each item it shares a seed with, and the best alignment of an
    item counts if it reaches ``least`` of the score of a verbatim copy; start and end are
    word positions. Seeds are rare by chance, not by how many documents hold them, so a copy
    in a third of the corpus is found in all of it.

    Null and empty texts, and items of fewer than three words, give no rows. Null ids of
    documents keep their rows. Repeated rows are told apart by nothing and give one row.
    Extra columns are not read.
    """
    held = seeds(items, word_counts(docs))
    held = staged(held.distinct(), "seeds")
    cut = passages(docs, seed_filter(held)).withColumn("passage", F.xxhash64("row_key", "start", "words"))
    cut = staged(cut, "passages")
    pairs = (
        cut.select("passage", F.explode("found").alias("seed"))
        .join(held, "seed").select("passage", "item_id").distinct()
    )
    texts = items.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("item"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [align(byte_words(i), byte_words(p)) for i, p in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            scores, starts, ends = zip(*rows) if rows else ((), (), ())
            first = np.array(batch.column(3).to_pylist(), np.int64)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(scores, pa.float64()),
                 pa.array(first + np.array(starts, np.int64)), pa.array(first + np.array(ends, np.int64))],
                ["row_key", "doc_id", "item_id", "score", "start", "end"],
            )

    scored = (
        pairs.join(texts, "item_id").join(cut, "passage")
        .select("row_key", "doc_id", "item_id", "start", "item", "words")
        .mapInArrow(score, "row_key long, doc_id long, item_id long, score double, start long, end long")
    )
    best = F.max(F.struct("score", (-F.col("start")).alias("s"), (-F.col("end")).alias("e"))).alias("best")
    return (
        scored.where(F.col("score") >= least).groupBy("row_key", "doc_id", "item_id").agg(best)
        .select("row_key", "doc_id", "item_id", "best.score", (-F.col("best.s")).alias("start"), (-F.col("best.e")).alias("end"))
    )


def decontaminated(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without those that hold an item; columns and repeated rows as they are."""
    leaked = contamination(docs, items, least).select(F.col("row_key").alias("_leaked")).distinct()
    return docs.join(leaked, row_key(docs) == F.col("_leaked"), "left_anti")
