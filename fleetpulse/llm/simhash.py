"""Near-duplicate groups by SimHash, found with covering-code anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetpulse.llm.common import byte_words, components, row_key, shuffle_partitions, staged

HALF = 32  # a fingerprint is covered as two halves by the product of two equal codes
SMALLEST, LARGEST = 6, 16  # dimensions of the half code, from first order to all quadratic forms
HOMES_PER_ANCHOR = 32  # the code grows until an anchor is home to about so many fingerprints
HOMES_PER_TASK = 4096  # an anchor that is home to more is compared in several tasks
REDUCTION = 0b100101  # x^5 + x^2 + 1, the field of 32 elements


def fingerprint(text: bytes | None, size: int, seed: int = 42) -> int:
    """64 majority bits over the XXH64 of the word shingles; 0 without words.

    A text shorter than ``size`` words is one shingle.
    """
    w = byte_words(text)
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(size)))) if len(w) > size else [b" ".join(w)]
    digests = b"".join([xxhash.xxh64_digest(g, seed) for g in grams])
    n, ones = len(digests) // 8, np.zeros(64, np.int64)
    hashes = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for at in range(0, n, 65536):
        ones += np.unpackbits(hashes[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, row_key, fp long) for every document; one pass, nothing shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "row_key", "fp"])

    return docs.select(
        F.col("doc_id").cast("long"), row_key(docs).alias("row_key"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(run, "doc_id long, row_key long, fp long")


def _product(a: int, b: int) -> int:
    """In the field of 32 elements."""
    out = 0
    while b:
        out ^= a if b & 1 else 0
        a = a << 1 ^ (REDUCTION if a & 16 else 0)
        b >>= 1
    return out


def _trace(a: int) -> int:
    total = power = a
    for _ in range(4):
        power = _product(power, power)
        total ^= power
    return total


def anchors(dimension: int) -> np.ndarray:
    """The 2**dimension words of a nested family of even-weight codes of length 32.

    The functions 1, Tr(ax), Tr(ax^3), Tr(ax^5) over the field of 32 elements, taken in this
    order: six span the first-order code, all sixteen the second-order one.
    """
    cubes = [_product(x, _product(x, x)) for x in range(32)]
    fifths = [_product(_product(x, x), c) for x, c in enumerate(cubes)]
    rows = [2**32 - 1]
    for values in (range(32), cubes, fifths):
        rows += [sum(_trace(_product(1 << i, v)) << x for x, v in enumerate(values)) for i in range(5)]
    code = np.zeros(1, np.uint32)
    for row in rows[:dimension]:
        code = np.concatenate([code, code ^ np.uint32(row)])
    return code


def code_dimension(count: int) -> int:
    """Of the half code, for so many fingerprints. It decides the work, never the result."""
    k = SMALLEST
    while k < LARGEST and count > HOMES_PER_ANCHOR << (2 * k):
        k += 1
    return k


def replicas(fps: np.ndarray, code: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of fingerprint, anchor, is home) for all anchors that each is copied to.

    The home is the nearest anchor, the first of equals, at distance r. Copies go to all
    anchors within r + threshold. Of two fingerprints at most ``threshold`` apart, the one
    with the smaller r has its home within that reach of the other, so they always meet.
    """
    size = len(code)
    high, low = (fps >> np.uint64(32)).astype(np.uint32), fps.astype(np.uint32)
    dh = np.bitwise_count(high[:, None] ^ code[None]).astype(np.int16)
    dl = np.bitwise_count(low[:, None] ^ code[None]).astype(np.int16)
    home = dh.argmin(1) * size + dl.argmin(1)
    # All words are even, so within one half every distance has the same parity.
    eh, el = dh - dh.min(1, keepdims=True), dl - dl.min(1, keepdims=True)
    who, where = [], []
    for reach in range(threshold + 1):
        i, a = np.nonzero(eh == reach)
        if not len(i):
            continue
        near = el[i] <= threshold - reach
        j, b = np.nonzero(near)
        who.append(i[j])
        where.append(a[j] * size + b)
    i, a = np.concatenate(who), np.concatenate(where)
    return i, a, a == home[i]


def spanning(homes: np.ndarray, members: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Edges that connect whatever the pairs (home, member) within the threshold connect.

    At most one edge a member, whatever the number of pairs; pairs are tested in blocks.
    """
    fps = np.concatenate([homes, members])
    label, n = np.arange(len(fps)), len(homes)
    rows = max(1, (1 << 20) // max(1, len(members)))
    for at in range(0, n, rows):
        near = np.bitwise_count(homes[at : at + rows, None] ^ members[None]) <= threshold
        for i in np.flatnonzero(near.any(1)):
            group = label[np.append(np.flatnonzero(near[i]) + n, at + i)]
            if (group != group[0]).any():
                label[np.isin(label, group)] = group.min()
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return [(a, b) for a, b in zip(fps[moved].tolist(), fps[label[moved]].tolist()) if a != b]


def links(distinct: DataFrame, threshold: int) -> DataFrame:
    """Edges (u, v) over the fingerprints of ``distinct`` (fp), whose components are those of
    all pairs at most ``threshold`` bits apart."""
    spark = distinct.sparkSession
    code = anchors(code_dimension(distinct.count()))
    groups = max(64, 4 * shuffle_partitions(spark))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(64, (1 << 21) // len(code))
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), step):
                i, anchor, home = replicas(fps[at : at + step], code, threshold)
                yield pa.record_batch(
                    [pa.array(anchor.astype(np.int64)), pa.array(fps[at : at + step][i].view(np.int64)), pa.array(home)],
                    ["anchor", "fp", "home"],
                )

    copied = distinct.select("fp").mapInArrow(copies, "anchor long, fp long, home boolean")
    # An anchor in the midst of very many near fingerprints: its homes are dealt over several
    # tasks, each of which sees all members.
    crowded = (
        copied.where("home").groupBy("anchor").count().where(F.col("count") > HOMES_PER_TASK)
        .select("anchor", F.ceil(F.col("count") / HOMES_PER_TASK).cast("int").alias("shares"))
    )
    dealt = (
        copied.join(crowded, "anchor", "left")
        .withColumn("shares", F.coalesce("shares", F.lit(1)))
        .withColumn("own", F.when(F.col("home"), F.pmod(F.xxhash64("fp"), F.col("shares"))).cast("int"))
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .select(
            "anchor", "fp", "share", (F.col("share") == F.coalesce("own", F.lit(-1))).alias("home"),
            F.pmod(F.xxhash64("anchor", "share"), F.lit(groups)).alias("part"),
        )
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        anchor, fp = frame["anchor"].to_numpy(), frame["fp"].to_numpy().view(np.uint64)
        share, home = frame["share"].to_numpy(), frame["home"].to_numpy()
        order = np.lexsort((share, anchor))
        anchor, fp, share, home = anchor[order], fp[order], share[order], home[order]
        edge = np.flatnonzero((anchor[1:] != anchor[:-1]) | (share[1:] != share[:-1])) + 1
        found = []
        for a, b in zip([0, *edge], [*edge, len(fp)]):
            if b - a > 1 and home[a:b].any():
                found += spanning(fp[a:b][home[a:b]], fp[a:b], threshold)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    return dealt.groupBy("part").applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, size: int = 3, threshold: int = 3) -> DataFrame:
    """(doc_id, row_key, fp long, root, component_id) for every row of ``docs`` (doc_id, text).

    Documents whose fingerprints differ in at most ``threshold`` bits are linked, and
    component_id is the smallest doc_id of those reachable. Equal fingerprints are folded
    into one before anything is compared, so a group of copies of any size costs one row.
    Documents without words, null texts among them, share fingerprint 0. A null doc_id
    keeps its row and is never a component_id; a component of such rows alone has a null.
    Repeated rows stay as they are. An empty table gives an empty result.
    """
    fps = staged(fingerprints(docs, size), "fingerprints")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(distinct, threshold)).withColumnRenamed("u", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(lowest, "root").select("fp", "root", "component_id")
    return fps.join(labels, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def distinct_documents(docs: DataFrame, size: int = 3, threshold: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: the one with the smallest doc_id.

    Of rows with that id, or of rows without any, the one with the smallest row key stays;
    of equal rows one.
    """
    return first_of_groups(docs, near_duplicates(docs, size, threshold))


def one_of_equals(docs: DataFrame) -> DataFrame:
    """One of each set of equal rows of ``docs``, with its row key as _row."""
    numbered = docs.withColumn("_row", row_key(docs))
    return numbered.withColumn("_copy", F.row_number().over(Window.partitionBy("_row").orderBy("_row"))).where("_copy = 1")


def first_of_groups(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id for each root in ``found`` (doc_id, row_key, root)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row_key")).alias("first")
    keep = found.groupBy("root").agg(first).select(F.col("first.row_key").alias("_key"))
    once = one_of_equals(docs)
    return once.join(keep, F.col("_row") == F.col("_key"), "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
