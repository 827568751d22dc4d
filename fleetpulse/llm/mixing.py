"""Mixing sources to target weights: balanced sampling by the cube method."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import row_key, staged, word_count

WEIGHTS = (1, 2, 3)  # dealt to the sources in order, again and again
MOST_COPIES = 3
BLOCK = 4096  # units that one flight moves
NEAR = 1e-9  # a probability so close to 0 or 1 is that
FEW = 16  # undecided units of a source of which the landing tries every choice
PAIRED = 256  # units whose pairs the landing tries with each other unit
EQUAL_ROWS = 65536  # of a set of equal rows, so many at most are one unit


def flight(size: np.ndarray, prob: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Moves probabilities to 0 or 1 until two at most are left between.

    Sum of prob and sum of prob * size stay as they are: three undecided units at a time
    move along the null space of the two constraints, up or down at random and as far as
    the first of them is decided, so that every unit keeps its expectation.
    """
    prob, waiting = prob.copy(), []
    for unit in np.flatnonzero((prob > NEAR) & (prob < 1 - NEAR)).tolist():
        waiting.append(unit)
        while len(waiting) == 3:
            a, b, c = size[waiting].tolist()
            way = np.array((c - b, a - c, b - a)) if not a == b == c else np.array((1.0, -1.0, 0.0))
            way = way / np.abs(way).max()
            p = prob[waiting]
            with np.errstate(divide="ignore", invalid="ignore"):
                up = np.where(way > 0, (1 - p) / way, np.where(way < 0, -p / way, np.inf)).min()
                down = np.where(way < 0, (p - 1) / way, np.where(way > 0, p / way, np.inf)).min()
            p = p + up * way if random.random() * (up + down) < down else p - down * way
            p[p < NEAR], p[p > 1 - NEAR] = 0, 1
            prob[waiting] = p
            waiting = [u for u in waiting if 0 < prob[u] < 1]
    return prob


def landing(size: np.ndarray, start: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Decides the two units at most that a flight leaves, nearest to the total of ``start``.

    A very large document stays undecided to the end and cannot be met by the other unit.
    So units of the same flight are then turned over: the one, two or three that together
    bring the total nearest, as long as it comes nearer. Of few units every choice is tried.
    """
    prob = prob.copy()
    free, left = np.flatnonzero((start > NEAR) & (start < 1 - NEAR)), np.flatnonzero((prob > NEAR) & (prob < 1 - NEAR))
    want = float((size * start).sum())
    choices = [np.array([k >> i & 1 for i in range(len(left))], float) for k in range(2 ** len(left))]
    prob[left] = min(choices, key=lambda x: abs(float((size[left] * (x - prob[left])).sum())))
    while len(free):
        gap = want - float((size * prob).sum())
        turn = exchange(size[free] * (1 - 2 * prob[free]), gap)
        if not len(turn):
            break
        prob[free[turn]] = 1 - prob[free[turn]]
    return prob


def exchange(change: np.ndarray, gap: float) -> np.ndarray:
    """Up to three units (all, where there are few) whose changes add up nearest to ``gap``.

    Empty if none comes nearer than leaving all as they are. Sums of two are sorted and
    searched; a third is tried with the pairs of PAIRED units, taken evenly from all sizes.
    """
    n, none = len(change), np.zeros(0, np.int64)
    if n <= FEW:
        masks = np.arange(1 << n)
        sums = ((masks[:, None] >> np.arange(n) & 1) * change).sum(1)
        best = int(np.abs(gap - sums).argmin())
        return np.flatnonzero(best >> np.arange(n) & 1) if abs(gap - sums[best]) < abs(gap) - 0.5 else none

    def nearest(values: np.ndarray, wanted: np.ndarray, clash) -> tuple[float, int, int]:
        """(miss, position in wanted, position in values), values being sorted."""
        at = np.searchsorted(values, wanted)
        found = (np.inf, 0, 0)
        for step in (-2, -1, 0, 1):
            there = np.clip(at + step, 0, len(values) - 1)
            miss = np.where(clash(there), np.inf, np.abs(wanted - values[there]))
            k = int(miss.argmin())
            found = min(found, (float(miss[k]), k, int(there[k])))
        return found

    order = np.argsort(change, kind="stable")
    one = int(np.abs(gap - change).argmin())
    tries = [(abs(gap - change[one]), [one])]
    ranked, each = change[order], np.arange(n)
    miss, i, j = nearest(ranked, gap - change, lambda there: order[there] == each)
    tries.append((miss, [i, int(order[j])]))
    some = order[np.unique(np.linspace(0, n - 1, min(n, PAIRED)).astype(np.int64))]
    first, second = np.triu_indices(len(some), 1)
    first, second = some[first], some[second]
    by_sum = np.argsort(change[first] + change[second], kind="stable")
    first, second = first[by_sum], second[by_sum]
    miss, i, j = nearest(change[first] + change[second], gap - change, lambda there: (first[there] == each) | (second[there] == each))
    tries.append((miss, [i, int(first[j]), int(second[j])]))
    miss, turn = min(tries, key=lambda t: (t[0], len(t[1])))
    return np.array(turn) if miss < abs(gap) - 0.5 else none


def _fly(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["order", "row_key", "chunk", "doc_id", "size"], ignore_index=True)
    size, prob = group["size"].to_numpy(float), group["prob"].to_numpy(float)
    random = np.random.default_rng([int(group["seed"].iloc[0]) % 2**32, len(group)])
    prob = flight(size, prob, random)
    if group["last"].iloc[0]:
        prob = landing(size, group["prob"].to_numpy(float), prob)
    return group.assign(prob=prob)


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, units, target) from rows (source, size, equal), equal counting copies.

    Sources in order of code point, null last, take the weights in turn and share the sum
    of all sizes; a target stops at three times its source's size and what is over is shared
    again by weight among the rest, until none is above. Nothing is gathered on the driver
    but sums.
    """
    spark = sizes.sparkSession
    totals = staged(sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("equal")).alias("source_size"), F.sum(F.ceil(F.col("equal") / EQUAL_ROWS)).alias("units")
    ), "sources")
    ordered = totals.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    rows = ordered.map(lambda x: (*x[0], WEIGHTS[x[1] % len(WEIGHTS)]))
    weighted = staged(spark.createDataFrame(rows, "source string, source_size long, units long, weight long"), "weights")
    total, all_weights = weighted.agg(F.sum("source_size"), F.sum("weight")).head()
    rest, weights, stopped = total or 0, all_weights or 1, -1
    while True:
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(max(weights, 1)))
        over = share > MOST_COPIES * F.col("source_size")
        count, taken, weight = weighted.where(over).agg(F.count("*"), F.sum("source_size"), F.sum("weight")).head()
        if count == stopped:
            return weighted.withColumn("target", F.when(over, MOST_COPIES * F.col("source_size")).otherwise(share).cast("double"))
        rest, weights, stopped = (total or 0) - MOST_COPIES * (taken or 0), (all_weights or 1) - (weight or 0), count


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, source, size, source_size, target, copies, taken) for every row.

    A source's rate is target / size of the source. Each document is taken floor(rate)
    times, and once more with the fraction as its probability, decided by the cube method:
    the source is cut into blocks of some thousand units, flights in each leave two
    units, which fly again with those of other blocks until one block a source is left,
    where the last two are rounded, and a few others turned over, towards the number of words.
    Documents and words of a source are thus met up to the landing.

    Choices follow from a row's content and a fixed seed, so reruns agree, whatever the ids
    and the partitioning. Equal rows are interchangeable: a set of them (in portions of
    EQUAL_ROWS) is one unit, of which the whole part of rows times fraction is taken for
    certain. A hot source, id or row only has more units or blocks.

    Null texts have size 0; a null source is a source; null ids and repeated rows are taken
    like others; ties of size change nothing; the length of a text only counts as its size;
    an empty table gives no rows. Only doc_id, source and text are read by name, all columns
    by the row's key, so names cannot clash.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("row_key"),
        "source", word_count(F.col("text")).alias("size"),
    )
    sized = staged(sized.groupBy("doc_id", "row_key", "source", "size").agg(F.count("*").alias("equal")), "sizes")
    targets = staged(source_targets(sized), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    portion = F.least(F.lit(EQUAL_ROWS), F.col("equal") - EQUAL_ROWS * F.col("chunk"))
    wanted = F.col("rows") * F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))
    blocks = F.ceil(F.col("units") / BLOCK).cast("long")
    units = (
        sized.withColumnRenamed("source", "own")
        .join(targets, F.col("own").eqNullSafe(F.col("source")))
        .withColumn("rate", F.least(rate, F.lit(float(MOST_COPIES))))
        .withColumn("base", F.floor(F.col("rate") + NEAR).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("equal") - 1) / EQUAL_ROWS).cast("int"))))
        .withColumn("rows", portion.cast("int"))
        .withColumn("sure", F.floor(wanted + NEAR).cast("int"))
        .select(
            "doc_id", "row_key", "chunk", "source", "size", "source_size", "target", "base", "rows", "sure",
            F.greatest(wanted - F.col("sure"), F.lit(0.0)).alias("prob"),
            F.xxhash64("row_key", "chunk", F.lit(1)).alias("order"),
            F.pmod(F.xxhash64("row_key", "chunk", F.lit(2)), blocks).alias("block"), blocks.alias("blocks"),
        )
    )
    decided, blocks = [], targets.agg(F.max(F.ceil(F.col("units") / BLOCK))).head()[0] or 1
    while True:
        flown = units.select(
            "*", F.xxhash64("source", "block", "blocks").alias("seed"), (F.col("blocks") <= 1).alias("last")
        )
        schema = flown.schema
        flown = staged(flown.groupBy("source", "block").applyInPandas(_fly, schema), "flown").drop("seed", "last")
        open_ = (F.col("prob") > 0) & (F.col("prob") < 1) & (F.col("blocks") > 1)
        decided.append(flown.where(~open_))
        if blocks <= 1:
            break
        merge = BLOCK // 2  # blocks of two units each that make a new block
        units = flown.where(open_).withColumn("block", F.floor(F.col("block") / merge).cast("long")).withColumn(
            "blocks", F.ceil(F.col("blocks") / merge).cast("long")
        )
        blocks = -(-blocks // merge)
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    more = F.when(F.col("_number") <= F.col("sure") + F.round("prob"), 1).otherwise(0)
    out = out.withColumn("_number", F.explode(F.sequence(F.lit(1), F.col("rows")))).withColumn("copies", (F.col("base") + more).cast("int"))
    return out.select(
        "doc_id", "row_key", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def take(docs: DataFrame) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken, with ``copy`` from 1.

    Equal rows are folded before the join and given back their copies.
    """
    copies = mix(docs).groupBy("row_key").agg(F.sum("copies").cast("int").alias("_copies"))
    names = docs.columns
    rows = docs.select(row_key(docs).alias("row_key"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))
    rows = rows.groupBy("row_key").agg(F.first("_row").alias("_row")).join(copies.where("_copies > 0"), "row_key")
    return rows.select("_row.*", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
