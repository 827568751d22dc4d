"""Toxicity by a weighted lexicon: folded text, Aho-Corasick, evidence against length."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import staged

SAMPLE = 16384  # labelled rows of each class, at most, from which terms and weights are learned
SHORTEST, LONGEST = 3, 8  # letters of a learned word beginning
LEAST_CONTEXTS = 5  # different neighbourhoods in which a learned term must be seen in toxic texts
LEAST_SHARE = 0.01  # and per toxic text of the sample, so that their number is bounded
LEAST_RATIO = 8.0  # how much more often than in other texts a term must occur
TRUST = 10.0  # occurrences that the given weight of a lexicon entry is worth
WIDEST = 40.0  # of the evidence, before it is turned into a score
STEP = 0.25  # of the evidence, in calibration
THRESHOLD = 0.7
DEFAULT = (-2.0, 1.0)  # of the calibration, where nothing is labelled

# Insults with their given weight, the logarithm of how much oftener toxic text has them.
LEXICON = {
    3.0: "clown fool loser pathetic stupid trash dumb disgusting worthless creep ugly freak dumm blöd bête nul tonto feo",
    4.5: "idiot moron scum imbecile retard jerk bastard vermin parasite idiota imbécil estúpido basura asqueroso imbécile crétin abruti ordure "
         "connard salaud trottel depp arschloch abschaum dreckskerl widerlich wertlos",
    6.0: "bitch asshole whore slut faggot cunt fuck fucking motherfucker hurensohn wichser schlampe puta cabrón gilipollas pute enculé salope",
}
# Within these a lexicon word insults nobody.
EXCEPTIONS = (
    "class clown", "clown fish", "clown car", "trash can", "trash bin", "taking out the trash", "sore loser", "the loser bracket",
    "pond scum", "soap scum", "dumb luck", "dumb bell", "fool proof", "april fool", "ugly duckling", "freak accident", "worthless check",
    "idiot proof", "stupid question", "vermin control",
)
# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = str.maketrans(
    "абвгдеёзікмнорстуухѕјһԁԛԝ" "αβεηικνορτυχω" "ıɩɡɑⅼ",
    "a6brgee3ikmhopctyyxsjhdqw" "abenikvoptuxw" "iigal",
)
DIGITS = str.maketrans("013457@$", "oieastas")
_DIGIT = re.compile(r"[013457@$]+(?=[^\W\d_])|(?<=[^\W\d_])[013457]+")
_RARE = re.compile(r"[013457@$]")


class _Letters(dict):
    """Translation table: a letter to its plain form, a mark or format sign to nothing, else a blank."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        category = unicodedata.category(c)
        if category in ("Mn", "Cf"):
            plain = ""
        else:
            base = "".join(x for x in unicodedata.normalize("NFKD", c.translate(HOMOGLYPHS)).lower() if unicodedata.category(x)[0] == "L")
            plain = base.translate(HOMOGLYPHS) or " "
        self[code] = plain
        return plain


_LETTERS = _Letters()


def fold(text: str | None) -> list[str]:
    """Words of a text in plain small letters.

    Look-alike letters, accents and full-width forms become Latin letters, digits and signs
    beside a letter the letters they stand for; what else is no letter parts words.
    """
    if not text:
        return []
    text = text.lower()
    if _RARE.search(text):
        text = _DIGIT.sub(lambda m: m.group().translate(DIGITS), text)
    return text.translate(_LETTERS).split()


def given_weights() -> dict[str, float]:
    """Lexicon terms, " word ", with their given weights."""
    return {f" {' '.join(fold(w))} ": weight for weight, words in LEXICON.items() for w in words.split()}


def _bounded_sample(labelled: DataFrame) -> DataFrame:
    """(doc_id, toxic) of at most SAMPLE rows of each class, the first by a hash of the id."""
    some = [
        labelled.where(F.col("toxic") == flag).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for flag in (True, False)
    ]
    return some[0].union(some[1])


def word_counts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(word, toxic, others): in how many neighbourhoods toxic texts of the sample have a word,
    and how often others have it.

    A pair of neighbours counts once in all toxic texts, so that copies and near copies of
    one text are no evidence for its words.
    """
    known = F.broadcast(sample.select(F.col("doc_id").alias("_id"), "toxic"))  # 2 * SAMPLE rows at most
    texts = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id")).select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts: set[tuple[str, int]] = set()
            others: Counter[str] = Counter()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = fold(text.as_py())
                if toxic:
                    around = zip(chain([""], words), chain(words[1:], [""]))
                    contexts.update(zip(words, (zlib.crc32(f"{a} {b}".encode()) for a, b in around)))
                else:
                    others.update(words)
            yield pa.record_batch(
                [pa.array([w for w, _ in contexts] + list(others), pa.string()),
                 pa.array([c for _, c in contexts] + [None] * len(others), pa.int64()),
                 pa.array([1] * len(contexts) + list(others.values()), pa.int64())],
                ["word", "context", "n"],
            )

    counted = texts.mapInArrow(count, "word string, context long, n long")
    return counted.groupBy("word", "context").agg(F.sum("n").alias("n")).groupBy("word").agg(
        F.count("context").alias("toxic"), F.coalesce(F.sum(F.when(F.col("context").isNull(), F.col("n"))), F.lit(0)).alias("others")
    )


def frequent_terms(words: DataFrame, toxic_texts: int) -> tuple[list[tuple[str, int, int]], int, int]:
    """((term, toxic, others) much more frequent in toxic texts, all toxic words, all others).

    A term is a word or the beginning of one. A text of k words supports at most 7 k of them
    and each needs LEAST_SHARE of all texts, so 700 times the mean length of the sample's
    toxic texts bounds what the driver gets.
    """
    toxic_words, other_words = (int(x or 0) for x in words.agg(F.sum("toxic"), F.sum("others")).head())
    lengths = F.when(F.length("word") >= SHORTEST, F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("word"))))
    starts = F.transform(F.coalesce(lengths, F.array().cast("array<int>")), lambda k: F.concat(F.lit(" "), F.substring("word", F.lit(1), k)))
    terms = words.select(F.explode(F.concat(starts, F.array(F.concat(F.lit(" "), F.col("word"), F.lit(" "))))).alias("term"), "toxic", "others")
    terms = terms.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others"))
    often = F.col("toxic") >= max(LEAST_CONTEXTS, math.ceil(LEAST_SHARE * toxic_texts))
    ratio = (F.col("toxic") + 0.5) * max(other_words, 1) / ((F.col("others") + 0.5) * max(toxic_words, 1))
    kept = terms.where((often & (ratio >= LEAST_RATIO)) | F.col("term").isin(list(given_weights())))
    return sorted((r["term"], r["toxic"], r["others"]) for r in kept.collect()), toxic_words, other_words


def learned_weights(terms: list[tuple[str, int, int]], toxic_words: int, other_words: int) -> dict[str, float]:
    """Term -> logarithm of how much oftener toxic texts have it; the given lexicon and more.

    Of a beginning, the longer ones and the words it covers, the one that parts toxic from
    other texts best is taken first, and what it counts is no longer evidence for those around
    it. A given weight counts as TRUST occurrences.
    """
    given = given_weights()
    left = {t: (c, n) for t, c, n in terms}
    ratio = lambda c, n: math.log((c + 0.5) / max(toxic_words, 1) * max(other_words, 1) / (n + 0.5))
    weights = {}
    for t, weight in given.items():
        c, n = left.get(t, (0, 0))
        weights[t] = (TRUST * weight + (c + n) * (ratio(c, n) if c + n else 0)) / (TRUST + c + n)
    by_start: dict[str, list[str]] = {}
    for t in left:
        by_start.setdefault(t[: SHORTEST + 1], []).append(t)
    for family in by_start.values():
        open_ = set(family)
        while open_:
            gain = lambda t: left[t][0] * ratio(*left[t])
            best = max(open_, key=lambda t: (round(gain(t), 9), len(t), t))
            c, n = left[best]
            if c < LEAST_CONTEXTS or ratio(c, n) < math.log(LEAST_RATIO):
                break
            weights[best] = max(weights.get(best, -math.inf), ratio(c, n)) if best not in given else weights[best]
            for t in list(open_):
                if t.startswith(best):
                    open_.discard(t)  # covered by it
                elif best.startswith(t):
                    left[t] = (left[t][0] - c, left[t][1] - n)
    return {t: w for t, w in weights.items() if w > 0}


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton:
    """Finds terms and exception phrases in " word word ... ", in one pass."""
    machine = ahocorasick.Automaton()
    for phrase in EXCEPTIONS:
        term = f" {' '.join(fold(phrase))} "
        machine.add_word(term, (len(term), None))
    for term, weight in weights.items():
        machine.add_word(term, (len(term), weight))
    machine.make_automaton()
    return machine


def matches(words: list[str], machine: ahocorasick.Automaton) -> tuple[int, float]:
    """(number, sum of the weights) of the words that the lexicon knows, outside of exceptions.

    The longest term that fits a word counts.
    """
    line = f" {' '.join(words)} "
    at: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in machine.iter(line):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif length > at.get(start, (0, 0.0))[0]:
            at[start] = length, weight
    hits = [w for start, (_, w) in at.items() if not any(a <= start < b for a, b in spared)] if spared else [w for _, w in at.values()]
    return len(hits), float(sum(hits))


def calibration(counts: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(a, b) of the logistic curve through (evidence, rows, toxic rows), with a weak prior."""
    counts = [*counts, (-WIDEST / 4, 1, 0), (WIDEST / 4, 1, 1)]
    x, n, y = (np.array(v, float) for v in zip(*counts))
    a, b = DEFAULT
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = n * p * (1 - p) + 1e-9
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, [(y - n * p).sum(), (x * (y - n * p)).sum()])
        step = np.clip(step, -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_words, n_hits) for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) teach where the column ``held_out`` (over doc_id) is false or
    null: terms and weights from a bounded sample, the calibration from all labelled rows. A
    text's evidence is the sum of the weights of its matches less what a text of its length
    would have more if it were toxic; the score is the logistic curve of it. A score reads the
    text alone. An id labelled twice is toxic if one label says so.

    The whole text is folded and matched in one pass; labels are joined to rows without texts.
    Null and empty texts have no evidence and get the score of a text without words. Rows with
    a null id are scored and teach nothing; repeated rows stay as they are; equal evidence
    has an equal score; an empty table gives no rows; without labels the given weights and
    curve hold; columns but doc_id and text are not read, so names cannot clash.
    """
    truth = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~F.coalesce(held_out, F.lit(False)))
    truth = staged(truth.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") == 1).alias("toxic")), "toxic-labels")
    sample = staged(_bounded_sample(truth), "toxic-sample")
    words = staged(word_counts(docs, sample), "toxic-words")
    terms, toxic_words, other_words = frequent_terms(words, sample.where("toxic").count())
    weights = learned_weights(terms, toxic_words, other_words)
    # Expected matches a word: more of them in toxic texts by this much.
    rates = [(c / max(toxic_words, 1) - n / max(other_words, 1)) for t, c, n in terms if t in weights]
    each = max(0.0, sum(rates))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            sizes, hits, evidence = [], [], []
            for text in batch.column(2):
                folded = fold(text.as_py())
                number, weight = matches(folded, machine) if folded else (0, 0.0)
                sizes.append(len(folded))
                hits.append(number)
                evidence.append(min(WIDEST, max(-WIDEST, weight - each * len(folded))))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), pa.array(evidence, pa.float64())],
                ["doc_id", "held_out", "n_words", "n_hits", "evidence"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    found = staged(rows.mapInArrow(match, "doc_id long, held_out boolean, n_words long, n_hits long, evidence double"), "toxic-evidence")
    taught = found.where("not held_out").join(truth, "doc_id")
    # At most 2 * WIDEST / STEP + 1 rows.
    curve = taught.groupBy(F.round(F.col("evidence") / STEP).alias("step")).agg(F.count("*").alias("n"), F.count_if("toxic").alias("y")).collect()
    a, b = calibration([(r["step"] * STEP, r["n"], r["y"]) for r in curve]) if curve else DEFAULT
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("evidence"))))
    return found.select(
        "doc_id", "held_out", score.alias("score"), F.when(score >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"), "n_words", "n_hits"
    )
