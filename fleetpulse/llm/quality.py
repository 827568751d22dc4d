"""Quality rules for documents, compiled from a threshold table into one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import words
from fleetpulse.operators.relations import evaluate_once

SYMBOLS = "#*$%&|<>"
# Very common words of some languages; running prose in one of them has a share of them. The
# rule is silent on documents in others, or in none that is known.
STOP_WORDS = {
    "en": "the of and to in a is that it for on was be with as by this at are from",
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans par au sur pas avec",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
# (measure, smallest, largest); a document is kept if every measure that applies lies within its bounds.
RULES = [
    ("n_words", 50, None),
    ("mean_word_chars", 2, 15),
    ("symbols_per_word", None, 0.1),
    ("exclamations_per_word", None, 0.2),
    ("dup_line_share", None, 0.5),
    ("repeat_word_share", None, 0.5),
    ("stop_word_share", 0.01, None),
]


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(word_list: Column) -> Column:
    """Number of words inside any 3-word window that is found twice or more in the list.

    Windows are compared by 64-bit hash. Sorting (hash, position) brings equal windows
    together; the positions found are sorted again, and a window adds the words that the
    next one does not cover, three at most.
    """
    def windows(h: Column) -> Column:
        """From word hashes; a shift by place makes a window's hash depend on the order."""
        moved = lambda x, k: F.call_function("shiftleft", x, F.lit(k))
        first = F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0)))
        return F.transform(
            first, lambda a, i: a.bitwiseXOR(moved(F.get(h, i + 1), 1)).bitwiseXOR(moved(F.get(h, i + 2), 2))
        )

    def covered(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, 2, F.size(p)), F.slice(p, 1, F.size(p) - 1), lambda b, a: F.least(b - a, F.lit(3)))
        return F.when(F.size(p) == 0, 0).otherwise(F.aggregate(steps, F.lit(3), lambda s, x: s + x))

    def among(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            equal = lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
            found = F.filter(s, lambda x, k: F.coalesce(equal(x, k), F.lit(False)))
            return F.sort_array(F.transform(found, lambda x: x["i"]))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(let(tagged, twice), covered))

    return let(let(F.transform(word_list, lambda w: F.xxhash64(w)), windows), among)


def occurrences(text: Column, characters: str) -> Column:
    """How many of the given characters a text has; the rare texts with any are taken apart."""
    there = text.contains(characters) if len(characters) == 1 else text.rlike(f"[{characters}]")
    return F.when(there, F.length(text) - F.length(F.translate(text, characters, ""))).otherwise(0).cast("long")


def measures(text: Column, w: Column) -> list[Column]:
    """The measured values of one text and its words. ``text`` must not be null."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    stop = sorted({x for line in STOP_WORDS.values() for x in line.split()})
    stop += [x.capitalize() for x in stop]
    return [
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        occurrences(text, SYMBOLS).alias("n_symbols"),
        occurrences(text, "!").alias("n_exclamations"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("stop_words"),
    ]


def verdicts(rules: list[tuple]) -> list[Column]:
    """One boolean per rule, true where the document breaks it."""
    out = []
    for name, least, most in rules:
        value = F.col(name)
        broken = (value < least) if least is not None else F.lit(False)
        broken = broken | (value > most) if most is not None else broken
        out.append(F.coalesce(broken, F.lit(False)).alias(f"_{name}"))
    return out


def _rated(docs: DataFrame, carried: Column, rules: list[tuple]) -> DataFrame:
    """``carried`` as _row, with the measures, the broken rules and the verdict of each text."""
    text = F.col("_text")
    # Words and measures are computed once each: no filter is pushed below them, where it
    # would repeat their expressions.
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    measured = docs.select(carried.alias("_row"), lang.alias("_lang"), F.coalesce("text", F.lit("")).alias("_text"))
    measured = evaluate_once(measured, "_words", words(text))
    measured = evaluate_once(measured, "_measures", F.struct(*measures(text, F.col("_words")))).select("_row", "_lang", "_measures.*")
    share = lambda a, b: F.when(b > 0, a / b)
    rated = measured.select(
        "_row", "n_words", "word_chars", "n_symbols", F.col("_lines.dup").cast("long").alias("n_dup_lines"),
        "n_repeat_words", "n_exclamations", "stop_words",
        share(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        share(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        share(F.col("n_exclamations"), F.col("n_words")).alias("exclamations_per_word"),
        share(F.col("_lines.dup"), F.col("_lines.n")).alias("dup_line_share"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_word_share"),
        F.when(F.col("_lang").isin(list(STOP_WORDS)), share(F.col("stop_words"), F.col("n_words"))).alias("stop_word_share"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    broken = verdicts(rules)
    names = F.array_compact(F.array(*(F.when(b, F.lit(r[0])) for b, r in zip(broken, rules))))
    return rated.withColumn("broken", names).withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def quality(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """doc_id of every row of ``docs`` (doc_id, text, and lang if there is one) with its measures,
    ``broken`` rules and ``kept``.

    Plain projections: no shuffle, no user function. The threshold table decides ``kept``,
    except that a text of fewer than 50 words, or with over half of its words in repeated
    3-word windows, is never kept (``base_failed``). Null and blank texts have no words and
    fail. No text is too long. Repeated rows, null ids and extra columns make no difference; a
    value on a bound is within it; only doc_id, text and lang are read, so a clash of names
    cannot arise; an empty table gives no rows.
    """
    rated = _rated(docs, F.col("doc_id"), rules)
    return rated.select(F.col("_row").alias("doc_id"), *(c for c in rated.columns if c != "_row"))


def quality_filter(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns, whatever their names."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return _rated(docs, row, rules).where("kept").select("_row.*")
