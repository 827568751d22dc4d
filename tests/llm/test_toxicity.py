"""Toxicity: folding, matching, learned terms, held-out accuracy."""

import math

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm.common import crc_mod
from fleetpulse.llm.toxicity import (
    EXCEPTIONS, automaton, calibration, fold, given_weights, learned_weights, matches, toxicity,
)
from tests.llm.conftest import prose


def test_folding():
    assert fold("You 1DI0T, іdіоt!") == ["you", "idiot", "idiot"]  # Cyrillic letters
    assert fold("Ｍｏｒｏｎ mörõn m​orn idi07") == ["moron", "moron", "morn", "idiot"]
    assert fold("$tupid $ 5 100 x-y") == ["stupid", "x", "y"]
    assert fold(None) == fold("") == fold(" \n12") == []


def test_matching_against_a_word_by_word_search():
    weights = {" lowei": 3.0, " loweiss ": 7.0, " clown ": 2.0, " scum ": 1.5, " a b ": 1.0}
    machine = automaton(weights)

    def plain(words):
        line, hits, at = f" {' '.join(words)} ", [], 0
        phrases = [f" {' '.join(fold(p))} " for p in EXCEPTIONS]
        for k in range(len(line)):
            found = [(len(t), w) for t, w in weights.items() if line.startswith(t, k)]
            inside = any(line[a : a + len(p)] == p and a <= k < a + len(p) - 1 for p in phrases for a in range(len(line)))
            if found and not inside:
                hits.append(max(found)[1])
            at += 1
        return len(hits), sum(hits)

    for text in ("loweia loweiss lowe clown", "the class clown met a clown", "scum pond scum scum", "a b a b", "x", "clown", "class clown fish scum"):
        assert matches(text.split(), machine) == pytest.approx(plain(text.split()))


def test_learned_terms():
    terms = [(" vequ", 60, 0), (" veq", 61, 40), (" vequte ", 9, 0), (" idiot ", 50, 1), (" clown ", 0, 500), (" rare ", 2, 0)]
    weights = learned_weights(terms, 10_000, 100_000)
    assert weights[" vequ"] == pytest.approx(math.log(60.5 / 10_000 * 100_000 / 0.5))
    assert " veq" not in weights and " vequte " not in weights and " rare " not in weights
    assert weights[" idiot "] > 4 and " clown " not in weights  # other texts have it oftener
    assert learned_weights([], 0, 0) == given_weights()


def test_calibration_follows_the_labels():
    a, b = calibration([(-5.0, 1000, 10), (0.0, 100, 50), (5.0, 1000, 990)])
    at = lambda x: 1 / (1 + math.exp(-(a + b * x)))
    assert at(-5) < 0.05 and 0.3 < at(0) < 0.7 and at(5) > 0.95
    a, b = calibration([(x, 5, 0) for x in (-3.0, -1.0, 0.0)])
    assert b >= 0 and math.isfinite(a)


def test_invented_words_are_learned_and_texts_decide(spark, documents):
    """Words of no lexicon, seen in toxic texts only; copies of one text teach nothing."""
    rows, labels = [], []
    for k in range(240):
        toxic = k % 3 == 0
        words = prose(k, 60 + k % 50).split()
        for at in range(5, len(words), 20):
            words[at] = ("zorgu" + "abcdef"[at % 6]) if toxic else words[at]
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(1000 + k, prose(77, 80) + " quibbel") for k in range(40)]
    labels += [(1000 + k, 1) for k in range(40)]
    rows += [(5000, "Z0RGUB and zorgua, zоrgud"), (5001, None), (5002, ""), (None, prose(900, 80)), (None, "zorgua " * 5), (5003, "zorgub zorgua word " * 20_000)]
    rows += [(5004, "the class clown"), (5005, "quibbel plain words here"), (5005, "quibbel plain words here")]
    docs = documents(rows, toxic=3, score=4, word="x", context=5, n_hits=6)
    table = spark.createDataFrame([(*x, 9) for x in labels] + [(None, 1, 9), (5, None, 9)], "doc_id long, toxic int, quality int")
    got = toxicity(docs, table, crc_mod(F.col("doc_id"), 3) == 1).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 40 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5000]["n_hits"] == 3 and by_id[5000]["predicted"] == by_id[5003]["predicted"] == 1
    assert by_id[5001]["predicted"] == by_id[5002]["predicted"] == by_id[5004]["predicted"] == by_id[5005]["predicted"] == 0
    assert by_id[5001]["score"] == by_id[5002]["score"] and by_id[5001]["n_words"] == 0
    assert sorted(r["predicted"] for r in got if r["doc_id"] is None) == [0, 1]
    assert toxicity(documents([]), table, F.lit(False)).count() == 0
    bare = {r["doc_id"]: r["predicted"] for r in toxicity(documents([(1, "you idiot, you moron"), (2, prose(3, 40))]), table.limit(0), F.lit(True)).collect()}
    assert bare == {1: 1, 2: 0}


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity(docs, labels, crc_mod(F.col("doc_id"), 3) == 1).where("held_out").join(labels, "doc_id")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    found, missed, false = counts[1, 1], counts[1, 0], counts.get((0, 1), 0)
    assert found / (found + missed) >= 0.85 and false / (counts[0, 0] + false) <= 0.005
