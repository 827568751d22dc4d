"""Language-model scoring and language identification."""

import math
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import language, scoring
from fleetpulse.llm.language import RATE, bloom_filters, filter_size, grams, gram_counts, identify, languages, own_grams, positions, _letter_table
from fleetpulse.llm.scoring import CLASSES, END, FREQUENT, SHRINK, STATES, TIED_ROUNDS, expected_counts, forward, scored, starting_point, word_class
from tests.llm.conftest import prose


def model():
    random = np.random.default_rng(4)
    return random.dirichlet(np.ones(3)), random.dirichlet(np.ones(3), 3), random.dirichlet(np.ones(5), 3).T


def paths(codes, m):
    initial, transition, emission = m
    for p in product(range(3), repeat=len(codes)):
        weight = initial[p[0]] * emission[codes[0], p[0]]
        for t in range(1, len(codes)):
            weight *= transition[p[t - 1], p[t]] * emission[codes[t], p[t]]
        yield p, weight


def test_forward_and_counts_against_all_paths():
    m, sequences = model(), [[0, 3, 1, 4, 2], [2, 2, 1], [4]]
    codes, lengths = np.concatenate(sequences).astype(np.uint16), np.array([5, 3, 1])
    starts = np.cumsum(lengths) - lengths
    score, _ = forward(codes, starts, lengths, m)
    begun, moves, uses = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s, seen in zip(score, sequences):
        total = sum(w for _, w in paths(seen, m))
        assert s == pytest.approx(math.log(total))
        for p, w in paths(seen, m):
            begun[p[0]] += w / total
            for t, k in enumerate(p):
                uses[seen[t], k] += w / total
                if t:
                    moves[p[t - 1], k] += w / total
    for got, want in zip(expected_counts(codes, starts, lengths, m), (begun, moves, uses)):
        assert np.allclose(got, want)


def test_base_scores_and_gain(documents):
    rows = [(k, prose(k % 9, 50 + k), "en") for k in range(60)] + [(70, None), (71, ""), (None, "Alpha BETA"), (72, "unseen " * 3), (1, prose(1, 51))]
    docs = documents(rows, codes=1, c=2, word=3)
    got = scored(docs, (F.col("doc_id") % 5 == 2)).collect()
    assert len(got) == len(rows)
    counts, end = Counter(), object()
    for d, t, *_ in rows:
        if d is None or d % 5 != 2:
            counts.update([*(t or "").lower().split(), end])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, t, *_ in rows:
        tokens = [*(t or "").lower().split(), end]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want[d, d is not None and d % 5 == 2, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert scored(documents([]), F.lit(False)).count() == 0
    alone = scored(documents([(1, "a b")]), F.lit(True)).collect()
    assert alone[0]["train_tokens"] == 0 and alone[0]["n_known"] == 0 and alone[0]["base_score"] == 0


def test_held_out_texts_are_likelier_than_by_words_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = [r for r in scored(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_scores(rows):
    """The model by its definitions, over (words, held out): one pass a text, no blocks or joins."""
    learn = [own for own, held in rows if not held]
    counts = Counter(w for own in learn for w in own)
    total = max(sum(counts.values()), 1)
    top = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w))[:FREQUENT])}
    pairs = np.zeros((len(top), len(top)))
    for own in learn:
        for a, b in zip(own, own[1:]):
            if a in top and b in top:
                pairs[top[a], top[b]] += 1
    initial, transition, lift = starting_point(pairs, STATES)
    head = sum(counts[w] for w in top) / total
    emission = {w: 0.9 * lift[top[w]] * head / (counts[w] / total) + 0.1 if w in top else np.ones(STATES) for w in counts}
    for last in [False] * TIED_ROUNDS + [True]:
        begun, moves, uses = np.ones(STATES), np.ones((STATES, STATES)), {w: np.zeros(STATES) for w in counts}
        for own in learn:
            ahead, back = [initial * emission[own[0]]], [np.ones(STATES)]
            for w in own[1:]:
                ahead.append(ahead[-1] @ transition * emission[w])
            for w in own[:0:-1]:
                back.insert(0, transition @ (emission[w] * back[0]))
            whole = ahead[-1].sum()
            begun += ahead[0] * back[0] / whole
            for t, w in enumerate(own):
                uses[w] += ahead[t] * back[t] / whole
                if t:
                    moves += np.outer(ahead[t - 1], emission[w] * back[t]) * transition / whole
        initial, transition = begun / begun.sum(), moves / moves.sum(1, keepdims=True)
        overall = sum(uses.values(), np.ones(STATES))
        if not last:
            tied = {}
            for w in counts:
                tied[w if w in top else word_class(w)] = tied.get(w if w in top else word_class(w), 0) + uses[w]
            base = overall / overall.sum()
            emission = {w: (u + base) / (u.sum() + 1) / base for w in counts for u in [tied[w if w in top else word_class(w)]]}
            continue
        shares = np.tile(overall / overall.sum(), (CLASSES, 1))
        kinds = np.ones(CLASSES)
        for w in counts:
            shares[word_class(w)] += uses[w] / counts[w]
            kinds[word_class(w)] += 1
        shares /= kinds[:, None]
        mass = {w: (counts[w] + 1) * (uses[w] + SHRINK * shares[word_class(w)]) / (counts[w] + SHRINK) for w in counts}
        sums = sum(mass.values(), shares.sum(0))
        emission = {w: m / sums for w, m in mass.items()}
    out = []
    for own, _ in rows:
        a, log = initial, 0.0
        for t, w in enumerate(own):
            a = (a if t == 0 else a @ transition) * emission.get(w, shares[word_class(w)] / sums)
            log, a = log + math.log10(a.sum()), a / a.sum()
        out.append(log)
    return out


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_scores_against_the_plain_model(documents, block, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK", block)
    rows = [(k, prose(k % 7, 5 + k) + f" w{k % 5} é{k} x", "en") for k in range(40)] + [(50, None), (51, "A"), (52, "zz unseen words of no class"), (None, "alpha")]
    docs = documents(rows, block=1, found=2, at=3, u0=4).repartition(3)
    held = lambda d: d is not None and d % 5 == 2
    want = plain_scores([([*(t or "").lower().encode().split(), END], held(d)) for d, t, *_ in rows])
    got = {r["doc_id"]: r["score"] for r in scored(docs, F.col("doc_id") % 5 == 2).collect()}
    assert len(got) == len(rows)
    assert all(got[r[0]] == pytest.approx(w, rel=1e-3) for r, w in zip(rows, want))


def test_a_long_text_is_scored_whole(documents, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK", 1000)
    long = " ".join(f"v{k % 70_000}" for k in range(150_000))  # more kinds of words than 16 bits name
    got = {r["doc_id"]: r for r in scored(documents([(1, long), (2, "v1 v2 v3")] * 2), F.lit(False)).collect()}
    assert got[1]["n_tokens"] == 150_001 and got[1]["n_known"] == 150_001 and math.isfinite(got[1]["score"])
    assert got[1]["train_tokens"] == 2 * (150_001 + 4)


def test_words_come_to_their_block_without_a_list(documents):
    plan = scored(documents([(1, "a b c"), (2, "b d")]), F.col("doc_id") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "collect_list" not in plan


def test_counts_in_single_precision():
    random = np.random.default_rng(3)
    lengths = np.array([300, 200, 200, 7])
    codes, starts = random.integers(0, 90, lengths.sum()), np.cumsum(lengths) - lengths
    model = [random.dirichlet(np.ones(STATES)), random.dirichlet(np.ones(STATES), STATES), random.random((90, STATES)) + 0.01]
    single = expected_counts(codes, starts, lengths, [x.astype(np.float32) for x in model])
    for got, want in zip(single, expected_counts(codes, starts, lengths, model)):
        assert got == pytest.approx(want, rel=1e-3, abs=1e-4)
    score, kept = forward(codes, starts, lengths, [x.astype(np.float32) for x in model], keep=True)
    assert kept[0][0].dtype == np.float32 and score.dtype == np.float64


def test_grams_are_runs_of_letters():
    letters = _letter_table()
    found = ["".join(chr(int(k) >> s & 0x1FFFFF) for s in (42, 21, 0)) for k in grams("Ab, 1 Éc", letters)]
    assert found == [" ab", "ab ", " éc", "éc "]
    assert len(grams("12 !", letters)) == len(grams(None, letters)) == 0


def test_false_positives_are_taken_off():
    keys = grams(prose(1, 40), _letter_table())
    table, at = np.zeros((1, 4096), np.uint32), positions(keys, 4096)
    for p in at:
        table[0, p] |= 1
    for p in at:
        table[0, p[: len(keys) // 2]] |= 2
    best, score = identify(keys, table, np.array([0.0, 0.0]))
    assert best == 0 and score > 0.5
    assert identify(keys, table, np.array([1.0, 0.0]))[0] == 1


def test_languages(documents):
    de, fr = "der schnelle fuchs und die katze mit dem hund auf einem haus ", "le renard rapide et la souris avec un chien sur une maison "
    rows = [(k, (de if k % 2 else fr) * (k % 4 + 1), "de" if k % 2 else "fr") for k in range(40)]
    rows += [(50, None, "de"), (51, "12 !?", "fr"), (52, "katze und hund", None), (None, de, None), (53, "", "de"), (54, "漢字", None)]
    got = {r["doc_id"]: r for r in languages(documents(rows, gram=1, n=2, slice=3), F.col("doc_id") % 3 == 1).collect()}
    assert len(got) == len(rows)
    assert all(got[k]["lang_pred"] == ("de" if k % 2 else "fr") for k in range(40))
    assert [got[k]["lang_pred"] for k in (50, 51, 52, None, 53)] == ["und", "und", "de", "de", "und"]
    assert got[54]["lang_pred"] in ("de", "fr") and got[54]["score"] == 0
    assert got[1]["held_out"] and not got[2]["held_out"] and all(0 <= r["score"] <= 1 for r in got.values())
    none = languages(documents([(1, "text", None)]), F.lit(False)).collect()
    assert none[0]["lang_pred"] == "und" and languages(documents([]), F.lit(False)).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = languages(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 1).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).head()
    assert n > 20 and right > 0.97


def test_filters_against_the_exact_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = gram_counts(docs.select("lang", "text"))
    names = ["en", "fr", "de", "es"]
    own = own_grams(counts, names)
    sets = [{r["gram"] for r in own.collect() if r["number"] == k} for k in range(4)]
    size = filter_size(max(map(len, sets)))
    table = bloom_filters(own, 4, size)
    every = np.array(sorted(set().union(*sets)), np.int64).view(np.uint64)
    strange = np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64)
    holds = lambda keys, k: np.bitwise_and.reduce([table[0, at] for at in positions(keys, size)]) >> np.uint32(k) & 1
    for k in range(4):
        inside = np.isin(every.view(np.int64), np.array(sorted(sets[k])))
        assert holds(every, k)[inside].all()  # none is missed
        assert holds(every, k)[~inside].mean() <= 2.5 * RATE and holds(strange, k).mean() <= 2 * RATE
    assert filter_size(0) == 4096 and filter_size(1_000_000) >= 10_000_000


def test_joined_languages_are_those_of_the_filters(spark, documents, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(None, "", "en"), (90001, None, None), (90002, "12 34", None), (90003, "\u6f22\u5b57 \u6f22", None), (90003, "\u6f22\u5b57 \u6f22", None)], docs.schema)
    docs = docs.union(extra)
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    key = lambda r: (str(r["doc_id"]), r["held_out"], r["lang_pred"])
    sent = sorted(languages(docs, fold).collect(), key=key)
    monkeypatch.setattr(language, "BROADCAST", 0)
    joined = sorted(languages(docs, fold).collect(), key=key)
    assert list(map(key, joined)) == list(map(key, sent))
    assert all(abs(a["score"] - b["score"]) < 0.05 for a, b in zip(sent, joined))
