"""Periodic runs against definitions taken literally."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import periodic
from fleetpulse.llm.periodic import COVER, CYCLE, Extensions, find_runs, grid, periodic_runs
from fleetpulse.llm.queries import periodic_run_detection, planted_periods
from tests.llm.conftest import prose


def all_runs(words):
    """By the definition: every maximal stretch for every period, kept under its smallest period."""
    n, out = len(words), set()
    for q in range(1, n // 3 + 1):
        s = 0
        while s < n - q:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e < n - q and words[e] == words[e + q]:
                e += 1
            part = words[s : e + q]
            if len(part) >= max(24, 3 * q) and q == next(p for p in range(1, q + 1) if part[p:] == part[:-p]):
                out.add((s, len(part), q))
            s = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_the_cover_holds_every_difference():
    assert {(a - b) % CYCLE for a in COVER for b in COVER} == set(range(CYCLE))


def test_extensions_against_comparison_word_by_word():
    random = np.random.default_rng(4)
    for n, kinds in ((1, 1), (40, 1), (200, 2), (300, 3)):
        values = random.integers(1, kinds + 1, n).astype(np.int32)
        values[n // 2 :] = values[: n - n // 2]
        i, j = np.triu_indices(n + 1, 1)
        want = []
        for a, b in zip(i, j):
            k = 0
            while b + k < n and values[a + k] == values[b + k]:
                k += 1
            want.append(k)
        assert Extensions(values)(i, j).tolist() == want


@pytest.mark.parametrize("pairs", [1 << 20, 50])
def test_runs_against_the_definition(monkeypatch, pairs):
    monkeypatch.setattr(periodic, "PAIRS", pairs)
    random = np.random.default_rng(6)
    for k in range(120):
        n = int(random.integers(0, 220))
        values = random.integers(1, random.integers(1, 5) + 1, n)
        if k % 2 and n > 40:
            p, a = int(random.integers(1, n // 4)), int(random.integers(0, n // 2))
            values = np.array([values[i] if i < a else values[a + (i - a) % p] for i in range(n)])
            values[int(random.integers(0, n))] = 9
        assert [tuple(r) for r in find_runs(values.astype(np.int32)).tolist()] == all_runs(values.tolist())


def test_a_grid_point_lies_in_every_possible_run():
    for n in (24, 100, 333):
        points = {(int(a), int(b)) for i, q in grid(n) for a, b in zip(i, q)}
        for q in range(1, n // 3 + 1):
            least = max(24, 3 * q)
            for start in range(n - least + 1):
                assert any((i, q) in points for i in range(start, start + least - q))


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_against_plain_python(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r["text"].split()) < 700}
    got = {r["doc_id"]: r for r in periodic_run_detection(spark, sf_dir).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for doc_id, text in texts.items():
        words = planted([w.decode() for w in text.encode().split()], doc_id)
        runs, r = all_runs(words), got[doc_id]
        some += len(runs)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == digest("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r["collapsed_sha256"] == digest(" ".join(w for i, w in enumerate(words) if i not in dropped))
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
    assert some > 10 and len(texts) > 100


def test_edges(spark, documents):
    long = " ".join(["a b c"] * 40_000)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "x " * 24), (4, "x " * 23), (5, long), (5, long), (6, prose(1, 300))]
    docs = documents(rows, runs=1, collapsed=2, n_words=3)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect()))
    assert got == sorted([
        (False, 1, 0, [], ""), (False, 2, 0, [], ""), (False, 3, 0, [], ""), (True, 0, 24, [(0, 24, 1)], "x"),
        (False, 4, 23, [], " ".join(["x"] * 23)), (False, 5, 120_000, [(0, 120_000, 3)], "a b c"), (False, 5, 120_000, [(0, 120_000, 3)], "a b c"),
        (False, 6, 300, [], prose(1, 300)),
    ])
    assert periodic_runs(documents([])).count() == 0
    kept = planted_periods(documents([(None, "a b"), (7, None), (8, "")])).collect()
    assert [r["text"] for r in kept] == ["a b", None, ""]
    assert planted_periods(documents([])).where(F.col("text").isNull()).count() == 0
