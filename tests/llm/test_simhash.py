import numpy as np
import pytest
import xxhash

from fleetpulse.llm.common import components
from fleetpulse.llm.simhash import anchors, code_dimension, distinct_documents, fingerprint, near_duplicates, replicas, spanning
from tests.llm.conftest import prose


def test_fingerprint_is_the_majority_of_shingle_bits():
    words = [w.lower() for w in "A b C d e f G".split()]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(5)]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > 5 for b in range(64)]
    assert fingerprint(b" A b\tC d e f G ", 3) == sum(1 << b for b in range(64) if bits[b])
    assert fingerprint(b"one two", 3) == xxhash.xxh64_intdigest("one two", 42)
    assert fingerprint(b"", 3) == fingerprint(None, 3) == fingerprint(b" \n", 3) == 0


def test_words_of_the_code_are_even_and_distinct():
    for k in (6, 11, 16):
        code = anchors(k)
        assert len(np.unique(code)) == 1 << k
        assert (np.bitwise_count(code) % 2 == 0).all()
    assert [code_dimension(n) for n in (0, 131072, 131073)] == [6, 6, 7]


@pytest.mark.parametrize("dimension", [6, 8])
def test_near_fingerprints_meet_at_a_home(dimension):
    random = np.random.default_rng(3)
    a = random.integers(0, 2**64, 300, dtype=np.uint64)
    for bits in range(4):
        b = a.copy()
        for k in range(len(b)):
            for at in random.choice(64, bits, replace=False):
                b[k] ^= np.uint64(1) << np.uint64(at)
        i, x, home_x = replicas(a, anchors(dimension), 3)
        j, y, home_y = replicas(b, anchors(dimension), 3)
        of_a, of_b = set(zip(i.tolist(), x.tolist())), set(zip(j.tolist(), y.tolist()))
        met = {k for k, h in zip(i[home_x].tolist(), x[home_x].tolist()) if (k, h) in of_b}
        met |= {k for k, h in zip(j[home_y].tolist(), y[home_y].tolist()) if (k, h) in of_a}
        assert len(met) == 300


def test_spanning_edges_connect_a_chain():
    fps = np.array([0, 0b111, 0b111111, 0xFF << 40], np.uint64)
    edges = spanning(fps, fps, 3)
    assert set(edges) == {(7, 0), (63, 0)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(5, 5), (1, 0), (None, 3)]
    found = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_against_all_pairs(spark, documents):
    base = prose(1, 400)
    rows = [(9, base), (4, base), (4, base), (7, base + " more"), (None, base), (1, None), (2, ""), (3, " \n"), (8, prose(2, 90)), (6, "x")]
    rows += [(20 + k, " ".join([*base.split()[:k], "changed", *base.split()[k + 1 :]])) for k in range(0, 400, 9)]
    docs = documents(rows, fp=1, root=2, row_key=3, component_id=4)
    got = near_duplicates(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    fps = {r[1]: fingerprint((r[1] or "").encode(), 3) for r in rows}
    nodes = sorted(set(fps.values()))
    label = {f: f for f in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if (a ^ b).bit_count() <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    first = {}
    for doc, text in rows:
        if doc is not None:
            root = label[fps[text]]
            first[root] = min(first.get(root, doc), doc)
    want = {(d, first.get(label[fps[t]])) for d, t in rows}
    assert {(r["doc_id"], r["component_id"]) for r in got} == want
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert distinct_documents(documents([])).count() == 0
