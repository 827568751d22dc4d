import hashlib
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import suffixes
from fleetpulse.llm.common import FREED, staged
from fleetpulse.llm.suffixes import deduplicated, deduplicated_documents, kept_bytes, runs, suffix_array
from tests.llm.conftest import prose


def test_suffix_array_against_sorting():
    random.seed(5)
    for _ in range(400):
        text = [random.randint(1, random.choice([1, 2, 3, 9])) for _ in range(random.randint(0, 70))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_equal_strings_have_equal_anchors():
    text = (prose(3, 60) + "aaaa" * 40).encode()
    a = runs(np.frombuffer(b"xyz" + text, np.uint8), np.array([0]))
    b = runs(np.frombuffer(b"some other lead " + text, np.uint8), np.array([0]))

    def by_string(r, lead):
        return {int(f + i - lead): (int(h), int(o - i)) for f, n, h, o in zip(r["first"], r["count"], r["anchor"], r["offset"]) for i in range(n)}

    a, b = by_string(a, 3), by_string(b, 16)
    assert len(a) == len(text) + 3 - 49
    assert all(a[i] == b[i] for i in range(len(text) - 49))


def brute(rows):
    first, out = {}, []
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - 49 if d is not None else 0):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - 49 if d is not None else 0):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = [True] * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"PIECE": 700}, {"CROWD": 1}, {"CROWDED": 1}, {"CROWD": 3, "CROWDED": 4}, {"RANGE": 16, "CROWD": 3}])
def test_removal_against_brute_force(documents, monkeypatch, limits):
    """In one piece and in several, with anchors kept whole, split by tasks and by ranges."""
    for name, value in limits.items():
        monkeypatch.setattr(suffixes, name, value)
    random.seed(11)
    passage, line = prose(1, 40), "é" * 30 + " end of line.\n"
    rows = [(1, passage), (2, "x" + passage + "y"), (3, passage[:200] + "Z" + passage[201:]), (4, line * 30), (5, line * 3 + "tail"),
            (6, None), (7, ""), (8, "short"), (None, passage), (9, passage[10:59]), (9, passage[10:60]), (10, passage), (10, passage)]
    rows += [(20 + k, prose(k, 30) + passage[k * 3 : k * 3 + 40 + k] + prose(50 + k, 20)) for k in range(30)]
    for k in range(30):
        copy = list(prose(k, 30))
        for _ in range(3):
            copy[random.randrange(len(copy))] = "#"
        rows.append((60 + k, "".join(copy)))
    got = deduplicated(documents(rows, key=1, spans=2, anchors=3)).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == brute(rows)


def test_crowded_anchor_is_dealt_over_ranges(documents, monkeypatch):
    """One passage behind a different word in each of many documents."""
    monkeypatch.setattr(suffixes, "CROWD", 4)
    passage = prose(1, 20)
    rows = [(k, f"{k * 7919 % 10007:05d}{'ab'[k % 2]} {passage} {k * 104729 % 100003:05d}") for k in range(300)]
    docs = documents(rows).repartition(4)
    ranges = 64
    keyed = docs.selectExpr("doc_id", "doc_id as row_key", "cast(text as binary) text")
    blobs = suffixes.anchored(keyed, ranges).collect()
    sizes = {}
    for b in blobs:
        if b["kind"] in (0, 2):
            sizes[b["part"]] = sizes.get(b["part"], 0) + len(suffixes.unpack([b["blob"]], suffixes.COLUMNS)["doc"])
    assert any(b["kind"] == 2 for b in blobs) and max(sizes.values()) < sum(sizes.values()) / 8
    got = deduplicated(docs).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == brute(rows)


def test_packed_columns_come_back():
    low, high = -(1 << 63), (1 << 63) - 1
    columns = {"anchor": [0, 2**32 - 1, 7], "context": [2**64 - 1, 0, 5], "doc": [high, low, high], "key": [low, high, -1],
               "first": [0, 2**31 - 1, 300], "count": [31, 1, 2], "offset": [0, 30, 1]}
    columns = {name: np.array(x, suffixes.COLUMNS[name]) for name, x in columns.items()}
    got = suffixes.unpack([suffixes.pack(columns, suffixes.COLUMNS)] * 2, suffixes.COLUMNS)
    assert {name: x.tolist() for name, x in got.items()} == {name: x.tolist() * 2 for name, x in columns.items()}
    assert len(suffixes.unpack([], suffixes.COLUMNS)["doc"]) == 0


def test_entries_are_sent_in_few_bytes(documents):
    random.seed(3)
    texts = [random.randbytes(2000).hex() for _ in range(200)]
    rows = [(5_000_000_000 + 3 * k, texts[k % 200]) for k in range(300)]
    keyed = documents(rows).select("doc_id", F.xxhash64("doc_id"), F.col("text").cast("binary")).coalesce(1)
    blobs = suffixes.anchored(keyed, 64).collect()
    sent = {kind: sum(len(b["blob"]) for b in blobs if b["kind"] == kind) for kind in (0, 1)}
    leaders = sum(len(suffixes.unpack([b["blob"]], suffixes.COLUMNS)["doc"]) for b in blobs if b["kind"] == 0)
    assert leaders > 40_000 and sent[0] < 19.5 * leaders and sent[1] < 9 * leaders / 2


def test_equal_rows_are_found_once(documents):
    rows = [(1, prose(1, 30))] + [(2, "x" + prose(1, 30))] * 40
    keyed = documents(rows).select("doc_id", F.xxhash64("doc_id"), F.col("text").cast("binary")).repartition(3)
    blobs = pd.DataFrame([b.asDict() for b in suffixes.anchored(keyed, 64).collect()])
    found = pd.concat([suffixes.settle(frame) for _, frame in blobs.groupby("part")])
    assert len(found) > 10 and not found.duplicated().any()


def test_a_staged_table_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before, setting = files(), spark.conf.get(FREED, None)
    table = staged(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "freed")
    left = None
    for _ in range(50):
        left = [name for name in files() - before if name.startswith("shuffle")]
        if not left:
            break
        time.sleep(0.2)
    assert not left and table.count() == 100 and spark.conf.get(FREED, None) == setting


def test_strings_of_a_context():
    texts = [b"0123" + b"q" * 26 + b"the anchor is here now and more of it", b"xyz3" + b"q" * 26 + b"the anchor is here now and more of it"]
    n = len(texts[0]) - 49
    contexts = {"doc": [4, 2], "key": [40, 20], "first": [100, 0], "count": [n, n], "offset": [30, 30]}
    strings, rows, mixed, settled = suffixes.single_strings({k: np.array(v) for k, v in contexts.items()}, np.frombuffer(b"".join(texts), np.uint8))
    assert len(rows) == len(mixed) == len(strings["doc"]) == n + 3
    assert {k: v.tolist() for k, v in settled.items()} == {"key": [40], "first": [103], "count": [n - 3]}
    assert strings["offset"].tolist() == [30, 29, 28, *range(30, 30 - n, -1)]


def test_whole_characters_are_kept():
    text = ("é" * 60).encode()
    assert kept_bytes(text, [1], [1], True)[0].decode() == "é" * (60 - 24)
    assert kept_bytes(text, [1], [1])[1] == 1


def test_documents_keep_their_columns_and_lose_repeats(documents):
    passage = prose(4, 30)
    docs = documents([(1, passage), (2, "Own words. " + passage), (3, passage), (4, None), (5, "")], key=1)
    got = {r["doc_id"]: r for r in deduplicated_documents(docs).collect()}
    assert deduplicated_documents(docs).columns == docs.columns
    assert got[1]["text"] == passage and got[2]["text"].startswith("Own words") and got[2]["n_chars"] == len(got[2]["text"]) < 20
    assert 3 not in got and got[4]["text"] is None and 5 in got
    assert deduplicated(documents([])).count() == 0
