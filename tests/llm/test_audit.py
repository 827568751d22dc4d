"""The filter audit against a replay of every order, document by document."""

from itertools import permutations

from fleetpulse.llm.audit import audit
from tests.llm.conftest import prose


def replay(rows, labels):
    """rows (doc_id, text, lang), labels (doc_id, quality, toxic) -> {(part, order, step): counts}."""
    import re

    def fails(doc_id, text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        smaller = [d for d, t, _ in rows if (t or "") == text and d is not None and (doc_id is None or d < doc_id)]
        conditions = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": bool(smaller),
        }
        return {f for f, c in conditions.items() if c}

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = [(lang or "", d, fails(d, text or "")) for d, text, lang in rows]
    out, shapley = {}, {}
    for part in {p for p, _, _ in docs}:
        for order in permutations("ABCDE"):
            left = [(d, f) for p, d, f in docs if p == part]
            gone = []
            for step, name in enumerate(order, 1):
                caught = [d for d, f in left if name in f]
                own = [f for p, _, f in docs if p == part and f == {name}]
                kept = [(d, f) for d, f in left if name not in f]
                out[part, "".join(order), step] = [
                    len(kept), len(caught), sum(name in f for f in gone), len(own), sum(d in good for d in caught), sum(d in toxic for d in caught)
                ]
                gone += [f for _, f in left if name in f]
                left = kept
                shapley[part, name] = shapley.get((part, name), 0) + len(caught)
    return {(p, o, s): [*v, shapley[p, o[s - 1]]] for (p, o, s), v in out.items()}


def test_audit_against_a_replay(spark, documents):
    long = prose(1, 120)
    rows = [(k, prose(k % 9, 90 + k), "en" if k % 3 else "de") for k in range(30)]
    rows += [(100 + k, long, None) for k in range(5)] + [(99, long, "fr"), (None, long, "fr"), (None, None, None), (40, None, ""), (41, "", "en")]
    rows += [(50, "A B " * 80, "en"), (51, long.upper() + " #", "de"), (52, "w " * 60_000, "en"), (53, long + " $", "en"), (53, long + " $", "en"), (53, long, "en")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(60)] + [(99, 1, 0), (99, 0, 1), (None, 1, 1), (53, None, None), (7777, 1, 1)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    docs = documents(rows, good=1, part=2, id=3, n=4, profile="x", filter="y")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(docs, table).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in got} == replay(rows, labels)
    assert len(got) == 600 * len({lang or "" for _, _, lang in rows})
    assert audit(documents([]), table).count() == 0
    bare = audit(docs, table.limit(0)).where("filter_order = 'EDCBA' and step = 1 and part = ''").head()
    assert (bare["good_lost"], bare["toxic_lost"], bare["removed"]) == (0, 0, 6)
