"""Suffix-array removal of byte strings that repeat across documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import row_key, staged

LENGTH = 50  # bytes of a repeated string
GRAM = 20  # bytes of an anchor
PIECE = 1 << 20  # bytes of text handled at once
HELD = 1 << 20  # entries a task gathers before it passes them on
RANGE = 1 << 22  # bytes of text for each range of hash values
SYMBOL = 7  # bytes of a symbol of the suffix array
CROWD, CROWDED = 256, 1 << 16  # leaders of one anchor in a task, and in a range, from which it is split
DEPTH = 6  # symbols that every string of LENGTH bytes contains; 8 bytes are left over
_MIX = np.uint64(0x9E3779B97F4A7C15)


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes, by linear grouping.

    ``text`` ends with a symbol smaller than any other. First the suffixes are grouped by
    their Lyndon prefix: starting from groups of equal first symbols, groups are taken in
    descending order; each suffix of one points to the nearest earlier suffix of a lower
    group, and the suffixes pointed at are moved, by how many point at them, into new groups
    right behind their own. Then, from the smallest suffix on, each one places the chain of
    previous smaller suffixes before it at the front of their groups. Nothing is renamed or
    solved recursively.
    """
    n = len(text)
    counts = np.bincount(text)
    begin = np.concatenate([[0], np.cumsum(counts)])
    order = np.argsort(text, kind="stable").tolist()  # groups are stretches of this list
    group = begin[text].tolist()  # a group is named by where it starts
    end = [0] * (n + 1)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        end[a] = b
    place = [0] * n
    for i, s in enumerate(order):
        place[s] = i
    previous = [-1] * n
    high = n
    while high:
        low = group[order[high - 1]]
        times: dict[int, int] = {}
        for s in sorted(order[low:high]) if high - low > 1 else order[low:high]:
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        high = low
        if not times:
            continue
        levels: dict[int, list[int]] = {}
        for p, c in times.items():
            levels.setdefault(c, []).append(p)
        for c in sorted(levels, reverse=True):
            moved: dict[int, int] = {}
            for p in levels[c]:
                g = group[p]
                e = end[g] - 1
                end[g] = e
                q, i = order[e], place[p]
                order[i], place[q] = q, i
                order[e], place[p] = p, e
                moved[g] = moved.get(g, 0) + 1
            starts = {g: end[g] for g in moved}
            for g, k in moved.items():
                end[starts[g]] = starts[g] + k
            for p in levels[c]:
                group[p] = starts[group[p]]
    front = list(range(n + 1))
    placed = [False] * n
    result = [0] * n
    result[0], placed[n - 1] = n - 1, True
    for i in range(n):
        s = result[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            result[front[g]] = s
            front[g] += 1
            placed[s] = True
            s = previous[s]
    return result


def _anchor_hashes(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of all runs of GRAM bytes."""
    a = x.astype(np.uint32)
    words = a[:-3] | a[1:-2] << np.uint32(8) | a[2:-1] << np.uint32(16) | a[3:] << np.uint32(24)
    m = len(x) - GRAM + 1
    v = np.zeros(m, np.uint64)
    for j in range(0, GRAM, 4):
        v ^= words[j : j + m]
        v *= _MIX
    v ^= v >> np.uint64(29)
    v *= _MIX
    return v


def _window_minima(v: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        v = np.minimum(v[:-reach], v[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        base, inverse = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _POWERS["up"] = np.multiply.accumulate(np.full(n, base, np.uint64))
            _POWERS["down"] = np.multiply.accumulate(np.full(n, inverse, np.uint64))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def runs(text: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Cuts all strings of LENGTH bytes into runs that share an anchor.

    ``text`` holds several documents end to end, which begin at ``starts``. The anchor of a
    string is the first of its runs of GRAM bytes with the smallest hash, so equal strings
    have equal anchors at equal places, wherever they stand. A run is a stretch of
    consecutive strings with the same anchor; its context is the bytes they span.
    """
    empty = np.zeros(0, np.int64)
    none = dict.fromkeys(("doc", "first", "count", "offset"), empty) | {"anchor": empty.astype(np.uint64), "context": empty.astype(np.uint64)}
    if len(text) < LENGTH:
        return none
    v = _anchor_hashes(text)
    position = np.arange(len(v), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    minima = _window_minima((v & ~low) | position, LENGTH - GRAM + 1)
    ends = np.append(starts[1:], len(text))
    doc = np.repeat(np.arange(len(starts)), ends - starts)
    inside = doc[: len(minima)] == doc[LENGTH - 1 : LENGTH - 1 + len(minima)]
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    anchor = (minima[at] & low).astype(np.int64)
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)))
    first, last, anchor = at[new], at[np.append(new[1:], len(at)) - 1], anchor[new]
    up, down = _powers(len(text) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((text + np.uint64(1)) * up[: len(text)])])
    context = (sums[last + LENGTH] - sums[first]) * down[first]
    context = (context ^ (last - first).astype(np.uint64)) * _MIX
    context ^= context >> np.uint64(32)
    return {"doc": doc[first], "first": first - starts[doc[first]], "count": last - first + 1, "offset": anchor - first,
            "anchor": v[anchor] * _MIX ^ v[anchor] >> np.uint64(31), "context": context}


# As sent, an anchor is the 32 bits below those that its range tells. Two anchors that agree in them are
# compared for nothing, which the strings show; a context is known by its own 64 bits beside them.
COLUMNS = {"anchor": np.uint32, "context": np.uint64, "doc": np.int64, "key": np.int64, "first": np.int32, "count": np.uint8, "offset": np.uint8}
SPANS = {"key": np.int64, "first": np.int32, "count": np.uint8}
PLANES = ("doc", "first")


def pack(columns: dict[str, np.ndarray], kinds: dict) -> bytes:
    """Columns end to end, compressed: neighbours that repeat cost next to nothing.

    Documents, sorted at best, are told by their differences. Of them and of places all
    first bytes come first, then all second bytes and so on: the high ones are mostly zero.
    """
    n, body = len(next(iter(columns.values()))), []
    for name, kind in kinds.items():
        x = np.ascontiguousarray(columns[name].astype(kind, copy=False))
        if name == "doc":
            x = np.diff(x, prepend=x.dtype.type(0))
        body.append((x.view(np.uint8).reshape(n, x.itemsize).T if name in PLANES else x).tobytes())
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(blobs, kinds: dict) -> dict[str, np.ndarray]:
    parts = {name: [] for name in kinds}
    for blob in blobs:
        n, body, at = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:]), 0
        for name, kind in kinds.items():
            size = np.dtype(kind).itemsize
            if name in PLANES:
                x = np.ascontiguousarray(np.frombuffer(body, np.uint8, n * size, at).reshape(size, n).T).view(kind).reshape(n)
            else:
                x = np.frombuffer(body, kind, n, at)
            parts[name].append(np.cumsum(x, dtype=kind) if name == "doc" else x)
            at += n * size
    return {name: np.concatenate(x) if x else np.zeros(0, kinds[name]) for name, x in parts.items()}


def fold(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Entries sorted by anchor, context and document, and whether each is a follower.

    A follower has the context of an entry of a document with a smaller id, so that all its
    strings go; nothing else needs to be known about it.
    """
    order = np.lexsort((e["doc"], e["context"], e["anchor"]))
    e = {name: x[order] for name, x in e.items()}
    same = (e["anchor"][1:] == e["anchor"][:-1]) & (e["context"][1:] == e["context"][:-1])
    heads = np.flatnonzero(np.append(True, ~same)) if len(e["doc"]) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(e["doc"])))
    return e, e["doc"] > np.repeat(e["doc"][heads], sizes)


def groups(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the stretches of equal values."""
    heads = np.flatnonzero(np.append(len(sorted_values) > 0, sorted_values[1:] != sorted_values[:-1]))
    return heads, np.diff(np.append(heads, len(sorted_values)))


def _found(e: dict[str, np.ndarray], chosen: np.ndarray, asked: bool, split: np.ndarray | bool = False) -> pa.RecordBatch:
    """The chosen entries, each once: equal rows have equal ones."""
    chosen = np.flatnonzero(chosen)
    chosen = chosen[np.lexsort((e["first"][chosen], e["key"][chosen]))]
    key, first = e["key"][chosen], e["first"][chosen]
    chosen = chosen[np.append(True, (key[1:] != key[:-1]) | (first[1:] != first[:-1]))[: len(chosen)]]
    n = len(chosen)
    return pa.record_batch(
        [pa.array(e["key"][chosen]), pa.array(e["first"][chosen].astype(np.int32)), pa.array(e["count"][chosen].astype(np.int32)),
         pa.array(e["offset"][chosen].astype(np.int32)), pa.array(np.full(n, asked)),
         pa.array(split[chosen] if isinstance(split, np.ndarray) else np.full(n, split))],
        ["key", "first", "count", "offset", "asked", "split"],
    )


_FOUND = "key long, first int, count int, offset int, asked boolean, split boolean"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[int], list[bytes]]]:
    """(doc ids, keys, offsets in the document, texts) of about PIECE bytes at a time.

    A longer document comes in pieces that overlap, so that each string is in one of them.
    """
    docs, keys, offsets, texts, held = [], [], [], [], 0
    for batch in batches:
        for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = text.as_py()
            if doc is None or text is None or len(text) < LENGTH:
                continue
            for at in range(0, len(text) - LENGTH + 1, PIECE):
                part = text[at : at + PIECE + LENGTH - 1]
                docs.append(doc), keys.append(key), offsets.append(at), texts.append(part)
                held += len(part)
                if held >= PIECE:
                    yield docs, keys, offsets, texts
                    docs, keys, offsets, texts, held = [], [], [], [], 0
    if texts:
        yield docs, keys, offsets, texts


def anchored(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, kind, blob): the runs of all documents; kind 0 are leaders, 1 followers.

    Followers within one task are settled there, so a passage that very many documents share
    costs one entry a task and context. Entries are dealt by anchor. An anchor with many
    contexts, as over the edges of such a passage, would fill its range: where it has more
    than a range's share of a task's leaders, those are dealt by context (kind 2), and two
    of them with different documents tell the anchor's range of it (kind 3). Of followers
    only their spans are sent.
    """
    told = np.uint64(ranges.bit_length() - 1)
    shift = np.uint64(64) - told

    def send(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        e, follows = fold({name: np.concatenate([p[name] for p in parts]) for name in COLUMNS})
        part = (e["anchor"] >> shift).astype(np.int64)
        lead = np.flatnonzero(~follows)
        heads, sizes = groups(e["anchor"][lead])
        docs = e["doc"][lead]
        lowest, highest = np.minimum.reduceat(docs, heads), np.maximum.reduceat(docs, heads)
        crowd = (sizes > max(CROWD, len(lead) // ranges)) & (lowest != highest)
        crowded, markers = np.zeros(len(part), bool), np.zeros(len(part), bool)
        crowded[lead] = np.repeat(crowd, sizes)
        for h, n in zip(heads[crowd].tolist(), sizes[crowd].tolist()):
            markers[lead[h + docs[h : h + n].argmin()]] = markers[lead[h + docs[h : h + n].argmax()]] = True
        by_context = ((e["context"] * _MIX ^ e["anchor"]) * _MIX >> shift).astype(np.int64)
        e["anchor"] = (e["anchor"] << told >> np.uint64(32)).astype(np.uint32)
        rows = []
        for kind, chosen, to in ((0, ~follows & ~crowded, part), (1, follows, part), (2, crowded, by_context), (3, markers, part)):
            chosen = np.flatnonzero(chosen)
            chosen = chosen[np.argsort(to[chosen], kind="stable")]
            to = to[chosen]
            chosen = {name: x[chosen] for name, x in e.items()}
            for h, n in zip(*(x.tolist() for x in groups(to))):
                p, own = int(to[h]), {name: x[h : h + n] for name, x in chosen.items()}
                by_doc = np.argsort(own["doc"], kind="stable")
                rows.append((p, kind, pack({name: x[by_doc] for name, x in own.items()}, SPANS if kind == 1 else COLUMNS)))
        a, b, c = zip(*rows)
        yield pa.record_batch([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], ["part", "kind", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for ids, keys, offsets, texts in _pieces(batches):
            lengths = np.array([len(t) for t in texts])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            e = runs(np.frombuffer(b"".join(texts), np.uint8), starts)
            e["first"] = (e["first"] + np.array(offsets)[e["doc"]]).astype(np.int32)
            e["key"] = np.array(keys, np.int64)[e["doc"]]
            e["doc"] = np.array(ids, np.int64)[e["doc"]]
            e["count"], e["offset"] = e["count"].astype(np.uint8), e["offset"].astype(np.uint8)
            parts.append(e)
            held += len(e["doc"])
            if held >= HELD:
                yield from send(parts)
                parts, held = [], 0
        if held:
            yield from send(parts)

    return docs.mapInArrow(run, "part int, kind int, blob binary")


def settle(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one range of anchors: followers, and leaders whose strings must be compared.

    Those are the leaders of anchors with two contexts and two documents at least. Anchors
    that a task has split, or that are very many here, are marked: their strings will be
    dealt one by one. The markers and the anchor's range agree on that for all its leaders.
    """
    local = unpack(frame.loc[frame["kind"] == 1, "blob"], SPANS)
    local["offset"] = np.zeros(len(local["key"]), np.uint8)
    dealt, late = fold(unpack(frame.loc[frame["kind"] == 2, "blob"], COLUMNS))
    tables = [_found(local, np.ones(len(local["key"]), bool), False), _found(dealt, late, False), _found(dealt, ~late, True, True)]
    markers = unpack(frame.loc[frame["kind"] == 3, "blob"], COLUMNS)
    e, follows = fold(unpack(frame.loc[frame["kind"].isin([0, 3]), "blob"], COLUMNS))
    tables.append(_found(e, follows, False))
    e = {name: x[~follows] for name, x in e.items()}
    if len(e["doc"]):
        heads, sizes = groups(e["anchor"])
        several = np.minimum.reduceat(e["doc"], heads) != np.maximum.reduceat(e["doc"], heads)
        split = (sizes > CROWDED) | np.isin(e["anchor"][heads], markers["anchor"])
        # A marker's own leader may be among the followers here, so its anchor is asked in any case.
        asked = several | split
        tables.append(_found(e, np.repeat(asked, sizes), True, np.repeat(split, sizes)))
    return pa.Table.from_batches(tables).to_pandas()


CONTEXTS = {"doc": np.int64, "key": np.int64, "first": np.int32, "count": np.int32, "offset": np.int32}


def covered(contexts: dict[str, np.ndarray], text: np.ndarray) -> dict[str, np.ndarray]:
    """Of contexts of shared anchors (their bytes end to end in ``text``): the strings that
    a document with a smaller id has too, as (key, first, count).

    Each context is read as symbols of SYMBOL bytes from a grid laid through its anchor, so
    equal strings have equal symbols. In the suffix array of all symbol sequences, stretches
    whose neighbours agree in DEPTH symbols are classes. A string is known by the class of
    the DEPTH whole symbols in it and the 8 bytes beside them.
    """
    count, lengths = contexts["count"].astype(np.int64), contexts["count"].astype(np.int64) + LENGTH - 1
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    grid = contexts["offset"].astype(np.int64) % SYMBOL
    symbols = (lengths - grid) // SYMBOL
    owner = np.repeat(np.arange(len(count)), symbols)
    index = np.arange(symbols.sum()) - np.repeat(np.cumsum(symbols) - symbols, symbols)
    at = begin[owner] + grid[owner] + SYMBOL * index
    value = np.zeros(len(at), np.uint64)
    for j in range(SYMBOL):
        value = value << np.uint64(8) | text[at + j]
    ids = np.unique(value, return_inverse=True)[1] + 2
    sequence = np.ones(len(at) + len(count) + 1, np.int64)  # 1 parts the contexts, 0 ends all
    spot = np.arange(len(at)) + owner
    sequence[spot] = ids
    sequence[-1] = 0
    order = np.array(suffix_array(sequence.tolist()))
    left = np.zeros(len(sequence), np.int64)  # symbols up to the end of the own context
    left[spot] = symbols[owner] - index
    padded = np.concatenate([sequence, np.zeros(DEPTH, np.int64)])
    whole = left[order] >= DEPTH
    order = order[whole]
    same = np.ones(max(0, len(order) - 1), bool)
    for j in range(DEPTH):
        same &= padded[order[1:] + j] == padded[order[:-1] + j]
    classes = np.full(len(sequence), -1, np.int64)
    classes[order] = np.cumsum(np.append(0, ~same)) if len(order) else 0
    # All strings: their context, first byte, and the first whole symbol in them.
    own = np.repeat(np.arange(len(count)), count)
    string = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    before = (grid[own] - string) % SYMBOL
    symbol = (string + before - grid[own]) // SYMBOL
    cls = classes[(np.cumsum(symbols) - symbols + np.arange(len(count)))[own] + symbol]
    base, rest = begin[own] + string, np.zeros(len(own), np.uint64)
    for j in range(LENGTH - SYMBOL * DEPTH):
        place = np.where(j < before, j, j + SYMBOL * DEPTH)
        rest = rest << np.uint64(8) | text[base + place]
    doc = contexts["doc"][own]
    by = np.lexsort((doc, rest, before, cls))
    equal = (cls[by][1:] == cls[by][:-1]) & (rest[by][1:] == rest[by][:-1]) & (before[by][1:] == before[by][:-1])
    heads = np.flatnonzero(np.append(True, ~equal))
    repeated = np.zeros(len(own), bool)
    repeated[by] = doc[by] > np.repeat(doc[by][heads], np.diff(np.append(heads, len(by))))
    return stretches(contexts, own, string, np.flatnonzero(repeated))


def stretches(contexts: dict[str, np.ndarray], own: np.ndarray, string: np.ndarray, hit: np.ndarray) -> dict[str, np.ndarray]:
    """The strings numbered ``hit``, in order, as (key, first, count): neighbours of one context together."""
    new = np.flatnonzero(np.append(True, (hit[1:] != hit[:-1] + 1) | (own[hit[1:]] != own[hit[:-1]]))) if len(hit) else hit
    first = hit[new]
    return {"key": contexts["key"][own[first]], "first": contexts["first"][own[first]] + string[first].astype(np.int32),
            "count": np.diff(np.append(new, len(hit))).astype(np.int32)}


def single_strings(contexts: dict[str, np.ndarray], text: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Contexts cut into their strings: (strings as contexts of one, their bytes, their hashes,
    what is settled). Of strings equal byte by byte those of the smallest document stay; the
    others are settled, as (key, first, count)."""
    count = contexts["count"].astype(np.int64)
    own = np.repeat(np.arange(len(count)), count)
    string = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    rows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[begin[own] + string]
    mixed = np.zeros(len(own), np.uint64)
    for j in range(LENGTH):
        mixed = (mixed ^ rows[:, j]) * _MIX
        mixed ^= mixed >> np.uint64(32)
    doc, offset = contexts["doc"][own], contexts["offset"][own] - string
    by = np.lexsort((doc, offset, mixed))
    same = (rows[by][1:] == rows[by][:-1]).all(1) & (offset[by][1:] == offset[by][:-1])
    heads = np.flatnonzero(np.append(True, ~same))
    follows = np.zeros(len(own), bool)
    follows[by] = doc[by] > np.repeat(doc[by][heads], np.diff(np.append(heads, len(by))))
    stay = np.flatnonzero(~follows)
    strings = {"doc": doc[stay], "key": contexts["key"][own[stay]], "first": contexts["first"][own[stay]] + string[stay],
               "count": np.ones(len(stay), np.int64), "offset": offset[stay]}
    return strings, rows[stay], mixed[stay], stretches(contexts, own, string, np.flatnonzero(follows))


def kept_bytes(text: bytes, first: list[int], count: list[int], whole: bool = False) -> tuple[bytes, int]:
    """What is left of a text without the strings that start at the given places, and the
    number of maximal removed stretches. With ``whole``, characters of which only a part
    would go stay, so that the rest is UTF-8 still."""
    steps = np.zeros(len(text) + 1, np.int32)
    np.add.at(steps, first, 1)
    np.add.at(steps, np.array(first) + np.array(count) + LENGTH - 1, -1)
    gone = np.cumsum(steps[:-1]) > 0
    if whole:
        head = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        gone = np.repeat(np.logical_and.reduceat(gone, head), np.diff(np.append(head, len(text))))
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), spans


def deduplicated(docs: DataFrame, text: bool = True, whole: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without the bytes that earlier documents hold.

    A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller
    doc_id; strings are judged on the input. Columns: doc_id, row_key, n_bytes, n_removed,
    n_spans, kept_sha256 and, unless ``text`` is false, kept (binary). ``whole`` spares
    characters of which only a part would go.

    Strings meet at their anchor, one in about sixteen positions. Anchors are dealt to
    ranges of hash values, one for each RANGE bytes of text. A context that an earlier document repeats as a whole is settled
    by its hash, first within a task and then within the range. The other contexts of shared
    anchors are compared by suffix array, range by range. An anchor with very many contexts
    is not kept in one range: they are settled by context and then compared string by string,
    dealt by the string's hash, after a task has folded its equal ones. Texts move twice in
    the plan, by the same exchange, and are never gathered.

    Null texts are empty; a null doc_id neither removes nor loses anything. Equal rows keep
    what they keep alike, as no other id is smaller; rows of one doc_id with different texts
    are separate and do not clean each other. Texts under LENGTH bytes stay whole. Extra
    columns are not read; an empty table gives no rows.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("row_key"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    n_bytes = keyed.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    ranges = 1 << max(6, (n_bytes // RANGE).bit_length())
    found = staged(anchored(keyed, ranges).groupBy("part").applyInPandas(settle, _FOUND), "anchors")
    asked = found.where("asked").groupBy("key").agg(F.collect_list(F.struct("first", "count", "offset", "split")).alias("runs"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - (ranges.bit_length() - 1))

        def dealt(kind: int, part: np.ndarray, columns: dict[str, np.ndarray], body) -> Iterator[tuple]:
            order = np.lexsort((columns["doc"], part))
            for h, n in zip(*(x.tolist() for x in groups(part[order]))):
                p, own = int(part[order[h]]), order[h : h + n]
                yield p, kind, pack({n: x[own] for n, x in columns.items()}, CONTEXTS), zstandard.ZstdCompressor(level=1).compress(body(own))

        def by_anchor(entries: list[tuple], anchors: list[bytes], bodies: list[bytes]) -> Iterator[tuple]:
            columns = np.array(entries, np.int64).reshape(-1, 5)
            hashes = np.frombuffer(b"".join(anchors), np.uint8).reshape(-1, GRAM).astype(np.uint64)
            mixed = np.zeros(len(hashes), np.uint64)
            for j in range(GRAM):
                mixed = (mixed ^ hashes[:, j]) * _MIX
                mixed ^= mixed >> np.uint64(32)
            columns = {n: columns[:, i] for i, n in enumerate(CONTEXTS)}
            return dealt(0, (mixed >> shift).astype(np.int64), columns, lambda own: b"".join([bodies[i] for i in own]))

        def by_string(entries: list[tuple], bodies: list[bytes]) -> Iterator[tuple]:
            columns = np.array(entries, np.int64).reshape(-1, 5)
            columns = {n: columns[:, i] for i, n in enumerate(CONTEXTS)}
            strings, rows, mixed, settled = single_strings(columns, np.frombuffer(b"".join(bodies), np.uint8))
            yield from dealt(0, (mixed >> shift).astype(np.int64), strings, lambda own: rows[own].tobytes())
            settled |= {"doc": settled["key"] * 0, "offset": settled["key"] * 0}
            yield from dealt(1, settled["key"] & (ranges - 1), settled, lambda own: b"")

        def packed(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            columns = list(zip(*rows))
            if columns:
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "kind", "entries", "bodies"])

        entries, anchors, bodies, single, single_bodies = [], [], [], [], []
        for batch in batches:
            for doc, key, text, own in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for r in own:
                    a, n, o = r["first"], r["count"], r["offset"]
                    if r["split"]:
                        single.append((doc, key, a, n, o))
                        single_bodies.append(text[a : a + n + LENGTH - 1])
                        if len(single) >= HELD // 128:
                            yield from packed(by_string(single, single_bodies))
                            single, single_bodies = [], []
                        continue
                    entries.append((doc, key, a, n, o))
                    anchors.append(text[a + o : a + o + GRAM])
                    bodies.append(text[a : a + n + LENGTH - 1])
                if len(entries) >= HELD // 8:
                    yield from packed(by_anchor(entries, anchors, bodies))
                    entries, anchors, bodies = [], [], []
        if entries:
            yield from packed(by_anchor(entries, anchors, bodies))
        if single:
            yield from packed(by_string(single, single_bodies))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        settled, frame = unpack(frame.loc[frame["kind"] == 1, "entries"], CONTEXTS), frame[frame["kind"] == 0]
        out = pd.DataFrame({name: settled[name] for name in ("key", "first", "count")})
        if len(frame):
            body = b"".join(zstandard.ZstdDecompressor().decompress(x) for x in frame["bodies"])
            out = pd.concat([out, pd.DataFrame(covered(unpack(frame["entries"], CONTEXTS), np.frombuffer(body, np.uint8)))])
        return out

    span = "key long, first int, count int"
    compared = (
        keyed.join(asked, keyed["row_key"] == asked["key"]).select("doc_id", "row_key", "text", "runs")
        .mapInArrow(contexts, "part int, kind int, entries binary, bodies binary")
        .groupBy("part").applyInPandas(compare, span)
    )
    spans = found.where("not asked").select("key", "first", "count").union(compared)
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("first", "count")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, key, text, own in zip(*(batch.column(i).to_pylist() for i in range(4))):
                kept, n = kept_bytes(text, [r["first"] for r in own], [r["count"] for r in own], whole) if own else (text, 0)
                rows.append((doc, key, len(text), len(text) - len(kept), n, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            out = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.record_batch(out if text_wanted else out[:6], names if text_wanted else names[:6])

    text_wanted, names = text, ["doc_id", "row_key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    schema = "doc_id long, row_key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text
    joined = keyed.join(spans, keyed["row_key"] == spans["key"], "left").select("doc_id", "row_key", "text", "spans")
    return joined.mapInArrow(cut, schema)


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with texts cut, and n_chars with them; rows that lose all their words go.

    Whole characters are removed only. Other columns, and null texts, stay as they are.
    """
    kept = deduplicated(docs, whole=True).where("n_removed > 0").select(
        F.col("row_key").alias("_key"), F.col("kept").cast("string").alias("_kept")
    )
    cut = docs.join(kept.dropDuplicates(["_key"]), row_key(docs) == F.col("_key"), "left")
    cut = cut.where("_kept is null or trim(_kept) <> ''")
    new = {"text": F.coalesce("_kept", "text"), "n_chars": F.coalesce(F.length("_kept").cast("long"), "n_chars") if "n_chars" in docs.columns else None}
    return cut.select(*((new[c].alias(c) if c in new else F.col(f"`{c}`")) for c in docs.columns))
