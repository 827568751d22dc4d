"""Chat formatting: conversations as windows of a token budget, with a loss mask."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET = 1024  # tokens of a window
HISTORY_TOKENS, HISTORY_TURNS = 256, 4  # of earlier turns that a window repeats
BLOCK = 128  # turns that are laid out together; a new block starts a new window
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A turn is <s>[ROLE]role[/ROLE], a line feed, its text, </s> and a line feed. In roles and
# texts a backslash after its first character breaks a control string, and backslashes
# are doubled, so that texts are read back as they were.
_ESCAPE = re.compile(r"\\|<(?=/?s>|</?SYS>>)|\[(?=/?(?:ROLE|INST)\])")
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\]\n(.*?)</s>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m.group() == "\\" else m.group() + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def turn_text(role: str, text: str) -> str:
    return f"<s>[ROLE]{escape(role)}[/ROLE]\n{escape(text)}</s>\n"


def read_turns(window: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(window)]


def spans(tokens: list[int], room: int) -> list[tuple[int, int]]:
    """Turn-aligned spans [a, b) of at most ``room`` tokens, by prefix sums; a longer turn is alone."""
    sums = np.concatenate([[0], np.cumsum(tokens)])
    out, a = [], 0
    while a < len(tokens):
        b = max(a + 1, int(np.searchsorted(sums, sums[a] + room, side="right")) - 1)
        out.append((a, b))
        a = b
    return out


def layout(turns: list[tuple], system: tuple | None, budget: int, history: tuple[int, int]) -> list[dict]:
    """Windows over ``turns`` (repeated, role, text, tokens), of which the first ones may be
    turns of the block before, to be repeated only."""
    old = sum(t[0] for t in turns)
    new = turns[old:]
    reserve = min(system[2] if system else 0, budget // 4)
    out = []
    for a, b in spans([t[3] for t in new], budget - reserve - history[0]):
        first, used = old + a, 0
        lead: list[tuple] = []
        while first > 0 and len(lead) < history[1] and used + turns[first - 1][3] <= history[0]:
            first -= 1
            used += turns[first][3]
            lead.insert(0, turns[first])
        if system:
            lead = [t for t in lead if (t[1], t[2]) != (system[0], system[1])]
            if (new[a][1], new[a][2]) != (system[0], system[1]):
                lead.insert(0, (True, *system))
        text, loss = "".join(turn_text(t[1], t[2]) for t in lead), []
        for t in new[a:b]:
            piece = turn_text(t[1], t[2])
            if t[1] == "assistant":
                end = len(text) + len(piece) - len("</s>\n")
                loss.append((end - len(escape(t[2])), end))
            text += piece
        total = sum(t[3] for t in lead) + sum(t[3] for t in new[a:b])
        out.append({"n_repeated": len(lead), "n_turns": b - a, "n_tokens": total, "over_budget": total > budget, "formatted": text, "loss": loss})
    return out


_WINDOW = (
    "conv_id long, block long, window int, n_repeated int, n_turns int, n_tokens long, over_budget boolean, "
    "formatted string, loss_starts array<int>, loss_ends array<int>"
)


def windows(turns: DataFrame, budget: int = BUDGET, history: tuple[int, int] = (HISTORY_TOKENS, HISTORY_TURNS),
            vocabulary: str = VOCABULARY) -> DataFrame:
    """Formatted windows of conversations, from rows (conv_id, turn, role, text).

    Prefix sums of the turns' tokens choose spans of whole turns that leave room in the
    budget for the system turn and some history. A window starts with the conversation's
    first system turn, repeats the last turns before its span (at most ``history`` tokens
    and turns) and then has the span. loss_starts and loss_ends are character places of
    assistant texts in the span, so that each is a target once, in one window; what is
    repeated is masked. A turn over the budget has a window of its own, marked so.

    Turns are laid out in blocks of BLOCK turn numbers, so a conversation of any length is
    many small groups. Turns are ordered by turn, null first, then role and text; repeated
    rows are turns like others. Null roles and texts are empty; null conv_ids are one
    conversation; an empty table gives no rows; extra columns are not read. The vocabulary
    file is read on the driver and sent to the executors.
    """
    spark = turns.sparkSession
    data = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.value.splitlines())}
        coder = tiktoken.Encoding("turns", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = [turn_text(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            n = [len(coder.encode_ordinary(t)) for t in texts]
            yield pa.record_batch([*batch.columns, pa.array(n, pa.int64())], ["conv_id", "turn", "role", "text", "tokens"])

    empty = F.lit("")
    plain = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    measured = "conv_id long, turn long, role string, text string, tokens long"
    number = F.coalesce("turn", F.lit(-1))
    block = F.floor(number / BLOCK)
    place = lambda b, old: F.struct(b.alias("block"), F.lit(old).alias("old"))
    # The last turns of a block are history of the next one too.
    places = F.when(F.pmod(number, F.lit(BLOCK)) >= BLOCK - history[1], F.array(place(block, False), place(block + 1, True)))
    places = F.explode(places.otherwise(F.array(place(block, False))))
    rows = plain.mapInArrow(measure, measured).select("*", places.alias("place")).select("*", "place.*").drop("place")
    turn = F.struct((~F.col("old")).alias("new"), "turn", "role", "text", "tokens")
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.max(~F.col("old")).alias("any"))
    system = plain.where("role = 'system'").mapInArrow(measure, measured).groupBy(F.col("conv_id").alias("_conv")).agg(
        F.min(F.struct("turn", "role", "text", "tokens")).alias("system")
    )
    blocks = blocks.where("any").join(system, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, block, turns, system in zip(*(batch.column(i).to_pylist() for i in range(4))):
                first = (system["role"], system["text"], system["tokens"]) if system else None
                own = [(not t["new"], t["role"], t["text"], t["tokens"]) for t in turns]
                for i, w in enumerate(layout(own, first, budget, history)):
                    out.append((conv, block, i, w["n_repeated"], w["n_turns"], w["n_tokens"], w["over_budget"], w["formatted"],
                                [a for a, _ in w["loss"]], [b for _, b in w["loss"]]))
            columns = list(zip(*out)) if out else [()] * 10
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _WINDOW.split(", ")])

    return blocks.select("conv_id", "block", "turns", "system").mapInArrow(lay, _WINDOW)


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from windows: one row per conversation with digests of its turns
    and of the text under the loss mask.

    A digest runs over a conversation from its first window to its last. The windows of one
    come sorted to one task, which holds one of them at a time.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in schema.split(", ")])
            done.clear()
            return out

        def finish() -> None:
            if state:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for batch in batches:
            for conv, repeated, text, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if state is None or state[0] != conv:
                    finish()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = read_turns(text)[repeated:]
                state[1] += len(turns)
                state[2].update("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends))
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(text)
            if done:
                yield flush()
        finish()
        if done:
            yield flush()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    return ordered.select("conv_id", "n_repeated", "formatted", "loss_starts", "loss_ends").mapInArrow(read, schema)
